import random

import numpy as np

from tidemark.llm import near_dedup, queries
from tidemark.llm.components import connected_components
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.shared import Scratch
from tidemark.llm.shingles import FastSketch

from .helpers import base_texts, documents, shingles


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    pairs = {(a, b) for group in index.values() for a in group for b in group if a < b}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 75 * (len(sets[a]) + len(sets[b]) - inter):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_op8_over_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op8_minhash_near_dedup(spark, sf_dir).collect()}
    assert got == brute(docs)


def test_near_copies_in_chains_and_edge_cases(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    texts = base_texts()
    for _ in range(12):
        w = [rng.choice(vocab) for _ in range(rng.choice((8, 40, 300)))]
        for _ in range(rng.randint(1, 25)):
            w = list(w)
            w[rng.randrange(len(w))] = rng.choice(vocab)  # each a copy of the last: chains whose ends are not alike
            texts.append(" ".join(w))
    rng.shuffle(texts)
    docs = documents(spark, texts)
    got = near_duplicates(docs.unionByName(docs.where("doc_id < 9"))).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(got) == len(texts) + 3
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    assert near_duplicates(documents(spark, [])).count() == 0
    assert {r.kept for r in near_duplicates(documents(spark, ["", None, " "])).collect()} == {True}


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    sketch, rng = FastSketch(256), np.random.default_rng(1)
    for n in (1, 3, 60, 5000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        assert (sketch(a) < 2**63).all()
        b = np.append(a[: 3 * n // 4], rng.integers(0, 2**63, n // 4).astype(np.uint64))
        same = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sketch(a) == sketch(b)).mean() - same) < 0.2
    assert (sketch(a) == sketch(rng.permutation(a))).all()


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2200)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}


def near_group(n, seed, most=5, length=120):
    """n copies of a text of its own, each with 1 to most words replaced: pairs lie on both sides of the threshold."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocab) for _ in range(length)]
    texts = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(1, most)):
            w[rng.randrange(length)] = rng.choice(vocab)
        texts.append(" ".join(w))
    return texts


def components_by_matrix(texts):
    sets = [shingles(t) for t in texts]
    columns = {s: k for k, s in enumerate(sorted(set().union(*sets)))}
    m = np.zeros((len(sets), len(columns)), np.float32)
    for i, s in enumerate(sets):
        m[i, [columns[x] for x in s]] = 1
    inter, size = m @ m.T, m.sum(1)
    linked = 100 * inter >= 75 * (size[:, None] + size[None, :] - inter)
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(1)
        if (new == label).all():
            return [3 * int(x) for x in label]
        label = new


def test_large_groups_around_the_threshold_stay_linear_and_whole(spark, monkeypatch):
    met, real = [], near_dedup.meet

    def counting(members, *rest):
        met.append(members.count())
        return real(members, *rest)

    monkeypatch.setattr(near_dedup, "meet", counting)
    work = []
    for n in (250, 500):
        texts = near_group(n, n)
        met.clear()
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(documents(spark, texts)).collect()}
        assert [got[3 * k] for k in range(n)] == components_by_matrix(texts)
        work.append(sum(met))
    assert work[1] < 2.2 * work[0] and work[1] < 30 * 500


def test_two_versions_with_many_copies_each(spark):
    """Two large components whose members share bands but are not alike enough."""
    texts = near_group(240, 7)
    texts[120:] = [t.rsplit(" ", 24)[0] + " " + " ".join(f"v{k}" for k in range(24)) for t in texts[120:]]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(documents(spark, texts)).collect()}
    assert [got[3 * k] for k in range(240)] == components_by_matrix(texts)
