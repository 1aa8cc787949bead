import random

import duckdb
import numpy as np

from tidemark.llm import near_dedup, parity_join, queries
from tidemark.llm.parity_join import SizeBands, block_keys, folded_sketch, jaccard_join

from .helpers import base_texts, documents, shingles


def brute(docs, width=4, percent=85):
    sets = {i: shingles(t, width) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    for a, b in {(a, b) for group in index.values() for a in group for b in group if a < b}:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {(i, len(s), find(i)) for i, s in sets.items()}


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return {tuple(r) for r in df.collect()}


def test_op13_over_documents_and_its_sql(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = found(queries.op13_ngram_jaccard_join(spark, sf_dir))
    assert got == brute(docs) and any(i != c for i, _, c in got)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert got == set(c.sql(queries.ORACLES["op13_ngram_jaccard_join"]).fetchall())


def copies(seed, sizes, most):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    out = []
    for n in sizes:
        base = [rng.choice(vocab) for _ in range(n)]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, max(1, n * most // 100))):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice(([rng.choice(vocab)], [], [w[k], rng.choice(vocab)]))
            out.append(" ".join(w))
        out += [" ".join(base + base[: n // 9] + [f"tail{k}" for k in range(n // 12)]), " ".join(base[n // 8 :])]
    return out


def test_near_copies_of_all_sizes_and_edge_cases(spark):
    texts = base_texts() + copies(1, (3, 6, 9, 20, 33, 60, 150, 900), 6)
    docs = documents(spark, texts)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = jaccard_join(docs.unionByName(docs.where("doc_id < 9")))
    assert got.count() == len(texts) + 3 and found(got) == want
    nameless = docs.where("doc_id = 6").selectExpr("cast(null as long) as doc_id", "text", "lang", "source", "n_chars", "id", "length", "key", "size", "component")
    assert found(jaccard_join(docs.limit(5).unionByName(nameless))) >= {(None, len(shingles(texts[2], 4)), None)}
    assert found(jaccard_join(documents(spark, []))) == set()
    assert found(jaccard_join(documents(spark, ["", None, " ", "a b"]))) == {(0, 0, 0), (3, 0, 3), (6, 0, 6), (9, 1, 9)}


def test_a_link_always_shares_a_key_and_sketches_bound_the_difference():
    rng, bands = np.random.default_rng(2), SizeBands(85)
    keys = {}
    for n in [*range(1, 60), 100, 301, 999, 5000]:
        for extra in {0, n // 20, n * 15 // 185, n * 15 // 100}:
            union = rng.integers(0, 2**63, n + extra).astype(np.uint64)
            for a, b in ((union[:n], union), (union[: n + extra - extra // 2], union[extra // 2 :])):
                inter, all_ = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                for words in (32, 64):
                    far = int(np.bitwise_count(folded_sketch(a, words) ^ folded_sketch(b, words)).sum())
                    assert far <= all_ - inter
                double = folded_sketch(a, 64)
                assert (double[:32] ^ double[32:] == folded_sketch(a, 32)).all()
                if 100 * inter >= 85 * all_ and inter < all_:
                    x, y = (set(block_keys(np.sort(s), bands).tolist()) for s in (a, b))
                    assert x & y, (n, extra)
                    keys[n] = max(len(x), len(y))
    assert all(v <= n + 8 for n, v in keys.items())


def test_empty_blocks_do_not_collect_unrelated_sets():
    rng, bands = np.random.default_rng(3), SizeBands(85)
    count = {}
    for n in (12, 40, 300):
        for _ in range(600):
            for k in block_keys(np.sort(rng.integers(0, 2**63, n).astype(np.uint64)), bands).tolist():
                count[k] = count.get(k, 0) + 1
    assert max(count.values()) < 40


def test_groups_in_rounds_and_in_tasks_lose_no_link(spark, monkeypatch):
    """Chains, versions with many copies and passages that all texts share, with buckets ended early, late and not at all."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(vocab) for _ in range(40))
    texts = []
    for _ in range(5):
        w = [rng.choice(vocab) for _ in range(90)]
        for _ in range(22):
            w = list(w)
            w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w) if rng.random() < 0.6 else passage + " " + " ".join(w[40:]))
    docs = documents(spark, texts)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for rounds, bucket in ((1, 2), (2, 3)):
        monkeypatch.setattr(parity_join, "_ROUNDS", rounds)
        monkeypatch.setattr(parity_join, "_BUCKET", bucket)
        assert found(jaccard_join(docs)) == want


def test_a_forest_of_near_pairs_joins_what_all_of_them_join():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 150).astype(np.uint64)
    sets = [np.concatenate((rng.permutation(base)[: 150 - int(k)], rng.integers(0, 2**63, int(k)).astype(np.uint64))) for k in rng.integers(0, 30, 300)]
    ids, n = np.arange(300) * 5, np.full(300, 150)
    sketches = np.array([folded_sketch(s, 32) for s in sets])

    def joined(forest):
        root, count = {i: i for i in ids.tolist()}, 0
        for g, a in parity_join.near_pairs(ids, n, ids.copy(), sketches, 85, forest):
            for x, y in zip(g.tolist(), a.tolist(), strict=True):
                count += 1
                low, high = sorted((root[x], root[y]))
                root = {i: low if r == high else r for i, r in root.items()}
        return root, count

    (all_, pairs), (some, few) = joined(False), joined(True)
    assert all_ == some and len(set(all_.values())) > 20 and few == 300 - len(set(all_.values())) and pairs > 20 * few


def test_members_that_a_centre_leaves_open_are_not_paired_with_one_another(spark, monkeypatch):
    """Variants too far from what they come from to be linked, each with a copy near the bound: rows grow with their number."""
    met, real, reopened, only = [], near_dedup.meet, [], parity_join._Buckets.only

    def counting(members, *rest):
        met.append(members.count())
        return real(members, *rest)

    def counted(self, keys, name):
        only(self, keys, name)
        reopened.append(self.sets.count())

    monkeypatch.setattr(near_dedup, "meet", counting)
    monkeypatch.setattr(parity_join._Buckets, "only", counted)
    rng = random.Random(4)
    base, texts = [f"w{rng.randrange(3000)}" for _ in range(148)], []

    def changed(w, places):
        w = list(w)
        for k in places:
            w[k] = f"v{rng.randrange(10**6)}"
        return w

    for _ in range(90):
        variant = changed(base, range(rng.randrange(8), 140, rng.choice((18, 20, 46))))
        texts += [" ".join(variant), " ".join(changed(variant, rng.sample(range(10, 140, 10), 2)))]
    docs = documents(spark, texts)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(jaccard_join(docs)) == want and 20 < len({c for _, _, c in want}) < len(texts)
    assert sum(met) < 4 * len(texts) and reopened[0] > 0  # pairs that are no links though sketches left them open
