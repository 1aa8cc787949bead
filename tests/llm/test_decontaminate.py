import random

import numpy as np
import pyarrow as pa

from tidemark.llm import queries
from tidemark.llm.decontaminate import BenchmarkIndex, closest, edits_allowed, find_benchmark, item_words, remove_contaminated

from .helpers import base_texts, documents, words


def sellers(item, text):
    """Least edit distance of item to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def planted(rng, n_items=30, n_docs=120):
    vocab = [f"w{rng.randrange(400)}" for _ in range(2000)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randint(8, 60))) for _ in range(n_items)]
    docs, want = [], []
    for _ in range(n_docs):
        k, body = rng.randrange(n_items), [rng.choice(vocab) for _ in range(rng.randint(0, 300))]
        w = items[k].split()
        n = rng.randint(0, edits_allowed(len(w), 0.2))
        for _ in range(n):
            p, what = rng.randrange(len(w)), rng.randrange(3)
            w[p : p + 1] = [] if what == 0 else [rng.choice(vocab)] if what == 1 else [rng.choice(vocab), w[p]]
        p = rng.randrange(len(body) + 1)
        docs.append(" ".join(body[:p] + w + body[p:]))
        want.append((k, n))
    return items, docs, want


def test_recall_of_edited_copies_and_exact_distances():
    items, docs, want = planted(random.Random(2))
    index = BenchmarkIndex(item_words(pa.array(items)))
    flat = item_words(pa.array(docs))
    rows = np.append(0, np.cumsum([len(x) for x in flat]))
    got = {(r, k): (start, n, e) for r, k, start, n, e in index.search(np.concatenate(flat), rows)}
    assert sum((r, k) in got for r, (k, _) in enumerate(want)) >= 0.99 * len(want)
    for (r, k), (start, n, e) in got.items():
        item, text = words(items[k]), words(docs[r])
        assert e == sellers(item, text) <= edits_allowed(len(item), 0.2)
        assert sellers(item, text[start : start + n]) == e


def test_closest_stretch():
    a = np.arange(1, 9, dtype=np.uint64)
    assert closest(a, np.concatenate(([99, 98], a, [97])).astype(np.uint64)) == (0, 2, 10)
    assert closest(a, np.array([1, 2, 3, 50, 5, 6, 8], np.uint64))[0] == 2


def test_op5_against_every_item_and_document(spark, sf_dir):
    docs = {r.doc_id: words((r.text or "").lower()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: words((r.text or "").lower()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.edits for r in queries.op5_benchmark_decontamination(spark, sf_dir).collect()}
    # A match keeps at least one word triple of its item, so only such pairs need the full distance.
    grams = {}
    for k, w in items.items():
        for g in zip(w, w[1:], w[2:], strict=False):
            grams.setdefault(g, set()).add(k)
    want = {}
    for i, w in docs.items():
        for k in set().union(*(grams.get(g, ()) for g in set(zip(w, w[1:], w[2:], strict=False)))):
            if len(items[k]) >= 8 and (e := sellers(items[k], w)) <= edits_allowed(len(items[k]), 0.2):
                want[i, k] = e
    assert got == want and want


def test_odd_rows_and_own_columns(spark):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog today"), (2, None), (3, ""), (4, "too short"), (1, "The quick brown fox jumps over the lazy dog today")], "item_id long, text string")
    texts = [*base_texts(), "He said THE QUICK brown fox jumps  over the lazy\ndog today and left", "the quick brown cat jumps over the lazy dog today"]
    docs = documents(spark, texts)
    n = len(base_texts())
    got = sorted(map(tuple, find_benchmark(docs.unionByName(docs.where(f"doc_id = {3 * n}")), items).collect()))
    assert got == [(3 * n, 1, 2, 10, 0)] * 2 + [(3 * n + 3, 1, 0, 10, 1)]
    left = remove_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3 * i for i in range(n)]
    assert find_benchmark(documents(spark, []), items).count() == 0
    assert find_benchmark(docs, items.where("false")).count() == 0
    assert remove_contaminated(docs, items.where("false")).count() == len(texts)
