"""Benchmark items of fewer than eight words are found word for word."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm.decontaminate import BenchmarkIndex, find_benchmark, item_words, remove_contaminated

from .helpers import documents


def test_short_items_against_every_place():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(12)}"
    items = [" ".join(word() for _ in range(rng.randint(1, 7))) for _ in range(60)] + ["", "w1 w2", "w1 w2"]
    docs = [" ".join(word() for _ in range(rng.randint(0, 80))) for _ in range(200)]
    flat = item_words(pa.array(docs))
    rows = np.append(0, np.cumsum([len(x) for x in flat]))
    got = BenchmarkIndex(item_words(pa.array(items))).search(np.concatenate(flat), rows)
    want = []
    for r, d in enumerate(docs):
        w = d.split()
        for k, item in enumerate(items):
            x = item.split()
            at = next((a for a in range(len(w) - len(x) + 1) if w[a : a + len(x)] == x), None) if x else None
            if at is not None:
                want.append((r, k, at, len(x), 0))
    assert got == sorted(want) and len({n for *_, n, _ in got}) >= 4


def test_short_items_are_reported_and_removed(spark):
    items = spark.createDataFrame([(1, "What is the capital of France?"), (2, "Blue whale"), (3, "one two three four five six seven eight nine")], "item_id long, text string")
    texts = ["so: what IS the\ncapital of France? Paris", "what is the capital of Spain?", "a blue whale", "blue", "whale blue", "x one two three four five six seven eight nine", "", None]
    docs = documents(spark, texts)
    assert sorted(map(tuple, find_benchmark(docs, items).collect())) == [(0, 1, 1, 6, 0), (6, 2, 1, 2, 0), (15, 3, 1, 9, 0)]
    assert sorted(r.doc_id for r in remove_contaminated(docs, items).collect()) == [3, 9, 12, 18, 21]
