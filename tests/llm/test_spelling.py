import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.spelling import spelling_variants

from .helpers import documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def vocabulary(docs, noise=97):
    n = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs, noise=97):
    """All pairs of words, as the definition says."""
    n = vocabulary(docs, noise)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if is_near(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_op12_over_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = rows(queries.op12_spelling_variants(spark, sf_dir))
    assert got == brute(docs) and any(r[1] for r in got)


def test_inserted_deleted_replaced_and_chains(spark):
    texts = ["colour " * 40, "color " * 20, "colours " * 9, "colourss colourss colourss colourss", "kolourss kolourss kolourss", "aaaaa " * 4, "aaaaaa " * 9, "aaaaaaa " * 30,
             "baaaaa aaaaab aabaaa " * 3, "tïtlé tïtle tïtlé " * 5, "ÀÈÌÒÙ àèìòù " * 4, "straße×x " * 7, "strasse " * 7, "house House HOUSE mouse mouse mouse", "house", None, "", " \n"]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.where("doc_id < 9")).unionByName(docs.where("doc_id = 12").withColumn("doc_id", F.lit(None).cast("long")))
    for noise in (97, 2):
        assert rows(spelling_variants(docs, noise)) == brute([(r.doc_id, r.text) for r in docs.collect()], noise)


def test_very_long_words_and_empty_tables(spark):
    long = "abcdefghij" * 3000
    texts = [f"{long} {long}x {long[:100]}y{long[101:]} {long} {long}x", f"{long} {long}x {long[:100]}y{long[101:]} " * 2]
    docs = documents(spark, texts)
    assert rows(spelling_variants(docs, 10**9)) == brute([(r.doc_id, r.text) for r in docs.collect()], 10**9)
    assert rows(spelling_variants(documents(spark, []))) == set()
    clash = docs.selectExpr("*", "1 as rank", "2 as n", "'x' as word", "3 as kind", "'y' as run", "4 as doc", "5 as h")
    assert rows(spelling_variants(clash, 10**9)) == rows(spelling_variants(docs, 10**9))
