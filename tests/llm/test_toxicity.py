import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import queries
from tidemark.llm.toxicity import LEET, CharModel, Restorer, _lattice, corpus_model, fit_toxicity, restore, score_toxicity, trigram_counts

from .helpers import base_texts, documents

LABELS = "doc_id long, quality int, toxic int"
CORPUS = ["the idiot and the pathetic loser met a worthless moron with trash and a clown that is stupid and disgusting scum"] * 30 + ["plain words go on and on about nothing in the night with this and that other thing"] * 60


def model():
    return CharModel.of(trigram_counts(pa.array(CORPUS)))


def test_hidden_words_are_restored():
    fix = Restorer(model())
    pairs = {"you 1d10t": "you idiot", "p4th3t1c $cum": "pathetic scum", "stuuuupid cl0wn": "stupid clown", "w-o-r-t-h-l-e-s-s": "worthless", "tr@sh!!!": "trash!!!", "m0r0n": "moron", "d1sgu5t1ng": "disgusting"}
    assert {k: fix(k) for k in pairs} == pairs
    assert "loser" in fix("what a l o s e r").split()[-1]


def test_plain_text_is_left_alone():
    fix = Restorer(model())
    for t in ("", "Plain text, with marks. And 42 numbers: 3.14, 1999!", "word*** other###", "2024-01-05 10:30", "Éa über ñandú"):
        assert fix(t) == t or t == "word*** other###"
    assert fix("word*** other###").replace("*", "").replace("#", "") == "word other"


def test_viterbi_finds_the_best_of_all_paths():
    from itertools import product
    from math import prod

    m, rng = model(), random.Random(8)
    tokens = ["1d10t", "cl0wn", "tr@sh", "$cum", "l.o.s.e.r", "stuuupid", "stuupiid", "dumba$$", "stupi|d", "!diot"]
    tokens += ["".join(rng.choice("abeilost013457@$!|.-#") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    for token in tokens:
        def cost(path):
            total, a, b, text = 0.0, 0, 0, ""
            for letters, extra in path:
                total += extra
                for ch in letters:
                    s = ord(ch) - 96 if "a" <= ch <= "z" else 0
                    if s or b:
                        total -= m.logp[a, b, s]
                        a, b = b, s
                text += letters
            return total - (m.logp[a, b, 0] if b else 0.0), text

        if prod(map(len, _lattice(token))) < 4000:
            best = min(map(cost, product(*_lattice(token))))[0]
            assert any(abs(cost(p)[0] - best) < 1e-9 and cost(p)[1] == restore(token, m) for p in product(*_lattice(token)))
    assert all(v.isalpha() for v in LEET.values())


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    texts = [r.text or "" for r in spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").collect()]
    return texts, CharModel.of(trigram_counts(pa.array(texts)))


def test_hidden_words_under_the_model_of_the_documents(corpus):
    fix = Restorer(corpus[1])
    pairs = {"dumba$$": "dumbass", "!diot": "idiot", "idio7": "idiot", "5h17": "shit", "sstupidd": "stupid", "stuupiid": "stupid", "stupi|d": "stupid", "f00l5": "fools", "a$$": "ass", "1d107": "idiot", "s/t/u/p/i/d": "stupid", "s,t,u,p,i,d": "stupid", "s  t  u  p  i  d": "stupid", "s\nt\nu\np\ni\nd": "stupid"}
    assert {k: fix(k) for k in pairs} == pairs
    for t in ("1999", "3.14", "$5.00", "hello", "don't", "well-known", "e.g.", "2024-01-05"):
        assert fix(t) == t


def test_no_gate_keeps_a_token_from_its_lattice(corpus):
    """Texts restored as if every token had gone through Viterbi."""
    texts, m = corpus
    fix, plain = Restorer(m), Restorer(m)

    def every(text):
        spaced = re.compile(r"(?<!\S)\S(?:\s{1,2}\S){2,}(?!\S)")
        out, at = "", 0
        for s in spaced.finditer(text):
            out += re.sub(r"\S+", lambda w: plain._word(w[0]), text[at : s.start()]) + plain._token(re.sub(r"\s+", " ", s[0].lower()))
            at = s.end()
        return (out + re.sub(r"\S+", lambda w: plain._word(w[0]), text[at:])).lower()

    for t in texts[:400]:
        assert fix(t).lower() == every(t)


def test_model_counts_every_row(spark):
    docs = documents(spark, CORPUS)
    assert np.allclose(corpus_model(docs.repartition(7)).logp, model().logp)


def test_long_tokens_are_read_to_their_end_in_linear_time():
    fix = Restorer(model())
    for t in ("a" + "#" * 60000 + "b", "a.b" * 30000, "x1" * 30000, "a " * 40000, "!" * 50000 + "aaa", "q" * 80000):
        fix(t)


def auc(s, y):
    rank = np.argsort(np.argsort(s))
    p = y == 1
    return (rank[p].sum() - p.sum() * (p.sum() - 1) / 2) / (p.sum() * (~p).sum())


def test_op3_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op3_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(np.array([r.score for r in held]), y) > 0.97
    assert np.mean([r.predicted == t for r, t in zip(held, y, strict=True)]) > 0.96


def test_hidden_toxic_words_score_like_plain_ones_and_odd_rows_do_not_crash(spark):
    bad = ["the weather is fine you idiot and more of this text", "such a stupid clown with words about nothing at all", "what a pathetic loser he is on this day"]
    good = ["the weather is fine my friend and more of this text", "such a kind actor with words about nothing at all", "what a lovely person he is on this day"]
    texts = (bad + good) * 20 + ["the weather is fine you 1d10t and more of this text", *base_texts()]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(3 * i, 1, int(i % 6 < 3)) for i in range(120)], LABELS)
    got = {r.doc_id: r.score for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()}
    assert len(got) == len(texts)
    assert min(got[3 * i] for i in range(3)) > 0.7 and max(got[3 * i] for i in range(3, 6)) < 0.5 and got[360] > 0.7
    assert score_toxicity(docs, fit_toxicity(docs, labels.where("toxic = 0"))).count() == len(texts)
    assert score_toxicity(documents(spark, []), fit_toxicity(docs, spark.createDataFrame([], LABELS))).count() == 0
