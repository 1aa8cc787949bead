import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries
from tidemark.llm.packing import pack_documents, packed_sequences, plan_best_fit
from tidemark.llm.sharding import RoomTree, best_fit, plan_shards, shard_documents
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.tokens import Encoder, tokenizer_json

from .helpers import base_texts, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aZé'sI.,-…<|> \n\t\x0b\x85́̇̌9", max_size=40)), max_size=12))
def test_encoder_equals_the_tokenizer(texts):
    import pyarrow as pa

    enc = test_encoder_equals_the_tokenizer.__dict__.setdefault("enc", Encoder(tokenizer_json(PATH), most_bits=6))
    texts = [t and t.encode("utf-8", "ignore").decode() for t in texts]
    ids, at = enc.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_round_trip(spark, tmp_path, tokenizer):
    out = f"{tmp_path}/set"
    docs = documents(spark).repartition(5)
    write_token_files(docs.unionByName(docs.where("doc_id = 0")), out, PATH, end_id=1)
    got = read_token_files(spark, out).collect()
    texts = [(0, base_texts()[0]), *((3 * i, t) for i, t in enumerate(base_texts()))]
    assert [r.doc_id for r in got] == sorted(i for i, _ in texts)
    start = 0
    for r, (_, t) in zip(got, texts, strict=True):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        start += len(ids)
    digests = read_token_files(spark, out, digest=True).collect()
    assert [d.ids_crc32 for d in digests] == [crc(r.ids) for r in got]


def test_token_files_of_nothing(spark, tmp_path):
    write_token_files(documents(spark, []), f"{tmp_path}/none", PATH)
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0


def test_op2_over_documents(spark, sf_dir, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op2_token_files(spark, sf_dir).collect()
    start = 0
    assert [r.doc_id for r in rows] == sorted(docs)
    for r in rows:
        ids = [*tokenizer.encode(docs[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25))
def test_plan_places_every_length_once(counts):
    rows = plan_best_fit(counts, 50)
    used = defaultdict(list)
    for length, lo, hi, sequence, each, place in rows:
        for r in range(lo, hi):
            used[sequence + (r - lo) // each].append((place + (r - lo) % each * length, length))
    assert Counter(n for s in used.values() for _, n in s) == Counter(counts)
    for s in used.values():
        at = 0
        for place, n in sorted(s):
            assert place == at
            at += n
        assert at <= 50
    # The same as best-fit decreasing over the single items.
    rooms = []
    for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(50 - n)
    assert len(used) == len(rooms)


def check_packing(rows, docs, tokenizer, capacity):
    want = Counter()
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want[(doc_id, p, a, len(part), crc(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seq = defaultdict(list)
    for r in rows:
        seq[r.sequence_id].append((r.offset, r.length))
    for s in seq.values():
        at = 0
        for a, n in sorted(s):
            assert a == at
            at += n
        assert at <= capacity
    return len(seq)


def test_op7_over_documents(spark, sf_dir, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op7_best_fit_packing(spark, sf_dir).collect()
    n = check_packing(rows, docs, tokenizer, 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 1


def test_packing_edge_cases(spark, tokenizer):
    docs = documents(spark)
    docs = docs.unionByName(docs.where("doc_id = 0")).unionByName(docs.where("doc_id = 9"))
    rows = pack_documents(docs, PATH, 64, 0, with_ids=True)
    got = rows.collect()
    check_packing(got, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 64)
    for s in packed_sequences(rows).collect():
        assert len(s.ids) == sum(r.length for r in got if r.sequence_id == s.sequence_id)
    assert pack_documents(documents(spark, []), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99)), unique=True, max_size=60), st.integers(0, 9))
def test_room_tree(keys, room):
    tree = RoomTree()
    for k in keys:
        tree.add(k)
    for k in keys[::3]:
        tree.remove(k)
    left = sorted(set(keys) - set(keys[::3]))
    assert tree.tightest(room) == min((k for k in left if k[0] >= room), default=None)
    assert tree.widest() == max(left, default=None)


def test_best_fit_with_a_fixed_capacity_opens_few():
    rows, loads = best_fit([(6, 4), (5, 2), (4, 4), (1, 2)], 10)
    assert sorted(loads) == [2] + [10] * 5 and sum(h - a for _, a, h, _ in rows) == 12


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 400), st.integers(1, 9), max_size=40), st.integers(1, 9))
def test_plan_shards_is_whole_and_near_equal(counts, shards):
    rows = plan_shards(counts, shards)
    seen, loads = defaultdict(set), [0] * shards
    for size, lo, hi, shard in rows:
        assert not seen[size] & set(range(lo, hi))
        seen[size] |= set(range(lo, hi))
        loads[shard] += size * (hi - lo)
    assert {s: set(range(n)) for s, n in counts.items()} == dict(seen)
    total, largest = sum(s * n for s, n in counts.items()), max(counts, default=0)
    assert max(loads) <= max(largest, total / shards + largest)


def check_shards(rows, docs, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    slots, of = defaultdict(list), defaultdict(set)
    text = dict(docs)
    for r in rows:
        slots[r.shard].append(r.slot)
        of[text[r.doc_id] or ""].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(s) == 1 for s in of.values())


def test_op6_over_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op6_sharding(spark, sf_dir).collect()
    check_shards(rows, docs, 24)
    loads = np.bincount([r.shard for r in rows], [r.size for r in rows], 24)
    whole = Counter()
    for _, t in docs:
        whole[t or ""] += len((t or "").encode()) + 8
    assert loads.max() <= max(max(whole.values()), 1.02 * loads.mean())


def test_sharding_edge_cases(spark):
    docs = documents(spark)
    docs = docs.unionByName(docs.where("doc_id = 0")).unionByName(docs.where("doc_id = 0"))
    check_shards(shard_documents(docs, 3).collect(), [(r.doc_id, r.text) for r in docs.collect()], 3)
    assert shard_documents(documents(spark, []), 4).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_equals_a_naive_one_of_the_same_sizes(seed):
    """Bin by bin: each size, largest first, into the fullest bin that it fits in, else into a new one."""
    rng = random.Random(seed)
    capacity = rng.choice((40, 100, 1000))
    counts = sorted({rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(1, 40))}.items(), reverse=True)
    naive = []
    for size, n in counts:
        for _ in range(n):
            fits = [b for b in range(len(naive)) if naive[b] + size <= capacity]
            if fits:
                naive[max(fits, key=lambda b: naive[b])] += size
            else:
                naive.append(size)
    rows, loads = best_fit(counts, capacity)
    assert sorted(loads) == sorted(naive)
    placed = {size: sorted((lo, hi) for s, lo, hi, _ in rows if s == size) for size, _ in counts}
    assert all(sum(hi - lo for lo, hi in placed[size]) == n for size, n in counts)
