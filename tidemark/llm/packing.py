"""Best-fit packing of documents into sequences, planned on a histogram of lengths.

Documents of one length are interchangeable, so best-fit decreasing runs over
the counts of lengths: at most ``capacity`` numbers, whatever the corpus.  The
plan is a short list of slot ranges, and documents take their slots by joining
on their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import salted_rank
from .shared import Scratch
from .tokens import encoder, tokenizer_json

_PLAN = "length long, lo long, hi long, sequence long, each long, place long"


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths.

    Returns rows (length, lo, hi, sequence, each, place): of the items of that
    length, those with rank lo <= r < hi go to sequence + (r - lo) // each, at
    place + (r - lo) % each * length.  Sequences that look alike are kept as
    one group (first sequence, how many), so the work depends on the number
    of lengths and not on that of the items.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    rows = []
    fresh = 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, many))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        rank, n = 0, counts[length]
        while rank < n:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, many = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[k]
            else:
                room, first = capacity, fresh
                many = -(-(n - rank) // (capacity // length))
                fresh += many
            each = room // length
            whole = min(many, (n - rank) // each)
            if whole:
                rows.append((length, rank, rank + whole * each, first, each, capacity - room))
                put(room - each * length, first, whole)
                rank += whole * each
            rest = n - rank if whole < many else 0
            if rest:
                rows.append((length, rank, n, first + whole, rest, capacity - room))
                put(room - rest * length, first + whole, 1)
                whole, rank = whole + 1, n
            put(room, first + whole, many - whole)
    return rows


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None, with_ids: bool = False) -> DataFrame:
    """Encode every whole text, add end_id, and cut what is longer than capacity.

    One row per piece: doc_id, piece (from 0), start (the document's ids before
    it), length, ids_crc32 (of little-endian unsigned 32-bit ids) and, on
    request, ids.  A null or empty text is a document of the end id alone (of
    no pieces without an end id).  Repeated doc_ids are separate documents.
    """
    source = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(source.value)
        for batch in batches:
            ids, at = enc.encode(batch.column(1))
            ids = ids.astype("<u4")
            if end_id is not None:
                ids = np.insert(ids, at[1:], np.uint32(end_id))
                at = at + np.arange(len(at))
            size = np.diff(at)
            many = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            begin = at[row] + start
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begin, begin + length, strict=True)]
            out = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array([ids[a:b] for a, b in zip(begin, begin + length, strict=True)], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, kind)


def pack_best_fit(pieces: DataFrame, capacity: int, salts: int = 256) -> DataFrame:
    """Place pieces (length in 1..capacity; any other columns) into as few sequences as best fit finds.

    Adds sequence_id (0, 1, ...) and offset, the piece's place in its sequence;
    a sequence is filled from 0 without gaps.  The histogram that the driver
    plans on has at most ``capacity`` rows, and the plan, whose size depends on
    capacity alone, is broadcast.  A length that a third of all pieces share is
    ranked in ``salts`` parts.  An empty table stays empty.  pieces is read
    three times: hand in a stored table.  Its other columns stay, whatever their names; a sequence_id or
    offset of its own is replaced.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(plan_best_fit(counts, capacity), _PLAN)
    plan = plan.select(*(F.col(c).alias(f"__{c}") for c in plan.columns))
    ranked = salted_rank(pieces.drop("sequence_id", "offset"), ["length"], ["doc_id", "piece"], "__rank", salts)
    at = F.col("__rank") - F.col("__lo")
    slot = ranked.join(F.broadcast(plan), (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi")))
    return slot.withColumns({"sequence_id": F.col("__sequence") + F.floor(at / F.col("__each")), "offset": F.col("__place") + F.pmod(at, F.col("__each")) * F.col("length")}).drop("__rank", *plan.columns)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack a corpus: token_pieces() stored once, then pack_best_fit().  Of docs only doc_id and text are read."""
    pieces = Scratch(docs.sparkSession, "pack").keep(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return pack_best_fit(pieces, capacity)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """Training rows of pieces packed with ids: sequence_id, ids, and where each document starts."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("in"))
    return rows.select("sequence_id", F.flatten("in.ids").alias("ids"), F.col("in.offset").alias("offsets"), F.col("in.doc_id").alias("doc_ids"))
