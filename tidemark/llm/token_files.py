"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

A data set is a folder.  Each writing task leaves three files:

* ``part-P-A.ids``  - token ids of its documents one after the other, uint16
  (uint32 where the tokenizer's ids need it), little endian;
* ``part-P-A.off``  - n + 1 offsets into them, int64, little endian;
* ``part-P-A.doc``  - the n document ids, int64, little endian;

and ``manifest`` (Parquet) names the parts in order with their counts.  A part
holds a range of document ids in ascending order.  The place of a part in the
whole stream is the sum of the parts before it, so no task waits for another.
P is the partition and A the task attempt: a part that a lost or slower
attempt wrote is not in the manifest and is never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import encoder, tokenizer_json

_MANIFEST = "part string, partition int, docs long, tokens long, width int"


def _fs(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{uri}")


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """Encode every whole text and write the data set; returns its manifest.

    docs: doc_id and text (other columns are ignored).  tokenizer: path of a
    tokenizers JSON file, read on the driver.  end_id: appended to every
    document.  Null and empty texts have no ids but the end id; repeated
    doc_ids are kept, next to each other, in the order of their texts; an empty
    table gives an empty manifest.  A null doc_id counts as the smallest, and
    is written as -2**63.
    """
    spark = docs.sparkSession
    source = spark.sparkContext.broadcast(tokenizer_json(tokenizer))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, files, n, total = encoder(source.value), None, 0, 0
        wide = enc.tokenizer.get_vocab_size() > 65536 or (end_id or 0) > 65535
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                task = TaskContext.get()
                part = f"part-{task.partitionId():07d}-{task.taskAttemptId()}"
                fs, root = _fs(out)
                fs.create_dir(root, recursive=True)
                files = [fs.open_output_stream(f"{root}/{part}.{x}") for x in ("ids", "off", "doc")]
                files[1].write(np.zeros(1, "<i8").tobytes())
            ids, at = enc.encode(batch.column(1))
            ids = ids.astype("<u4" if wide else "<u2")
            if end_id is not None:
                ids = np.insert(ids, at[1:], np.array(end_id, ids.dtype))
                at = at + np.arange(len(at))
            files[0].write(ids.tobytes())
            files[1].write((at[1:] + total).astype("<i8").tobytes())
            files[2].write(batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n, total = n + batch.num_rows, total + len(ids)
        if files is not None:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n]), pa.array([total]), pa.array([4 if wide else 2], pa.int32())], ["part", "partition", "docs", "tokens", "width"])

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{out}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{out}/manifest")


class TokenFile:
    """One part, memory-mapped where the folder is a local or mounted one."""

    def __init__(self, root: str, part: str, width: int):
        fs, path = _fs(root)
        kind = "<u4" if width == 4 else "<u2"
        self.ids, self.off, self.doc = (self._open(fs, f"{path}/{part}.{x}", k) for x, k in (("ids", kind), ("off", "<i8"), ("doc", "<i8")))

    @staticmethod
    def _open(fs, path: str, kind: str) -> np.ndarray:
        if not fs.get_file_info(path).size:
            return np.zeros(0, kind)
        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            return np.memmap(path, kind, "r")
        with fs.open_input_file(path) as f:
            return np.frombuffer(f.read_buffer(), kind)

    def __len__(self) -> int:
        return len(self.doc)

    def __getitem__(self, k: int) -> np.ndarray:
        return self.ids[self.off[k] : self.off[k + 1]]


def read_token_files(spark: SparkSession, out: str, digest: bool = False) -> DataFrame:
    """The documents of a data set in stored order: doc_id, start, n_tokens and their ids.

    start: ids of all documents before this one.  ids: array<int>; with digest,
    ids_crc32 instead, the CRC-32 of the ids as little-endian unsigned 32-bit
    integers.  Each task maps the parts it is given; the manifest, a row per
    part, is all that the driver sees.  A doc_id written as -2**63 is null again.
    """
    import zlib

    parts = spark.read.schema(_MANIFEST).parquet(f"{out}/manifest").orderBy("partition").collect()
    bases = np.cumsum([0, *(p.tokens for p in parts)]).tolist()
    table = spark.createDataFrame([(p.part, p.width, b) for p, b in zip(parts, bases, strict=False)], "part string, width int, base long")

    def read(batches):
        for batch in batches:
            for part, width, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                f = TokenFile(out, part, width)
                for k in range(0, len(f), 4096):
                    rows = range(k, min(len(f), k + 4096))
                    off = f.off[k : k + 4097]
                    off = np.asarray(off[: len(rows) + 1])
                    if digest:
                        last, kind = pa.array([zlib.crc32(f[i].astype("<u4").tobytes()) for i in rows], pa.int64()), "ids_crc32"
                    else:
                        flat = pa.array(np.asarray(f.ids[off[0] : off[-1]]).astype(np.int32))
                        last, kind = pa.ListArray.from_arrays(pa.array((off - off[0]).astype(np.int32)), flat), "ids"
                    doc = np.asarray(f.doc[k : k + len(rows)])
                    yield pa.RecordBatch.from_arrays([pa.array(doc, mask=doc == -(1 << 63)), pa.array(off[:-1] + base), pa.array(np.diff(off)), last], ["doc_id", "start", "n_tokens", kind])

    return table.mapInArrow(read, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))
