"""Stages that run once for each configuration: kept tables are addressed by what made them.

A stage's table lies in a folder named by a digest of the stage, the part of the configuration that it uses, and the
digest of its input.  What has the same digest is reused, across runs and across candidate configurations; what differs
anywhere before it has another digest, so a stale table is never read.  A table counts once its manifest is there, which is
written last and as one file: a run that breaks off leaves nothing that a later one would take for whole.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics, select, splits
from ..operators.model import Scorer
from . import pipeline
from .pipeline import Config, feature_columns

#: Change it when a stage's code gives other tables than before: the kept ones are then made anew.
VERSION = 1


@dataclass(frozen=True)
class Stage:
    """A function (table before, configuration, folder for other files) -> table, and the configuration fields it uses."""

    name: str
    make: Callable[[DataFrame, Config, str], DataFrame]
    uses: tuple[str, ...]


@dataclass
class Run:
    """What a run made or found: per stage its table, its folder and whether it had to be made."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    folders: dict[str, str] = field(default_factory=dict)
    made: list[str] = field(default_factory=list)
    manifests: dict[str, dict] = field(default_factory=dict)

    @property
    def last(self) -> DataFrame:
        return list(self.tables.values())[-1]


def _plain(make: Callable[[DataFrame, Config], DataFrame]) -> Callable[[DataFrame, Config, str], DataFrame]:
    return lambda df, c, folder: make(df, c)


def sample(df: DataFrame, c: Config, folder: str) -> DataFrame:
    """Training rows, rebalanced, in folds by whole ids; validation rows have no fold.

    All copies and periods of an id share a fold: it is a hash of the id, so that no id is on both sides of a test.
    """
    key = [c.roles.id, "period"]
    train, rest = df.where("part = 'train'"), df.where("part <> 'train'")
    train = splits.rebalance(train, "target", key, c.most, c.least)
    fold = F.pmod(F.xxhash64(F.lit(c.seed), c.roles.id), F.lit(max(1, c.folds))).cast("int")
    return train.withColumn("fold", fold).unionByName(rest.withColumn("fold", F.lit(None).cast("int")))


def choose(df: DataFrame, c: Config, folder: str) -> DataFrame:
    """Keys, target, part and fold with the columns that the filters keep on the training rows."""
    fixed = [c.roles.id, "period", "target", "part", "fold"]
    own = [x for x in feature_columns(df, c) if x not in fixed]
    parts = {k: df.where(F.col("part") == k) for k in ("train", "validate")}
    chosen = select.project(parts, "train", lambda train: select.correlation_filter(train, own, mode_share=c.mode_share, r=c.correlation), fixed)
    return chosen["train"].unionByName(chosen["validate"])


def fit(df: DataFrame, c: Config, folder: str) -> DataFrame:
    """Scores of all rows by a model of the training rows, which is saved in the folder."""
    names = [x for x in feature_columns(df, c) if x != "fold"]
    scorer = Scorer.fit(df.where("part = 'train'"), names, "target", trees=c.trees, depth=c.depth, seed=c.seed)
    scorer.save(f"{folder}/scorer")
    return scorer.score(df, [c.roles.id, "period", "target", "part"])


def measure(df: DataFrame, c: Config, folder: str) -> DataFrame:
    return metrics.classifier_report(df.where("part = 'validate'"), df.where("part = 'train'"), "target", "probability")


STAGES = (
    Stage("clean", _plain(pipeline.clean), ("roles", "reference")),
    Stage("label", _plain(pipeline.label), ("roles", "period", "horizon")),
    Stage("panel", _plain(pipeline.panel), ("roles", "period", "value_columns")),
    Stage("enrich", _plain(pipeline.enrich), ("roles", "value_columns", "rolling", "lag")),
    Stage("split", _plain(pipeline.split), ("roles", "validate_periods", "outlier_threshold")),
    Stage("sample", sample, ("roles", "most", "least", "folds", "seed")),
    Stage("select", choose, ("roles", "correlation", "mode_share")),
    Stage("model", fit, ("roles", "trees", "depth", "seed")),
    Stage("metrics", measure, ()),
)


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's columns and rows, in any order; one pass."""
    mark = F.xxhash64(*df.columns)
    n, x, s = df.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(F.pmod(mark, F.lit(1 << 31)))).first()
    return _digest([df.dtypes, n, x, s])


def _digest(what) -> str:
    return hashlib.sha256(json.dumps(what, sort_keys=True, default=dataclasses.asdict).encode()).hexdigest()[:24]


class _Files:
    """Small files beside the tables, through Spark's file systems."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def read(self, path: str) -> dict | None:
        fs, p = self.at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        except ValueError:  # cut off while it was written
            return None
        finally:
            stream.close()

    def write(self, path: str, what: dict) -> None:
        """Under another name first, so that a reader never finds a part of it."""
        fs, p = self.at(path)
        _, part = self.at(f"{path}.part")
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(what, indent=1).encode()))
        finally:
            stream.close()
        fs.delete(p, False)
        if not fs.rename(part, p):
            raise OSError(f"cannot commit {path}")


def run(log: DataFrame, c: Config, folder: str, upto: str = "metrics", stages: tuple[Stage, ...] = STAGES, source: str | None = None) -> Run:
    """Runs or reuses each stage up to the named one.  source: the log's digest where it is known, else it is taken from its rows."""
    spark, files, out = log.sparkSession, _Files(log.sparkSession), Run()
    key, table = source or fingerprint(log), log
    if upto not in {s.name for s in stages}:
        raise ValueError(f"no stage {upto!r}")
    for stage in stages:
        key = _digest([VERSION, stage.name, {f: getattr(c, f) for f in stage.uses}, key])
        at = f"{folder}/{stage.name}/{key}"
        manifest = files.read(f"{at}/manifest.json")
        if manifest is None:
            began, before = time.perf_counter(), table.columns
            made = stage.make(table, c, at)
            made.write.mode("overwrite").parquet(f"{at}/table")
            table = spark.read.parquet(f"{at}/table")
            changed = {"added": [x for x in table.columns if x not in before], "dropped": [x for x in before if x not in table.columns]}
            manifest = {"stage": stage.name, "key": key, "rows": table.count(), "columns": table.columns, **changed, "seconds": round(time.perf_counter() - began, 3)}
            files.write(f"{at}/manifest.json", manifest)
            out.made.append(stage.name)
        else:
            table = spark.read.parquet(f"{at}/table")
        out.tables[stage.name], out.folders[stage.name], out.manifests[stage.name] = table, at, manifest
        if stage.name == upto:
            break
    return out


def search(log: DataFrame, candidates: list[Config], folder: str, figure: str = "auc") -> tuple[Config, DataFrame]:
    """(the candidate with the best figure of its metrics stage, a row for each candidate); the first of equals.

    Candidates share every stage up to the first parameter in which they differ.
    """
    source, rows = fingerprint(log), []
    for k, c in enumerate(candidates):
        done = run(log, c, folder, source=source)
        value = done.last.first()[figure]
        rows.append((k, None if value is None else float(value), ",".join(done.made)))
    best = max(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, -r[0]))[0]
    table = log.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows], f"candidate int, {figure} double, made string, best boolean")
    return candidates[best], table
