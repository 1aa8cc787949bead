"""Exact tree attributions of gradient-boosted scores, from the model's nodes and what their training rows weighed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stored import remove, shared_folder

_PREFIX = "phi_"


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and, for each feature on its path, the share of training rows that its splits let through and their bounds."""

    value: float
    features: tuple[int, ...]
    shares: tuple[float, ...]
    above: tuple[float, ...]  # a row passes if above < x <= upto
    upto: tuple[float, ...]


def leaves_of(nodes: dict[int, tuple], weight: float) -> list[Leaf]:
    """The leaves of a tree.  nodes: id -> (prediction, rows, left, right, feature, threshold); left is -1 in a leaf."""
    out = []

    def go(node: int, path: dict[int, tuple[float, float, float]]) -> None:
        prediction, rows, left, right, feature, threshold = nodes[node]
        if left < 0:
            fs = tuple(path)
            out.append(Leaf(weight * prediction, fs, *(tuple(path[f][k] for f in fs) for k in range(3))))
            return
        share, above, upto = path.get(feature, (1.0, -math.inf, math.inf))
        for child, low, high in ((left, above, min(upto, threshold)), (right, max(above, threshold), upto)):
            go(child, {**path, feature: (share * nodes[child][1] / rows, low, high)})

    go(0, {})
    return out


def model_leaves(model: PipelineModel) -> list[Leaf]:
    """All leaves of a fitted fit_gbt() model; their number is bounded by trees * 2**depth."""
    trees, spark = model.stages[-1], SparkSession.active()
    path = f"{shared_folder(spark)}/trees-{trees.uid}"
    trees.write().overwrite().save(path)
    try:
        d = F.col("nodeData")
        split = d["split"]
        rows = spark.read.parquet(f"{path}/data").select("treeID", d["id"], d["prediction"], d["rawCount"], d["leftChild"], d["rightChild"], split["featureIndex"], F.get(split["leftCategoriesOrThreshold"], 0), split["numCategories"]).collect()
    finally:
        remove(spark, path)
    by_tree: dict[int, dict[int, tuple]] = {}
    for tree, node, prediction, count, left, right, feature, threshold, categories in rows:
        if left >= 0 and categories >= 0:
            raise ValueError("splits on categories have no order to attribute by")
        by_tree.setdefault(tree, {})[node] = (prediction, count, left, right, feature, threshold)
    return [leaf for tree, weight in enumerate(trees.treeWeights) for leaf in leaves_of(by_tree[tree], weight)]


def base_value(leaves: list[Leaf]) -> float:
    """The margin that a row of no known feature is expected to have."""
    return float(sum(x.value * math.prod(x.shares) for x in leaves))


def attribute(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley values (rows x features) of the trees' margin; unknown features go down both sides as the training rows did.

    For a leaf whose path has m features, the sets of known features of each size are counted by the polynomial
    prod(share_j + passes_j t) over its other features: m divisions of one product instead of 2**m sets, for all rows at once.
    """
    out = np.zeros(x.shape)
    for leaf in leaves:
        m = len(leaf.features)
        if not m:
            continue
        own = x[:, leaf.features]
        passes = ((own > leaf.above) & (own <= leaf.upto)).astype(np.float64).T
        product = np.zeros((m + 1, len(x)))
        product[0] = 1.0
        for z, o in zip(leaf.shares, passes, strict=True):
            product[1:] = product[1:] * z + product[:-1] * o
            product[0] *= z
        weights = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
        for f, z, o in zip(leaf.features, leaf.shares, passes, strict=True):
            through, total = o > 0, np.zeros(len(x))
            rest = np.zeros(len(x))
            for k in range(m - 1, -1, -1):  # the product without this feature, from its highest power down
                rest = np.where(through, product[k + 1] - rest * z, product[k] / z)
                total += weights[k] * rest
            out[:, f] += leaf.value * (o - z) * total
    return out


def attributions(model: PipelineModel, df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """keep with base, phi_<column> for each column, and margin: base and the attributions add up to the model's margin.

    The margin is half the log-odds of the score.  Null features count as 0, as in scoring.  The leaves, bounded by the model's
    size, are broadcast; rows are not shuffled.
    """
    leaves = model_leaves(model)
    base = base_value(leaves)
    held = df.sparkSession.sparkContext.broadcast(leaves)
    names = [f"{_PREFIX}{c}" for c in columns]
    own = [f.name for f in df.select(*keep).schema]
    schema = df.select(*keep).schema
    for n in names:
        schema = schema.add(n, "double")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(len(own) + k).to_numpy(zero_copy_only=False) for k in range(len(columns))], axis=1)
            phi = attribute(held.value, x)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(own)], *(pa.array(np.ascontiguousarray(phi[:, k])) for k in range(len(columns)))], [*own, *names])

    rows = df.select(*keep, *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__x{k}") for k, c in enumerate(columns)))
    out = rows.mapInArrow(task, schema)
    total = F.lit(base)
    for n in names:
        total = total + F.col(n)
    return out.select(*keep, F.lit(base).alias("base"), *names, total.alias("margin"))


def importance_table(attributed: DataFrame, columns: list[str]) -> DataFrame:
    """column, mean_abs, mean, rank: how much each column moves the margin; one aggregation."""
    row = attributed.agg(*(F.struct(F.avg(F.abs(f"{_PREFIX}{c}")).alias("mean_abs"), F.avg(f"{_PREFIX}{c}").alias("mean")).alias(f"c{k}") for k, c in enumerate(columns)))
    cells = (F.struct((-F.col(f"c{k}.mean_abs")).alias("o"), F.lit(c).alias("column"), F.col(f"c{k}.mean_abs"), F.col(f"c{k}.mean")) for k, c in enumerate(columns))
    numbered = row.select(F.posexplode(F.array_sort(F.array(*cells))).alias("at", "x"))
    return numbered.select("x.column", "x.mean_abs", "x.mean", (F.col("at") + 1).cast("int").alias("rank"))
