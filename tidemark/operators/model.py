"""Gradient-boosted classification with Spark ML: fits, stored scorers, cross-validation and searches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stored import dealt, remove, stored
from .boosting import Boosted
from .metrics import auc, classifier_report


def fit_gbt(train: DataFrame, columns: list[str], target: str, trees: int = 20, depth: int = 4, step: float = 0.1, seed: int = 7, boosted: Boosted | None = None) -> PipelineModel:
    """Null features count as 0.  With boosted, the fit goes on from earlier ones on the same rows, and its model only scores."""
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    if boosted is not None:
        return PipelineModel([assembler, boosted.model(train, columns, target, trees, depth, step)])
    stages = [assembler, GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)]
    return Pipeline(stages=stages).fit(dealt(train.na.fill(0.0, columns).select(*columns, F.col(target).cast("double").alias("label"))))


def score(model: PipelineModel, df: DataFrame, columns: list[str], keep: list[str], threshold: float = 0.5) -> DataFrame:
    """keep with probability and prediction (1 from the threshold on)."""
    out = model.transform(df.na.fill(0.0, columns)).withColumn("__p", vector_to_array("probability")[1])
    return out.select(*keep, F.col("__p").alias("probability"), (F.col("__p") >= threshold).cast("int").alias("prediction"))


@dataclass(frozen=True)
class Scorer:
    """A fitted model with the names and types of the columns that it was fitted on, in their order."""

    model: PipelineModel
    columns: tuple[tuple[str, str], ...]
    target: str
    threshold: float = 0.5

    @staticmethod
    def fit(train: DataFrame, columns: list[str], target: str, threshold: float = 0.5, **params) -> Scorer:
        kinds = dict(train.dtypes)
        return Scorer(fit_gbt(train, columns, target, **params), tuple((c, kinds[c]) for c in columns), target, threshold)

    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def check(self, df: DataFrame) -> None:
        """Refuses a table that lacks a column or holds another type in it."""
        kinds = dict(df.dtypes)
        wrong = [f"{c}: {kinds.get(c, 'missing')} instead of {t}" for c, t in self.columns if kinds.get(c) != t]
        if wrong:
            raise ValueError("columns differ from those of the fit: " + ", ".join(wrong))

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        self.check(df)
        return score(self.model, df, self.names(), keep, self.threshold)

    def save(self, path: str) -> None:
        """The model and, last, its signature: a folder without one is no finished model.  An earlier model there is replaced."""
        spark = SparkSession.active()
        remove(spark, f"{path}/signature")
        self.model.write().overwrite().save(f"{path}/model")
        text = json.dumps({"columns": self.columns, "target": self.target, "threshold": self.threshold})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/signature")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scorer:
        signature = json.loads(spark.read.text(f"{path}/signature", wholetext=True).first()[0])
        model = PipelineModel.load(f"{path}/model")
        columns = tuple((c, t) for c, t in signature["columns"])
        if model.stages[0].getInputCols() != [c for c, _ in columns]:
            raise ValueError("the stored model was fitted on other columns than its signature says")
        return Scorer(model, columns, signature["target"], signature["threshold"])


def save_folds(df: DataFrame, path: str) -> None:
    """Training rows in folders by their fold, so that a fold is read or left out without a scan; rows without one are in fold -1."""
    stored_as = df.withColumn("fold", F.coalesce("fold", F.lit(-1)).cast("int"))
    stored_as.repartition("fold", F.pmod(F.xxhash64(*[c for c in df.columns if c != "fold"]), F.lit(16))).write.mode("overwrite").partitionBy("fold").parquet(path)


def read_fold(spark: SparkSession, path: str, fold: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) of one fold of save_folds(); rows without a fold always train."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)


def cross_validation(df: DataFrame, columns: list[str], target: str, keys: list[str], folds: int, at_once: int = 1, threshold: float = 0.5, **params) -> tuple[DataFrame, DataFrame]:
    """(scores, metrics) of the folds: keys, target, fold, part, probability, prediction for the test rows of each, and one row a fold.

    df has a fold column (fold_assign); rows without a fold always train.  It is stored once and all fits read
    the same rows; ``at_once`` folds are in flight together: one fold's small jobs fill the gaps of another's, but each holds its rows
    in memory.  metrics:
    fold, n_train, n_test, n_positive and the figures of classifier_report(), whose KS compares with the fold's own training scores.
    """
    rows = stored(df.select(*dict.fromkeys([*keys, target, *columns, "fold"])), "folds")

    def run(k: int) -> tuple[DataFrame, DataFrame]:
        test, train = rows.where(F.col("fold") == k), rows.where(F.col("fold").isNull() | (F.col("fold") != k))
        model = fit_gbt(train, columns, target, **params)
        own = [*keys, target]
        both = score(model, test, columns, own, threshold).withColumn("part", F.lit("test")).unionByName(score(model, train, columns, own, threshold).withColumn("part", F.lit("train")))
        scored = stored(both.withColumn("fold", F.lit(k)), f"scores-{k}")
        tested, trained = scored.where("part = 'test'"), scored.where("part = 'train'")
        sizes = scored.agg(F.count_if(F.col("part") == "train").alias("n_train"), F.count_if(F.col("part") == "test").alias("n_test"), F.count_if((F.col("part") == "test") & (F.col(target) == 1)).alias("n_positive"))
        figures = classifier_report(tested, trained, target, "probability", threshold)
        row = sizes.select(F.lit(k).alias("fold"), "*").join(F.broadcast(figures), F.lit(True))  # a row each
        return tested.drop("part"), row

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        done = [f.result() for f in [pool.submit(inheritable_thread_target(run), k) for k in range(folds)]]
    scores, metrics = done[0]
    for s, m in done[1:]:
        scores, metrics = scores.unionByName(s), metrics.unionByName(m)
    return scores, stored(metrics.coalesce(1), "fold-metrics")


@dataclass
class SharedFits:
    """Rows with a fold column, and what fits on each fold's training rows share when they are validated with several parameters."""

    rows: DataFrame
    boosted: dict[int, Boosted] = field(default_factory=dict)

    def free(self) -> None:
        for b in self.boosted.values():
            b.free()


def cross_validate(df: DataFrame | SharedFits, columns: list[str], target: str, keys: list[str], folds: int, at_once: int = 2, **params) -> list[float]:
    """AUC of each fold; df has a fold column, and rows without a fold always train.  Many passes go over df: store it first.

    ``at_once`` folds are in flight together.
    """
    shared = df if isinstance(df, SharedFits) else None
    rows = shared.rows if shared else df

    def run(k: int) -> float:
        test, train = rows.where(F.col("fold") == k), rows.where(F.col("fold").isNull() | (F.col("fold") != k))
        more = {"boosted": shared.boosted.setdefault(k, Boosted())} if shared else {}
        model = fit_gbt(train, columns, target, **params, **more)
        return auc(stored(score(model, test, columns, [*keys, target]), "scores"), target, "probability").first()[0]

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(run), k) for k in range(folds)]]


def coordinate_search(evaluate: Callable[[dict], float], grid: dict[str, Iterable], start: dict, sweeps: int = 1) -> tuple[dict, float]:
    """Per parameter in turn the value with the best result, the others held; so many sweeps."""
    best, value = dict(start), evaluate(dict(start))
    for _ in range(sweeps):
        for name, options in grid.items():
            for option in options:
                if option == best[name]:
                    continue
                trial = best | {name: option}
                got = evaluate(trial)
                if got > value:
                    best, value = trial, got
    return best, value


def candidate_search(candidates: list[dict], evaluate: Callable[[dict], float]) -> tuple[dict, float]:
    """The whole-stage configuration with the best result; the first of equals."""
    results = [evaluate(c) for c in candidates]
    k = max(range(len(results)), key=lambda i: (results[i], -i))
    return candidates[k], results[k]
