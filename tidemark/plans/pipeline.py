"""The staged event-sequence pipeline: log to panel to features to splits to scores.

A stage is a function of the table before it.  With a folder, each stage's
table is Parquet there, and a run can resume from any of them; without one, the chain is one plan, and the small
statistics that enter it as literals (last dates, periods, outlier bounds) each run what comes before them again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import densify, features, metrics, model, outliers, periods, select, splits, timeline
from ..roles import Duration, PanelRoles, Roles


@dataclass(frozen=True)
class Config:
    """What a run needs to know; reference is a SQL condition, durations are written like "2month"."""

    roles: Roles
    reference: str
    value_columns: list[str]
    period: str = "1month"
    horizon: str = "2month"
    rolling: int = 3
    lag: int = 2
    outlier_threshold: float = 10.0
    correlation: float = 0.85
    mode_share: float = 0.95
    validate_periods: int = 2
    most: float = 0.9
    least: float = 0.25
    trees: int = 20
    depth: int = 4
    folds: int = 4
    seed: int = 7


@dataclass
class StageResult:
    """The table of a stage and how long it took to make."""

    name: str
    table: DataFrame
    seconds: float = 0.0
    columns: list[str] = field(default_factory=list)


def clean(df: DataFrame, c: Config) -> DataFrame:
    """Reference flag, timeline and time-since features of each event."""
    return timeline.time_since_reference(timeline.mark_reference(df, c.roles, F.expr(c.reference)), c.roles)


def label(df: DataFrame, c: Config) -> DataFrame:
    """Period and target of each event; events outside the calendar go after labelling."""
    d = Duration.parse(c.period)
    df = densify.label_next(df, c.roles, F.col("ref_event") == 1, Duration.parse(c.horizon).days)
    return periods.assign_period(df, c.roles.date, d.unit, d.count).where("period >= 0")


def panel(df: DataFrame, c: Config) -> DataFrame:
    """One row for each id and period, gaps filled."""
    p = PanelRoles(c.roles.id, "period")
    df = df.withColumn("n_events", F.lit(1))
    rows = densify.collapse(df, c.roles, "period", [*c.value_columns, "days_since_timeline", "target"], ["n_events", "ref_event"])
    rows = densify.densify(rows, p)
    rows = densify.fill_gaps(rows, p, "imputed", zeros=["n_events", "ref_event"], carried=[*c.value_columns, "target"], since=["days_since_timeline"], period_days=Duration.parse(c.period).days)
    return densify.drop_trailing_imputed(rows, p)


def enrich(df: DataFrame, c: Config) -> DataFrame:
    return features.enrich(df, PanelRoles(c.roles.id, "period"), ["n_events", *c.value_columns], c.rolling, c.lag)


def split(df: DataFrame, c: Config) -> DataFrame:
    """part: train or validate, by period; outliers are clamped to what the training rows show."""
    own = [x for x in feature_columns(df, c) if x != "imputed"]
    train = df.where(F.col("period") > c.validate_periods)
    out = outliers.clamp(df, own, outliers.outlier_stats(train, own, c.outlier_threshold))
    return out.withColumn("part", F.when(F.col("period") > c.validate_periods, "train").otherwise("validate"))


def feature_columns(df: DataFrame, c: Config) -> list[str]:
    return sorted(n for n, t in df.dtypes if t in ("int", "bigint", "double") and n not in (c.roles.id, "period", "target"))


STAGES: tuple[tuple[str, Callable[[DataFrame, Config], DataFrame]], ...] = (("clean", clean), ("label", label), ("panel", panel), ("enrich", enrich), ("split", split))


def run(log: DataFrame, c: Config, folder: str | None = None, resume_from: str | None = None) -> list[StageResult]:
    """Stages up to the split, in order; resume_from: the first stage to run, on what the folder has of the one before."""
    names = [n for n, _ in STAGES]
    first = names.index(resume_from) if resume_from else 0
    if first:
        if not folder:
            raise ValueError("resuming needs the folder of an earlier run")
        log = log.sparkSession.read.parquet(f"{folder}/{names[first - 1]}")
    out = []
    for name, stage in STAGES[first:]:
        began = time.perf_counter()
        log = stage(log, c)
        if folder:
            log.write.mode("overwrite").parquet(f"{folder}/{name}")
            log = log.sparkSession.read.parquet(f"{folder}/{name}")
        out.append(StageResult(name, log, time.perf_counter() - began, log.columns))
    return out


def fit_and_score(table: DataFrame, c: Config) -> tuple[DataFrame, DataFrame]:
    """Choose columns and fit on rebalanced training rows; (scores of the validate rows, their metrics)."""
    key = [c.roles.id, "period"]
    train, validate = table.where("part = 'train'"), table.where("part = 'validate'")
    names = select.correlation_filter(train, feature_columns(table, c), mode_share=c.mode_share, r=c.correlation)
    fitted = model.fit_gbt(splits.rebalance(train, "target", key, c.most, c.least), names, "target", c.trees, c.depth)
    scores = model.score(fitted, validate, names, [*key, "target"])
    return scores, metrics.classifier_metrics(scores, "target", "probability")
