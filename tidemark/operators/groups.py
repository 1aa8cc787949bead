"""Columns by what they hold, and the treatment that follows from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType


def column_types(df: DataFrame, columns: list[str] | None = None, most: int = 16) -> DataFrame:
    """column, n, n_null, n_distinct (null above most), estimate, kind of each column, from one pass.

    kind: constant (no or one value), two_valued, date, numeric (a number with more than most values) or factor.
    Null is no value.  NaN is one.

    A column's state is bounded however many values it has.  A frequent-items sketch counts values exactly up to three times
    ``most``; a HyperLogLog estimate above twice ``most`` (off by a twentieth, as a rule) tells where there are more.
    """
    columns = df.columns if columns is None else columns
    tracked = 1 << max(6, (4 * most).bit_length())
    cells: list[Column] = []
    for k, c in enumerate(columns):
        few = F.expr(f"approx_top_k(cast(`{c}` as string), {most + 1}, {tracked}) filter (where `{c}` is not null)")
        size = F.coalesce(F.size(F.filter(few, lambda x: x["item"].isNotNull())), F.lit(0))
        cells.append(F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(f"`{c}`").isNull()).alias("n_null"), size.alias("few"), F.approx_count_distinct(f"`{c}`").alias("estimate")).alias(f"c{k}"))
    rows = df.agg(*cells).select(F.explode(F.array(*(F.col(f"c{k}") for k in range(len(columns))))).alias("x")).select("x.*")
    types = {f.name: f.dataType for f in df.schema.fields}
    dates = [c for c in columns if isinstance(types[c], DateType | TimestampType | TimestampNTZType)]
    numbers = [c for c in columns if isinstance(types[c], NumericType)]
    many = (F.col("few") > most) | (F.col("estimate") > 2 * most)
    kind = F.when(~many & (F.col("few") <= 1), "constant").when(~many & (F.col("few") == 2), "two_valued").when(F.col("column").isin(dates), "date").when(many & F.col("column").isin(numbers), "numeric").otherwise("factor")
    return rows.select("column", "n", "n_null", F.when(~many, F.col("few")).alias("n_distinct"), "estimate", kind.alias("kind"))


@dataclass(frozen=True)
class ColumnGroups:
    """What follows from the kinds of a log's columns."""

    constant: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    factors: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()

    @staticmethod
    def of(types: DataFrame, exclude: tuple[str, ...] = ()) -> ColumnGroups:
        """From column_types(): a row for each column comes to the driver."""
        kinds: dict[str, list[str]] = {}
        for r in types.orderBy("column").collect():
            if r["column"] not in exclude:
                kinds.setdefault(r["kind"], []).append(r["column"])
        return ColumnGroups(*(tuple(kinds.get(k, ())) for k in ("constant", "two_valued", "factor", "numeric", "date")))

    @property
    def since(self) -> tuple[str, ...]:
        """Time-since columns, moved on through empty periods."""
        return tuple(c for c in self.numeric + self.binary + self.factors if "td_" in c)

    @property
    def running(self) -> tuple[str, ...]:
        return tuple(c for c in self.numeric if c.startswith("expanding_"))

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.factors + self.binary

    @property
    def carried(self) -> tuple[str, ...]:
        """Columns whose last value holds through empty periods."""
        return tuple(c for c in self.categorical + self.running if c not in self.since)

    @property
    def dynamic(self) -> tuple[str, ...]:
        """Columns that an empty period changes: all but the constant ones and the dates."""
        return self.categorical + self.numeric

    def only(self, chosen: list[str]) -> tuple[ColumnGroups, list[str]]:
        """(the groups restricted to an experiment's columns, the columns that it drops)."""
        want = set(chosen)
        unknown = want - {c for f in self.__dataclass_fields__ for c in getattr(self, f)}
        if unknown:
            raise ValueError(f"not in any group: {sorted(unknown)}")
        kept = {f: tuple(c for c in getattr(self, f) if c in want) for f in self.__dataclass_fields__}
        return ColumnGroups(**kept), sorted(c for f in self.__dataclass_fields__ for c in getattr(self, f) if c not in want)
