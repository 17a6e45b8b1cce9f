"""Measures over levels: semi-additive, scenario, curated and comparative."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from olapflow.operators.agg import combined_measures, cube_levels, partial_measures, rollup_levels

ALL = object()
"""Slicer value that stands for every member."""


def semi_additive(
    df: DataFrame,
    date: str,
    levels: Mapping[str, Column],
    measure: Column,
    by: Sequence[str] = (),
    how: str = "last",
    name: str = "value",
) -> DataFrame:
    """Value of the first or last day of each period, for every level given.

    ``levels`` maps a level name to its period, an expression of ``date``. Facts are
    summed per day once; a period never adds days up.
    """
    pick = {"first": F.min_by, "last": F.max_by}[how]
    daily = df.groupBy(*by, date).agg(measure.alias("__v"))
    periods = F.explode(
        F.array(*[F.struct(F.lit(n).alias("level"), p.cast("string").alias("period")) for n, p in levels.items()])
    )
    spread = daily.select(*by, date, "__v", periods.alias("__p"))
    return spread.groupBy(*by, F.col("__p.level").alias("level"), F.col("__p.period").alias("period")).agg(
        pick("__v", date).alias(name)
    )


def monthly_hierarchy(day: str) -> dict[str, Column]:
    d = F.col(day)
    return {
        "year": F.year(d),
        "quarter": F.year(d) * 10 + F.quarter(d),
        "month": F.year(d) * 100 + F.month(d),
    }


def weekly_hierarchy(day: str) -> dict[str, Column]:
    d = F.col(day)
    iso_year = F.extract(F.lit("YEAROFWEEK"), d)
    return {"iso_year": iso_year, "iso_week": iso_year * 100 + F.extract(F.lit("WEEK"), d)}


def semi_additive_in(
    df: DataFrame, date: str, hierarchy: str, measure: Column, by: Sequence[str] = (), how: str = "last"
) -> DataFrame:
    """Semi-additive measure in the active calendar hierarchy, ``monthly`` or ``weekly``."""
    levels = {"monthly": monthly_hierarchy, "weekly": weekly_hierarchy}[hierarchy](date)
    return semi_additive(df, date, levels, measure, by, how)


def period_change(df: DataFrame, period_no: str, measure: str, by: Sequence[str] = (), name: str = "change") -> DataFrame:
    """Value minus the value of the preceding period.

    ``period_no`` counts periods without gaps (such as year * 12 + month), so a missing
    period is noticed and not skipped. Null when the value is empty or the preceding
    one is zero or absent. The frame holds one row per (by, period).
    """
    w = Window.partitionBy(*by).orderBy(period_no)
    follows = F.lag(period_no).over(w) == F.col(period_no) - 1
    before = F.when(follows, F.lag(measure).over(w))
    return df.withColumn(name, F.when(before != 0, F.col(measure) - before))


def ratio_measure(df: DataFrame, by: Sequence[str], a: Column, b: Column, name: str = "ratio") -> DataFrame:
    """Ratio of two totals, taken after aggregation; null over zero."""
    parts = df.groupBy(*by).agg(a.alias("__a"), b.alias("__b"))
    return parts.select(*by, F.try_divide("__a", "__b").alias(name))


def scenario(df: DataFrame, by: Sequence[str], cases: Mapping[str, Column], dim="scenario", name="value") -> DataFrame:
    """One row per member and scenario; the scenario member selects the measure."""
    wide = df.groupBy(*by).agg(*[c.alias(n) for n, c in cases.items()])
    return wide.unpivot(list(by), list(cases), dim, name)


def what_if(df: DataFrame, measure: str, rates: Sequence[float], dim="rate", name="projected") -> DataFrame:
    """Each row once per rate, with the measure raised by it. Apply it to aggregated rows."""
    rows = df.withColumn(dim, F.explode(F.array(*[F.lit(float(r)) for r in rates])))
    return rows.withColumn(name, F.col(measure) * (F.lit(1.0) + F.col(dim)))


def curated_rollup(
    df: DataFrame, levels: Sequence[str], measures: Mapping[str, tuple[str, str | Column]], keep: Column
) -> DataFrame:
    """Every level's totals over the kept leaves only; levels without any stay visible."""
    kept = {}
    for name, (how, column) in measures.items():
        value = column if isinstance(column, Column) else F.lit(1) if column == "*" else F.col(column)
        kept[name] = (how, F.when(keep, value))
    return rollup_levels(df, levels, kept)


def fixed_measure(df: DataFrame, name: str, measure: Column, cond: Column) -> DataFrame:
    """The measure at one fixed member, shown on every row."""
    return df.withColumn(name, df.where(cond).agg(measure.alias(name)).scalar())


def slice_by(df: DataFrame, members: Mapping[str, object]) -> DataFrame:
    """Keep one member, a list of members, or all of them (``ALL``) per level."""
    for level, wanted in members.items():
        if wanted is ALL:
            continue
        wanted = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        df = df.where(F.col(level).isin(wanted))
    return df


def filter_members(df: DataFrame, member: Sequence[str], measures: Mapping[str, Column], cond: Column) -> DataFrame:
    """Members whose aggregated measures meet a condition."""
    return df.groupBy(*member).agg(*[c.alias(n) for n, c in measures.items()]).where(cond)


def derive_dim(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dimension view over columns kept in the fact."""
    return fact.select(*columns).distinct()


@dataclass(frozen=True)
class Dimension:
    """A dimension table, how the fact refers to it, and its levels from coarse to fine."""

    table: DataFrame
    on: Mapping[str, str]
    levels: Sequence[str] = ()


@dataclass(frozen=True)
class Cube:
    """A fact with dimensions and typed measures (sum, count, min, max, avg)."""

    fact: DataFrame
    dims: Mapping[str, Dimension] = field(default_factory=dict)
    measures: Mapping[str, tuple[str, str | Column]] = field(default_factory=dict)
    formats: Mapping[str, str] = field(default_factory=dict)

    def _rows(self, levels: set[str]) -> DataFrame:
        df = self.fact
        for dim in self.dims.values():
            if not levels & set(dim.table.columns):
                continue
            df = df.join(dim.table, reduce(and_, [df[a] == dim.table[b] for a, b in dim.on.items()]))
        return df

    def query(
        self,
        rows: Sequence[str],
        cols: Sequence[str] = (),
        where: Mapping[str, object] | None = None,
        measures: Sequence[str] | None = None,
        totals: bool = False,
    ) -> DataFrame:
        """Measures by the row and column levels. Only dimensions in use are joined.

        ``totals`` adds the roll-up of the rows, or the All members of both axes.
        """
        where = where or {}
        wanted = {m: self.measures[m] for m in (measures or self.measures)}
        df = slice_by(self._rows({*rows, *cols, *where}), where)
        if totals and cols:
            return cube_levels(df, rows, cols, wanted)
        if totals:
            return rollup_levels(df, rows, wanted)
        leaf = df.groupBy(*rows, *cols).agg(*partial_measures(wanted))
        return leaf.groupBy(*rows, *cols).agg(*combined_measures(wanted))

    def formatted(self, df: DataFrame) -> DataFrame:
        """Measures as text in their printf formats, in columns ending in ``_text``."""
        present = {m: f for m, f in self.formats.items() if m in df.columns}
        return df.withColumns({f"{m}_text": F.format_string(f, F.col(m)) for m, f in present.items()})
