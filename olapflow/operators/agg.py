"""Grouping, roll-ups, pivots, bins, sorts and top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from olapflow.operators.window import next_value

# ---------------------------------------------------------------- measures
# A measure is (how, column) with how in sum, count, min, max, avg, and "*" allowed
# for count. Each splits into partial columns that can be combined again, so a
# roll-up aggregates the facts once, at the finest level.

Measures = Mapping[str, tuple[str, "str | Column"]]


def _source(column: str | Column) -> Column:
    if isinstance(column, Column):
        return column
    return F.lit(1) if column == "*" else F.col(column)


def partial_measures(measures: Measures) -> list[Column]:
    out = []
    for name, (how, column) in measures.items():
        value = _source(column)
        if how == "avg":
            out += [F.sum(value).alias(f"{name}__sum"), F.count(value).alias(f"{name}__n")]
        elif how == "count":
            out.append(F.count(value).alias(name))
        elif how in ("sum", "min", "max"):
            out.append(getattr(F, how)(value).alias(name))
        else:
            raise ValueError(f"measure {name}: {how} cannot be rolled up from partial results")
    return out


def combined_measures(measures: Measures) -> list[Column]:
    out = []
    for name, (how, _) in measures.items():
        if how == "avg":
            out.append(F.try_divide(F.sum(f"{name}__sum").cast("double"), F.sum(f"{name}__n")).alias(name))
        elif how == "count":
            out.append(F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name))
        else:
            out.append(getattr(F, how)(name).alias(name))
    return out


# ---------------------------------------------------------------- grouping


def group_by(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, str]], order: Sequence[str] = ()
) -> DataFrame:
    """Group step: COUNT_ANY (rows), COUNT_ALL (non-null), SUM, MIN, MAX, FIRST.

    No keys means the whole stream. FIRST needs ``order``.
    """
    forms = {
        "COUNT_ANY": lambda c: F.count(F.lit(1)),
        "COUNT_ALL": lambda c: F.count(c),
        "SUM": lambda c: F.sum(c),
        "MIN": lambda c: F.min(c),
        "MAX": lambda c: F.max(c),
        "FIRST": lambda c: F.min_by(c, F.struct(*order)),
    }
    return df.groupBy(*keys).agg(*[forms[how](c).alias(n) for n, (how, c) in aggs.items()])


def concat_string(
    df: DataFrame, keys: Sequence[str], column: str, sep: str, order: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    """Values of each group joined in order.

    ``chunk`` is a coarse monotone function of ``order[0]``: texts are joined per
    (keys, chunk) first, and the last step joins few long pieces. The result is one
    cell per group by definition.
    """
    item = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(column).cast("string").alias("v"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: x.v)
    pieces = df.groupBy(*keys, chunk.alias("__chunk")).agg(F.array_join(ordered, sep).alias("v"))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("__chunk", "v"))), lambda x: x.v)
    return pieces.groupBy(*keys).agg(F.array_join(whole, sep).alias(name))


def count_distinct(df: DataFrame, keys: Sequence[str], column: str, name: str, approx: bool = False) -> DataFrame:
    """Distinct values per group: exact, or a sketch of fixed size per group."""
    how = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*keys).agg(how(column).alias(name))


def time_bucket(df: DataFrame, ts: str, every: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per fixed time bucket, labelled with its start."""
    return df.groupBy(F.window(ts, every).start.alias("bucket"), *keys).agg(*aggs)


def with_global(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Whole-frame aggregates on every row, each read once as a scalar subquery."""
    return df.withColumns({name: df.agg(column.alias(name)).scalar() for name, column in values.items()})


def distinct_rows(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Unique rows, or the first row (by ``order``) of each key."""
    if not keys:
        return df.distinct()
    first = F.min_by(F.struct(*df.columns), F.struct(*(order or df.columns)))
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(first.alias("r")).select("r.*")


def build_aggregate(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate table: sum, average and non-null count per measure, and the row count."""
    aggs = []
    for name, column in measures.items():
        aggs += [
            F.sum(column).alias(f"{name}_sum"),
            # a quotient of exact sums: decimal averages would be cut to few digits
            F.try_divide(F.sum(column).cast("double"), F.count(column)).alias(f"{name}_avg"),
            F.count(column).alias(f"{name}_count"),
        ]
    return df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("row_count"))


def rollup_avg(agg: DataFrame, keys: Sequence[str], measure: str, how: str = "AvgFromSum") -> DataFrame:
    """Average (or sum) at a coarser grain from an aggregate table.

    AvgFromSum: sum of sums over sum of counts. AvgFromAvg: averages weighted by their
    counts. SumFromAvg: the total rebuilt from averages. Counts are non-null counts.
    """
    n = F.col(f"{measure}_count")
    weighted = F.sum(F.col(f"{measure}_avg") * n)
    result = {
        "AvgFromSum": F.try_divide(F.sum(f"{measure}_sum").cast("double"), F.sum(n)),
        "AvgFromAvg": F.try_divide(weighted, F.sum(n)),
        "SumFromAvg": weighted,
    }[how]
    return agg.groupBy(*keys).agg(result.alias(measure))


def summarize_all(df: DataFrame, keys: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Row count, and total and average of every numeric column not skipped."""
    aggs = [F.count(F.lit(1)).alias("count")]
    for field in df.schema:
        if isinstance(field.dataType, T.NumericType) and field.name not in (*keys, *skip):
            total = F.sum(field.name)
            mean = F.try_divide(total.cast("double"), F.count(field.name))  # decimal averages are cut to few digits
            aggs += [total.alias(f"total_{field.name}"), mean.alias(f"avg_{field.name}")]
    return df.groupBy(*keys).agg(*aggs)


def rollup_levels(df: DataFrame, levels: Sequence[str], measures: Measures) -> DataFrame:
    """Measures at every level of a hierarchy, with level number and name.

    The facts are grouped once at the finest level; the roll-up expands that result.
    """
    levels = list(levels)
    leaf = df.groupBy(*levels).agg(*partial_measures(measures))
    up = leaf.rollup(*levels).agg(F.grouping_id().alias("__gid"), *combined_measures(measures))
    depth = F.lit(len(levels)) - F.bit_count("__gid")
    names = F.array(F.lit("all"), *[F.lit(x) for x in levels])
    return (
        up.withColumn("level_no", depth.cast("int"))
        .withColumn("level_name", F.element_at(names, F.col("level_no") + 1))
        .drop("__gid")
    )


def cube_levels(df: DataFrame, a: Sequence[str], b: Sequence[str], measures: Measures) -> DataFrame:
    """Cross-tab of two level sets with an All member on both sides.

    Each set is kept or collapsed as a whole; ``a_all`` and ``b_all`` mark collapsed
    ones. Again the facts are grouped once.
    """
    a, b = list(a), list(b)
    leaf = df.groupBy(*a, *b).agg(*partial_measures(measures))
    sets = [[*a, *b], a, b, []]
    columns = [[F.col(c) for c in s] for s in sets]
    return leaf.groupingSets(columns, *a, *b).agg(
        F.grouping(a[0]).cast("int").alias("a_all"),
        F.grouping(b[0]).cast("int").alias("b_all"),
        *combined_measures(measures),
    )


def denormalise(df: DataFrame, group: Sequence[str], key: str, value: str, keys: Sequence[str]) -> DataFrame:
    """Key/value rows to one column per listed key."""
    aggs = [F.max(F.when(F.col(key) == k, F.col(value))).alias(str(k)) for k in keys]
    return df.groupBy(*group).agg(*aggs)


def to_crosstab(
    df: DataFrame, category: str, series: str, value: Column, members: Sequence, series_in_rows: bool = False
) -> DataFrame:
    """Relational rows to a cross-tab of ``members`` columns; optionally series and category swapped."""
    rows, cols = (series, category) if series_in_rows else (category, series)
    return df.groupBy(rows).pivot(cols, list(members)).agg(value)


def to_relational(
    df: DataFrame, category: Sequence[str], series: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Cross-tab columns to (category, series, value) rows; empty cells are left out."""
    columns = list(columns or [c for c in df.columns if c not in category])
    return df.unpivot(list(category), columns, series, value).where(F.col(value).isNotNull())


def flow_links(df: DataFrame, entity: str, order: Sequence[str], state: str, chunk=None) -> DataFrame:
    """Transitions between states: source, target and how often."""
    steps = next_value(df, [entity], order, {"target": state}, chunk)
    return (
        steps.where(F.col("target").isNotNull())
        .groupBy(F.col(state).alias("source"), "target")
        .agg(F.count(F.lit(1)).alias("value"))
    )


def flow_nodes(links: DataFrame) -> DataFrame:
    """Every state a link touches."""
    return links.select(F.explode(F.array("source", "target")).alias("node")).distinct()


def quantize(df: DataFrame, column: str, n: int, name: str = "class") -> DataFrame:
    """Number of one of ``n`` equal-width classes between minimum and maximum (1..n), null for null."""
    value = F.col(column).cast("double")
    lo, hi = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    step = F.floor(F.try_divide((value - lo) * F.lit(n), hi - lo)) + 1
    known = F.least(F.coalesce(step, F.lit(1)), F.lit(n)).cast("int")
    return df.withColumn(name, F.when(value.isNotNull(), known))


# ---------------------------------------------------------------- order and top-n


def sort_by(df: DataFrame, spec: Sequence[tuple[str, bool, bool]]) -> DataFrame:
    """Sort by (column, ascending, nulls_last)."""

    def one(name, asc, last):
        c = F.col(name)
        if asc:
            return c.asc_nulls_last() if last else c.asc_nulls_first()
        return c.desc_nulls_last() if last else c.desc_nulls_first()

    return df.orderBy(*[one(*s) for s in spec])


def top_count(df: DataFrame, member: str, measure: Column, n: int, name: str = "measure") -> DataFrame:
    """The ``n`` members with the highest measure; ties go to the smaller member."""
    return (
        df.groupBy(member).agg(measure.alias(name)).orderBy(F.col(name).desc_nulls_last(), F.col(member)).limit(n)
    )


def top_per_group(
    df: DataFrame, group: Sequence[str], measure: str, n: int, tie_break: Sequence[str], rank: str | None = None
) -> DataFrame:
    """Exactly ``n`` rows per group by measure; only n rows per group and map task move."""
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last(), *tie_break)
    out = df.withColumn(rank or "__rank", F.row_number().over(w)).where(F.col(rank or "__rank") <= n)
    return out if rank else out.drop("__rank")


def top_count_total(
    df: DataFrame, member: str, measure: Column, n: int, per: Sequence[str] = (), name: str = "total"
) -> DataFrame:
    """Sum over the ``n`` best members, for each outer member of ``per``."""
    cells = df.groupBy(*per, member).agg(measure.alias("__m"))
    if per:
        best = top_per_group(cells, per, "__m", n, [member])
    else:
        best = cells.orderBy(F.col("__m").desc_nulls_last(), member).limit(n)
    return best.groupBy(*per).agg(F.sum("__m").alias(name))


def hierarchize(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Members in hierarchy order: a parent (nulls below it) before its children."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in levels])
