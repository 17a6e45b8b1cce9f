"""Joins and lookups.

No side is broadcast on trust: Spark decides by its own size statistics, or a row
count is checked first. Hot keys of shuffled joins are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from olapflow.operators.window import row_index, running_sum
from olapflow.session import stored


def _both(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def lookup_key(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str] | str, key: str, drop_natural: bool = True
) -> DataFrame:
    """Swap the natural key of a fact for the dimension's surrogate key (inner join)."""
    pairs = {on: on} if isinstance(on, str) else dict(on)
    ref = dim.select(F.col(key), *[F.col(d).alias(f"__{d}") for d in pairs.values()])
    out = fact.join(ref, _both([F.col(f) == F.col(f"__{d}") for f, d in pairs.items()]))
    out = out.drop(*[f"__{d}" for d in pairs.values()])
    return out.drop(*pairs) if drop_natural else out


def null_safe_join(a: DataFrame, b: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null."""
    ref = b.withColumnsRenamed({c: f"__{c}" for c in columns})
    cond = _both([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns])
    return a.join(ref, cond, how).drop(*[f"__{c}" for c in columns])


def merge_join(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join on equal names; inputs need no sorting beforehand."""
    return a.join(b, list(on), how)


def stream_lookup(
    df: DataFrame,
    ref: DataFrame,
    on: Mapping[str, str],
    fields: Mapping[str, str],
    order: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add reference fields; first match by ``order`` only, defaults where there is none.

    ``fields`` maps new names to reference columns. The reference is reduced to one
    row per key by partial aggregation, so the input never grows.
    """
    keys = list(on.values())
    first = F.min_by(F.struct(*[F.col(src).alias(n) for n, src in fields.items()]), F.struct(*order))
    one = ref.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(first.alias("__ref"), F.lit(1).alias("__hit"))
    out = df.join(one, _both([F.col(c) == F.col(f"__{k}") for c, k in on.items()]), "left")
    added = {}
    for name in fields:
        value = F.col(f"__ref.{name}")
        if defaults and name in defaults:
            value = F.when(F.col("__hit").isNull(), F.lit(defaults[name])).otherwise(value)
        added[name] = value
    return out.withColumns(added).drop("__ref", "__hit", *[f"__{k}" for k in keys])


def lookup(df: DataFrame, ref: DataFrame, on: Mapping[str, str], rename: Mapping[str, str]) -> DataFrame:
    """Left lookup with renamed fields, so one dimension can play several roles."""
    keys = {k: f"__{k}" for k in on.values()}
    side = ref.select(*[F.col(k).alias(a) for k, a in keys.items()], *[F.col(s).alias(n) for s, n in rename.items()])
    cond = _both([F.col(c) == F.col(keys[k]) for c, k in on.items()])
    return df.join(side, cond, "left").drop(*keys.values())


def db_join(df: DataFrame, ref: DataFrame, equal: Mapping[str, str], residual: Column | None = None, how="inner") -> DataFrame:
    """The set form of one parameterised query per row: all matching reference rows.

    ``equal`` maps input columns to reference columns and keeps this a hash join;
    ``residual`` may compare further columns of both sides.
    """
    cond = _both([df[a] == ref[b] for a, b in equal.items()])
    return df.join(ref, cond if residual is None else cond & residual, how)


def cross(df: DataFrame, other: DataFrame, cond: Column | None = None) -> DataFrame:
    """All pairs, optionally filtered; the product itself is the wanted result.

    Whether a side is broadcast follows from Spark's size in bytes.
    """
    return df.crossJoin(other) if cond is None else df.join(other, cond)


def _position(df: DataFrame, column: str) -> Column:
    """A value as a number on its own axis: days for dates, seconds for times."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "date":
        return F.unix_date(F.col(column)).cast("bigint")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column))
    return F.floor(F.col(column)).cast("bigint")


def range_join(
    facts: DataFrame, spans: DataFrame, point: str, lo: str, hi: str, width: int, on: Sequence[str] = ()
) -> DataFrame:
    """Rows whose ``point`` lies in [lo, hi), as an equi-join on bins of ``width``.

    Units are days for dates, seconds for times, one for numbers. A span is copied
    once per bin it touches; the exact bounds are checked after the join. Choose a
    width near the usual span length.
    """
    a = facts.withColumn("__bin", F.floor(_position(facts, point) / F.lit(width)))
    first, last = _position(spans, lo), _position(spans, hi)
    b = (
        spans.where(F.col(lo) < F.col(hi))
        .withColumn(
            "__bin",
            F.explode(F.sequence(F.floor(first / F.lit(width)), F.floor(last / F.lit(width)))),
        )
        .withColumnsRenamed({c: f"__{c}" for c in on})
    )
    cond = [a["__bin"] == b["__bin"], a[point] >= b[lo], a[point] < b[hi]]
    cond += [a[c] == b[f"__{c}"] for c in on]
    return a.join(b, _both(cond)).drop("__bin", *[f"__{c}" for c in on])


def _aligned_pieces(first: Column, last: Column) -> Column:
    """Positions first..last as aligned pieces (level, bin) of 2^level positions: the fewest
    that make up the span, at most two of a level."""

    def of_level(j: Column) -> Column:
        a = -F.call_function("shiftright", -first, j)  # rounded up
        b = F.call_function("shiftright", last + 1, j) - 1
        left, right = (a % 2 != 0) & (a <= b), (b % 2 == 0) & (a <= b)
        own = lambda k: F.array(F.struct(j.alias("level"), k.alias("bin")))
        none = F.array().cast("array<struct<level:int,bin:bigint>>")
        return F.concat(F.when(left, own(a)).otherwise(none), F.when(right & ~(left & (a == b)), own(b)).otherwise(none))

    top = F.length(F.conv((last - first + 1).cast("string"), 10, 2)) - 1  # levels that fit into the span
    return F.flatten(F.transform(F.sequence(F.lit(0), top), of_level))


#: Points of a key in one bin of ``range_join_any``.
BIN_POINTS = 16


def range_join_any(
    facts: DataFrame, spans: DataFrame, point: str, lo: str, hi: str, finest: int = 1, on: Sequence[str] = ()
) -> DataFrame:
    """Rows whose ``point`` lies in [lo, hi), for spans of very different lengths in one table.

    The points of a key are numbered in order, large keys in ranges over many tasks, and
    each run of ``BIN_POINTS`` is a bin; the same pass counts the points before either end
    of a span. A point is in one bin, and a span is copied once per bin in which it holds
    points, so copies follow the rows of the result and not the length of spans, and a span
    without points has none. Neither side is broadcast: its size on file says nothing of
    its copies. The exact bounds are checked after the join. ``finest`` is kept for
    callers; bins need no unit. Null points, null keys and spans that are empty or have a
    null bound match nothing.
    """
    keys = [f"__on{i}" for i in range(len(on))]
    named = [F.col(c).alias(k) for c, k in zip(on, keys)]
    known = lambda *columns: _both([F.col(c).isNotNull() for c in (*columns, *on)])
    marked = stored(spans.where((F.col(lo) < F.col(hi)) & known(lo)).withColumn("__id", F.monotonically_increasing_id()), "spans")
    points = facts.where(known(point)).select(*named, F.col(point).alias("__time"), F.lit(1).alias("__kind"), F.struct(*facts.columns).alias("__a"))
    firsts = marked.select(*named, F.col(lo).alias("__time"), F.lit(-1).alias("__kind"), "__id", F.struct(*spans.columns).alias("__b"))
    lasts = marked.select(*named, F.col(hi).alias("__time"), F.lit(0).alias("__kind"), "__id")
    events = points.unionByName(firsts, allowMissingColumns=True).unionByName(lasts, allowMissingColumns=True)
    # at equal times the ends of spans come before points
    counted = running_sum(events, keys, ["__time", "__kind"], (F.col("__kind") == 1).cast("bigint"), "__n")
    counted = stored(counted, "counted-points")
    held = counted.where("__kind = 1").select(*keys, "__a", F.expr(f"(__n - 1) div {BIN_POINTS}").alias("__bin"))
    ends = counted.where("__kind = 0").select("__id", F.col("__n").alias("__end"))
    bounds = counted.where("__kind = -1").select(*keys, "__id", "__b", "__n").join(ends.hint("merge"), "__id").where("__n < __end")
    bins = F.sequence(F.expr(f"__n div {BIN_POINTS}"), F.expr(f"(__end - 1) div {BIN_POINTS}"))
    pieces = bounds.select(*keys, "__b", F.explode(bins).alias("__bin"))
    out = held.join(pieces.hint("merge"), [*keys, "__bin"])
    at = F.col("__a").getField(point)
    out = out.where((at >= F.col("__b").getField(lo)) & (at < F.col("__b").getField(hi)))
    return out.select(
        *[F.col("__a").getField(c).alias(c) for c in facts.columns],
        *[F.col("__b").getField(c).alias(c) for c in spans.columns if c not in on],
    )


def anti(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner."""
    return df.join(other, list(on), "left_anti")


def semi(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with a partner, each once."""
    return df.join(other, list(on), "left_semi")


def winners(df: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """Rows that reach the highest measure of their group; ties are all kept.

    The rank filter becomes a limit on the map side, so few rows of a hot group move.
    """
    best = F.rank().over(Window.partitionBy(*group).orderBy(F.col(measure).desc()))
    return df.withColumn("__r", best).where(F.col("__r") == 1).drop("__r")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Inner join of a fact to several dimensions, each by (fact column -> dim column)."""
    for dim, on in dims:
        fact = fact.join(dim, _both([fact[f] == dim[d] for f, d in on.items()]))
    return fact


def nest_children(
    parent: DataFrame,
    child: DataFrame,
    on: str,
    fields: Sequence[str],
    order: Sequence[str],
    name: str,
    block: int = 10_000,
    chunk: Column | None = None,
) -> DataFrame:
    """Children nested under their parent, in order, as an array of structs.

    One row per parent and block of ``block`` children, so a parent that owns a third
    of all children spreads over many rows; joined in ``part`` order they are the
    whole list, and ``is_last`` marks its end. A parent without children has one row
    with an empty array.
    """
    item = F.struct(F.col("__i"), F.struct(*fields).alias("item"))
    blocks = (
        row_index(child, [on], order, "__i", chunk=chunk)
        .withColumn("part", F.expr(f"__i div {int(block)}"))
        .groupBy(F.col(on).alias("__on"), "part")
        .agg(F.array_sort(F.collect_list(item)).alias("__items"))
        .withColumn(name, F.transform("__items", lambda x: x.item))
        .drop("__items")
        .withColumn("is_last", F.col("part") == F.max("part").over(Window.partitionBy("__on")))
    )
    out = parent.join(blocks, F.col(on) == F.col("__on"), "left").drop("__on")
    return out.withColumns({
        "part": F.coalesce("part", F.lit(0)), name: F.coalesce(name, F.array()), "is_last": F.coalesce("is_last", F.lit(True)),
    })


def xml_open(tag: str, attributes: Mapping[str, Column]) -> Column:
    """Start tag with escaped attribute values."""
    parts = [F.lit(f"<{tag}")]
    for label, value in attributes.items():
        parts += [F.lit(f' {label}="'), xml_escape(value.cast("string")), F.lit('"')]
    return F.concat(*parts, F.lit(">"))


def xml_element(tag: str, attributes: Mapping[str, Column], body: Column) -> Column:
    """One XML element with escaped attribute values around a ready body."""
    return F.concat(xml_open(tag, attributes), body, F.lit(f"</{tag}>"))


def xml_escape(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def detect_empty(df: DataFrame, default_row: Mapping[str, Column]) -> DataFrame:
    """The frame itself, or one default row when it is empty. Looks at one row."""
    count = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    filler = count.where("n = 0").select(
        *[default_row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]
    )
    return df.unionByName(filler)
