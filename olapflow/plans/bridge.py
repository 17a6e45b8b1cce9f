"""Many-to-many bridges between facts and items, and facts that share dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from olapflow.operators.window import row_index
from olapflow.plans.dims import assign_keys
from olapflow.session import checkpointed


def weighted_bridge(pairs: DataFrame, group: str, item: str, weight: str = "weight") -> DataFrame:
    """Bridge rows of equal weight 1/n over the distinct items of each group."""
    rows = pairs.select(group, item).distinct()
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(sizes, group).select(group, item, (F.lit(1.0) / F.col("__n")).alias(weight))


def allocate(fact: DataFrame, bridge: DataFrame, group: str, measures: Sequence[str], weight: str = "weight") -> DataFrame:
    """Fact rows spread over the items of their group, measures multiplied by the weight."""
    out = fact.join(bridge, group)
    return out.withColumns({m: F.col(m) * F.col(weight) for m in measures}).drop(weight)


def allocate_totals(
    fact: DataFrame, bridge: DataFrame, group: str, item: str, measures: Sequence[str], weight: str = "weight"
) -> DataFrame:
    """Weighted totals per item. Facts are summed per group before they meet the bridge."""
    per_group = fact.groupBy(group).agg(*[F.sum(m).alias(m) for m in measures])
    spread = per_group.join(bridge, group)
    return spread.groupBy(item).agg(*[F.sum(F.col(m) * F.col(weight)).alias(m) for m in measures])


def allocate_exact(
    fact: DataFrame, pairs: DataFrame, group: str, item: str, measures: Sequence[str], scale: int = 2
) -> DataFrame:
    """Fact rows spread evenly over the distinct items of their group, to the last digit.

    Shares are cut to ``scale`` digits and the units left over go to the first items, one
    each, so the shares of a fact add up to its measure exactly.
    """
    unit, wide = 10**scale, "decimal(38,0)"
    rows = row_index(pairs.select(group, item).distinct(), [group], [item], "__place", 1)
    sizes = rows.groupBy(group).agg(F.max("__place").alias("__n"))
    spread = fact.join(rows.join(sizes, group), group)

    def share(measure: str) -> Column:
        units = (F.col(measure).cast(f"decimal(28,{scale})") * unit).cast(wide)
        left = F.pmod(units, F.col("__n").cast(wide))
        whole = ((units - left) / F.col("__n")).cast(wide)
        mine = whole + F.when(F.col("__place") <= left, 1).otherwise(0)
        return (mine / unit).cast(f"decimal(28,{scale})")

    return spread.withColumns({m: share(m) for m in measures}).drop("__place", "__n")


def impact(fact: DataFrame, bridge: DataFrame, group: str, item: str, measures: Sequence[str]) -> DataFrame:
    """Unweighted totals per item: each item counts the whole measure of its groups."""
    per_group = fact.groupBy(group).agg(*[F.sum(m).alias(m) for m in measures])
    pairs = bridge.select(group, item).distinct()
    return per_group.join(pairs, group).groupBy(item).agg(*[F.sum(m).alias(m) for m in measures])


def _prints(pairs: DataFrame, group: str, item: str) -> DataFrame:
    """Size and two 64-bit order-free hashes of each group's item set."""
    return pairs.groupBy(group).agg(
        F.count(F.lit(1)).alias("__n"),
        F.bit_xor(F.xxhash64(F.lit(1), F.col(item))).alias("__h1"),
        F.bit_xor(F.xxhash64(F.lit(2), F.col(item))).alias("__h2"),
    )


def match_groups(
    bridge: DataFrame, group: str, item: str, incoming: DataFrame, record: str, out: str = "matched_group"
) -> DataFrame:
    """For each incoming record, the lowest group holding exactly its items, else null.

    ``incoming`` has the columns record and item. Sets are never gathered in one place:
    size and hashes pick one candidate group per record, and an item-by-item join
    confirms it. A candidate that fails (equal hashes of different sets) raises an
    error instead of giving a wrong answer.
    """
    have = bridge.select(F.col(group).alias("__g"), F.col(item).alias("__item")).distinct()
    want = incoming.select(F.col(record).alias("__r"), F.col(item).alias("__item")).distinct()
    key = ["__n", "__h1", "__h2"]
    lowest = _prints(have, "__g", "__item").groupBy(*key).agg(F.min("__g").alias("__g"))
    chosen = _prints(want, "__r", "__item").join(lowest, key, "left").select("__r", "__g", "__n")
    confirmed = (
        want.join(chosen.where(F.col("__g").isNotNull()).select("__r", "__g"), "__r")
        .join(have, ["__g", "__item"])
        .groupBy("__r")
        .agg(F.count(F.lit(1)).alias("__same"))
    )
    checked = chosen.join(confirmed, "__r", "left")
    fault = F.raise_error(F.lit("two item sets share one fingerprint"))
    result = F.when(F.col("__g").isNull() | (F.col("__same") == F.col("__n")), F.col("__g")).otherwise(
        fault.cast(bridge.schema[group].dataType)
    )
    return checked.select(F.col("__r").alias(record), result.alias(out))


def match_group(bridge: DataFrame, group: str, item: str, items: Sequence) -> DataFrame:
    """The lowest group whose members are exactly the given items; empty if there is none."""
    spark = bridge.sparkSession
    kind = bridge.schema[item].dataType.simpleString()
    wanted = spark.createDataFrame([(0, i) for i in items], f"__rec int, {item} {kind}")
    found = match_groups(bridge, group, item, wanted, "__rec", group)
    return found.where(F.col(group).isNotNull()).select(group)


def maintain_bridge(
    bridge: DataFrame,
    dim: DataFrame,
    incoming: DataFrame,
    record: str,
    name: str,
    group: str = "group_tk",
    item: str = "item_tk",
    order: Sequence[str] | None = None,
    name_chunk: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All incoming records against the bridge in one plan.

    Unknown items get keys, a record whose item set is known reuses that group, and
    every new set becomes one group of weight 1/n. Returns the dimension, the bridge
    rows to append, and the group of every record. Each stage is used several times and
    is written to the shared checkpoint folder once instead of being computed again.
    """
    new_dim = checkpointed(assign_keys(dim, incoming, [name], item, order, name_chunk))
    names = new_dim.select(F.col(name).alias("__name"), F.col(item).alias("__key"))
    named = incoming.join(names, F.col(name).eqNullSafe(F.col("__name")))  # a null item is an item
    keyed = checkpointed(named.select(record, F.col("__key").alias(item)).distinct())
    known = checkpointed(match_groups(bridge, group, item, keyed, record, "__known"))
    fresh = keyed.join(known.where(F.col("__known").isNull()), record, "left_semi")
    fresh = checkpointed(fresh)
    first = match_groups(fresh.withColumnRenamed(record, "__g"), "__g", item, fresh, record, "__first")
    first = checkpointed(first)
    numbered = row_index(first.select("__first").distinct(), [], ["__first"], "__i", 1)
    top = bridge.agg(F.coalesce(F.max(group), F.lit(0)).alias("top")).scalar()
    keys = numbered.select("__first", (F.col("__i") + top).cast("bigint").alias(group))
    sets = fresh.join(keys, F.col(record) == F.col("__first"))
    rows = checkpointed(weighted_bridge(sets, group, item))
    owned = first.join(keys, "__first").select(record, group)
    reused = known.where(F.col("__known").isNotNull()).select(record, F.col("__known").cast("bigint").alias(group))
    return new_dim, rows, reused.unionByName(owned)


def drill_across(facts: Sequence[tuple[DataFrame, Mapping[str, Column]]], keys: Sequence[str]) -> DataFrame:
    """Measures of several facts side by side on their shared keys.

    Each fact is aggregated on its own, so rows never multiply; the results are stacked
    and folded, which keeps members that only one fact knows.
    """
    names, stacked = [], None
    for df, measures in facts:
        names += list(measures)
        part = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])


def explode_attribute(fact: DataFrame, attributes: DataFrame, on: str) -> DataFrame:
    """Fact rows repeated per value of a multi-valued attribute."""
    return fact.join(attributes, on)


def valid_measure(target: DataFrame, fact: DataFrame, shared: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """A measure shown at the nearest level where it exists, repeated on each target row."""
    totals = fact.groupBy(*shared).agg(*[c.alias(n) for n, c in measures.items()])
    return target.join(totals, list(shared), "left")
