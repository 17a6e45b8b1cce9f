"""Mixing sources to target weights, with exact budgets and repeatable draws.

Every document gets a hash-random key. Within a source, key order is a random order, and
since the keys are hash values, equal ranges of them hold about equal shares of every
source: a range of keys of one source is a chunk that one task sorts, however large the
source is. Sums per chunk carry the running totals over the chunk borders. The document
at which a source's running total passes its budget is found in its chunk; only that one
row per source is needed to say what every document contributes.

A source takes as many whole passes (epochs) as its budget holds, and from the next pass
the documents before the cut. The document at the cut gives the words still missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from olapflow.llm.base import SPACE, SPACES, WORD, stored
from olapflow.operators.window import running

#: Weights of the sources in code point order, repeating; the mix's size in halves of the
#: input; the most epochs of any source; rows that one chunk holds at most (about).
WEIGHTS, HALVES, EPOCHS, CHUNK_ROWS = (3, 1, 2), 3, 2, 50_000

_SOURCE, _KEY, _SIZE = "__source", "__key", "__size"
_HEX = 15  # digits of the key, which then fits a long


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, seed: str) -> Column:
    """A hash-random number of 60 bits, the same on every run."""
    named = F.concat_ws(":", F.lit(seed), doc_id.cast("string"))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, _HEX), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` -> also ``target``, by water-filling. One row per source.

    Sources ordered by code point, null last, have the weights 3, 1, 2, 3, ... They share
    one and a half times all sizes; none gets more than twice its own, and what a capped
    source leaves is shared by the others. Source sizes are whole numbers, so the order of
    additions does not matter.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn(
        "w", F.array(*[F.lit(w) for w in WEIGHTS])[((F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("int")]
    )
    # the fuller a source's share of its own size, the sooner it is capped
    by_fill = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    exact = "decimal(38,0)"
    filled = (
        weighted.withColumn("budget", (HALVES * F.sum(F.col("source_size").cast(exact)).over(everything)).cast(exact))
        .withColumn("below", F.coalesce(F.sum(2 * EPOCHS * F.col("source_size").cast(exact)).over(before), F.lit(0)).cast(exact))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn(
            "capped",
            (F.col("budget") - F.col("below")).cast("decimal(30,0)") * F.col("w")
            >= (2 * EPOCHS * F.col("source_size")).cast("decimal(30,0)") * F.col("w_left"),
        )
    )
    level = (
        F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), 2 * EPOCHS * F.col("source_size").cast(exact))).over(everything), F.lit(0))
    ).cast("double")
    share = level / 2.0 * F.col("w") / F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    return filled.select(
        "source", "source_size",
        F.when(F.col("capped"), (EPOCHS * F.col("source_size")).cast("double")).otherwise(share).alias("target"),
    )


def cuts(rows: DataFrame) -> DataFrame:
    """Sized rows (source, key, size) -> one row per source: its size, target, whole epochs,
    the key at the cut, and the words the cut still takes out of those at that key."""
    source_sizes = rows.groupBy(F.col(_SOURCE).alias("source")).agg(F.sum(_SIZE).alias("source_size"))
    plan = targets(source_sizes).withColumn("budget", F.floor("target").cast("long")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0).cast("long")
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))

    shuffle = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(shuffle, -(-rows.count() // CHUNK_ROWS))  # a hot source spreads over all tasks
    width = -(-(16**_HEX) // chunks)
    grouped = rows.groupBy(_SOURCE, _KEY).agg(F.sum(_SIZE).alias(_SIZE))  # equal keys share one place
    placed = running(
        grouped, [_SOURCE], [_KEY], F.col(_SIZE), "upto", chunk=F.expr(f"{_KEY} div {width}")
    )
    at_cut = placed.join(plan, F.col(_SOURCE).eqNullSafe(F.col("source"))).where(
        (F.col("rest") > 0) & (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col(_SIZE) < F.col("rest"))
    ).select(
        F.col("source").alias("cut_source"), F.col(_KEY).alias("cut_key"), F.col(_SIZE).alias("cut_size"),
        (F.col("rest") - (F.col("upto") - F.col(_SIZE))).alias("cut_take"),
    )
    return plan.join(at_cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
        "source", "source_size", "target", "epochs", "cut_key", "cut_size", "cut_take"
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = "mix") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    A null or empty text has size 0 and gives nothing. Null sources form a source of their
    own, the last. Rows with an equal key (repeated ids) stand at one place of the order;
    at the cut each gives its share, rounded down. A source's taken words are its target,
    rounded down, but for that rounding. An empty table gives an empty result. Input
    columns with the names of added ones are replaced.
    """
    base = docs.drop("size", "source_size", "target", "taken")
    sized = base.select(
        F.col(source).alias(_SOURCE), draw_key(F.col(doc_id), seed).alias(_KEY),
        word_count(F.col(text).cast("string")).alias(_SIZE),
    )
    plan = stored(cuts(stored(sized, "mix-sizes")), "mix-cuts")
    plan = plan.select([F.col(c).alias(f"__cut_{c}") for c in plan.columns])
    own = base.withColumn(_KEY, draw_key(F.col(doc_id), seed)).withColumn("size", word_count(F.col(text).cast("string")))
    key, cut = F.col(_KEY), F.col("__cut_cut_key")
    partial = (
        F.when(key < cut, F.col("size"))
        .when(key == cut, F.expr("cast(cast(size as decimal(20,0)) * __cut_cut_take as decimal(38,0)) div __cut_cut_size"))
        .otherwise(F.lit(0))
    )
    return own.join(plan, F.col(source).eqNullSafe(F.col("__cut_source")), "left").withColumns({
        "source_size": F.col("__cut_source_size"),
        "target": F.col("__cut_target"),
        "taken": (F.col("__cut_epochs") * F.col("size") + partial).cast("long"),
    }).drop(_KEY, *plan.columns)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    leading = F.when(F.ltrim(text, F.lit(SPACE)) == text, n).otherwise(n + 1)
    pieces = F.split(text, SPACES, (leading + 1).cast("int"))
    tail = F.when(F.size(pieces) > leading, F.length(F.element_at(pieces, -1))).otherwise(0)
    return F.rtrim(F.left(text, (F.length(text) - tail).cast("int")), F.lit(SPACE))


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = "mix") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document once for every whole pass
    taken, and the one at the cut once more up to its last taken word. Documents of which
    nothing is taken, such as empty ones, are not in it."""
    drawn = mix(docs.select([F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]),
                *[f"c{docs.columns.index(c)}" for c in (text, source, doc_id)], seed)
    content = f"c{docs.columns.index(text)}"
    whole, rest = F.expr("taken div size"), F.expr("taken % size")
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")),
    )
    out = drawn.where("taken > 0").withColumn("__upto", F.explode(copies))
    cut = F.when(F.col("__upto") > 0, first_words(F.col(content), F.col("__upto"))).otherwise(F.col(content))
    return out.withColumn(content, cut).select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
