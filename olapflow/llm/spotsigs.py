"""SpotSigs fingerprints, in built-in column expressions only.

Anchors are the most common words of the corpus. A signature is an anchor with the chain
of content words (words that are no anchors) that follow it. A document's fingerprint is
the set of its signatures, hashed, sorted and written as hexadecimal digits. Two
fingerprints are compared by the Jaccard similarity of their sets, pruned by length: only
pairs whose lengths leave a chance of reaching the floor are intersected. A floor of 0
keeps every value. Pairs are given (a document and its edit or the next document), so the
partitions of lengths are no join key here; they prune single comparisons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from olapflow.llm.rules import let
from olapflow.operators.window import bound_index, order_bounds

#: Number of anchors, content words of a chain, similarity below which sets count as unlike.
ANCHORS, CHAIN, FLOOR = 60, 2, 0.02

#: Rows that one chunk of the document order should hold.
CHUNK_ROWS = 20_000


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def anchors(docs: DataFrame, text: str = "text", n: int = ANCHORS) -> list[str]:
    """The ``n`` most common words over all documents; ties go by the word."""
    words = docs.select(F.explode(terms(F.col(text).cast("string"))).alias("word"))
    top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(n)
    return [r.word for r in top.collect()]


def signatures(text: Column, common: list[str], chain: int = CHAIN) -> Column:
    """Sorted distinct 64-bit signatures. A text without any has the hash of its whole
    content as the only one; an empty text has none."""

    def chains(words: Column) -> Column:
        is_anchor = (lambda w: w.isin(*common)) if common else (lambda w: F.lit(False))
        places = F.filter(F.transform(words, lambda w, i: F.when(is_anchor(w), i).otherwise(-1)), lambda i: i >= 0)
        content = F.filter(words, lambda w: ~is_anchor(w))

        def at(places: Column, content: Column) -> Column:
            # the j-th anchor stands at i, so i - j content words lie before it
            return F.transform(places, lambda i, j: F.when(
                i - j + (chain - 1) < F.size(content),
                F.xxhash64(words[i], *[F.get(content, i - j + k) for k in range(chain)]),
            ))

        return F.array_compact(let(places, lambda p: let(content, lambda c: at(p, c))))

    found = let(F.sort_array(F.array_distinct(let(terms(text), chains))), lambda s: F.when(F.size(s) > 0, s).otherwise(
        F.array(F.xxhash64(text))
    ))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<bigint>"))


def as_text(sigs: Column) -> Column:
    """The fingerprint: sixteen hexadecimal digits per signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def length_part(sigs: Column, floor: float) -> Column:
    """Partition of a set by its length. Sets whose similarity can reach ``floor`` lie in
    the same partition or in neighbouring ones."""
    return F.floor(F.log(F.size(sigs).cast("double")) / F.lit(math.log(1 / floor))).cast("int")


def likeness(a: Column, b: Column, floor: float = FLOOR) -> Column:
    """Jaccard similarity of two signature sets, or 0 where it is below ``floor``.

    The sets are intersected only if the shorter is long enough to reach ``floor`` at all;
    sets further apart than neighbouring length partitions never are. Two empty sets are
    alike.
    """
    smaller, larger = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    far = F.abs(length_part(a, floor) - length_part(b, floor)) > 1 if 0 < floor < 1 else F.lit(False)
    jaccard = let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    return (
        F.when(larger == 0, F.lit(1.0)).when(smaller == 0, F.lit(0.0))
        .when(far | (smaller < F.lit(floor) * larger), F.lit(0.0))
        .otherwise(let(jaccard, lambda j: F.when(j < floor, 0.0).otherwise(j)))
    )


def with_next(docs: DataFrame, doc_id: str, value: str, name: str) -> DataFrame:
    """Add ``value`` of the next row by ``doc_id`` as ``name``; after the last, the first.

    Rows are shuffled once, by ranges of the order. The first rows of each range go to the
    range before as guests, those of the first range to the last. Null ids come first;
    rows of equal ids follow in the order of ``value``.
    """
    shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.count()
    bounds = order_bounds(docs, doc_id, min(rows, max(rows // CHUNK_ROWS, 4 * shuffle)))
    kind, n = docs.schema[doc_id].dataType, max(1, len(bounds))
    ranged = docs.withColumn("__range", bound_index(F.col(doc_id), bounds, kind))
    lowest = F.array(*[F.lit(b).cast(kind) for b in bounds])[F.col("__range") - 1] if bounds else F.col(doc_id)
    opens = F.col(doc_id).isNull() | (F.col(doc_id) == lowest)
    home = F.struct(F.col("__range").alias("r"), F.lit(0).alias("guest"))
    before = F.struct(((F.col("__range") + (n - 2)) % n + 1).alias("r"), F.lit(1).alias("guest"))
    dealt = ranged.withColumn("__at", F.explode(F.when(opens, F.array(home, before)).otherwise(F.array(home))))
    order = Window.partitionBy("__at.r").orderBy("__at.guest", F.col(doc_id).asc_nulls_first(), value)
    return dealt.withColumn(name, F.lead(value).over(order)).where("__at.guest = 0").drop("__range", "__at")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by as much of the next one's start."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following, half))


def spot_signatures(docs: DataFrame, text: str = "text", common: list[str] | None = None) -> DataFrame:
    """``docs`` with ``signatures`` (array of longs) and ``fingerprint`` (text).

    A null text is an empty one and has the empty fingerprint. Equal texts have equal
    fingerprints. Words count in lower case, without punctuation. Input columns of these
    names are replaced; an empty table gives an empty result; texts are read whole.
    """
    if common is None:
        common = anchors(docs, text)
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn("signatures", signatures(own, common)).withColumn("fingerprint", as_text(F.col("signatures")))


def compare_with_next(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", common: list[str] | None = None, floor: float = FLOOR
) -> DataFrame:
    """How a document's fingerprint changes with an edit, and how like the next document's it is.

    One row per row of ``docs``: ``doc_id``, ``text`` (null as empty), ``edited_text``,
    their fingerprints, ``near_edited`` and ``near_next``, which are 0
    below ``floor``. Rows go by ``doc_id``, null ids first; rows of one id, tied or repeated,
    follow in the order of their texts, each with a next of its own. The next of the last row
    is the first; a single row is its own. An empty table gives an empty result. Other columns
    are not read, so their names may clash with those returned.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if common is None:
        common = anchors(rows)
    pairs = with_next(rows, "doc_id", "text", "next_text").withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    signed = pairs.withColumns({
        f"s_{name}": signatures(F.col(column), common)
        for name, column in (("own", "text"), ("edited", "edited_text"), ("next", "next_text"))
    })
    return signed.select(
        "doc_id", "text", "edited_text",
        as_text(F.col("s_own")).alias("fingerprint"), as_text(F.col("s_edited")).alias("edited_fingerprint"),
        likeness(F.col("s_own"), F.col("s_edited"), floor).alias("near_edited"),
        likeness(F.col("s_own"), F.col("s_next"), floor).alias("near_next"),
    )
