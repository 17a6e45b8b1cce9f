"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

Fingerprints are computed once per document and written as a narrow table; only distinct
ones are compared. Two fingerprints within three bits agree on at least one of their four
16-bit blocks, so a tile is formed only among those that agree on the leading bits of a
block; how many bits follows from the number of fingerprints. Groups larger than a tile
are cut by population count and a salt, and a tile pair is formed only if the population
counts of its tiles differ by no more than the radius. Within a tile pair numpy computes
exclusive-or and bit counts for all rows in strips, again only over columns whose
population count is near. Each tile pair reports a spanning forest of its links and not
the links, so a dense group of copies gives as many edges as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from olapflow.llm.base import stored
from olapflow.llm.components import components

#: Differing bits up to which fingerprints are linked; rows of a tile; words of a shingle.
RADIUS, TILE_ROWS, SHINGLE, SEED = 3, 2_048, 3, 42

_BLOCKS, _BLOCK_BITS = 4, 16
_STRIP, _SLICE = 64, 65_536


def text_fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text: a bit is set if over half of the shingle hashes set it."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    votes = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, _SLICE):  # bounded memory for long texts
        part = words[start : start + _SLICE + shingle - 1]
        hashes = np.fromiter(
            (digest(join(s), SEED) for s in zip(*[part[k:] for k in range(shingle)], strict=False)), np.uint64
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


@F.arrow_udf(LongType())
def fingerprint(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The fingerprint of each text as a signed long; 0 for a text without words."""
    for batch in texts:
        found = [text_fingerprint(t) for t in batch.cast(pa.binary()).to_pylist()]
        yield pa.array(np.array(found, np.uint64).view(np.int64))


def as_hex(column: Column) -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _forest(values: np.ndarray, first: np.ndarray, second: np.ndarray, radius: int):
    """Linked pairs between ``first`` and ``second`` rows of a tile pair, as star edges
    (value, root of its local component)."""
    order = np.argsort(np.bitwise_count(values), kind="stable")
    values, first, second = values[order], first[order], second[order]
    counts = np.bitwise_count(values).astype(np.int64)
    label = np.arange(len(values))
    rows, cols = np.flatnonzero(first), np.flatnonzero(second)
    col_values, col_counts = values[cols], counts[cols]
    for start in range(0, len(rows), _STRIP):
        strip = rows[start : start + _STRIP]
        lo, hi = np.searchsorted(col_counts, [counts[strip[0]] - radius, counts[strip[-1]] + radius + 1])
        near = np.bitwise_count(values[strip][:, None] ^ col_values[None, lo:hi]) <= radius
        i, j = np.nonzero(near)
        i, j = strip[i], cols[lo + j]
        i, j = i[i != j], j[i != j]
        while len(i):  # hook the larger label to the smaller, then shorten the paths
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                shorter = label[label]
                if (shorter == label).all():
                    break
                label = shorter
    leaf = np.flatnonzero(label != np.arange(len(values)))
    return values[leaf], values[label[leaf]]


def tile_pairs(unique: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Every fingerprint once for each tile pair it takes part in, with its side of it."""
    n = unique.count()
    bits = min(_BLOCK_BITS, max(0, (max(n, 1) * 2 // tile_rows).bit_length()))
    blocks = _BLOCKS if bits else 1
    dealt = unique.select(
        "fp", F.bit_count("fp").alias("ones"),
        F.posexplode(F.array(*[
            F.shiftrightunsigned(F.col("fp"), _BLOCK_BITS * b + _BLOCK_BITS - bits).bitwiseAND((1 << bits) - 1)
            for b in range(blocks)
        ])).alias("block", "lead"),
    )
    # at most 4 x 2^16 groups of 65 counts; only groups over a tile are kept
    sizes = dealt.groupBy("block", "lead", "ones").agg(F.count(F.lit(1)).alias("n"))
    large = (
        sizes.groupBy("block", "lead")
        .agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile_rows).cast("int")))).alias("salts"))
        .where(F.col("n") > tile_rows)
        .drop("n")
    )
    known = dealt.join(large, ["block", "lead"], "left")
    salt = F.pmod(F.xxhash64("fp"), F.col("salts")[F.col("ones")]).cast("int")
    own = F.struct(F.col("ones").alias("o"), salt.alias("s"))
    partners = F.flatten(F.transform(
        F.sequence(F.col("ones") - radius, F.col("ones") + radius),
        lambda o: F.when(
            F.coalesce(F.col("salts")[o], F.lit(0)) > 0,
            F.transform(F.sequence(F.lit(0), F.col("salts")[o] - 1), lambda s: F.struct(o.alias("o"), s.alias("s"))),
        ).otherwise(F.array().cast("array<struct<o:int,s:int>>")),
    ))
    one = F.struct(F.lit(-1).alias("o"), F.lit(0).alias("s"))
    mine = F.when(F.col("salts").isNull(), one).otherwise(own)
    others = F.when(F.col("salts").isNull(), F.array(one)).otherwise(partners)
    pairs = known.select("fp", "block", "lead", mine.alias("mine"), F.explode(others).alias("other"))
    return pairs.select(
        "fp", "block", "lead",
        F.least("mine", "other").alias("left"), F.greatest("mine", "other").alias("right"),
        (F.col("mine") <= F.col("other")).alias("first"), (F.col("mine") >= F.col("other")).alias("second"),
    )


def links(unique: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Distinct fingerprints (column ``fp``) -> edges (``a``, ``b``) whose components are
    those of all pairs within ``radius`` bits (at most 3)."""
    if radius >= _BLOCKS:
        raise ValueError("four blocks find pairs within three bits")

    def compare(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        a, b = _forest(values, table.column("first").to_numpy(), table.column("second").to_numpy(), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (
        tile_pairs(unique, radius, tile_rows)
        .groupBy("block", "lead", "left", "right")
        .applyInArrow(compare, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (long), ``component_id``, the
    smallest id that links of up to ``radius`` bits reach, itself included, and ``root``,
    the smallest fingerprint reached.

    A null, empty or blank text has fingerprint 0, which links like any other. Texts of
    fewer words than a shingle hash as a whole. Equal texts, repeated rows and repeated
    ids share a component. A null id is never the smallest, and a component of null ids
    has a null component_id. Other columns are not read. An empty table gives an empty
    result.
    """
    own = stored(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text).cast("string")).alias("fingerprint")), "simhash"
    )
    unique = own.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("smallest"))
    linked = components(links(unique.select("fp"), radius, tile_rows))
    rooted = unique.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of = rooted.join(named, "root").select(F.col("fp").alias("fingerprint"), "component_id", "root")
    return own.join(of, "fingerprint").select("doc_id", "fingerprint", "component_id", "root")


def distinct_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id. If several
    of its rows have that id, or none has an id, one of those rows stays."""
    names = docs.columns
    plain = docs.select([F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    text, doc_id = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    found = stored(near_duplicates(plain, text, doc_id), "simhash-found")
    # all rows of an id count, as some may lie in components with smaller ids
    counts = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.expr("doc_id = component_id")).alias("leads")
    )
    ids = stored(counts.where("leads").select(F.col("doc_id").alias("component_id"), "rows"), "simhash-ids")
    own = F.col(doc_id)
    # the ids grow with the texts, so both are sorted by id at any size and none is broadcast
    out = plain.join(ids.where("rows = 1").hint("merge"), own == F.col("component_id")).select(*plain.columns)
    several, unnamed = ids.where("rows > 1"), found.where("component_id is null")
    if not (several.isEmpty() and unnamed.isEmpty()):  # ids that name no single row: go by fingerprint
        rest = plain.join(several, own == F.col("component_id"), "left_semi").unionByName(plain.where(own.isNull()))
        prints = found.select("fingerprint", "root", "component_id").distinct()
        marked = rest.withColumn("fingerprint", fingerprint(F.col(text).cast("string"))).join(prints, "fingerprint")
        first = marked.where(own.eqNullSafe(F.col("component_id"))).dropDuplicates([doc_id, "root"])
        out = out.unionByName(first.select(*plain.columns))
    return out.select([F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
