"""Line dedup: lines that many documents share are dropped from all of them but one.

Lines are exploded into 128-bit hashes of their normalised keys, one row per document and
key. Distinct documents per key are counted in two steps, first by (key, document), so
that a key which a third of all documents hold is never in one task. Keys over the
threshold are joined back to their documents, and each document is put together again
from its kept lines, in their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from olapflow.llm.base import SPACE, stored

#: Code points a key must have, and distinct documents that make it a repeated line.
MIN_CHARS, MIN_DOCS = 20, 3

_SPACE = SPACE.encode()


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the line without outer white space and with A-Z lower-cased; None if short."""
    key = line.strip(_SPACE).lower()  # bytes: only A-Z change
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def document_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """One row (doc_id, key) for every distinct long line of every row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("key", BinaryType())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for i, value in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = {line_key(line, min_chars) for line in value.split(b"\n")} if value else set()
                found.discard(None)
                keys.extend(found)
                at.extend([i] * len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())], ["doc_id", "key"]
            )

    return rows.mapInArrow(explode, out)


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with shortened texts, ``n_lines`` (before) and ``n_dropped``.

    A line whose key has ``min_chars`` code points and stands in ``min_docs`` documents is
    dropped everywhere except in the document with the largest id holding it, which keeps
    all its lines. Shorter lines, blank ones too, always stay. A null or empty text is one
    empty line; a null text stays null. Rows with equal ids, null included, count as one
    document (null is the smallest id). An empty table gives an empty result. Input
    columns named n_lines or n_dropped are replaced.
    """
    keys = stored(document_keys(docs, doc_id, text, min_chars), "line-keys")
    shared = (
        keys.groupBy("key")
        .agg(F.countDistinct(F.struct("doc_id")).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
    )
    # a table of its own, so that the join can split a key which very many documents hold
    shared = stored(shared, "shared-lines")
    dropped = (
        keys.join(shared, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("__doc_id"))
        .agg(F.collect_set("key").alias("__dropped"))
    )

    @F.arrow_udf("text string, n_lines long, n_dropped long")
    def reassemble(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in parts:
            new, lines_of, dropped_of = [], [], []
            for value, drop in zip(texts.cast(pa.binary()).to_pylist(), drops.to_pylist(), strict=True):
                if not drop:
                    new.append(value)
                    lines_of.append(value.count(b"\n") + 1 if value else 1)
                    dropped_of.append(0)
                    continue
                out, lines = set(drop), (value or b"").split(b"\n")
                kept = [line for line in lines if line_key(line, min_chars) not in out]
                new.append(None if value is None else b"\n".join(kept))
                lines_of.append(len(lines))
                dropped_of.append(len(lines) - len(kept))
            yield pa.StructArray.from_arrays(
                [pa.array(new, pa.binary()).view(pa.string()), pa.array(lines_of, pa.int64()), pa.array(dropped_of, pa.int64())],
                ["text", "n_lines", "n_dropped"],
            )

    base = docs.drop("n_lines", "n_dropped")
    names = base.columns
    joined = base.join(dropped, F.col(doc_id).eqNullSafe(F.col("__doc_id")), "left")
    made = joined.withColumn("__made", reassemble(F.col(text).cast("string"), F.col("__dropped")))
    return made.select(
        *[F.col("__made.text").alias(c) if c == text else F.col(c) for c in names], "__made.n_lines", "__made.n_dropped"
    )
