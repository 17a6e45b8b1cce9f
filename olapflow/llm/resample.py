"""Importance resampling of documents towards a target set.

Two generative models over hashed word n-grams are fitted: one on target texts, one on
the raw corpus. A document's weight is the ratio of its likelihoods under the two, per
n-gram, so that length alone neither helps nor harms; a short text is drawn to a ratio of
one. Adding Gumbel noise to the log
weight and taking the k largest draws k documents without replacement in proportion to
their weights. The noise is a hash of the document id, so reruns agree.

The raw model counts every document. The target model is fitted on labelled documents,
at most ``TARGET_ROWS`` of them, chosen by a hash of their ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from olapflow.llm.base import stored
from olapflow.llm.tokenizer import LONG, _Kept
from olapflow.operators.window import row_index

#: Buckets of the models, labelled rows the target model is fitted on, smoothing counts of
#: each bucket, n-grams of no evidence added to each text, strength of the weights against
#: the noise.
BUCKETS, TARGET_ROWS, SMOOTH, PRIOR, SHARPNESS = 1 << 16, 50_000, 1.0, 32, 64.0

_MIX = np.uint64(0x9E3779B97F4A7C15)
_HASHES = _Kept(lambda w: xxhash.xxh64_intdigest(w))


def ngram_buckets(text: bytes | None, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every word and every pair of neighbouring words, in lower case (A-Z)."""
    words = text.lower().split() if text else []
    one = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    two = (one[:-1] * _MIX + one[1:]) * _MIX
    return ((np.concatenate([one * _MIX, two]) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def ngram_counts(docs: DataFrame, text: str, is_target: Column, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``raw`` and ``target`` counts. A task reports each bucket at most once."""
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(is_target, F.lit(False)).alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for value, chosen in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(ngram_buckets(value, buckets), minlength=buckets) if value else 0
                raw += found
                if chosen:
                    target += found
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
        )

    parts = rows.mapInArrow(count, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability per bucket; one row per bucket comes to the driver."""
    raw, target = np.full(buckets, SMOOTH), np.full(buckets, SMOOTH)
    for row in counts.collect():
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def target_ids(labels: DataFrame, is_target: Column, doc_id: str = "doc_id", rows: int = TARGET_ROWS) -> DataFrame:
    """Ids of at most ``rows`` target documents, by a hash of the id, without repeats."""
    ids = labels.where(is_target & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("target_id")).distinct()
    return ids.orderBy(F.xxhash64("target_id"), "target_id").limit(rows)


def gumbel(doc_id: Column, seed: str) -> Column:
    """Standard Gumbel noise as a function of the id."""
    named = F.concat_ws(":", F.lit(seed), doc_id.cast("string"))
    part = F.pmod(F.xxhash64(named), F.lit(1 << 52)).cast("double")
    return -F.log(-F.log((part + 0.5) / float(1 << 52)))


def resample(
    docs: DataFrame, targets: DataFrame, share: float, text: str = "text", doc_id: str = "doc_id", seed: str = "resample",
) -> DataFrame:
    """Every document's ``doc_id``, ``n_ngrams``, ``log_weight``, ``draw`` and ``kept``.

    ``targets`` holds the ids of the target documents (``target_id``, bounded, see
    ``target_ids``). The ``share`` of all rows with the largest ``draw`` is kept, ties going
    to the smaller id and then in any order among equal rows. ``log_weight`` is the
    log ratio per n-gram, ``PRIOR`` n-grams of ratio one added; a null or empty text has no n-grams and the weight 0 of a text
    the models cannot tell apart. Equal texts have equal weights. Rows with a null id all
    have the same noise. Other columns are not read. An empty table gives an empty result.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = named.join(F.broadcast(targets), F.col("doc_id") == F.col("target_id"), "left")
    ratios = log_ratios(ngram_counts(marked, "text", F.col("target_id").isNotNull()))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.arrow_udf("n_ngrams long, log_weight double")
    def weigh(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ratio = shared.value
        for batch in texts:
            found = [ngram_buckets(t) for t in batch.cast(pa.binary()).to_pylist()]
            mean = [float(ratio[f].sum()) / (len(f) + PRIOR) for f in found]
            yield pa.StructArray.from_arrays(
                [pa.array([len(f) for f in found], pa.int64()), pa.array(mean, pa.float64())], ["n_ngrams", "log_weight"]
            )

    weighed = stored(
        named.select("doc_id", weigh("text").alias("w")).select(
            "doc_id", "w.*", (SHARPNESS * F.col("w.log_weight") + gumbel(F.col("doc_id"), seed)).alias("draw")
        ),
        "resample",
    )
    return top_draws(weighed, share)


def top_draws(weighed: DataFrame, share: float) -> DataFrame:
    """Mark the rows with the largest ``draw``, ``share`` of them, as ``kept``."""
    rows = weighed.count()
    ordered = weighed.withColumn("__order", -F.col("draw"))
    ranked = row_index(ordered, [], ["__order", "doc_id"], "__rank", start=1)
    return ranked.withColumn("kept", F.col("__rank") <= math.floor(share * rows + 0.5)).drop("__order", "__rank")
