"""Token counts by a map-side lookup in two tiers, without a shuffle of pre-tokens.

Tier one is a compact table of the most frequent pre-tokens (words between white space)
and their token lengths, broadcast to all workers. Tier two is a bounded cache in each
Python worker; only what neither holds is encoded. The tiers change the speed, never the
counts. The table has a fixed number of entries, so its size does not follow the data.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from olapflow.llm.tokenizer import LONG, _Kept, load

#: Entries of the broadcast table, documents it is drawn from (about), and words a task
#: reports for it.
FREQUENT, SAMPLED, REPORTED = 32_768, 2_000, 8_192

_COUNTERS: dict = {}


def frequent_words(docs: DataFrame, text: str = "text", size: int = FREQUENT, sampled: int = SAMPLED) -> list[bytes]:
    """Frequent pre-tokens, at most ``size`` of them, from about ``sampled`` documents drawn
    over the whole table.

    Each task counts the words of its drawn documents and reports its ``REPORTED`` most
    frequent to the driver: no pre-token is shuffled, and the reports are bounded by the
    sample. Words over 64 bytes are left out. The table only saves work, so the sample
    changes no count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()).to_pylist():
                if value:
                    seen.update(value.split())
            if len(seen) > 32 * REPORTED:
                seen = Counter(dict(seen.most_common(8 * REPORTED)))
        top = [(w, n) for w, n in seen.most_common(REPORTED) if len(w) <= LONG]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["word", "n"]
        )

    rows = docs.count()
    drawn = docs.select(F.col(text).cast("string").alias("text")).sample(fraction=min(1.0, sampled / max(rows, 1)), seed=19)
    total: Counter = Counter()
    for word, n in drawn.mapInArrow(count, "word binary, n long").collect():
        total[bytes(word)] += n
    return sorted(total, key=lambda w: (-total[w], w))[:size]


def _counter(path: str, mark: str, words: list[bytes]):
    """The worker's lookup: frequent lengths first, then a cache, then the tokenizer."""
    if mark not in _COUNTERS:
        _COUNTERS.clear()
        tokenizer = load(path)
        first = {w: len(tokenizer.word_ids(w)) // tokenizer.width for w in words}
        _COUNTERS[mark] = tokenizer, _Kept(lambda w: len(tokenizer.word_ids(w)) // tokenizer.width, first)
    return _COUNTERS[mark]


def token_length(docs: DataFrame, path: str, text: str = "text") -> Column:
    """Expression for the number of tokens of ``text`` under the tokenizer file ``path``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(docs, text) if load(path).by_word else [])

    mark = uuid.uuid4().hex

    @F.arrow_udf(LongType())
    def n_tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer, lengths = _counter(path, mark, shared.value)
        look = lengths.__getitem__
        for batch in texts:
            values = batch.cast(pa.binary()).to_pylist()
            if tokenizer.by_word:
                counts = [sum(map(look, v.split())) if v else 0 for v in values]
            else:
                counts = [len(tokenizer.text_ids(v.decode("utf-8", "replace"))) // tokenizer.width if v else 0 for v in values]
            yield pa.array(counts, pa.int64())

    return n_tokens(F.col(text).cast("string"))


def token_counts(docs: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    A null or empty text has 0 bytes and 0 tokens. Input columns of those three names are
    replaced; other columns, nulls, repeated and tied rows pass as they are. An empty
    table gives an empty result. A text is one row and is read whole, whatever its length.
    """
    return docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long"),
        "n_tokens": token_length(docs, path, text),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
