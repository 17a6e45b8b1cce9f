"""Quality rules as a short-circuit cascade, in built-in column expressions only.

A text is rejected as soon as one rule rejects it. Which rules run first is decided from
a sample: each rule's cost (time per sampled row) and selectivity (share it rejects) are
measured, and the rules are ordered by rejection per cost. The order changes the work,
never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from olapflow.llm.base import SPACE, stored, words_of

#: Rows the order is fitted on. The sample is drawn from the whole table.
SAMPLE_ROWS = 1_000

_TEXT, _WORDS = "__text", "__words"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though it is used many times."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Number of words in three-word windows that occur twice or more.

    Windows are compared by a 64-bit hash. Texts whose windows all differ stop there;
    others sort (hash, position) pairs and measure what the repeated windows cover.
    """

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, i: F.when(i < F.size(places) - 1, F.least(F.lit(3), places[i + 1] - p)).otherwise(3),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def repeated(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda e, i: (F.get(pairs, i - 1)["h"].eqNullSafe(e["h"])) | (F.get(pairs, i + 1)["h"].eqNullSafe(e["h"])),
        )
        return let(F.array_sort(F.transform(twice, lambda e: e["i"])), covered)

    def of_windows(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
        ).otherwise(let(pairs, repeated))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])
    )
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(windows, of_windows))


def _worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACE))) > 0)


def _without(text: Column, pattern: str) -> Column:
    """How many characters of the text the pattern takes."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """What the rules measure, by name."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": _without(text, r"[#*$%&|<>]+"),
        "n_dup_lines": let(_worded_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(words),
    }


def rules(text: Column, words: Column, m: dict[str, Column]) -> dict[str, Column]:
    """The rules: name -> condition under which a text is rejected, never null."""
    return {
        "few_words": m["n_words"] < 50,
        "repeated_windows": 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "word_length": (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
        "symbols": 5 * m["n_symbols"] > m["n_words"],
        "duplicate_lines": 2 * m["n_dup_lines"] > F.size(_worded_lines(text)),
        "upper_case": 5 * _without(text, r"\p{Lu}+") > 2 * m["word_chars"],
        "few_lettered": 100 * F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) < 70 * m["n_words"],
    }


def rule_order(texts: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejection per cost, measured on about ``sample_rows`` rows of the
    texts; only those are split into words."""
    conditions = rules(F.col(_TEXT), F.col(_WORDS), measures(F.col(_TEXT), F.col(_WORDS)))
    n = texts.count()
    if not n:
        return list(conditions)
    drawn = texts.select(_TEXT).sample(fraction=min(1.0, sample_rows / n), seed=17)
    sample = stored(drawn.withColumn(_WORDS, words_of(F.col(_TEXT))), "rules-sample")

    def timed(condition: Column) -> tuple[float, float]:
        ask = sample.agg(F.avg(condition.cast("double")).alias("rejected"))
        best = float("inf")
        for _ in range(2):  # the first run also compiles
            start = time.perf_counter()
            rejected = ask.first().rejected
            best = min(best, time.perf_counter() - start)
        return best, rejected or 0.0

    idle, _ = timed(F.size(_WORDS) < 0)
    gain = {}
    for name, condition in conditions.items():
        cost, rejected = timed(condition)
        gain[name] = rejected / max(cost - idle, 1e-4)
    return sorted(conditions, key=lambda name: -gain[name])


def quality_rules(
    docs: DataFrame, text: str = "text", report: bool = False, order: list[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``kept`` (boolean) and ``rejected_by`` (the first rule that rejects, or null).

    With ``report`` the measures of every text are added too; without, a rule's measure
    is computed only for texts that no earlier rule has rejected. ``order`` takes an
    order found before and leaves out the sample.

    A null or empty text has no words and is rejected by ``few_words`` or another rule.
    An empty table gives an empty result. Repeated rows get equal verdicts. Input columns
    with the names of added ones are replaced. Lines are compared whole, words of any
    length count, and no text is cut.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.drop("kept", "rejected_by", *(MEASURES if report else [])).withColumn(_TEXT, content)
    if order is None:
        order = rule_order(base, sample_rows)
    # a generator, since a filter on the verdict would carry the splitting into the lambdas,
    # to be done once per word, if the words came from a plain projection
    base = base.withColumn(_WORDS, F.explode(F.array(words_of(F.col(_TEXT)))))
    measured = measures(F.col(_TEXT), F.col(_WORDS))
    if report:
        base = base.withColumns(measured)
        measured = {name: F.col(name) for name in MEASURES}
    conditions = rules(F.col(_TEXT), F.col(_WORDS), measured)
    first = F.lit(None).cast("string")
    for name in reversed(order):
        first = F.when(conditions[name], F.lit(name)).otherwise(first)
    out = base.withColumn("rejected_by", first).withColumn("kept", F.col("rejected_by").isNull())
    return out.drop(_TEXT, _WORDS)
