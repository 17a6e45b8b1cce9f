"""Language identification of mixed-language text, span by span.

A text is cut into words, runs of letters and marks. The scripts of a word's letters,
known from ranges of code points, narrow the languages it can be in to those that use one
of them. Each candidate scores the word by the frequencies of its character n-grams. The
most likely sequence of languages then follows from Viterbi's recursion over the word
scores, with a penalty for each switch: single words with a foreign look stay with their
surroundings, a passage in another language gets a span of its own. The language of a
text is the one whose spans hold most of its letters.

All scoring is done on arrays of code points of many texts at once. A text needs no
recursion if, in no stretch of it, another language gains more than half the penalty on
the best single one, since no sequence with switches can win then. The others go through
it side by side, word by word.

Models are fitted in Spark on a sample of labelled texts of bounded size: tasks count
hashed n-grams per language, and their counts are added up in slices.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled texts fitted on per language (about; drawn by a hash of the text), languages
#: learned at most (the commonest), buckets of n-grams, and the longest n-gram.
TEXTS, LANGUAGES, BUCKETS, ORDERS = 4_000, 256, 1 << 16, 4

#: Cost of a change of language, the most a word can count against a language, weight of
#: an n-gram's log frequency (n-grams overlap), and the frequency of what was never seen.
SWITCH, CLIP, WEIGHT, UNSEEN = 12.0, 6.0, 0.5, 1e-6

#: What a text without letters is in.
UNDETERMINED = "und"

#: Share of a language's letters from which on a script counts as one of its own.
_SCRIPT_SHARE = 0.01

#: Code point ranges of scripts (first, last), after the Unicode blocks.
SCRIPT_RANGES = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F), (0xFB13, 0xFB17)],
    "Hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Syriac": [(0x700, 0x74F)],
    "Thaana": [(0x780, 0x7BF)],
    "Devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Oriya": [(0xB00, 0xB7F)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Sinhala": [(0xD80, 0xDFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Lao": [(0xE80, 0xEFF)],
    "Tibetan": [(0xF00, 0xFFF)],
    "Myanmar": [(0x1000, 0x109F), (0xAA60, 0xAA7F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "Ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F)],
    "Cherokee": [(0x13A0, 0x13FF), (0xAB70, 0xABBF)],
    "Canadian": [(0x1400, 0x167F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Mongolian": [(0x1800, 0x18AF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "Han": [(0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
_OTHER = len(SCRIPT_RANGES)  # letters of any other script
_MARK = _OTHER + 1  # combining marks belong to a word, but to no script

#: Code points of texts that are scored together (more if one text is longer).
_TOGETHER = 1 << 18
#: Word scores that wait for the recursion at most (about).
_WAITING = 1 << 22
_SLICE = 4_096
_MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its class (0 for no letter, else 1 + script), and its lower case
    where that is one code point too."""
    kind, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    script = np.full(0x110000, _OTHER, np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values()):
        for first, last in ranges:
            script[first : last + 1] = number
    for code in range(0x32400):
        char = chr(code)
        if char.isalpha():
            kind[code] = 1 + script[code]
            small = char.lower()
            if len(small) == 1:
                lower[code] = ord(small)
        elif unicodedata.category(char)[0] == "M":
            kind[code] = 1 + _MARK
    return kind, lower


@dataclass
class Words:
    """Words of several texts: ``start`` and ``end`` in the joined code points, the text of
    each, how many letters, the scripts as bits, and the hashed n-grams of every place."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray
    grams: list[np.ndarray]


def _shifted(values: np.ndarray, by: int, fill) -> np.ndarray:
    return np.concatenate([np.full(min(by, len(values)), fill, values.dtype), values[:-by]])


def split_words(codes: np.ndarray, sizes: np.ndarray) -> Words:
    """Words of texts whose code points follow one another, each text followed by a zero.
    Marks alone are no word. ``sizes`` include the zeros."""
    kinds, lower = _tables()
    kind = kinds[codes]
    inside = kind > 0
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(before & ~inside)
    letter = inside & (kind != 1 + _MARK)
    bits = np.where(letter, np.uint64(1) << (np.maximum(kind, 1) - 1).astype(np.uint64), np.uint64(0))
    letters = np.add.reduceat(letter.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    scripts = np.bitwise_or.reduceat(bits, start) if len(start) else np.zeros(0, np.uint64)
    good = letters > 0
    text = np.searchsorted(np.cumsum(sizes), start, side="right")

    # the n-grams that end at each place; boundaries count as a character
    shown = np.where(inside, lower[codes], 0).astype(np.uint64) + np.uint64(1)
    mixed, linked, grams = shown * _MIX[0], np.ones(len(codes), bool), []
    for order in range(1, ORDERS + 1):
        if order > 1:
            earlier = _shifted(shown, order - 1, np.uint64(1))
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1] + np.where(linked, earlier, np.uint64(1)) * _MIX[order - 1]
            linked &= _shifted(inside, order - 1, False)  # no further back than the word's start
        bucket = ((mixed ^ (mixed >> np.uint64(32))) * _MIX[3] >> np.uint64(48)).astype(np.int64)
        grams.append(np.where(inside if order == 1 else inside | before, bucket, BUCKETS))
    return Words(start[good], end[good], text[good], letters[good], scripts[good], grams)


def _joined(values: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, each followed by a zero, and their numbers."""
    parts = [np.frombuffer(v.decode("utf-8", "replace").encode("utf-32-le"), "<u4") for v in values]
    zero = np.zeros(1, np.uint32)
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    return (np.concatenate([x for p in parts for x in (p, zero)]) if parts else zero[:0]), sizes


def _groups(values: Sequence[bytes | None]) -> Iterator[list[int]]:
    """Positions of texts to be handled together."""
    held, size = [], 0
    for i, value in enumerate(values):
        if not value:
            continue
        if held and size + len(value) > _TOGETHER:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(value)
    if held:
        yield held


@dataclass
class Model:
    """Languages by code point, log frequencies of n-grams (bucket, language; the last row,
    of zeros, is for places without one) and the scripts of each language as bits."""

    languages: list[str]
    table: np.ndarray
    scripts: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        """Log likelihood of each word per language, at most 0 (the best candidate's) and
        at least -CLIP. Languages without the word's scripts get -CLIP, unless none has
        them."""
        if not len(words.start):
            return np.zeros((0, len(self.languages)), np.float32)
        total = self.table[words.grams[0]]
        for gram in words.grams[1:]:
            total += self.table[gram]
        # a word's n-grams end at its letters and at the place after it
        cuts = np.stack([words.start, words.end + 1], axis=1).reshape(-1)
        if cuts[-1] >= len(total):
            cuts = cuts[:-1]
        scores = np.add.reduceat(total, cuts, axis=0)[::2] * np.float32(WEIGHT)
        fits = (words.scripts[:, None] & self.scripts[None, :]) != 0
        fits |= ~fits.any(axis=1, keepdims=True)
        scores = np.where(fits, scores, -np.inf)
        scores -= scores.max(axis=1, keepdims=True)
        return np.maximum(scores, -np.float32(CLIP))


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", texts: int = TEXTS, languages: int = LANGUAGES
) -> Model:
    """Model of the ``languages`` commonest values of ``lang``, on about ``texts`` texts of
    each, drawn by a hash of the text. Rows with a null or empty text, or a null language,
    are left out. Without any row the model has no language."""
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text <> '' and lang is not null"
    )
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    names = sorted(r.lang for r in sizes)
    if not names:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0, np.uint64))
    share = {r.lang: min(1.0, texts / r.n) for r in sizes}
    wanted = F.create_map(*[F.lit(x) for name in names for x in (name, share[name])])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < wanted[F.col("lang")] * (1 << 30)
    slices = BUCKETS // _SLICE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            values = batch.column(0).cast(pa.binary()).to_pylist()
            labels = batch.column(1).to_pylist()
            for label in set(labels):
                own = [v for v, name in zip(values, labels, strict=True) if name == label]
                mine = counts.setdefault(label, np.zeros(BUCKETS, np.int64))
                seen = scripts.setdefault(label, np.zeros(_SLICE, np.int64))
                for group in _groups(own):
                    codes, lengths = _joined([own[i] for i in group])
                    words = split_words(codes, lengths)
                    for gram in words.grams:
                        mine += np.bincount(gram, minlength=BUCKETS + 1)[:BUCKETS]
                    kinds = _tables()[0][codes]
                    seen[:_MARK] += np.bincount(kinds, minlength=_MARK + 1)[1 : _MARK + 1]
        for label, mine in counts.items():
            parts = [*mine.reshape(slices, _SLICE), scripts[label]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * (slices + 1)), pa.array(range(slices + 1), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["lang", "slice", "counts"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"lang": table.column("lang")[:1], "slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()])})

    schema = "lang string, slice int, counts binary"
    counted = rows.where(drawn).mapInArrow(count, schema).groupBy("lang", "slice").applyInArrow(add, schema).collect()
    full = np.zeros((len(names), slices + 1, _SLICE), np.float64)
    at = {name: i for i, name in enumerate(names)}
    for row in counted:
        full[at[row.lang], row.slice] = np.frombuffer(row.counts, np.int64)
    grams, scripts = full[:, :slices].reshape(len(names), BUCKETS), full[:, slices, :_MARK]
    table = np.log(grams / np.maximum(grams.sum(axis=1, keepdims=True), 1) + UNSEEN)
    common = scripts >= _SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    bits = (common.astype(np.uint64) << np.arange(_MARK, dtype=np.uint64)).sum(axis=1).astype(np.uint64)
    return Model(names, np.vstack([table.T, np.zeros((1, len(names)))]).astype(np.float32), bits)


def best_paths(scores: Sequence[np.ndarray], switch: float) -> list[np.ndarray]:
    """Viterbi's recursion over several score tables (word, language), side by side. Ties
    stay, or go to the first language."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    total = np.concatenate([scores[i] for i in order]).astype(np.float64)
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    value = total[base].copy()
    stays = np.ones(total.shape, bool)
    source = np.zeros(len(total), np.int64)
    for t in range(1, int(lengths[0])):
        active = int(np.searchsorted(-lengths, -t, side="left"))
        now, at = value[:active], base[:active] + t
        best = now.argmax(axis=1)
        other = now[np.arange(active), best][:, None] - switch
        stays[at], source[at] = now >= other, best
        value[:active] = np.maximum(now, other) + total[at]
    label = np.zeros(len(total), np.int64)
    state = value.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        active = int(np.searchsorted(-lengths, -t, side="left"))
        at = base[:active] + t
        own = state[:active]
        label[at] = own
        state[:active] = np.where(stays[at, own], own, source[at])
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    for k, i in enumerate(order):
        out[i] = label[base[k] : base[k] + lengths[k]]
    return out


def path(scores: np.ndarray, switch: float) -> np.ndarray | None:
    """The one language of all words if no switch can pay, else None.

    A language other than the best single one must gain more than half a penalty on it in
    some stretch: with m stretches in others there are m switches, or m - 1, at least half
    of m, if the best one is not used at all.
    """
    best = int(scores.sum(axis=0, dtype=np.float64).argmax())
    gain = np.zeros((len(scores) + 1, scores.shape[1]))
    np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64, out=gain[1:])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() > switch / 2:
        return None
    return np.full(len(scores), best, np.int64)


def _verdict(model: Model, words: tuple[np.ndarray, ...], labels: np.ndarray) -> tuple[str, float, list[dict]]:
    """Language, score and spans of a text from the labels of its words."""
    start, end, letters, odds = words
    held = np.bincount(labels, letters, len(model.languages))
    top = int(held.argmax())
    score = float((odds[:, top] * letters).sum() / letters.sum())
    heads = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1])
    tails = np.concatenate([heads[1:] - 1, [len(labels) - 1]])
    spans = [
        {"start": s, "end": e, "lang": model.languages[name]}
        for s, e, name in zip(start[heads].tolist(), end[tails].tolist(), labels[heads].tolist(), strict=True)
    ]
    return model.languages[top], min(max(score, 0.0), 1.0), spans


def label_texts(values: Sequence[bytes | None], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans of each text."""
    out: list[tuple[str, float, list[dict]]] = [(UNDETERMINED, 0.0, [])] * len(values)
    if not model.languages:
        return out
    waiting: list[tuple[int, np.ndarray, tuple[np.ndarray, ...]]] = []  # texts that need the recursion

    def release() -> None:
        labels = best_paths([scores for _, scores, _ in waiting], switch) if waiting else []
        for (i, _, words), found in zip(waiting, labels, strict=True):
            out[i] = _verdict(model, words, found)
        waiting.clear()

    entries = 0
    for group in _groups(values):
        codes, sizes = _joined([values[i] for i in group])
        words = split_words(codes, sizes)
        scores = model.word_scores(words)
        odds = np.exp(scores)
        odds /= odds.sum(axis=1, keepdims=True)
        edges = np.searchsorted(words.text, np.arange(len(group) + 1)).tolist()
        offsets = (np.cumsum(sizes) - sizes).tolist()
        for i, lo, hi, offset in zip(group, edges[:-1], edges[1:], offsets, strict=True):
            if lo == hi:
                continue
            mine = (words.start[lo:hi] - offset, words.end[lo:hi] - offset, words.letters[lo:hi], odds[lo:hi])
            single = path(scores[lo:hi], switch)
            if single is not None:
                out[i] = _verdict(model, mine, single)
                continue
            waiting.append((i, scores[lo:hi], mine))
            entries += scores[lo:hi].size
        if entries > _WAITING:
            release()
            entries = 0
    release()
    return out


def identify(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_spans``.

    ``lang_pred`` is the language with most letters in its spans (ties: the first by code
    point). ``score`` is the mean over the letters of the probability that their word alone
    gives that language. ``lang_spans`` are start and end (code points, end exclusive) and
    language of stretches of words, in order; words are runs of letters and marks.

    A text that is null or has no letter is ``und`` with score 0 and no spans, and so is
    every text if the model has no language. Words in a script no language uses are scored
    by all. Texts are read whole, repeated rows get equal results, an empty table gives an
    empty one. Input columns with the names of added ones are replaced. The model is sent
    to the tasks; its size is 65,537 x 4 bytes a language, for 256 languages at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    @F.arrow_udf("lang_pred string, score double, lang_spans array<struct<start:long,end:long,lang:string>>")
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = label_texts(batch.cast(pa.binary()).to_pylist(), shared.value, switch)
            names, scores, spans = zip(*found, strict=True) if found else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                ["lang_pred", "score", "lang_spans"],
            )

    added = ["lang_pred", "score", "lang_spans"]
    names = [c for c in docs.columns if c not in added]
    made = docs.withColumn("__found", find(F.col(text).cast("string")))
    return made.select(*names, *[F.col(f"__found.{c}").alias(c) for c in added])
