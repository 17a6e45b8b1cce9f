"""Periodic runs of the words of a text, found from Lyndon arrays.

A suffix sorter in the manner of Baier groups the suffixes of a text first. Its first
phase takes the groups from the highest down: every suffix of the group in hand is joined
to the nearest suffix on its left that is in a lower group, which thereby moves to a group
of its own just above its old one. When a group's turn comes, the words its members have
gathered are their longest Lyndon prefixes. So the first phase alone gives the Lyndon
array; it is run under both orders of the words.

Every run has a Lyndon root under one of the orders. Each Lyndon prefix is taken as a root
and extended to both sides by longest common extensions, which compare hashes of word
sequences in a binary search; a run so found is compared word by word before it counts.

A text is one row, and rows are independent, so Spark may place them anywhere. Long
repeats are rare in clean text: the grouping is done for the stretches of a text all of
whose word windows come up again in it, outside of which no run can lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words a run must have, and times its period must fit into it.
LEAST_WORDS, LEAST_PERIODS = 24, 3

#: Modulus and base of the word hashes of extensions; a clash costs time, not the result.
_PRIME, _BASE = np.uint64((1 << 31) - 1), 1_103_515_245

RUN = "struct<start:long,length:long,period:long>"


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon prefix at each place; ``ranks`` are 0, 1, ... in the
    order of the words, each in use. A shorter word sequence comes before a longer one
    that begins with it."""
    n, top = len(ranks), max(ranks, default=-1)
    group = list(ranks)
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for place, rank in enumerate(ranks):
        members[rank].append(place)
    gathered = [1] * (top + 1)
    below, above = list(range(-1, top)), list(range(1, top + 2))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    lengths = [1] * n
    now = top
    while now >= 0:
        words = gathered[now]
        moved: dict[tuple[int, int], list[int]] = {}
        for i in members[now]:
            if group[i] != now:
                continue
            lengths[i] = words
            j = left[i]
            if j >= 0 and group[j] == now:
                continue
            times, k = 1, right[i]  # a chain of members, all joined to j
            while k < n and group[k] == now:
                times, k = times + 1, right[k]
            if k < n:
                left[k] = j
            if j >= 0:
                right[j] = k
                moved.setdefault((times, group[j]), []).append(j)
        for times, old in sorted(moved, reverse=True):  # longer chains are higher
            fresh = len(members)
            members.append(moved[times, old])
            gathered.append(gathered[old] + times * words)
            below.append(old)
            above.append(above[old])
            below[above[old]] = fresh  # the group in hand is above all that move
            above[old] = fresh
            for j in moved[times, old]:
                group[j] = fresh
        now = below[now]
    return lengths


class _Extensions:
    """Longest common extensions of many pairs of places at once."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.ones(n + 1, np.uint64)
        step, done = np.uint64(_BASE), 1
        while done <= n:
            upto = min(done, n + 1 - done)
            power[done : done + upto] = power[:upto] * step % _PRIME
            step, done = step * step % _PRIME, done + upto
        self.n, self.power = n, power
        values = (words.astype(np.uint64) * np.uint64(2_654_435_761) + np.uint64(12_345)) % _PRIME
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n] % _PRIME, out=self.sums[1:])
        self.sums %= _PRIME

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the hashes of ``length`` words at i and at j (i < j) agree."""
        first = (self.sums[i + length] + _PRIME - self.sums[i]) % _PRIME
        second = (self.sums[j + length] + _PRIME - self.sums[j]) % _PRIME
        return first * self.power[j - i] % _PRIME == second

    def _search(self, most: np.ndarray, test) -> np.ndarray:
        found = np.zeros_like(most)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            more = np.flatnonzero(found + step <= most)
            good = more[test(more, found[more] + step)] if len(more) else more
            found[good] += step
            step >>= 1
        return found

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._search(self.n - j, lambda at, k: self.equal(i[at], j[at], k))

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words before i that equal the words before j."""
        return self._search(i.copy(), lambda at, k: self.equal(i[at] - k, j[at] - k, k))


def _grown(words: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """Start and end of the stretch around a root, word by word (after a hash clash)."""
    lo, hi = start, start + period
    while hi < len(words) and words[hi] == words[hi - period]:
        hi += 1
    while lo > 0 and words[lo - 1] == words[lo - 1 + period]:
        lo -= 1
    return lo, hi


def stretch_runs(words: np.ndarray, least: int, times: int) -> set[tuple[int, int, int]]:
    """Runs (start, length, period) of a sequence of word numbers."""
    _, ranks = np.unique(words, return_inverse=True)
    ranks, n = ranks.astype(np.int64), len(words)
    top = int(ranks.max())
    extensions = _Extensions(words)
    found = set()
    for order in (ranks, top - ranks):
        periods = np.array(lyndon_array(order.tolist()), np.int64)
        starts = np.arange(n)
        fits = starts + periods <= n
        starts, periods = starts[fits], periods[fits]
        ends = starts + periods
        lo = starts - extensions.backward(starts, ends)
        hi = ends + extensions.forward(starts, ends)
        good = hi - lo >= np.maximum(least, times * periods)
        for key in set(zip(lo[good].tolist(), hi[good].tolist(), periods[good].tolist(), strict=True)):
            a, b, p = key
            if np.array_equal(words[a : b - p], words[a + p : b]):
                found.add((a, b - a, p))
                continue
            for root in starts[good & (lo == a) & (hi == b) & (periods == p)].tolist():
                a, b = _grown(words, root, p)
                if b - a >= max(least, times * p):
                    found.add((a, b - a, p))
    return found


def repeated_stretches(words: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of words in windows whose hash comes up twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return []
    hashed = np.zeros(n, np.uint64)
    for k in range(window):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n].astype(np.uint64) + np.uint64(1)
    order = np.argsort(hashed, kind="stable")
    same = hashed[order][1:] == hashed[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    cut = np.flatnonzero(np.diff(at) > window) + 1
    heads, tails = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    return list(zip(heads.tolist(), (tails + window).tolist(), strict=True))


def word_runs(words: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of at least ``least`` words and ``times`` periods, by
    start, then period. Within a run every window of a third of ``least`` words comes up
    again a period away, so runs are looked for in such stretches only."""
    found = set()
    for a, b in repeated_stretches(words, max(1, least // times)):
        if b - a >= least:
            found.update((a + s, length, p) for s, length, p in stretch_runs(words[a:b], least, times))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal words alike."""
    number = dict(zip(dict.fromkeys(words), range(len(words)), strict=False))
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay if only the first period of each run does."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth)[:n] == 0


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for run in runs:  # by start, then period, so a tie leaves the earlier one
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, times: int = LEAST_PERIODS
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period; word numbers
    from 0; by start, then period), ``strongest`` (the run with the greatest length over
    period; ties: first in that order; null without a run) and ``collapsed`` (the text's
    words, of each run its first period only, one blank between).

    Words are what lies between ASCII white space. A run is a stretch with smallest period
    p, of at least ``least`` words and ``times`` (2 or more) periods, that neither
    neighbouring word extends. A null, empty or blank text has no words, no runs and an
    empty ``collapsed``. Repeated rows get equal results, an empty table an empty one.
    Input columns with the names of added ones are replaced. Texts of any length are read
    whole; memory grows with one batch of texts.
    """
    if times < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    @F.arrow_udf(f"n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string")
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            counts, all_runs, best, collapsed = [], [], [], []
            for value in batch.cast(pa.binary()).to_pylist():
                words = value.split() if value else []
                runs = word_runs(numbered(words), least, times)
                if runs:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
                counts.append(len(words) if not runs else len(value.split()))
                named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                all_runs.append(named)
                top = _strongest(runs)
                best.append(dict(zip(("start", "length", "period"), top, strict=True)) if top else None)
                collapsed.append(b" ".join(words))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(all_runs, kind), pa.array(best, kind.value_type),
                 pa.array(collapsed, pa.binary()).view(pa.string())],
                ["n_words", "runs", "strongest", "collapsed"],
            )

    added = ["n_words", "runs", "strongest", "collapsed"]
    names = [c for c in docs.columns if c not in added]
    made = docs.withColumn("__found", find(F.col(text).cast("string")))
    return made.select(*names, *[F.col(f"__found.{c}").alias(c) for c in added])


def planted(text: Column, doc_id: Column) -> Column:
    """Texts with a planted period, for one document in ten by the checksum of its id: from
    a word on, the words repeat with a period. Other texts stay as they are."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    chosen = checksum % 10 == 0

    @F.arrow_udf("string")
    def plant(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sums in parts:
            out = []
            for value, h in zip(texts.cast(pa.binary()).to_pylist(), sums.to_pylist(), strict=True):
                words = value.split() if value else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words = words[:a] + [words[a + i % p] for i in range(n - a)]
                out.append(b" ".join(words) if words else None)
            yield pa.array(out, pa.binary()).view(pa.string())

    text = text.cast("string")
    return F.coalesce(plant(F.when(chosen, text), checksum), text)
