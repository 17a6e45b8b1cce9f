"""Mixing and SimHash dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from olapflow.llm import components, mixing, simhash
from olapflow.llm.base import stored


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def check_mix(rows, out):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    target, taken = brute_targets(sizes), defaultdict(int)
    for r in out:
        assert (r.size, r.source_size) == (size_of(r.text), sizes[r.source])
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source in sizes:
        assert -1e-6 <= target[source] - taken[source] < 3
    return taken


def random_rows(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(n)]


def test_mix_meets_its_targets(docs, monkeypatch):
    rows = random_rows(400) + [(1000, None, "a"), (1001, "", "d"), (None, "no id here", "b")]
    first = mixing.mix(docs(rows)).collect()
    check_mix(rows, first)
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 10)  # many chunks, equal draws
    again = mixing.mix(docs(rows[::-1])).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.taken)
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_keys_follow_the_hash(docs):
    key = int(hashlib.md5(b"mix:5").hexdigest()[:15], 16)
    assert docs([(5, "a", "s")]).select(mixing.draw_key(mixing.F.col("doc_id"), "mix")).first()[0] == key


def test_repeated_ids_share_at_the_cut(docs):
    rows = [(1, "a b c d e", "s")] * 6 + [(2, "x y z", "t"), (3, "u v", None)]
    taken = check_mix_sums(rows, mixing.mix(docs(rows)).collect())
    assert all(t % 1 == 0 for t in taken.values())


def check_mix_sums(rows, out):
    taken = defaultdict(int)
    for r in out:
        assert r.taken <= 2 * r.size
        taken[r.source] += r.taken
        assert r.taken <= r.target
    for r in out:  # rounding leaves at most one word per tied row
        assert r.target - taken[r.source] < 1 + len(rows)
    return taken


def test_one_source_and_empty_tables(docs):
    rows = [(i, "one two three", "only") for i in range(20)]
    check_mix(rows, mixing.mix(docs(rows)).collect())
    assert mixing.mix(docs([])).count() == 0
    assert [r.taken for r in mixing.mix(docs([(1, "", "s"), (2, None, None)])).collect()] == [0, 0]


def test_the_mix_as_documents(docs):
    rows = random_rows(200, 3) + [(900, "  lead two\n three\tfour  ", "b")]
    taken = {r.doc_id: r.taken for r in mixing.mix(docs(rows)).collect()}
    frame = mixing.mixed_documents(docs(rows))
    assert frame.columns == docs(rows).columns
    words, texts = defaultdict(int), {i: t for i, t, _ in rows}
    for r in frame.collect():
        words[r.doc_id] += size_of(r.text)
        assert texts[r.doc_id].startswith(r.text) and r.kept == "kept?" and r.size == 7
    assert dict(words) == {i: t for i, t in taken.items() if t}


@pytest.mark.parametrize("n, want", [(1, "  a"), (2, "  a\tb"), (3, "  a\tb \n c"), (9, "  a\tb \n c")])
def test_first_words(spark, n, want):
    frame = spark.createDataFrame([("  a\tb \n c ", n)], "t string, n long")
    assert frame.select(mixing.first_words(mixing.F.col("t"), mixing.F.col("n"))).first()[0] == want


# ---------------------------------------------------------------- SimHash


def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0d]+", lower)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def near_texts(n, seed=5):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 9)) for _ in range(120)) for _ in range(n)]
    edits = [b.rsplit(" ", 1)[0] + " changed" for b in base[: n // 2]]
    return base + edits + base[:5] + ["", None, "  ", "One two", "one TWO", "ÉA b c d", "éa b c d"]


def test_fingerprints_and_components_against_brute_force(docs):
    texts = near_texts(60)
    rows = [(1000 - i, t, "s") for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in simhash.near_duplicates(docs(rows)).collect()}
    prints = [brute_print(t) for t in texts]
    roots = brute_components(prints)
    least = defaultdict(lambda: 10**9)
    for (doc_id, _, _), root in zip(rows, roots, strict=True):
        least[root] = min(least[root], doc_id)
    for (doc_id, _, _), p, root in zip(rows, prints, roots, strict=True):
        assert out[doc_id].fingerprint & (2**64 - 1) == p and out[doc_id].component_id == least[root]


@pytest.mark.parametrize("tile_rows", [8, 64, 4096])
def test_tiles_find_the_links_of_all_pairs(spark, tile_rows):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 120, dtype=np.int64).astype(np.uint64)
    prints = {int(s) for s in seeds}
    for s in seeds[:40]:
        for _ in range(12):  # a dense group around each of some seeds
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            prints.add(int(s) ^ int(sum(1 << int(f) for f in flips)))
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(frame, tile_rows=tile_rows)).collect()}
    roots = brute_components(prints)
    mine = [found.get(int(np.uint64(p).astype(np.int64)), int(np.uint64(p).astype(np.int64))) for p in prints]
    assert len(set(mine)) == len(set(roots)) == len(set(zip(mine, roots, strict=True)))


def test_components_of_a_path_and_of_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 150: 150, 200: 150}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(docs):
    rows = [(1, "a b c d e f", "s"), (2, "a b c d e f", "t"), (2, "a b c d e f", "u"), (3, None, "s"), (9, "", "s"), (None, "a b c d e f", "s"),
            (None, "quite another text here", "s"), (None, "quite another text here", "s"), (5, "five", "s"), (5, "five", "s"),
            (6, "one of two texts", "s"), (6, "under the same id", "s")]
    frame = docs(rows)
    out = simhash.distinct_documents(stored(frame, "test"))
    assert out.columns == frame.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, "a b c d e f"), (3, None), (None, "quite another text here"), (5, "five"),
                         (6, "one of two texts"), (6, "under the same id")], key=str)
    assert simhash.distinct_documents(docs([])).count() == 0


def test_a_repeated_id_with_one_text_near_a_smaller_id(docs):
    frame = docs([(2, "a b c d e f", "s"), (4, "a b c d e f", "s"), (4, "quite another text here", "s"), (7, "quite another text here", "s")])
    got = sorted((r.doc_id, r.text) for r in simhash.distinct_documents(stored(frame, "test")).collect())
    assert got == [(2, "a b c d e f"), (4, "quite another text here")]


def test_long_texts_vote_in_slices(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1013}" for i in range(5_000)).encode()
    whole = simhash.text_fingerprint(text)
    monkeypatch.setattr(simhash, "_SLICE", 64)
    assert simhash.text_fingerprint(text) == whole == brute_print(text.decode())
