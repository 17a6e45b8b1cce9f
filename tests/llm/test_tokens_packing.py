"""Token counts and packing against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from olapflow.llm import packing, tokens
from olapflow.llm.tokenizer import _Kept, load

ODD = [
    "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "İstanbul ﬁne", "áb̀ ́a", "don't DON'T I'LL x'reé", "日本語 한국어", "²³½x9",
    "a b c", "x\x1cy\x85z", "ªº ª", "ΣΑΣ ς", "😀👍🏽", "a" * 3000, "ß ẞ K ſ", "a­b µ×÷", " \n\t ", "the the\nthe", "",
]


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_words_have_the_ids_of_the_text(bpe, library, text):
    text = text.encode("utf-8", "ignore").decode()
    own = load(bpe)
    packed = b"".join(own.word_ids(w) for w in text.encode().split())
    assert np.frombuffer(packed, f"<u{own.width}").tolist() == ids(library, text)


def test_counts_equal_the_library(spark, docs, bpe, library):
    rows = [(i, t, "s") for i, t in enumerate([*ODD, None, "the the"])] + [(0, "twice", "s"), (None, "no id", "s")]
    out = tokens.token_counts(docs(rows), bpe, limit=5)
    assert out.columns[:3] == ["doc_id", "text", "source"]
    for r in out.collect():
        want = len(ids(library, r.text))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len((r.text or "").encode()), want > 5)
    assert out.count() == len(rows)


def test_counts_of_an_empty_table(docs, bpe):
    assert tokens.token_counts(docs([]), bpe).count() == 0


def test_whole_texts_go_to_tokenizers_of_another_kind(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    for r in tokens.token_counts(docs([(1, " a  b", "s"), (2, None, "s")]), path).collect():
        assert r.n_tokens == len(other.encode(r.text or "", add_special_tokens=False).ids)


def test_cache_keeps_two_generations():
    made = []
    kept = _Kept(lambda k: made.append(k) or len(k), {"first": 1}, room=2)
    assert [kept[k] for k in ("a", "bb", "ccc", "a", "first", "x" * 100)] == [1, 2, 3, 1, 1, 100]
    assert made == ["a", "bb", "ccc", "x" * 100] and len(kept) <= 3


def check_packing(library, rows, pieces, length=2048):
    want = defaultdict(list)
    for doc_id, text, _ in rows:
        want[doc_id].append([*ids(library, text), 1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for doc_id, parts in by_doc.items():
        if len(want[doc_id]) > 1:  # repeated ids: the pieces hold all their tokens
            assert sum(p.length for p in parts) == sum(map(len, want[doc_id]))
            continue
        all_ids, at = np.array(want[doc_id][0], "<u4"), 0
        for p in sorted(parts, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(all_ids))
            assert bytes(p.ids) == all_ids[at : at + p.length].tobytes()
            at += p.length
        assert at == len(all_ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0


@pytest.mark.parametrize("length", [8, 2048])
def test_packing(docs, bpe, library, length):
    rows = [(i, t, "s") for i, t in enumerate([*ODD, None])] + [(i, "copy of one text", "s") for i in range(100, 140)]
    rows += [(7, "an id twice", "s"), (None, "no id", "s"), (200, "word " * 30_000, "s")]
    out = packing.pack(docs(rows), bpe, length=length)
    check_packing(library, rows, out.collect(), length)


def test_packing_of_an_empty_table(docs, bpe):
    out = packing.pack(docs([]), bpe)
    assert out.count() == 0 and "sequence_id" in out.columns


def test_digest_of_pieces(docs, bpe, library):
    from olapflow.llm.queries import piece_digest

    whole = np.array([*ids(library, "one two"), 1], "<u4")
    for row in piece_digest(packing.pack(docs([(1, "one two", "s")]), bpe)).collect():
        assert row.ids_crc32 == zlib.crc32(whole[row.start : row.start + row.length].tobytes())


def test_hilbert_curve_visits_neighbours():
    side = 4
    grid = np.array([[a, b, c, d] for a in range(side) for b in range(side) for c in range(side) for d in range(side)])
    points = grid[np.argsort(packing.hilbert_keys(grid))]
    assert len(set(packing.hilbert_keys(grid).tolist())) == len(grid)
    assert (np.abs(np.diff(points, axis=0)).sum(axis=1) == 1).all()


def test_like_texts_lie_near_on_the_curve():
    one = np.random.default_rng(1).integers(0, 40_000, 2_000)
    near = one.copy()
    near[:2] = 5
    far = np.random.default_rng(2).integers(0, 40_000, 2_000)
    a, b, c = packing.hashed_vectors([one, near, far])
    assert a @ b > 0.95 > 0.5 > a @ c


def test_the_frequent_table_needs_no_shuffle(spark, docs):
    frame = docs([(i, "common words " + f"rare{i} " + "x" * 100, "s") for i in range(50)] + [(99, None, "s")]).repartition(5)
    assert tokens.frequent_words(frame, size=2) == [b"common", b"words"]
    assert tokens.frequent_words(docs([])) == [] and len(tokens.frequent_words(frame, sampled=5)) < 30
    plan = frame.select(tokens.token_length(docs([(1, "a b", "s")]), __import__("public_tokenizers").path("word_bpe_49k.json")))
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
