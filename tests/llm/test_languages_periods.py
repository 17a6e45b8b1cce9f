"""Languages by held-out accuracy and exhaustive paths; runs against every period of every text."""

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from olapflow.llm import language, periods
from olapflow.llm.queries import op11, op13

FOLDER = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- languages

@pytest.fixture(scope="module")
def labelled(spark):
    rows = [
        ("the house and the garden are old and the water is cold", "en"), ("there is nothing that they would not have done with this", "en"),
        ("das haus und der garten sind alt und das wasser ist kalt", "de"), ("es gibt nichts was sie nicht mit diesem getan hätten", "de"),
        ("дом и сад старые а вода холодная", "ru"), ("нет ничего чего бы они не сделали", "ru"),
        ("το σπίτι και ο κήπος είναι παλιά", "el"), (None, "en"), ("", "de"), ("no label", None),
    ]
    return spark.createDataFrame(rows, "text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return language.fit(labelled)


def found(text, model):
    return language.label_texts([text.encode() if text is not None else None], model)[0]


def test_model_knows_languages_and_scripts(model):
    assert model.languages == ["de", "el", "en", "ru"]
    assert model.scripts[0] == model.scripts[2] and len(set(model.scripts.tolist())) == 3
    assert not model.table[-1].any()


def test_mixed_text_gets_spans(model):
    text = "  the water and the garden, the old house is there. Das Wasser und der Garten, das alte Haus ist nicht kalt; вода и дом!"
    lang, score, spans = found(text, model)
    assert [s["lang"] for s in spans] == ["en", "de", "ru"] and 0 < score < 1
    assert text[spans[0]["start"] : spans[0]["end"]].startswith("the water")
    assert text[spans[1]["start"] : spans[1]["end"]].endswith("kalt")
    assert text[spans[2]["start"] : spans[2]["end"]] == "вода и дом"
    assert lang == "de"  # most letters


def test_texts_without_letters_are_undetermined(model):
    for text in (None, "", " \n", "123 ... 4!", "́"):
        assert found(text, model) == ("und", 0.0, [])
    empty = language.Model([], np.zeros((language.BUCKETS + 1, 0), np.float32), np.zeros(0, np.uint64))
    assert found("some words", empty) == ("und", 0.0, [])


def test_unknown_scripts_are_scored_by_all(model):
    assert found("日本語", model)[0] in model.languages
    assert found("κήπος", model)[0] == "el" and found("вода", model)[0] == "ru"


def brute_path(scores, switch):
    n, k = scores.shape
    return max(
        sum(scores[i, s] for i, s in enumerate(p)) - switch * sum(a != b for a, b in itertools.pairwise(p))
        for p in itertools.product(range(k), repeat=n)
    )


@given(st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_paths_are_best(seed):
    rng = np.random.default_rng(seed)
    tables = [-rng.integers(0, 6, (rng.integers(1, 7), 3)).astype(np.float32) for _ in range(4)]
    for switch in (1.0, 3.0, 7.0):
        for scores, labels in zip(tables, language.best_paths(tables, switch), strict=True):
            best = brute_path(scores, switch)
            cost = lambda p: sum(scores[i, s] for i, s in enumerate(p)) - switch * sum(a != b for a, b in itertools.pairwise(p))
            assert cost(labels.tolist()) == best
            single = language.path(scores, switch)
            assert single is None or cost(single.tolist()) == best


def test_ngrams_stop_at_words():
    grams = lambda text: [g.tolist() for g in language.split_words(*language._joined([text.encode()])).grams]
    one, two = grams("ab"), grams("xyz ab")
    for a, b in zip(one, two, strict=True):
        assert a == b[4:]  # what stands before a word does not change its n-grams
    assert grams("AB")[1] == one[1] and grams("ÄÖ") == grams("äö")


def test_chunks_and_long_texts_agree(model, monkeypatch):
    texts = ["the water is cold. das wasser ist nicht kalt und der garten " * k for k in (1, 40, 3, 400)] + [None, ""]
    values = [t.encode() if t else None for t in texts]
    whole = language.label_texts(values, model)
    monkeypatch.setattr(language, "_TOGETHER", 10)
    monkeypatch.setattr(language, "_WAITING", 1)
    assert language.label_texts(values, model) == whole


def test_operator_handles_odd_rows(spark, docs, labelled, model):
    rows = [(1, "the old garden", "s"), (1, "the old garden", "s"), (None, "das alte haus", None), (2, None, "s"), (3, "", "s")]
    frame = docs(rows).withColumn("score", F.lit("old")).withColumn("lang_spans", F.lit(1))
    out = language.identify(frame, model)
    assert out.columns[-3:] == ["lang_pred", "score", "lang_spans"] and "n_chars" in out.columns
    got = sorted((r.text or "", r.lang_pred, r.score == 0) for r in out.collect())
    assert got == [("", "und", True), ("", "und", True), ("das alte haus", "de", False), ("the old garden", "en", False), ("the old garden", "en", False)]
    assert language.identify(docs([]), model).count() == 0
    nothing = language.fit(labelled.where("false"))
    assert {r.lang_pred for r in language.identify(docs(rows), nothing).collect()} == {"und"}
    few = language.fit(labelled, texts=1, languages=2)
    assert len(few.languages) == 2


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    got = op11(spark, FOLDER).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


# ---------------------------------------------------------------- runs

def brute_runs(words, least, times):
    n, out = len(words), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            stretch = words[start : i + p]
            smaller = any(stretch[q:] == stretch[:-q] for q in range(1, p))
            if len(stretch) >= max(least, times * p) and not smaller:
                out.append((start, len(stretch), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_lyndon(ranks):
    ends = []
    for i in range(len(ranks)):
        k = i + 1
        while k < len(ranks) and ranks[i:] < ranks[k:]:
            k += 1
        ends.append(k - i)
    return ends


def noisy(rng, n, letters, period):
    base = [rng.randrange(letters) for _ in range(period)]
    return [base[i % period] if rng.random() > 0.03 else rng.randrange(letters) for i in range(n)]


@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 4), st.integers(1, 9))
@settings(max_examples=400, deadline=None)
def test_runs_equal_brute_force(seed, n, letters, period):
    words = noisy(random.Random(seed), n, letters, period)
    ranks = np.unique(words, return_inverse=True)[1].tolist()
    assert periods.lyndon_array(ranks) == brute_lyndon(ranks)
    for least, times in ((24, 3), (6, 3), (4, 2), (2, 2)):
        assert periods.word_runs(np.array(words, np.int64), least, times) == brute_runs(words, least, times)


def test_hash_clashes_cost_no_run(monkeypatch):
    monkeypatch.setattr(periods, "_PRIME", np.uint64(7))
    rng = random.Random(3)
    for _ in range(60):
        words = noisy(rng, 80, 3, rng.randint(1, 6))
        assert periods.word_runs(np.array(words, np.int64), 6, 3) == brute_runs(words, 6, 3)


@pytest.mark.parametrize("n", [30_000])
def test_long_texts(n):
    assert periods.word_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    words = np.arange(n) % 1_000
    assert periods.word_runs(words) == [(0, n, 1_000)]
    assert periods.word_runs(np.arange(n)) == []


def expected(text, doc_id):
    words, n = (text or "").encode().split(), len((text or "").encode().split())
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 24, 3)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_query_equals_brute_force(spark):
    import hashlib

    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op13(spark, small).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for doc_id, text in texts.items():
        if len((text or "").split()) > 1_500:
            continue  # too long for brute force
        runs, kept = expected(text, doc_id)
        r = got[doc_id]
        some += bool(runs)
        digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.runs_sha256, r.collapsed_sha256) == (len(runs), digest, hashlib.sha256(kept.encode()).hexdigest())
        assert (r.start, r.length, r.period) == best and r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert some > 3


def test_runs_of_odd_rows(docs):
    text = "a b c " * 10 + "end"
    rows = [(1, text, "s"), (1, text, "s"), (None, text, None), (2, None, "s"), (3, "", "s"), (4, " \n ", "s")]
    frame = docs(rows).withColumn("runs", F.lit("old")).withColumn("collapsed", F.lit(0))
    out = periods.periodic_runs(frame).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.text == text:
            assert ([tuple(x) for x in r.runs], tuple(r.strongest), r.collapsed, r.n_words) == ([(0, 30, 3)], (0, 30, 3), "a b c end", 31)
        else:
            assert (r.runs, r.strongest, r.collapsed, r.n_words) == ([], None, "", 0)
    assert periods.periodic_runs(docs([])).count() == 0


def test_planted_periods(docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    text = " ".join(f"w{i}" for i in range(100))
    frame = docs([(i, text, "s") for i in [*ids, 1]] + [(ids[0], None, "s"), (ids[1], " ", "s"), (None, text, "s")])
    out = frame.select("doc_id", periods.planted(F.col("text"), F.col("doc_id")).alias("t")).collect()
    for r in out:
        if r.t and r.t.strip():
            chosen = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0
            assert (r.t != text) == chosen and len(r.t.split()) == 100
