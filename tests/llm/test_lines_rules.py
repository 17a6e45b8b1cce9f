"""Line dedup and quality rules against brute force."""

import re
from collections import Counter, defaultdict

from olapflow.llm import lines, rules

LONG = "This line is long enough to count"


def brute_dedup(rows, min_chars=20, min_docs=3):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    ids = defaultdict(set)
    for doc_id, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                ids[key(line)].add(doc_id)
    low = lambda i: (i is not None, i or 0)
    keeper = {k: max(v, key=low) for k, v in ids.items() if len(v) >= min_docs}
    out = []
    for doc_id, text, _ in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if key(x) not in keeper or keeper[key(x)] == doc_id]
        out.append((doc_id, None if text is None else "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


ROWS = [
    (1, f"{LONG}\nown one\n{LONG}", "a"), (2, f"  {LONG.upper()}\t\nx", "a"), (3, f"{LONG}\n\n{LONG}\r", "a"), (4, "short\nshort", "b"),
    (5, None, "b"), (6, "", None), (7, "é" * 19, "a"), (8, "é" * 19, "a"), (9, "é" * 19, "a"), (10, "É" * 20, "a"),
    (11, "é" * 20, "a"), (12, "É" * 20, "a"), (13, "É" * 20, "a"), (None, LONG, "a"), (None, LONG, "a"), (3, "other\n" + LONG, "z"),
]


def test_lines_against_brute_force(docs):
    out = lines.dedup_lines(docs(ROWS))
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()], key=str) == brute_dedup(ROWS)


def test_a_document_without_an_id_is_one_document(docs):
    rows = [(None, LONG, "a"), (1, LONG, "a"), (2, LONG, "a")]
    got = {r.doc_id: r.n_dropped for r in lines.dedup_lines(docs(rows)).collect()}
    assert got == {None: 1, 1: 1, 2: 0}


def test_lines_of_an_empty_table(docs):
    assert lines.dedup_lines(docs([])).count() == 0


def test_a_hot_line_and_a_long_text(docs):
    rows = [(i, f"{LONG}\nline number {i} of its own", "a") for i in range(300)] + [(900, "\n".join(["w" * 30] * 50_000), "a")]
    out = {r.doc_id: r for r in lines.dedup_lines(docs(rows)).collect()}
    assert sum(r.n_dropped for r in out.values()) == 299 and out[299].n_dropped == 0 and out[900].n_lines == 50_000


def brute_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    worded = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    n, chars, symbols = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t))
    dup = len(worded) - len(set(worded))
    upper = sum(c.isupper() for c in t)
    lettered = sum(any(c.isalpha() for c in x) for x in w)
    bad = n < 50 or 100 * len(repeated) > 50 * n or chars < 2 * n or chars > 15 * n or 5 * symbols > n
    bad = bad or 2 * dup > len(worded) or 5 * upper > 2 * chars or 100 * lettered < 70 * n
    return n, chars, symbols, dup, len(repeated), not bad


PLAIN = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
TEXTS = [
    PLAIN, PLAIN.upper(), None, "", "  \n\t ", "a b c a b c a b c", PLAIN + "\n" + PLAIN, "\n".join([PLAIN[:40]] * 30), PLAIN.replace(" ", " # "),
    " ".join("1234" for _ in range(60)), " ".join(str(i) for i in range(500)), "x " * 60, " ".join(["y" * 20 + str(i) for i in range(60)]),
    "éà " + PLAIN + "\n\n x \n\n x ", "a b c d a b c e f a b c", PLAIN + " 😀 <tag> |",
]


def test_measures_and_verdicts_against_brute_force(docs):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "s"), (None, TEXTS[5], "s")]
    out = rules.quality_rules(docs(rows), report=True)
    for r in out.collect():
        assert tuple(r[m] for m in rules.MEASURES) + (r.kept,) == brute_rules(r.text), r.text
        assert r.kept == (r.rejected_by is None)
    assert out.count() == len(rows)


def test_the_order_of_the_rules_changes_no_verdict(docs):
    frame = docs([(i, t, "s") for i, t in enumerate(TEXTS)])
    names = ["few_lettered", "upper_case", "duplicate_lines", "symbols", "word_length", "repeated_windows", "few_words"]
    verdicts = [
        {r.doc_id: r.kept for r in rules.quality_rules(frame, order=order).collect()} for order in (names, names[::-1])
    ]
    assert verdicts[0] == verdicts[1] == {i: brute_rules(t)[-1] for i, t in enumerate(TEXTS)}


def test_a_filter_on_the_verdict_does_not_split_words_again(docs):
    kept = rules.quality_rules(docs([(1, PLAIN, "s")]), order=["repeated_windows", "few_words"]).where("kept")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(btrim") + plan.count("split(trim") == 1
    assert kept.count() == 1


def test_rules_of_an_empty_table(docs):
    assert rules.quality_rules(docs([])).count() == 0


def test_a_long_text(docs):
    text = " ".join(f"w{i % 7_000}x" for i in range(60_000))
    row = rules.quality_rules(docs([(1, text, "s")]), report=True).first()
    assert tuple(row[m] for m in rules.MEASURES) + (row.kept,) == brute_rules(text)


def test_python_stays_out_of_the_rules(docs):
    plan = rules.quality_rules(docs([(1, PLAIN, "s")]), report=True)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
