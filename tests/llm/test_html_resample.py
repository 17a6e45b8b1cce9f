"""HTML extraction by golden pages, resampling against brute force, and the pipeline."""

import math
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from olapflow.llm import html_text, resample
from olapflow.llm.base import documents
from olapflow.operators import window

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("source, want", [
    ("", ""), ("plain a < b & c", "plain a < b & c"), ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<br/><br>c", "a\nb\n\nc"),
    ("<title>t</title><style>s</style><script>x='</p>'</script><p>shown", "shown"), ("<!-- c --><!doctype html><p>x<!-- > -->y", "xy"),
    ("<div>a</div><div> b  c </div>", "a\nb c"), ("<b>bo</b>ld<span> x</span>", "bold x"), ("<p>a</p>&lt;&amp;&nbsp;&copy;&#65;", "a\n\n<& ©A"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n\n  3. x\n  4. y\n\n- c"), ("<li>alone", "- alone"),
    ("<p hidden>no</p><div style='Display : none'>no<p>no</div><input type=hidden value=x>yes", "yes"),
    ("<pre>\n a\n   b</pre>c", " a\n   b\n\nc"), ("<dl><dt>t<dd>d<dd>e</dl>", "t\n    d\n    e"), ("<h1>a</h2>b", "a\n\nb"),
    ("<table><tr><th>Name<th>N<tr><td>Apple<td>3</table>", "Name   N\nApple  3"),
    ("<table><caption>C</caption><tr><td rowspan=2>é<td>1<tr><td>22<td>3<tr><td colspan=2>wide cell<td>z</table>", "C\n\né  1\n   22      3\nwide cell  z"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"), ("<p>a</p></div></p>b", "a\n\nb"), ("<a title='x>y'>z</a>", "z"),
    ("<a title='open>z", "z"), ("<select><option>a<option>b</select>", "a\nb"), ("<textarea> k\n l</textarea>", " k\n l"), ("<p>x<table><tr><td>y</table>", "x\n\ny"),
])
def test_golden_pages(source, want):
    assert html_text.html_text(source) == want


@pytest.mark.parametrize("source, want", [
    ("<p>let <math><mi>x</mi> <mo>=</mo>\n<mn> 1 </mn></math> be", "let x=1 be"),
    ("a <math><mfrac><mn>1</mn><mn>2</mn></mfrac><mphantom><mi>z</mi></mphantom></math>", "a 1 2"),
    ("<math display=block><semantics><mrow><mi>E</mi></mrow><annotation encoding='application/x-tex'>E_0</annotation></semantics></math>x", "E\nx"),
    ("<math><mtext>if <b>so</b></mtext></math> y", "if so y"), ("<math><mi>a<![CDATA[<b]]></mi></math>", "a<b"),
    ("<svg><title>no</title><desc>no<b>no</b></desc><defs><text>no</text></defs><text>A</text> stray <text>B<tspan>C</tspan></text></svg>", "A\nBC"),
    ("<svg><text><tspan x='0'>two</tspan><tspan x='0' dy='1em'>lines</tspan></text></svg>", "two lines"),
    ("<svg><style>no</style><script>no</script><metadata>no</metadata><g display='none'><text>no</text></g><a><text>yes</text></a></svg>", "yes"),
    ("<svg><switch><foreignObject><div>html<p>in</div></foreignObject><text>no</text></switch></svg>out", "html\n\nin\n\nout"),
    ("<body>a<svg/>b<math/>c<p>d", "abc\n\nd"), ("<svg><path d='M0'/><defs/><title/><script/><text>t</text></svg>u", "t\nu"),
    ("<svg><defs><p>a</p>b", "a\n\nb"), ("<math><mrow><div>a</div>b", "a\nb"), ("<svg><font color=red>a</font>b", "ab"),
    ("<svg><defs></p>a", "a"), ("<div><svg><defs></div>a", "a"), ("<svg><g id=a/><text>t", "t"), ("<svg><defs id='a=b'/><text>t", "t"),
    ("<p>a<svg><foreignObject><p>b</p></foreignObject></svg>c", "a\n\nb\n\nc"), ("<svg><text>a<br>b", "a\n\nb"), ("<o:p>x</o:p>", "x"),
    ("<head><title>no</title><svg><text>a</text></svg><p>b", "a\n\nb"), ("<svg><![CDATA[no]]><text>1 &lt; <![CDATA[2 & 3]]></text></svg>", "1 < 2 & 3"),
])
def test_golden_pages_with_svg_and_math(source, want):
    assert html_text.html_text(source) == want


def test_depth_and_length_are_no_limit():
    assert html_text.html_text("<div>" * 50_000 + "x") == "x"
    assert html_text.html_text("<table><tr><td>" * 500 + "x") == "x"
    assert html_text.html_text("<p>" + "word " * 200_000).count("word") == 200_000


class Visible(HTMLParser):
    """Words outside of what the test pages hide."""

    def __init__(self):
        super().__init__()
        self.skip, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_numbers_of_any_length():
    page = f'<table><tr><td colspan="{"9" * 5_000}" rowspan="{"8" * 5_000}">a &#{"1" * 5_000}; &#{"0" * 5_000}65; &#x{"0" * 5_000}42;<td>b</table>'
    assert html_text.html_text(page) == "a \ufffd A B  b"
    assert html_text.html_text(f'<p title="&#{"7" * 5_000};">&#1114112; &#12345678 &#55296;') == "\ufffd \ufffd \ufffd"


def test_one_hostile_page_leaves_the_others_alone(spark):
    rows = [(1, f"<p>&#{'1' * 5_000};"), (2, "<p>fine"), (3, None)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id int, html string"))
    assert [r.text for r in out.orderBy("page_id").collect()] == ["\ufffd", "fine", ""]


@pytest.mark.parametrize("name, page", [
    ("nested", "<div>" * 200_000), ("stray ends", "<b>" * 20_000 + "</p>" * 20_000), ("foreign", "<svg>" + "<g>" * 50_000 + "</x>" * 50_000),
    ("quotes", "<blockquote>x" * 30_000), ("lists", "<ul><li>x" * 20_000),
    ("one long cell", "<table>" + "<tr><td>a<td>b" * 10_000 + "<tr><td>" + "w" * 200_000 + "<td>z</table>"),
    ("one long cell of many lines", "<table><tr><td>" + "w" * 100_000 + "<td>" + "z<br>" * 20_000 + "</table>"),
    ("wide spans", "<table>" + ("<tr>" + "<td colspan=1000 rowspan=0>x" * 10) * 1_000 + "</table>"),
    ("stairs", "<table>" + "<tr><td rowspan=65534>x" * 4_000 + "</table>"),
])
def test_time_and_text_are_in_proportion_to_the_page(name, page):
    start = time.process_time()
    text = html_text.html_text(page)
    assert time.process_time() - start < 15 and len(text) < 20 * len(page)
    assert sum(map(text.count, "xwz")) == sum(map(re.sub("<[^>]*>", "", page).count, "xwz"))


def test_rows_that_cells_reach_down_to():
    page = "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d<tbody><tr><td>e<td>f</table>"
    assert html_text.html_text(page) == "a  b\n   c\n   d\ne  f"  # 0: to the end of the group
    page = "<table><tr><td rowspan=2000>a<td>b" + "<tr><td>c" * 1_500 + "</table>"
    assert html_text.html_text(page) == "\n".join(["a  b"] + ["   c"] * 1_500)


def laid_out(rows):
    """A plain table: cells padded to the longest of their column, two blanks between."""
    widths = [max(len(line) for row in rows if c < len(row) for line in row[c]) for c in range(max(map(len, rows)))]
    lines = []
    for row in rows:
        if any(line for cell in row for line in cell):
            for k in range(max(map(len, row))):
                lines.append("  ".join((cell[k] if k < len(cell) else "").ljust(widths[c]) for c, cell in enumerate(row)).rstrip(" "))
    return "\n".join(lines)


def test_random_trees_against_a_plain_layout():
    """Blocks, breaks, lists and tables built together with their text."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    for _ in range(300):
        parts, want = [], []
        for _ in range(rng.randint(1, 5)):
            kind = rng.choice(["p", "div", "br", "ul", "ol", "table", "blockquote"])
            a, b = word(), word()
            if kind == "p":
                parts.append(f"<p>{a}  \n<i>{b}</i>")
                want.append((True, f"{a} {b}"))
            elif kind == "div":
                parts.append(f"<div>{a}</div><div> {b} </div>")
                want += [(False, a), (False, b)]
            elif kind == "br":
                parts.append(f"<div>{a}<br>{b}</div>")
                want.append((False, f"{a}\n{b}"))
            elif kind in ("ul", "ol"):
                parts.append(f"<{kind}><li>{a}<li>{b}</{kind}>")
                want.append((True, f"- {a}\n- {b}" if kind == "ul" else f"1. {a}\n2. {b}"))
            elif kind == "blockquote":
                parts.append(f"<blockquote>{a}</blockquote>")
                want.append((True, f"    {a}"))
            else:
                rows = [[[word() for _ in range(rng.randint(1, 2))] for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 3))]
                parts.append("<table>" + "".join("<tr>" + "".join(f"<td>{'<br>'.join(c)}" for c in r) for r in rows) + "</table>")
                want.append((True, laid_out(rows)))
        text = ""
        for i, (spaced, block) in enumerate(want):
            text += ("\n\n" if spaced or want[i - 1][0] else "\n") * bool(i) + block
        assert html_text.html_text("".join(parts)) == text.strip("\n"), parts


def test_every_visible_word_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_text.extract(pages).collect():
        plain = Visible()
        plain.feed(r.html)
        plain.close()
        words = re.sub(r"\s+", "", "".join(plain.words))
        assert re.sub(r"\s+", "", re.sub(r"(?m)^- ", "", r.text)) == words
    assert pages.count() == html_text.extract(pages).count()


def test_pages_with_nulls(spark):
    frame = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (None, "<p>a", "t")], "page_id long, html string, text string")
    assert [r.text for r in html_text.extract(frame).collect()] == ["", "", "a"]
    assert html_text.extract(frame.limit(0)).count() == 0


# ---------------------------------------------------------------- resampling


def test_weights_and_draws_against_brute_force(docs):
    good, bad = "clear sober prose about the weather ", "### buy $$$ now ### "
    rows = [(i, good * (1 + i % 3) + f"day {i}", "s") for i in range(60)] + [(100 + i, bad * (1 + i % 2), "s") for i in range(20)]
    rows += [(200, None, "s"), (201, "", "s"), (0, good + "day 0", "s")]
    frame = docs(rows)
    targets = frame.where("doc_id < 30").select(F.col("doc_id").alias("target_id")).distinct()
    out = resample.resample(frame, targets, 0.75).collect()
    raw, target = np.ones(resample.BUCKETS), np.ones(resample.BUCKETS)
    grams = [resample.ngram_buckets((t or "").encode()) for _, t, _ in rows]
    for (doc_id, _, _), g in zip(rows, grams, strict=True):
        np.add.at(raw, g, 1)
        if doc_id < 30:
            np.add.at(target, g, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    want = {i: ratio[g].sum() / (len(g) + resample.PRIOR) for (i, _, _), g in zip(rows, grams, strict=True) if i}
    for r in out:
        if r.doc_id:
            assert r.log_weight == pytest.approx(want[r.doc_id])
    keep = math.floor(0.75 * len(rows) + 0.5)
    assert sum(r.kept for r in out) == keep and len(out) == len(rows)
    assert min(r.draw for r in out if r.kept) >= max(r.draw for r in out if not r.kept)
    assert not any(r.kept for r in out if r.doc_id and 100 <= r.doc_id < 120)
    again = resample.resample(docs(rows[::-1]), targets, 0.75).collect()
    assert {(r.doc_id, r.draw, r.kept) for r in again} == {(r.doc_id, r.draw, r.kept) for r in out}


def test_top_draws_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(window, "CHUNK_ROWS", 7)
    rows = [(i, float(i % 50)) for i in range(300)] + [(5, 49.0)] * 3
    out = resample.top_draws(spark.createDataFrame(rows, "doc_id long, draw double"), 0.3).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[: math.floor(0.3 * len(rows) + 0.5)]
    assert sorted((r.doc_id, r.draw) for r in out if r.kept) == sorted(want)


def test_noise_is_gumbel(spark):
    noise = [r[0] for r in spark.range(20_000).select(resample.gumbel(F.col("id"), "s")).collect()]
    assert np.mean(noise) == pytest.approx(0.5772, abs=0.03) and np.std(noise) == pytest.approx(1.2825, abs=0.03)


def test_resampling_an_empty_table(docs):
    targets = docs([]).select(F.col("doc_id").alias("target_id"))
    assert resample.resample(docs([]), targets, 0.5).count() == 0


def test_held_out_labels(spark):
    """Targets from one half of the labels; the other half must be told apart."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    targets = resample.target_ids(labels.where("doc_id % 2 = 0"), (F.col("quality") == 1) & (F.col("toxic") == 0))
    share = labels.agg(F.avg("quality")).first()[0]
    out = resample.resample(documents(spark, folder), targets, share).join(labels.where("doc_id % 2 = 1"), "doc_id")
    found = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert found[1, True] / (found[1, True] + found.get((1, False), 0)) > 0.9
    assert found.get((0, True), 0) / (found.get((0, True), 0) + found[0, False]) < 0.4


# ---------------------------------------------------------------- pipeline


def test_stages_against_brute_force(spark):
    from tests.llm.test_lines_rules import brute_dedup, brute_rules
    from tests.llm.test_mixing_simhash import brute_components, brute_print, brute_targets, size_of

    docs = documents(spark, SF)
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "simhash_dedup", "source_mix", "curve_packing"]

    docs = corpus_pipeline.stored(stages["quality_rules"](spark, docs, SF), "t")
    kept = {i for i, r in rows.items() if brute_rules(r.text)[-1]}
    assert {r.doc_id for r in docs.collect()} == kept

    want = brute_dedup([(i, rows[i].text, rows[i].source) for i in kept])
    docs = corpus_pipeline.stored(stages["line_dedup"](spark, docs, SF), "t")
    assert sorted([(r.doc_id, r.text) for r in docs.collect()], key=str) == [w[:2] for w in want]
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    texts = sorted((w[0], w[1]) for w in want)
    roots = brute_components([brute_print(t) for _, t in texts])
    unique = {i for k, (i, _) in enumerate(texts) if roots[k] == k}
    docs = corpus_pipeline.stored(stages["simhash_dedup"](spark, docs, SF), "t")
    assert sorted(r.doc_id for r in docs.collect()) == sorted(unique)

    sizes, texts = {}, dict(texts)
    for i in unique:
        sizes[rows[i].source] = sizes.get(rows[i].source, 0) + size_of(texts[i])
    target = brute_targets(sizes)
    mixed = corpus_pipeline.stored(stages["source_mix"](spark, docs, SF), "t")
    assert mixed.columns == list(next(iter(rows.values())).asDict())
    got = {}
    for r in mixed.collect():
        got[r.source] = got.get(r.source, 0) + size_of(r.text)
        assert texts[r.doc_id].startswith(r.text)
    assert got == {s: math.floor(t + 1e-9) for s, t in target.items() if t >= 1}

    pieces = stages["curve_packing"](spark, mixed, SF).collect()
    by_sequence = {}
    for p in pieces:
        by_sequence[p.sequence_id] = by_sequence.get(p.sequence_id, 0) + p.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in by_sequence.values())
    assert {p.doc_id for p in pieces} == {r.doc_id for r in mixed.select("doc_id").collect()}


def test_every_operator_and_the_pipeline_are_registered():
    known = driver.queries()
    assert {int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in known) if m} == set(range(1, 14))
    assert "pipeline" in known and set(driver.oracle_sql()) <= set(known)


@pytest.mark.parametrize("name", ["op4_line_dedup", "op5_quality_rules", "op9_source_mix"])
def test_queries_agree_with_sql(spark, name):
    import duckdb

    from check import compare

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good, text = compare(spark, SF, name, driver.queries()[name], driver.oracle_sql()[name], con)
    assert good, text
