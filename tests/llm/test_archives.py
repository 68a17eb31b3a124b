"""Operator 3: round trips, magic inside payloads, splits, damage. Operator 6: rendering."""

from __future__ import annotations

import hashlib
import os
import tempfile

import pytest
from cases import sf  # noqa: F401
from pyspark.sql import functions as F
from touchline.llm import html_text, warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 40\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"


def _pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.withColumns({c: F.lit(None).cast("string") for c in ("id", "payload", "sha1", "bytes", "first", "value", "text")}).coalesce(2)


def _rows():
    big = "x" * 3000
    rows = [(1, "u", big), (2, None, big), (5, "a\r\nb", big), (3, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 500), (9, "u", "é" * 500)]
    rows += [(10, "u", FAKE), (11, "u", FAKE * 60), (12, "u", "WARC/1.0\r\n" * 300), (13, "u", "tail WARC/1.0\r\n"), (14, "u", "WARC/1.0\r\n\r\n"), (15, "u", "\r\n\r\n" * 500)]
    return rows + [(20 + i, "u", f"page {i} " * (i * 7)) for i in range(120)] + [(None, "u", big), (None, None, None), (1, "u", big), (5, "u", big)]


@pytest.mark.parametrize("split", ["128m", "4k"])
def test_round_trip(spark, split):
    rows, path = _rows(), os.path.join(tempfile.mkdtemp(prefix="warc-test-"), "out")
    warc.write(_pages(spark, rows), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = largest.get(html or "")
        again = len(data) >= 1000 and first is not None and i != first
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(map(repr, want)) == sorted(repr((r["id"], r["bytes"], r["sha1"], r["type"], r["refers_to"])) for r in got)


def test_long_urls(spark):
    rows, path = [(i, "u" * n, f"page {i}") for i, n in enumerate([5, 70_000, 5, 3_000_000, 5])], os.path.join(tempfile.mkdtemp(prefix="warc-test-"), "out")
    warc.write(_pages(spark, rows).coalesce(1), path)
    assert sorted((r["id"], r["url"], r["bytes"]) for r in warc.read(spark, path).collect()) == [(i, url, len(html)) for i, url, html in rows]


def test_damage_and_foreign_records(spark):
    folder = tempfile.mkdtemp(prefix="warc-test-")
    record = lambda kind, body: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    with open(os.path.join(folder, "a.warc"), "w", newline="") as f:
        f.write(record("warcinfo", "software: x") + record("resource", "plain") + "WARC/1.0\r\nWARC-Type: response\r\n\r\nno length\r\n\r\n" + record("resource", "unreachable"))
    with open(os.path.join(folder, "b.warc"), "w", newline="") as f:
        f.write(record("resource", "whole") + record("resource", "cut short")[:-9])
    open(os.path.join(folder, "c.warc"), "w").close()
    got = {(os.path.basename(r["path"]), r["type"], r["sha1"], r["id"]) for r in warc.read(spark, folder).collect()}
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert got == {("a.warc", "warcinfo", sha("software: x"), None), ("a.warc", "resource", sha("plain"), None), ("b.warc", "resource", sha("whole"), None)}


def test_empty_archives(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="warc-test-"), "out")
    warc.write(_pages(spark, []), path)
    assert warc.read(spark, path).count() == 0


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<p> </p>\n", ""),
    ("<p>a<p>b <b>c</b>  d<br>e<div>f</div>g", "a\n\nb c d\ne\n\nf\ng"),
    ("<ul><li>x<li>y<ol start=3><li>p</li><li>q</ol></ul>", "- x\n- y\n  3. p\n  4. q"),
    ("<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>pear and fig<td>10</table>tail", "Cap\nName          Qty\napple         3\npear and fig  10\n\ntail"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<table><tr><td>one<table><tr><td>in1<td>in2</table><td>two</table>", "one       two\n\nin1  in2"),
    ("<div hidden>no</div><span style='display: none'>no</span>yes<style>.x{display:none}</style><p class='a x'>no</p><script>no</script>", "yes"),
    ("<span style='visibility:hidden'>h<b style='visibility:visible'>v</b></span>", "v"),
    ("<pre> a\n  b\n</pre>x&amp;y &lt;z&gt;<!-- c -->t", " a\n  b\n\nx&y <z>t"),
    ("<td>stray</td>a < b and <", "straya < b and <"), ("<head><title>t</title></head><body>b", "b"),
    ("<select><option>one<option>two</select>", "one\ntwo"), ("a<!-- never closed", "a"), ("a<script>never closed", "a"), ("<p title='>'>q", "q"),
])
def test_rendering(page, text):
    assert html_text.render(page)[0] == text


@pytest.mark.parametrize("sheet,seen", [
    ("@media print {.x{display:none}}", True), ("@media (max-width:600px){.y{color:red}.x{display:none}}", True), ("@MEDIA screen and (max-width:9em){.x{display:none}}", True),
    ("@supports (display:grid){.x{display:none}}", True), ("@media print{@media screen{.x{display:none}}}", True), (".y{color:red; .x{display:none} }", True),
    ("@media print{.y{color:red}} .x{display:none}", False), ("@media screen{.x{display:none}}", False), ("@media print, all{.x{display:none}}", False),
    ("@layer a{.x{display:none}}", False), ("@import 'a.css'; @charset \"}\"; .x{display:none}", False), (".y{content:'{'} p, .x{color:red;display:none;.z{color:red}}", False),
    (".x{color:red;@media print{display:none}}", True), ("}.x{display:none}", False), ("@layer a, b; .x{display:none}", False),
])
def test_rules_that_hold_on_a_screen(sheet, seen):
    assert html_text.render(f"<style>{sheet}</style><b class=x>text</b>")[0] == ("text" if seen else "")


@pytest.mark.parametrize("page,text", [
    ("<style media=print>b{display:none}</style><b>x</b>", "x"), ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"),
    ("<math><semantics><mi>x</mi><annotation encoding='application/x-tex'>\\x</annotation></semantics></math>", "x"),
    ("<svg><title>t</title><desc>d</desc><defs/><path d='M0'/><text>one</text><text x=3>two</text><g display=none><text>no</text></g></svg>z", "one two z"),
    ("<svg><defs><text>no</text></defs><metadata>no</metadata><text>a<tspan x=1>b</tspan></text></svg>", "a b"),
    ("<svg/>a<desc>b</desc>", "ab"), ("<svg><title/><text>a</text></svg>", "a"),
])
def test_rendering_of_drawings_and_formulas(page, text):
    assert html_text.render(page)[0] == text


def test_rendering_survives(spark):
    assert html_text.render("<div>" * 50000 + "deep" + "</div>" * 3)[0] == "deep"
    assert html_text.render("<ul><li>" * 3000 + "deep")[0].strip().endswith("deep")
    assert html_text.render("<table><tr><td colspan=99999999>" * 300 + "deep")[0].strip() == "deep"
    assert html_text.render('<a "' * 20000) is not None
    long = html_text.render("<table>" + "<tr><td>" + "word " * 20000 + "<td>short" + "</table>")[0]
    assert long.count("word") == 20000 and len(long) < 300_000
    rows = [(1, "u", None), (2, "u", ""), (None, None, "<p>x"), (3, "u", "<p>x"), (3, "u", "<p>x"), (4, "u", "\x00<p>퟿&#0;&#x110000;&bogus;")]
    got = html_text.extract(_pages(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got)[:5] == [(0, "x"), (1, ""), (2, ""), (3, "x"), (3, "x")]
    assert html_text.extract(_pages(spark, [])).count() == 0


def test_rendering_keeps_words(spark, sf):
    """Every visible word of the given pages is in the text: their articles' paragraphs are."""
    import re

    for r in spark.read.parquet(f"{sf}/pages.parquet").limit(40).collect():
        text = " ".join(html_text.render(r["html"])[0].split())
        for p in re.findall(r"<p>([^<>&]+)</p>", r["html"]):
            assert " ".join(p.split()) in text
