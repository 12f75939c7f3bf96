from __future__ import annotations

import hashlib

import pytest

from snapfold.llm import warc
from tools.oracle_check import duck, rows_of

PAGES = [
    (1, "http://a.example/", "<html lang=\"en\"><head><title>A &amp; B\n c</title><style>p{}</style></head><body><p>Hello <b>wo</b>rld"
        "<br/>two&nbsp;words<script>var t='</p>'</script><!-- no --> &lt;x&gt;</p><a class='q' href=\"/l?a=1&amp;b=2\">go</a></body></html>"),
    (2, None, None), (None, "u", ""), (1, "http://a.example/", "plain < text"), (3, "x", "<script>never closed"),
    (4, "y", "<p>" * 50_000 + "deep"),
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(*p, "clash", "clash", 5) for p in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block string, record_id string, links int")
    return warc.as_warc(warc.derive(warc.responses(pages))).collect()


def test_two_linked_records_a_page(records):
    assert len(records) == 2 * len(PAGES)
    of = {(r.refers_to, r.record_type): r for r in records}
    for r in records:
        other = of[r.refers_to, "metadata" if r.record_type == "conversion" else "conversion"]
        assert r.related_to == other.record_id and r.record_id != r.refers_to
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.source_digest in {"sha256:" + hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in PAGES}


def test_text_and_fields(records):
    text = next(r.block for r in records if r.source_id == 1 and r.record_type == "conversion" and r.n_links)
    assert text == "Hello world\ntwo words <x>\ngo"
    meta = next(r.block for r in records if r.source_id == 1 and r.record_type == "metadata" and r.n_links)
    assert meta.split("\r\n")[:2] == ["title: A & B c", "language: en"]
    assert "outlink: /l?a=1&b=2" in meta.split("\r\n") and "source-header: HTTP/1.1 200 OK" in meta.split("\r\n")
    assert [r.block for r in records if r.source_id == 4 and r.record_type == "conversion"] == ["deep"]
    assert [r.block for r in records if r.source_id == 2 and r.record_type == "conversion"] == [""]


def test_record_in_the_file_format(records):
    for r in records:
        head, _, rest = r.record.encode().partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[:n] == r.block.encode() and rest[n:] == b"\r\n\r\n"
        assert fields[b"WARC-Refers-To"].decode() == r.refers_to


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derive(warc.responses(pages)).count() == 0


def test_query_as_sql(spark, sf_dir):
    from snapfold.llm.queries import ORACLE, op8_warc_derivatives
    got = rows_of(op8_warc_derivatives(spark, sf_dir).toPandas())
    assert got == rows_of(duck(sf_dir).execute(ORACLE["op8_warc_derivatives"]).df())


def test_quotes_and_references(spark):
    page = ("<html class=x xml:lang=no lang='fr'><title>L&#8217;&eacute;t&#xE9; &mdash; &amp;lt; &#128; &#0; &#x1F600;</title>"
            "<a href='/a?x=1&amp;y=2'>1</a><a class=q href=/b>2</a><a title=\"x > href=no\" href = \"/c\">3</a>"
            "<a data-href='no' href=\"/d&#39;\">4</a><A HREF=/e/>5</A><a name=z>6</a><article href=no>7</article>"
            "&hellip;&NotEqualTilde;&nbsp;&#160;&nosuch; &copy &#99999999999999999999; AT&T &")
    rows = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    by = {r.record_type: r for r in warc.derive(warc.responses(rows)).collect()}
    lines = by["metadata"].block.split("\r\n")
    assert lines[:2] == ["title: L\u2019\u00e9t\u00e9 \u2014 &lt; \u20ac \ufffd \U0001f600", "language: fr"]
    assert [x[9:] for x in lines if x.startswith("outlink: ")] == ["/a?x=1&y=2", "/b", "/c", "/d'", "/e/"]
    assert by["metadata"].n_links == 5
    assert by["conversion"].block.endswith("\u2026\u2242\u0338  &nosuch; &copy \ufffd AT&T &")


def test_every_named_reference(spark):
    from html.entities import html5
    names = [n for n in html5 if n.endswith(";")]
    rows = spark.createDataFrame([(k, f"[&{n}]") for k, n in enumerate(names)], "k int, t string")
    got = {r.k: r.c for r in rows.select("k", warc.unescape(rows.t).alias("c")).collect()}
    assert all(got[k] == f"[{' ' if n in ('nbsp;', 'NonBreakingSpace;') else html5[n]}]" for k, n in enumerate(names))
