"""WARC derivatives: metadata and plain-text conversion records of response records.

``responses`` frames fetched pages as response records. ``derive`` turns each response
into two records that refer to it: a metadata record (application/warc-fields: title,
language, the response's own headers, its payload digest, its links) and a conversion
record (text/plain). Both carry WARC-Refers-To, the target URI and date of the response
and a digest of their own block; the conversion is also linked to the metadata record.
``as_warc`` writes a record in the file format. Everything is a column expression; there
is no shuffle.

Defined results: a null page or url is empty text, a null id has the text ``null`` in
the identifier; repeated rows give repeated records with equal identifiers; an element
that is never closed is kept as text; attribute values are read with double, single or no
quotes; named (HTML's list) and numeric references are replaced where a semicolon ends
them, and no-break spaces so written become spaces; other columns are ignored.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"      # of the fetch, where the pages hold none

# Elements without text, tags that end a line. ENTITIES, LANGUAGE and LINK are
# the usual forms alone, for the SQL oracle; pages are read by NAMED, REFERENCE and attribute().
SILENT = ("head", "script", "style", "noscript", "template")
LINE_TAGS = r"(?i)</?(?:br|p|h[1-6]|li|ul|ol|div|article|section|nav|header|footer|tr|table|title|main|hr|pre|blockquote)(?:[ \t\r\n/][^>]*)?>"
ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"),
            ("&gt;", ">"), ("&amp;", "&")]
SILENT_ELEMENT = rf"(?is)<({'|'.join(SILENT)})(?:[ \t\r\n][^>]*)?>.*?</\1[ \t\r\n]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LANGUAGE = r'(?is)<html[^>]*[ \t\r\n]lang="([^"]*)"'
LINK = r'(?is)<a[ \t\r\n][^>]*?href="([^"]*)"'
# HTML's named references, commonest first as a map is searched in order; a no-break space is a space
NAMED = {n[1:-1]: c for n, c in ENTITIES if n[1] != "#"}
NAMED |= {n[:-1]: c for n, c in html5.items() if n.endswith(";") and n[:-1] not in NAMED} | {"NonBreakingSpace": " "}
REFERENCE = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
# numeric references to C1 controls mean characters of windows-1252
CONTROLS = {f"{b:X}": bytes([b]).decode("cp1252") for b in range(128, 160) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def record_id(*parts: Column) -> Column:
    """A urn:uuid that depends on the parts alone."""
    h = F.md5(F.concat_ws("|", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def _map(of: dict[str, str]) -> Column:
    """A map literal."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in of.items())), F.lit("\x01"), F.lit("\x02"))


def _character(ref: Column) -> Column:
    """What a reference stands for; an unknown name stays as it is."""
    dec, hexa = (F.regexp_extract(ref, p, 1) for p in ("#0*([0-9]+);", "[xX]0*([0-9a-fA-F]+);"))
    code = F.when(dec == "", F.upper(hexa)).when(F.length(dec) <= 7, F.conv(dec, 10, 16)).otherwise(F.lit("FFFFFFF"))
    padded = F.lpad(code, 8, "0")
    wrong = (F.length(code) > 6) | (padded > "0010FFFF") | padded.between("0000D800", "0000DFFF") | (padded == "00000000")
    number = F.when(wrong, F.lit("\ufffd")).when(code == "A0", F.lit(" ")).otherwise(
        F.coalesce(F.element_at(_map(CONTROLS), code), F.decode(F.unhex(F.when(~wrong, padded)), "UTF-32")))
    return F.when(F.substring(ref, 2, 1) == "#", number).otherwise(
        F.coalesce(F.element_at(_map(NAMED), ref.substr(F.lit(2), F.length(ref) - 2)), ref))


def unescape(text: Column) -> Column:
    """``text`` with its references replaced, each once. The argument stands in the result
    several times: give a column that is there already, or a short expression."""
    refs = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), _character)
    both = F.zip_with(F.split(text, REFERENCE, -1), refs, lambda t, c: F.concat(t, F.coalesce(c, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(both, "")).otherwise(text)


def attribute(tag: str, name: str) -> str:
    """A pattern of a tag up to the value of its first attribute ``name``, which is group 1
    with its quotes, if any. Other attributes are stepped over with their values."""
    ws, value = r"[ \t\r\n\f]", r"""(?:"[^"]*"|'[^']*'|[^ \t\r\n\f>"'][^ \t\r\n\f>]*+)"""
    other = rf"(?:[ \t\r\n\f/]*+(?!{name}{ws}*+=)[^ \t\r\n\f/>][^ \t\r\n\f/>=]*+(?:{ws}*+={ws}*+{value})?+)*+"
    return rf"(?is)<{tag}(?=[ \t\r\n\f/]){other}[ \t\r\n\f/]*+{name}{ws}*+={ws}*+({value})"


def unquoted(value: Column) -> Column:
    return F.when(F.substring(value, 1, 1).isin('"', "'"), value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)


def one_line(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, "[ \t\r\n]+", " "), F.lit(" "))


def with_plain_text(df: DataFrame, html_col: str, name: str) -> DataFrame:
    """Adds ``name``: the page's text, a line for each block, single spaces within. What a
    step refers to more than once is a column of its own before it, so that each regular
    expression runs once over a page."""
    t = F.regexp_replace(html_col, SILENT_ELEMENT, "")
    t = F.regexp_replace(t, "(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, "[ \t\r\n]{2,}|[\t\r\n]", " ")     # single spaces stay as they are
    t = F.regexp_replace(F.regexp_replace(t, LINE_TAGS, "\n"), "<[^>]*>", "")
    df = df.withColumn(name, t).withColumn(name, unescape(F.col(name)))
    return df.withColumn(name, F.btrim(F.regexp_replace(name, " *\n[ \n]*", "\n"), F.lit(" \n")))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = DATE) -> DataFrame:
    """(source_id, record_id, target_uri, warc_date, http_headers, payload, payload_digest)."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                       F.octet_length(html).cast("string"), F.lit("\r\n"))
    return pages.select(F.col(id_col).cast("long").alias("source_id"),
                        record_id(key, url, F.lit("response")).alias("record_id"), url.alias("target_uri"),
                        F.lit(date).alias("warc_date"), headers.alias("http_headers"), html.alias("payload"),
                        digest(html).alias("payload_digest"))


def derive(resp: DataFrame) -> DataFrame:
    """Two rows per response: (source_id, record_type, record_id, refers_to, related_to,
    target_uri, warc_date, content_type, source_digest, block, block_digest, n_links)."""
    html = F.col("payload")
    links = F.transform(F.regexp_extract_all(html, F.lit(attribute("a", "href")), F.lit(1)), unquoted)
    source_lines = F.transform(F.filter(F.split("http_headers", "\r\n"), lambda x: x != ""),
                               lambda x: F.concat(F.lit("source-header: "), x))
    fields = F.concat(
        F.array(F.concat(F.lit("title: "), one_line(unescape(F.col("title")))),
                F.concat(F.lit("language: "), unquoted(F.col("language"))),
                F.concat(F.lit("payload-digest: "), F.col("payload_digest"))),
        source_lines, F.transform("links", lambda x: F.concat(F.lit("outlink: "), one_line(x))))
    read = resp.withColumn("title", F.regexp_extract(html, TITLE, 1)) \
        .withColumn("language", F.regexp_extract(html, attribute("html", "lang"), 1)) \
        .withColumn("links", links).withColumn("links", F.transform("links", unescape))
    read = with_plain_text(read, "payload", "text") \
        .withColumn("metadata", F.concat(F.array_join(fields, "\r\n"), F.lit("\r\n"))) \
        .withColumn("meta_id", record_id(F.col("record_id"), F.lit("metadata"))) \
        .withColumn("text_id", record_id(F.col("record_id"), F.lit("conversion")))
    record = lambda kind, rid, other, mime, block: F.struct(
        F.lit(kind).alias("record_type"), F.col(rid).alias("record_id"), F.col(other).alias("related_to"),
        F.lit(mime).alias("content_type"), F.col(block).alias("block"))
    both = F.array(record("metadata", "meta_id", "text_id", "application/warc-fields", "metadata"),
                   record("conversion", "text_id", "meta_id", "text/plain; charset=utf-8", "text"))
    return read.select("source_id", "record_id", "target_uri", "warc_date", "payload_digest",
                       F.size("links").cast("long").alias("n_links"), F.explode(both).alias("r")).select(
        "source_id", "r.record_type", F.col("r.record_id").alias("record_id"),
        F.col("record_id").alias("refers_to"), "r.related_to", "target_uri", "warc_date", "r.content_type",
        F.col("payload_digest").alias("source_digest"), "r.block", digest(F.col("r.block")).alias("block_digest"),
        "n_links")


def as_warc(records: DataFrame) -> DataFrame:
    """Adds ``record``: the record as it stands in a WARC file."""
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")), F.concat(F.lit("WARC-Date: "), F.col("warc_date")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to")),
        F.concat(F.lit("WARC-Refers-To-Target-URI: "), F.col("target_uri")),
        F.concat(F.lit("WARC-Refers-To-Date: "), F.col("warc_date")),
        F.concat(F.lit("WARC-Concurrent-To: "), F.col("related_to")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")),
        F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest")),
        F.concat(F.lit("Content-Type: "), F.col("content_type")),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")))
    return records.withColumn("record", F.concat(head, F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r\n")))
