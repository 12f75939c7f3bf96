"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from snapfold.llm import decontamination, license_scan, vector_codes, warc


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped(text: str) -> str:
    """An E'' string, for text with line ends."""
    return "E" + quoted(text.replace("\\", "\\\\").replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t"))


def license_sql() -> str:
    k, grams = license_scan.K, license_scan.template_grams()
    known = ",\n".join(f"({quoted(g)}, {n}, {q}, {of}, {quoted(label)}, {str(base).lower()})"
                       for g, n, q, of, label, base in grams)
    rolled = " || ' ' || ".join(f"ws[p + {j + 1}]" for j in range(k))
    return rf"""
WITH cut AS (
  SELECT row_number() OVER () AS line, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '{license_scan.WORD}') AS ws
  FROM documents),
known(gram, n, q, parts, label, is_base) AS (VALUES {known}),
rolled AS (
  SELECT line, p, {rolled} AS gram
  FROM (SELECT line, ws, unnest(range(len(ws) - {k - 1})) AS p FROM cut)),
hits AS (SELECT r.line, r.p, k.* FROM rolled r JOIN known k USING (gram)),
places AS (
  SELECT line, label, min(p) AS place FROM hits WHERE is_base
  GROUP BY line, label, n, parts, p - q HAVING count(DISTINCT q) = parts),
steps AS (
  SELECT *, CASE WHEN (p - q) - lag(p - q) OVER (PARTITION BY line, n ORDER BY p - q, q) > {license_scan.MERGE_WORDS}
                 THEN 1 ELSE 0 END AS opens
  FROM hits WHERE NOT is_base),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY line, n ORDER BY p - q, q ROWS UNBOUNDED PRECEDING) AS run FROM steps),
notices AS (
  SELECT line, label, count(DISTINCT q)::DOUBLE / parts AS share FROM runs
  GROUP BY line, n, label, parts, run HAVING count(DISTINCT q)::DOUBLE / parts >= {license_scan.MIN_SHARE}),
of_base AS (
  SELECT line, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM places GROUP BY line),
every AS (
  SELECT line, label, 1.0::DOUBLE AS share FROM places UNION ALL SELECT line, label, share FROM notices),
of_all AS (
  SELECT line, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score,
         count(*) AS n_spans FROM every GROUP BY line)
SELECT c.doc_id, len(c.ws)::BIGINT AS n_words, coalesce(b.n_base, 0)::BIGINT AS n_base,
       b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
       coalesce(b.base_labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       coalesce(a.score, 0)::DOUBLE AS score, coalesce(a.n_spans, 0)::BIGINT AS n_spans
FROM cut c LEFT JOIN of_base b USING (line) LEFT JOIN of_all a USING (line)
"""


def warc_sql() -> str:
    def uuid(parts: str) -> str:
        cuts = " || '-' || ".join(f"substr({{h}}, {a}, {n})" for a, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])
        return f"'<urn:uuid:' || {cuts.format(h=f'md5({parts})')} || '>'"

    def unescape(x: str) -> str:
        for entity, char in warc.ENTITIES:
            x = f"replace({x}, {quoted(entity)}, {quoted(char)})"
        return x

    def sub(x: str, pattern: str, by: str = "") -> str:
        return f"regexp_replace({x}, {_escaped(pattern)}, {_escaped(by)}, 'g')"

    def one_line(x: str) -> str:
        return f"trim({sub(x, '[ \t\r\n]+', ' ')}, ' ')"
    t = "html"
    for tag in warc.SILENT:
        t = sub(t, f"(?is)<{tag}(?:[ \t\r\n][^>]*)?>.*?</{tag}[ \t\r\n]*>")
    t = sub(t, "(?s)<!--.*?-->")
    t = sub(t, "[ \t\r\n]+", " ")
    t = sub(sub(t, warc.LINE_TAGS, "\n"), "<[^>]*>")
    t = sub(unescape(t), " *\n[ \n]*", "\n")
    crlf = "E'\\r\\n'"
    return rf"""
WITH page AS (
  SELECT page_id AS source_id, coalesce(page_id::VARCHAR, 'null') AS k, coalesce(url, '') AS target_uri,
         coalesce(html, '') AS html FROM pages),
resp AS (SELECT *, {uuid("k || '|' || target_uri || '|response'")} AS rid, 'sha256:' || sha256(html) AS pd FROM page),
read AS (
  SELECT *, {uuid("rid || '|metadata'")} AS meta_id, {uuid("rid || '|conversion'")} AS text_id,
         trim({t}, E' \n') AS plain,
         regexp_extract_all(html, {_escaped(warc.LINK)}, 1) AS links,
         {one_line(unescape(f"regexp_extract(html, {_escaped(warc.TITLE)}, 1)"))} AS title,
         regexp_extract(html, {_escaped(warc.LANGUAGE)}, 1) AS lang FROM resp),
filled AS (
  SELECT *, 'title: ' || title || {crlf} || 'language: ' || lang || {crlf} || 'payload-digest: ' || pd || {crlf}
       || 'source-header: HTTP/1.1 200 OK' || {crlf} || 'source-header: Content-Type: text/html; charset=utf-8'
       || {crlf} || 'source-header: Content-Length: ' || strlen(html)::VARCHAR || {crlf}
       || array_to_string(list_transform(links, lambda x: 'outlink: ' || {one_line(unescape('x'))} || {crlf}), '') AS meta
  FROM read),
records AS (
  SELECT source_id, 'metadata' AS record_type, meta_id AS record_id, rid AS refers_to, text_id AS related_to,
         target_uri, 'application/warc-fields' AS content_type, pd, meta AS block, links FROM filled
  UNION ALL
  SELECT source_id, 'conversion', text_id, rid, meta_id, target_uri, 'text/plain; charset=utf-8', pd, plain, links
  FROM filled)
SELECT source_id, record_type, record_id, refers_to, related_to, target_uri, {quoted(warc.DATE)} AS warc_date,
       content_type, pd AS source_digest, block, 'sha256:' || sha256(block) AS block_digest,
       len(links)::BIGINT AS n_links
FROM records
"""


def vector_codes_sql(dim: int = 64) -> str:
    """Each round spelled out over (row, part, component) columns, for vectors of ``dim``."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    width = dim // parts
    comps = [f"c{k}" for k in range(width)]
    listed = ", ".join(comps)

    def assigned(book: str) -> str:
        far = " + ".join(f"(t.{c} - b.{c}) * (t.{c} - b.{c})" for c in comps)
        return (f"SELECT t.line, t.p, any_value(t.label) AS label, {', '.join(f'any_value(t.{c}) AS {c}' for c in comps)}, "
                f"min(({far}) * {entries} + b.e) AS best FROM part t JOIN {book} b USING (p) GROUP BY t.line, t.p")

    def moved(near: str, book: str) -> str:
        floors = ", ".join(f"((sum({c}) - ((sum({c}) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS {c}" for c in comps)
        return (f"SELECT b.p, b.e, {', '.join(f'coalesce(m.{c}, b.{c}) AS {c}' for c in comps)} FROM {book} b LEFT JOIN "
                f"(SELECT p, best % {entries} AS e, {floors} FROM {near} GROUP BY ALL) m USING (p, e)")
    steps, book = [], "book0"
    for k in range(vector_codes.ROUNDS):
        steps += [f"near{k} AS ({assigned(book)})", f"book{k + 1} AS ({moved(f'near{k}', book)})"]
        book = f"book{k + 1}"
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS line, vec_id, label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {vector_codes.SCALE})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (
  SELECT line, label, p, {', '.join(f'v[{width} * p + {k + 1}] AS {c}' for k, c in enumerate(comps))}
  FROM kept, range({parts}) r(p)),
book0 AS (SELECT p, line - 1 AS e, {listed} FROM part WHERE line <= {entries}),
{', '.join(steps)},
last AS ({assigned(book)}),
coded AS (
  SELECT line, any_value(label) AS label, string_agg(format('{{:02x}}', best % {entries}), '' ORDER BY p) AS code,
         sum(best // {entries})::BIGINT AS error FROM last GROUP BY line)
SELECT kept.vec_id, code, error, (sum(error) OVER (PARTITION BY coded.label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(concat_ws(',', {listed}), ',' ORDER BY p, e)) FROM {book}) AS codebooks_sha256
FROM coded JOIN kept USING (line)
"""


def decontamination_sql() -> str:
    window = decontamination.WINDOW
    cut = (f"regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), "
           f"'{license_scan.WORD}')")
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS line, doc_id, {cut} AS ws FROM documents),
item AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {cut} AS ws FROM benchmark),
phrase AS (
  SELECT DISTINCT item, n, array_to_string(ws[p + 1:p + n], ' ') AS words
  FROM (SELECT item, ws, least(len(ws), {window}) AS n, unnest(range(greatest(len(ws) - {window - 1}, 1))) AS p
        FROM item WHERE len(ws) > 0)),
place AS (
  SELECT line, n, p, array_to_string(ws[p + 1:p + n], ' ') AS words
  FROM (SELECT line, ws, n, unnest(range(len(ws) - n + 1)) AS p FROM doc, (SELECT DISTINCT n FROM phrase) sizes
        WHERE len(ws) >= n)),
hit AS (SELECT line, n, p, item FROM place JOIN phrase USING (n, words)),
words AS (
  SELECT line, count(DISTINCT w) AS n_hit FROM (SELECT DISTINCT line, unnest(range(p, p + n)) AS w FROM hit) GROUP BY line),
items AS (
  SELECT line, count(DISTINCT item) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS items_sha256
  FROM hit GROUP BY line)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN words USING (line) LEFT JOIN items USING (line)
"""


ORACLE: dict[str, str] = {
    "op1_license_scan": license_sql(),
    "op8_warc_derivatives": warc_sql(),
    "op11_vector_codes": vector_codes_sql(),
    "op13_decontamination": decontamination_sql(),
}
