"""Secret scan with corpus-wide ownership frequency.

Every whole text is searched for credentials of three base kinds and of further kinds
that are only candidates. The hash of each value found is counted over the corpus by
distinct repositories and owners: a value that more than ``max_owners`` owners hold is a
widely copied example, one that few hold looks live, in however many of their
repositories it stands (``n_repos`` is returned, and decides nothing). Base spans are always reported;
the other kinds only where the value looks live and base spans do not cover them whole.

Counts are partial aggregates over (value, owner, repository); what a document holds is
gathered per row, never per value. No text is shuffled.

Defined results: null and empty texts have no spans; repeated rows give repeated rows
(the same repository counts once); a null owner or repository counts as one of its own;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from xxhash import xxh64_intdigest

from snapfold.functions.hot import join_unique
from snapfold.llm.common import OWN, batch_of, boxed, map_slices, store, unboxed

MAX_OWNERS = 2
TOKEN_BITS = 3.5        # bits a character that a bare token has at least

# The base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")

# Candidate kinds: (kind, a string that every match holds, pattern).
MORE = [
    ("github", "gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}")),
    ("stripe", "k_live_", re.compile(r"\b[sr]k_live_[A-Za-z0-9]{16,}")),
    ("jwt", "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("pem", "-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----BEGIN ).)*?-----END [A-Z ]*PRIVATE KEY-----"
                                     r"|(?:\s*[A-Z][A-Za-z]*-[A-Za-z]+: [^\r\n]*)*[^-]*)", re.DOTALL)),
    ("url", "://", re.compile(r"(?<=://)[^\s:/@]+:[^\s/@]+(?=@)")),
    ("token", "", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")),
]
KINDS = ["assign", "access", "hex"] + [k for k, _, _ in MORE]
Span = tuple[int, int, int, str]      # kind, start, end, value


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds, by start, then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _random_looking(value: str) -> bool:
    n = len(value)
    bits = -sum(c / n * log2(c / n) for c in Counter(value).values())
    return (bits >= TOKEN_BITS and any(c.isdigit() for c in value) and any(c.islower() for c in value)
            and any(c.isupper() for c in value))


def more_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates of the further kinds that base spans leave at least a character of; the
    first kind to cover a place has it."""
    united: list[list[int]] = []            # the places of base spans, by start
    for _, s, e, _ in base:
        if united and s <= united[-1][1]:
            united[-1][1] = max(united[-1][1], e)
        else:
            united.append([s, e])
    starts = [s for s, _ in united]
    found: list[Span] = []
    for k, (kind, needs, pattern) in enumerate(MORE, start=3):
        if needs not in text:
            continue
        for m in pattern.finditer(text):
            if kind == "token" and not _random_looking(m[0]):
                continue
            at = bisect_right(starts, m.start()) - 1
            if at >= 0 and m.end() <= united[at][1]:
                continue
            if all(m.end() <= s or m.start() >= e for _, s, e, _ in found):
                found.append((k, m.start(), m.end(), m[0]))
    return found


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.int64())])


FOUND = ArrayType(StructType([StructField(n, t()) for n, t in (
    ("kind", IntegerType), ("start", IntegerType), ("end", IntegerType), ("hash", LongType))]))


def _searched(rows: DataFrame, *kept: str) -> DataFrame:
    """Columns ``kept`` of every row, and ``found``: the spans of its column text."""
    def make():
        def run(batch):
            out = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                out.append([{"kind": k, "start": s, "end": e,
                             "hash": xxh64_intdigest(v.encode("utf-8", "surrogatepass")) - (1 << 63)}
                            for k, s, e, v in base + more_spans(text, base)])
            return batch_of({c: batch.column(c) for c in kept} | {"found": (out, pa.list_(SPAN))})
        return run
    return map_slices(rows, make, StructType([rows.schema[c] for c in kept] + [StructField("found", FOUND)]))


def _named(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str, *more) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       text(owner_col).alias("owner"), text(repo_col).alias("repo"), text(text_col).alias("text"), *more)


def _each(found: DataFrame) -> DataFrame:
    """(row, owner, repo, kind, start, end, hash): a row for every span."""
    return found.select("row", "owner", "repo", F.explode("found").alias("s")).select("row", "owner", "repo", "s.*")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """(row, doc_id, owner, repo, found): one row per row of ``docs`` with its spans of
    all kinds as array of (kind, start, end, hash of the value)."""
    return _searched(_named(docs, id_col, text_col, owner_col, repo_col), "row", "doc_id", "owner", "repo")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners, n) over the corpus, from rows (hash, owner, repo); n: rows."""
    held = found.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return per_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"),
                                         F.sum("n").alias("n"))


def _with_owners(each: DataFrame, owners: DataFrame) -> DataFrame:
    """The spans with what the corpus says of their value, which any share of them may have."""
    return join_unique(each, owners.drop("n"), ["hash"], counts=owners.select("hash", "n"))


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """(row, doc_id, found, judged): ``found`` as of ``candidates``; ``judged`` the same
    spans by start, then kind, as (start, kind, end, live, n_repos, n_owners)."""
    found = store(candidates(docs, id_col, text_col, owner_col, repo_col), "secrets")
    each = _each(found)
    judged = (_with_owners(each, store(ownership(each), "owners"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                  "start", "kind", "end", (F.col("n_owners") <= max_owners).alias("live"),
                  "n_repos", "n_owners"))).alias("judged")))
    return found.join(judged, "row", "left").select("row", "doc_id", "found", "judged")


def spans_text(spans):
    """kind:start:end, comma-joined, of an array of (start, kind, end, ...)."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


# ---- masking

MASK = "[SECRET]"


def masked_text(text: str, more: list[tuple[int, int]]) -> str:
    """``text`` with its base spans and the spans ``more`` replaced."""
    return replaced(text, [(s, e) for _, s, e, _ in base_spans(text)] + more)


def replaced(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with the spans replaced; spans that overlap become one."""
    out, at = [], 0
    for k, (start, end) in enumerate(sorted(spans)):
        if start >= at or k == 0:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def _masked(rows: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """Column OWN of (own, spans) with the spans of its text replaced."""
    def make():
        def run(batch):
            own = batch.column(OWN)
            fields = dict(zip(columns, own.flatten()))
            texts = [None if t is None else replaced(t, [(x["start"], x["end"]) for x in spans])
                     for t, spans in zip(fields[text_col].to_pylist(), batch.column("spans").to_pylist())]
            fields[text_col] = pa.array(texts, own.type.field(columns.index(text_col)).type)
            return batch_of({OWN: pa.StructArray.from_arrays(list(fields.values()), fields=list(own.type))})
        return run
    return map_slices(rows, make, StructType([rows.schema[OWN]]))


def mask(docs: DataFrame, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "doc_id") -> DataFrame:
    """All rows with secrets masked: every base span, and those of the further kinds whose
    value looks live. Owners are counted as in ``scan``, over the values of all kinds in all
    rows. Texts are searched once, and stored with their spans; rows without a span stay as
    they are, and only those with a span of a further kind are joined with what the corpus
    says of its value. The text column is a string."""
    columns = docs.columns
    found = store(_searched(_named(docs, id_col, text_col, owner_col, repo_col, boxed(docs)),
                            "row", "owner", "repo", OWN), "secret-rows")
    each = _each(found)
    live = store(ownership(each), "owners")
    kind = lambda test: F.filter("found", lambda x: test(x["kind"]))
    short = lambda spans: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    found = found.withColumn("base", short(kind(lambda k: k < 3))).withColumn("told", F.exists("found", lambda x: x["kind"] >= 3))
    more = (_with_owners(each, live).filter((F.col("kind") >= 3) & (F.col("n_owners") <= max_owners))
            .groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("more")))
    told = found.filter("told").join(more, "row", "left") \
        .select(OWN, F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,end:int>>"))).alias("spans"))
    quiet = found.filter("NOT told AND size(found) > 0").select(OWN, F.col("base").alias("spans"))
    masked = _masked(quiet, columns, text_col).unionByName(_masked(told, columns, text_col))
    return unboxed(masked.unionByName(found.filter("size(found) = 0").select(OWN)), columns)
