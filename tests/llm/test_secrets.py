from __future__ import annotations

import hashlib
import re

from snapfold.llm import secrets
from snapfold.llm.queries import op7_secret_scan
from tests.llm import cases

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def joined(found):
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)


def shown(out):
    return sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out.collect()), key=str)


def wanted(rows):
    return sorted(((i, *(sum(k == n for _, k, _ in brute(t)) for n in range(3)),
                    hashlib.sha256(joined(brute(t)).encode()).hexdigest()) for i, t in rows), key=str)


def test_base_spans(monkeypatch):
    for text in [t for _, t in cases.texts()] + ["TOKEN:abc123 tokeN='abcde' api-key=abcdefgh apikey = x.y/z=+1 ſecret=abcdef1",
                                                "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "c", "f" * 23 + "g" + "0" * 24 + "F",
                                                "password=password=hunter22 secret: token=abcdef"]:
        assert [(s, k, e) for k, s, e, _ in secrets.base_spans(text or "")] == brute(text)


def test_rows(spark, sf_dir, tmp_path, monkeypatch):
    from snapfold.llm import queries
    monkeypatch.setattr(queries, "table", lambda *_: cases.docs(spark))
    out = op7_secret_scan(spark, sf_dir)
    assert shown(out) == wanted(cases.texts())
    for r in out.collect():
        assert len([x for x in r.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")]) \
            == r.n_assign + r.n_access + r.n_hex


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert shown(op7_secret_scan(spark, sf)) == wanted(rows)


LIVE, EXAMPLE = "ghp_" + "aB3" * 12, "ghp_" + "xY9" * 12


def corpus(spark):
    rows = [(1, f"key {LIVE} here", "src1"), (2, f"again {LIVE}", "src1"), (3, "nothing", "src2"), (4, None, None)]
    rows += [(10 + k, f"as in the manual: {EXAMPLE} password=abcdef1", f"src{k}") for k in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_ownership_separates_examples(spark):
    by = {r.doc_id: r for r in secrets.scan(corpus(spark)).collect()}
    live = lambda i: [(x.live, x.n_repos, x.n_owners) for x in by[i].judged if x.kind == 3]
    assert live(1) == live(2) == [(True, 2, 1)]
    assert live(10) == [(False, 6, 6)] and by[3].judged is None


def test_mask(spark):
    got = {r.doc_id: r.text for r in secrets.mask(corpus(spark)).collect()}
    assert got[1] == "key [SECRET] here" and got[3] == "nothing" and got[4] is None
    assert got[10] == f"as in the manual: {EXAMPLE} [SECRET]"
    assert secrets.masked_text("0123456789abcdef01234567", []) == "[SECRET]"
    assert secrets.masked_text("a password=" + "ab" * 12 + " z", []) == "a [SECRET] z"


def test_mask_keeps_rows_and_columns(spark):
    docs = cases.docs(spark)
    out = secrets.mask(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(not secrets.base_spans(r.text or "") for r in out.collect())


def test_empty_table(spark):
    assert secrets.scan(cases.empty(spark)).count() == 0
    assert secrets.mask(cases.empty(spark)).count() == 0


def test_mask_counts_owners_of_all_kinds(spark):
    rows = [(k, f'token = "{EXAMPLE}"', f"src{k}") for k in range(20)] + [(20, f"see {EXAMPLE} here", "src3"),
                                                                          (21, f"key {LIVE} here", "src3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = {r.doc_id: r.judged for r in secrets.scan(docs).collect()}
    assert judged[20][0].n_owners == 20 and not judged[20][0].live
    got = {r.doc_id: r.text for r in secrets.mask(docs).collect()}
    assert got[20] == f"see {EXAMPLE} here" and got[21] == "key [SECRET] here"
    assert got[0] == '[SECRET]"'


def masked_whole(text):
    base = secrets.base_spans(text)
    return secrets.masked_text(text, [(s, e) for _, s, e, _ in secrets.more_spans(text, base)])


def test_candidates_partly_under_base_spans():
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIb\nshort==\n"
    end = "-----END RSA PRIVATE KEY-----"
    assert masked_whole(f'secret: "{key}{end}" tail') == '[SECRET]" tail'
    sealed = key.replace("MIIb", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,01AB\n\nMIIb")
    assert masked_whole(f"a {sealed}{end} b {key}{end} c") == "a [SECRET] b [SECRET] c"
    assert masked_whole(f"a {sealed}") == "a [SECRET]" and masked_whole(f"{key}{key}{end} z") == "[SECRET][SECRET] z"
    assert masked_whole("x://me:token=abcdef,more@host") == "x://[SECRET]@host"
    base = secrets.base_spans(f"token={LIVE}")
    assert base and not secrets.more_spans(f"token={LIVE}", base)          # covered whole


def test_query_returns_both_frequencies(spark, sf_dir, monkeypatch):
    from snapfold.llm import queries
    monkeypatch.setattr(queries, "table", lambda *_: corpus(spark))
    got = {r.doc_id: (r.spans.count(","), r.frequencies) for r in op7_secret_scan(spark, sf_dir).collect()}
    assert got[1] == got[2] == (0, "2:1") and got[10] == (0, "6:6") and got[3][1] == got[4][1] == ""
