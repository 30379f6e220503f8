"""Trigram queries, candidates and spans against the patterns run over everything."""

import hashlib
import re

import numpy as np
import pytest

from tidelake.llm.queries import op7_secrets
from tidelake.llm.secrets import RULES, Rule, Scanner, candidates, find_secrets, index, redact, trigram_query, trigrams

KEY = "AKIA" + "B" * 16
TEXTS = [
    None, "", "nothing here", "PassWord = 'abcdefgh12'", "passwd:short", "token=secret:abcdefgh", "api_key=ABCDEFGH apikey: x.y.z-w_v",
    f"x {KEY} y {KEY[:14]}", "AKIA" * 5, "0123456789abcdef" * 2, "0123456789abcdef" * 2 + "g" + "f" * 31, "é世 secret=\"" + "a" * 40 + "\"",
    "ſecret=abcdefghij toKen=abcdefghij", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "pass word=abcdefgh pas\nsword=abcdefgh",
    "word " * 9000 + "token=abcdefgh", f"{KEY} password={KEY}",
]


def plain(text):
    rx = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(rx, text or "", re.IGNORECASE | re.ASCII) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


@pytest.mark.parametrize(("pattern", "query"), [
    ("abcd", ("and", ("abc", "bcd"))),
    ("AB[cd]e", ("or", (("and", ("abc", "bce")), ("and", ("abd", "bde"))))),
    ("abc|xyz", ("or", ("abc", "xyz"))),
    ("abc|x", None),
    ("[0-9a-f]+", None),
    ("(abc)+z", "abc"),
    ("foo.*bar", ("and", ("foo", "bar"))),
    ("(?:abc)?def", ("or", (("and", ("abc", "bcd", "cde", "def")), "def"))),
])
def test_queries(pattern, query):
    assert trigram_query(pattern) == query


def test_rules_without_trigrams_scan_fully():
    queries = {r.kind: trigram_query(r.pattern) for r in RULES}
    assert queries["hex"] is None
    assert all(q is not None for kind, q in queries.items() if kind != "hex")
    assert {"pas", "swd", "sec", "ken", "api"} <= trigrams(queries["assign"])


def test_index():
    texts = ["abcabc", None, "xABc", "bca", "", "世abc"]
    got = index(texts, ["abc", "bca", "zzz"])
    assert {k: v.tolist() for k, v in got.items()} == {"abc": [0, 2, 5], "bca": [0, 3]}
    assert candidates(("and", ("abc", "bca")), got, 6).tolist() == [0]
    assert candidates(("or", ("abc", "bca")), got, 6).tolist() == [0, 2, 3, 5]
    assert candidates(None, got, 3).tolist() == [0, 1, 2]
    assert candidates("zzz", got, 6).tolist() == []


def test_long_blocks_keep_their_edges(monkeypatch):
    text = "x" * ((1 << 22) - 2) + "token=abcdefgh"
    assert [len(x) for x in Scanner(RULES[:1]).spans([text, "y", None])] == [1, 0, 0]


def test_spans(spark):
    frame = spark.createDataFrame([(None if i == 4 else i % 16, t, 5) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, secrets int").repartition(4)
    got = sorted(str([tuple(s)[:3] for s in r.secrets if s.base]) for r in find_secrets(frame).collect())
    assert got == sorted(str(plain(t)) for t in TEXTS)
    assert find_secrets(frame.limit(0)).count() == 0


def test_added_rules_stay_beside_base():
    more = Scanner(RULES).spans(["ghp_" + "a" * 36 + " token=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----"])
    assert [[RULES[k].kind for *_, k in x] for x in more] == [["code_host", "hex", "assign"], ["private_key"]]


def test_redact(spark):
    rows = [(1, f"a {KEY} b password={KEY} c", "en", 3), (2, None, None, None), (3, "clean", "en", 5)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint")
    out = redact(frame)
    assert out.schema == frame.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a [access] b [assign] c", 2: None, 3: "clean"}


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op7_secrets(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, *_ in spans) for x in ("assign", "access", "hex")]


def test_own_rules():
    rule = Rule("id", r"id-[0-9]+", 5)
    assert Scanner((rule,)).spans(["id-1 id-22 ID-333"]) == [[(5, 10, 0)]]
    assert np.array_equal(candidates(trigram_query(rule.pattern), index(["id-9", "i d-"], ["id-"]), 2), [0])


BODY = ["MIIEpAIBAAKCAQEAxq" + "Zb7+/Kd9" * 5, "Qw3rTy" * 10, "pL0kMj8h=="]


@pytest.mark.parametrize("text", [
    "a\n-----BEGIN RSA PRIVATE KEY-----\n{}\n{}\n{}\n-----END RSA PRIVATE KEY-----\nplain tail",
    "a\r\n-----BEGIN ENCRYPTED PRIVATE KEY-----\r\n{}\r\n{}\r\n{}\r\n-----END ENCRYPTED PRIVATE KEY-----\r\nplain tail",
    "a -----BEGIN EC PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00AA\n\n{}\n{}\n{}\nplain tail",
    'a "-----BEGIN PRIVATE KEY-----\\n{}\\n{}\\n{}\\n" plain tail',
    "a -----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\n{}\n{}\n{}\n=aB3d\n-----END PGP PRIVATE KEY BLOCK-----\nplain tail",
    "a -----BEGIN PRIVATE KEY-----\n{}\n{}\n{}\n-----BEGIN PRIVATE KEY-----\nMIIEpAIBAAKCAQEAxq\n-----END PRIVATE KEY-----\nplain tail",
])
def test_no_part_of_a_key_stays(spark, text):
    frame = spark.createDataFrame([(text.format(*BODY),)], "text string")
    out = redact(frame).first().text
    assert "[private_key]" in out and out.startswith("a") and out.endswith("plain tail")
    assert not any(part in out for line in BODY for part in (line[:8], line[-8:], "KEY-----", "4,ENC", "00AA", "MIIE", "aB3d"))
