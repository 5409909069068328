"""Secret scans against the regular expressions of the standard library."""

import random
import re

import pytest
from docweave.llm import queries
from docweave.llm import secrets as S

A = re.compile(S.BASE[0].pattern, re.ASCII | re.I)
B = re.compile(S.BASE[1].pattern)
C = re.compile(S.BASE[2].pattern)


def brute(t):
    found = [(m.start(), m.end(), 0) for m in A.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), 1) for m in B.finditer(t) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), m.end(), 2) for m in C.finditer(t) if len(m[0]) >= 24])


@pytest.fixture(scope="module")
def scanner():
    return S.Scanner()


def test_random_texts(scanner):
    rng = random.Random(1)
    parts = ["token", "secret", "passwd", "password", "apikey", "api_key", "AKIA", "=", ":", " ", '"', "'", "abc", "0123456789abcdef", "ABCD1234EF", "é", "\n", "x", ".", "-", "tok", "PASSWORD", "ſecret"]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert brute(t) == [x for x in scanner.spans(t.encode()) if x[2] < 3], t


def test_other_rules(scanner):
    full = {r.kind: re.compile(r.pattern) for r in S.MORE}
    texts = ["eyJhbGciOiJI.eyJzdWIiOiIx.abc_def-123456", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN x-----BEGIN PRIVATE KEY-----", "ghp_" + "a1" * 20, "xoxb-12345-abcdef-1", "AIza" + "x_-1" * 9, "eyJa eyJb.c", "ghp_short"]
    for t in texts:
        t = f"é {t} ."
        want = sorted((m.start(), m.end(), k + 3) for k, r in enumerate(S.MORE) for m in full[r.kind].finditer(t) if len(m[0]) >= r.least)
        assert want == [x for x in scanner.spans(t.encode()) if x[2] >= 3], t


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    names = [r.kind for r in S.BASE]
    import hashlib

    got = queries.op6_secrets(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        want = brute(docs[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for *_, k in want) for n in range(3)]
        joined = ",".join(f"{names[k]}:{i}:{j}" for i, j, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_edges(spark):
    rows = [(1, None, 0, "x"), (1, "", 0, "x"), (None, "token=abcdef", 12, "x"), (2, "ab" * 100_000, 200_000, "x"), (3, "é secret: 'hunter22' ok", 22, "x"), (3, "é secret: 'hunter22' ok", 22, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, found string")
    got = {(r.doc_id, tuple((x.kind, x.start, x.end) for x in r.found)) for r in S.scan(df).collect()}
    assert got == {(1, ()), (None, (("assign", 0, 12),)), (2, (("hex", 0, 200_000),)), (3, (("assign", 2, 19),))}
    assert S.scan(df.limit(0)).count() == 0
    red = sorted(S.redact(df).collect(), key=str)
    assert len(red) == 6
    assert {(r.text, r.n_chars) for r in red if r.doc_id == 3} == {("é [assign]' ok", 14)}
    assert {r.text for r in red if r.doc_id == 1} == {None, ""}
    assert {(r.text, r.n_chars) for r in red if r.doc_id == 2} == {("[hex]", 5)}


def test_random_texts_of_all_rules(scanner):
    rng = random.Random(2)
    full = [(re.compile(r.pattern, re.ASCII | (re.I if r.any_case else 0)), r) for r in S.RULES]
    parts = ["eyJ", ".", "a1", "eyJab.", "-----", "BEGIN ", "-----BEGIN ", "PRIVATE KEY-----", "A B ", "ghp_", "gho", "_", "a1" * 20, "xoxb-", "12-ab", "AIza", "x_-1" * 9, "AKIA", "Z9" * 9, "0123456789abcdef" * 2, "token", "=", " ", "é", "SECRET: "]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        want = []
        for k, (p, r) in enumerate(full):
            want += [(m.start(), m.end(), k) for m in p.finditer(t) if len(m[r.group]) >= r.least]
        assert sorted(want) == scanner.spans(t.encode()), t


def test_small_rules():
    from docweave.llm.automaton import Automaton

    patterns = ["x[ab]*", "(ab|ba?c)d{2,3}", "[ab]+", "q[ab]?r", "aab*"]
    auto = Automaton([(p, False, 0) for p in patterns])
    rng = random.Random(3)
    for _ in range(5_000):
        t = "".join(rng.choices("abcdxqr", k=rng.randint(0, 12)))
        want = sorted((m.start(), m.end(), k) for k, p in enumerate(patterns) for m in re.finditer(p, t))
        assert [s[:3] for s in auto.spans(t.encode())] == want, t
    for bad in ("[ab]*x", "a(bc)*", "q[a-z]?r", "(a|"):
        with pytest.raises((ValueError, IndexError)):
            Automaton([(bad, False, 0)])
