"""Automata and the secrets they find, against Python's expressions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import secretscan
from eventmart.llm.automaton import SEPARATOR, Automaton
from tests.llm import tables

_KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)]


def joined(spans, kinds=("assign", "access", "hex")):
    return [f"{s['kind']}:{s['start']}:{s['stop']}" for s in spans if s["kind"] in kinds]


@pytest.fixture(scope="module")
def scanner():
    return secretscan.Scanner()


def test_random_texts_equal_the_expressions(scanner):
    rng = random.Random(3)
    parts = ["token", "Token", " ", "=", ":", '"', "'", "secret", "PASSWORD", "abc", "x1", "é", "AKIA", "Z9", "0a1b2c3d", "deadbeef", "api_key"]
    parts += ["apikey", "==", " = ", "\n", "ghp_", "passwd", "日本", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += [None, "", "token= 'secret' : abcdefghij", "token=" + " " * 100_000 + "abcdefgh", "a" * 60_000, "token=" * 9_000, "AKIA" * 9_000]
    assert [joined(s) for s in scanner.spans(pa.array(texts))] == [base_spans(t) for t in texts]
    assert [joined(s) for t in texts for s in scanner.spans(pa.array([t], pa.string()))] == [base_spans(t) for t in texts]


def test_more_kinds(scanner):
    text = (
        "é -----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 10 + " ghp_short xoxb-123456789012 "
        "postgres://me:pass@host https://plain.example/x -----BEGIN PUBLIC KEY-----"
    )
    found = scanner.spans(pa.array([text]))[0]
    assert [s["kind"] for s in found] == ["private_key", "github", "slack", "login"]
    assert [text[s["start"] : s["stop"]] for s in found][::3] == ["-----BEGIN RSA PRIVATE KEY-----", "postgres://me:pass@"]


def test_lanes_join_as_one_pass():
    automaton = Automaton(["ab+c", "x[^y]*y"], anywhere=True)
    rng = np.random.default_rng(1)
    for alphabet, n in (("abcxy", 50_000), ("ab", 30_000), ("xa", 40_000), ("z", 20_000)):
        data = rng.choice(np.frombuffer(alphabet.encode(), np.uint8), n)
        data[::7919] = SEPARATOR
        data[0] = ord("x")
        classes, table, accepts = automaton.lists()
        state, expected = 0, []
        for b in data.tolist():
            state = table[state + classes[b]]
            expected.append(accepts[state])
        assert automaton.scan(data).tolist() == expected


@pytest.mark.parametrize("pattern", ["a(b|cd)*e", "(?i:k[a-c])x{2,4}", r"[^a\-c]+\.", "a?b?c", "ab|ac|b", r"\x41[]x]{2}", "a{3}", "(ab?)+"])
def test_automaton_equals_expression(pattern):
    rng, automaton = random.Random(5), Automaton([pattern], anywhere=False)
    whole = re.compile(pattern.replace("[]x]", r"[\]x]"))
    for _ in range(3000):
        text = "".join(rng.choice("abcdeKk.xA]-") for _ in range(rng.randrange(1, 8)))
        classes, table, accepts = automaton.lists()
        state = 0
        for b in text.encode():
            state = table[state + classes[b]]
        assert bool(accepts[state]) == bool(whole.fullmatch(text)), text


@pytest.mark.parametrize("pattern", ["a(b", "[ab", "a**b)", "é", r"\d", "a{3,2}", "a*", r"\xff", "?"])
def test_bad_rules_are_refused(pattern):
    with pytest.raises(ValueError):
        Automaton([pattern], anywhere=True)


def test_query_columns_and_awkward_rows(spark):
    rows = tables.doc_rows()
    rows += [(500, "é token = \"" + "0f" * 20 + "\"", *[None] * 5), (500, "é token = \"" + "0f" * 20 + "\"", *[None] * 5), (None, "AKIA" + "Z" * 12, *[None] * 5)]
    found = {}
    for r in secretscan.counts(tables.docs(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, found.values())) == len(rows) and len(found[500]) == 2
    for doc_id, text, *_ in rows:
        expected = base_spans(text)
        r = found[doc_id][0]
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in expected) for k in ("assign", "access", "hex")]
        assert set(expected) <= set(r.spans.split(","))
    assert found[500][0].spans == "assign:2:51,hex:11:51" and found[None][0].n_access == 1
    assert secretscan.counts(tables.docs(spark, rows).limit(0)).count() == 0


def test_annotate_keeps_columns_and_redact_replaces(spark):
    rows = [(1, "x token=abcdefgh1 y", "en", None, 1, 1, "z"), (2, None, *[None] * 5), (3, "plain", *[None] * 5), (4, "é" + "ab" * 20 + " token: " + "0" * 40, *[None] * 5)]
    docs = tables.docs(spark, rows)
    marked = secretscan.annotate(docs)
    assert marked.columns == [*docs.columns, "secrets"]
    with pytest.raises(ValueError):
        secretscan.annotate(docs.withColumnRenamed("_id", "secrets"))
    clean = {r.doc_id: r.text for r in secretscan.redact(docs.withColumnRenamed("_id", "_secrets")).collect()}
    assert clean == {1: "x [secret] y", 2: None, 3: "plain", 4: "é[secret] [secret]"}
