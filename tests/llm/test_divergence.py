"""The source divergence audit against exact arithmetic in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from eventmart.llm import divergence
from tests.llm import tables

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top=50):
    """rows: (text, lang, source)."""
    counts, held, groups = defaultdict(Counter), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(tables.lower(text))
        counts[lang, source].update(terms)
        held.update((lang, t) for t in set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (of, t), n in held.items() if of == lang and n >= least]
        mine = sorted(s for of, s in groups if of == lang)
        whole = {s: sum(counts[lang, s][t] for t in kept) + 5 * len(kept) for s in mine}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // whole[s] for t in kept} for s in mine}
        total = {t: sum(counts[lang, s][t] for s in mine) for t in kept}
        of_lang = sum(total.values()) + 5 * len(kept)
        q = {t: 1 + 10**9 * (total[t] + 5) // of_lang for t in kept}
        for s in mine:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def check(spark, rows, least, **more):
    docs = spark.createDataFrame([(t, la, s, i) for i, (t, la, s) in enumerate(rows)], "text string, lang string, source string, g int").repartition(3)
    found = [tuple(r) for r in divergence.source_divergence(docs, least, **more).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rows, least, **({"top": more["top_terms"]} if more else {}))
    return found


def random_rows(seed, n, sources, langs=("en", "de", None)):
    rng = random.Random(seed)
    words = ["Straße", "été", "ÉTÉ", "日本"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choices(words, weights, k=rng.randrange(40)))
        rows.append((text.title() if rng.random() < 0.3 else text, rng.choice(langs), rng.choice(sources)))
    return rows


def test_random_groups(spark):
    found = check(spark, random_rows(1, 400, [f"s{i}" for i in range(9)] + [None, ""]), 5)
    assert {f[2] for f in found} == {"pair", "term"}


def test_few_ranks(spark):
    check(spark, random_rows(2, 200, ["a", "b"], ("en",)), 3, top_terms=4)


def test_awkward_rows(spark):
    rows = [(None, "en", "a"), ("", "en", "b"), ("12 34 !", "en", None), ("x" * 90_000, "de", "a"), ("only One", "de", "a"), ("only one", "de", "a")]
    check(spark, rows, 2)  # "en" keeps no term: all its values are 0
    check(spark, rows + [("one", "de", "b")] * 3 + [("one", None, None)] * 3, 2)
    check(spark, [("word", "en", "a")] * 40, 30)  # one group: no pairs, and no share above that of the language
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_more_groups_and_terms_than_a_tree_holds(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_TERMS", 40)
    rng = random.Random(4)
    rows = [(" ".join(rng.choices([f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"], k=6)), "en", f"s{i % 300}") for i in range(900)]
    check(spark, rows, 1)


def test_trees_equal_dense_matrices():
    rng = np.random.default_rng(0)
    for rows_a, rows_b, width, dense in ((20, 20, 256, 0.3), (256, 100, 200, 0.02), (1, 256, 7, 0.5), (3, 3, 256, 0.0), (17, 33, 1, 1.0)):
        sides = []
        for n in (rows_a, rows_b):
            cells = np.where(rng.random((n, width)) < dense, rng.integers(1, 10**6, (n, width)), 0)
            zero = rng.integers(1, 99, n)
            sides.append((divergence.QuadTree(*np.nonzero(cells), cells[np.nonzero(cells)]), zero, np.where(cells > 0, cells, zero[:, None])))
        (a, zero_a, whole_a), (b, zero_b, whole_b) = sides
        got = divergence.joint_distances(a, b, zero_a, zero_b, width)
        assert np.array_equal(got, np.abs(whole_a[:, None] - whole_b[None]).sum(axis=2))


def test_shares_are_exact_for_large_counts(spark):
    cases = [(0, 5), (7, 10**15), (10**15, 10**15 + 17), (8 * 10**15, 9 * 10**15)]
    expected = [1 + 10**9 * (n + 5) // w for n, w in cases]
    assert divergence.shares(np.array([c[0] for c in cases]), np.array([c[1] for c in cases])).tolist() == expected
    df = spark.createDataFrame(cases, "n long, w long")
    assert [r[0] for r in df.select(divergence.share_column(df.n, df.w)).collect()] == expected
