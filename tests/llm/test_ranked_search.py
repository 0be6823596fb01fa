"""Ranked search against scores of every document in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from eventmart.llm import bestposition
from tests.llm import tables

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs, items, k=20):
    """docs, items: (id, text)."""
    bags = [(d, TERM.findall(tables.lower(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        scored = []
        for d, bag in bags:
            m = 75 + 25 * len(bag) * n_docs // n_terms if n_terms else 0
            tf = Counter(bag)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in TERM.findall(tables.lower(text)) if tf[t]
            )
            if score > 0:
                scored.append((-score, math.inf if d is None else d, d))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return out


def check(spark, docs, items, k=20):
    table = tables.docs(spark, [(d, t, *[None] * 5) for d, t in docs])
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    found = [(r.item_id, r["rank"], r.doc_id, r.score) for r in bestposition.rank_documents(table, asked, k).collect()]
    expected = brute(docs, items, k)
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    return expected


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)] + ["été", "Ñandú", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(80))) for _ in range(n)]
    texts[50:90] = [texts[7]] * 40
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 30)))) for i in range(12)]
    return list(enumerate(texts)), items


def test_equals_scoring_every_document(spark):
    docs, items = corpus()
    assert check(spark, docs, items + [(90, docs[7][1]), (91, "w1 w1 w1"), (92, "unheard of"), (93, "w1-w2_W3")])


def test_small_shards_and_blocks(spark, monkeypatch):
    docs, items = corpus(2)
    monkeypatch.setattr(bestposition, "SHARD_COUNTS", 50)
    monkeypatch.setattr(bestposition, "ITEM_BYTES", 300)
    monkeypatch.setattr(bestposition, "DEPTH", 1)
    check(spark, docs, items, k=3)


def test_awkward_rows(spark):
    docs = [(r[0], r[1]) for r in tables.doc_rows()] + [(None, "solo eins"), (3, "solo"), (3, "solo"), (None, "solo eins")]
    items = [(1, "Solo eins"), (2, None), (3, ""), (4, "!?"), (None, "zwei né"), (6, "x" * 400)]
    check(spark, docs, items)
    assert bestposition.rank_documents(spark.createDataFrame([], tables.COLUMNS), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert bestposition.rank_documents(tables.docs(spark), nothing).count() == 0


def test_of_repeated_items_the_greatest_text_counts(spark):
    docs = [(1, "alpha"), (2, "beta"), (3, "alpha beta")]
    table = tables.docs(spark, [(d, t, *[None] * 5) for d, t in docs])
    asked = spark.createDataFrame([(1, "alpha"), (1, "beta"), (1, "beta")], "item_id long, text string")
    found = [(r.item_id, r["rank"], r.doc_id, r.score) for r in bestposition.rank_documents(table, asked).collect()]
    assert sorted(found) == sorted(brute(docs, [(1, "beta")]))


def test_best_positions_stop_before_the_lists_end():
    rng = np.random.default_rng(2)
    n, terms = 20_000, 4
    impact = (rng.pareto(1.2, n * terms) * 1000 + 1).astype(np.int64)
    shard = bestposition.Shard(np.full(n, terms), np.tile(np.arange(terms), n), impact, terms)
    docs, scores, read = shard.best(np.arange(terms), np.array([1, 2, 1, 1]), np.arange(n), 10)
    whole = impact.reshape(n, terms) @ [1, 2, 1, 1]
    expected = np.lexsort((np.arange(n), -whole))[:10]
    assert docs.tolist() == expected.tolist() and scores.tolist() == whole[expected].tolist()
    assert read < n * terms / 10
    assert not shard.seen.any() and not shard.met.any() and not shard.repeats.any()
