"""Near duplicates, repeated strings, decontamination: against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import decontaminate, graph, jaccard, substrings
from tests.llm import tables


def _components(edges, nodes):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    rng.shuffle(edges)
    want = _components(edges, {x for e in edges for x in e})
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _shingles(text):
    w = tables.words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_jaccard_classes_equal_brute_force(spark):
    rows = tables.doc_rows()
    sets = {r[0]: _shingles(r[1]) for r in rows}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = _components(edges, sets)
    got = jaccard.near_duplicates(tables.docs(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(edges) > 20
    kept = jaccard.one_of_each(tables.docs(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({want[i] for i in sets})
    assert kept.columns == tables.docs(spark, rows).columns


def test_jaccard_awkward_rows(spark):
    rows = [(None, "a b c d e f", *[None] * 5), (5, "a b c d e f", *[None] * 5), (5, "a b c d e f", *[None] * 5), (6, "A B c d e F", *[None] * 5)]
    got = sorted(jaccard.near_duplicates(tables.docs(spark, rows)).collect(), key=repr)
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got] == [(5, 2, 5), (5, 2, 5), (6, 2, 5), (None, 2, None)]
    assert jaccard.near_duplicates(tables.docs(spark, [])).count() == 0


def test_large_bands_meet_in_blocks():
    rng = random.Random(5)
    base = tables.random_text(rng, 60).split()
    texts = []
    for _ in range(80):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = str(rng.randrange(999))
        texts.append(" ".join(w))
    values, first = jaccard.shingle_sets(pa.array(texts))
    ids = np.arange(80)
    sides = ids % 3
    edges = []
    for low in range(3):
        for high in range(low, 3):
            pick = np.flatnonzero((sides == low) | (sides == high))
            v, f = jaccard.shingle_sets(pa.array([texts[i] for i in pick]))
            edges += list(zip(*jaccard._tile(ids[pick], v, f, sides[pick])))
    whole = list(zip(*jaccard._tile(ids, values, first, np.zeros(80, int))))
    assert _components(edges, range(80)) == _components(whole, range(80))


def _cut(rows, length=50):
    seen, out = {}, {}
    for i, text in sorted((r[0], r[1]) for r in rows):
        raw = (text or "").encode()
        marks, new = bytearray(len(raw)), []
        for k in range(len(raw) - length + 1):
            s = raw[k : k + length]
            if seen.get(s, i) < i:
                marks[k : k + length] = b"\1" * length
            new.append(s)
        for s in new:
            seen.setdefault(s, i)
        left = bytes(c for c, m in zip(raw, marks) if not m)
        spans = sum(1 for k in range(len(raw)) if marks[k] and (k == 0 or not marks[k - 1]))
        out[i] = (len(raw), sum(marks), spans, hashlib.sha256(left).hexdigest(), left)
    return out


def test_repeated_strings_equal_brute_force(spark):
    rows = tables.doc_rows()
    got = substrings.deduplicate(tables.docs(spark, rows)).collect()
    assert {r[0]: (*r[1:5], bytes(r[5])) for r in got} == _cut(rows)
    assert sum(r.n_removed > 0 for r in got) > 15


def test_repeated_strings_awkward_rows(spark):
    text = "abcdefghij" * 6 + "z"
    rest = [None] * 5
    rows = [(None, text, *rest), (3, text, *rest), (3, text, *rest), (4, text, *rest), (5, text[:49], *rest)]
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in substrings.deduplicate(tables.docs(spark, rows)).collect()}
    assert got == {None: (61, 0), 3: (61, 0), 4: (61, 61), 5: (49, 0)}
    assert substrings.deduplicate(tables.docs(spark, [])).count() == 0


def test_strings_of_hot_anchors_equal_brute_force(spark, monkeypatch):
    """A short line in very many documents, with other text around it; no task may get all of its bucket."""
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    monkeypatch.setattr(substrings, "HOT", 8)
    rng = random.Random(11)
    line = "all rights reserved by the owners of it"
    near = [tables.random_text(rng, 6) for _ in range(4)]
    rest = [None] * 5
    rows = tables.doc_rows() + [(200 + i, f"{rng.choice(near)} {line} {rng.choice(near)} {i}", *rest) for i in range(60)]
    docs = tables.docs(spark, rows)
    got = substrings.deduplicate(docs).collect()
    assert {r[0]: (*r[1:5], bytes(r[5])) for r in got} == _cut(rows)
    texts = docs.where("doc_id is not null and octet_length(text) >= 50").select("doc_id", "text")
    hot = substrings._hot(texts)
    largest = substrings._repeated(texts, hot).where("salt < 0").groupBy("anchor").count().agg({"count": "max"}).first()[0]
    assert len(hot) > 0 and largest < 8


def test_buckets_may_be_cut_anywhere():
    """A bucket's rows give the same intervals in one batch and one by one."""
    rng = random.Random(2)
    common = tables.random_text(rng, 40)
    texts = [tables.random_text(rng, 5) + " " + common[rng.randrange(20) :] for _ in range(12)]
    data, offsets = substrings.text_bytes(pa.array(texts))
    place, ids, text, lo, hi = substrings.anchors(data, offsets)
    order = np.lexsort((text, ids))
    place, ids, text, lo, hi = (x[order] for x in (place, ids, text, lo, hi))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids.view(np.int64)), pa.array(text), pa.array(text), pa.array(place - offsets[text]), pa.array((place - lo).astype(np.int32)),
         pa.array((hi - lo + 1).astype(np.int32)), pa.array([data[a : b + 50].tobytes() for a, b in zip(lo, hi)], pa.binary())],
        ["anchor", "doc_id", "version", "place", "before", "strings", "bytes"],
    )

    def covered(sizes):
        state, found, at = substrings._Bucket(), set(), 0
        for size in sizes:
            for d, _, start, end in zip(*(c.to_pylist() for c in substrings._refine(batch.slice(at, size), state).columns)):
                found.update((d, k) for k in range(start, end))
            at += size
        return found

    n = batch.num_rows
    whole = covered([n])
    assert whole and covered([1] * n) == whole and covered([7] * (n // 7) + [n % 7]) == whole
    want = {d: v for d, v in _cut([(i, t) for i, t in enumerate(texts)]).items()}
    assert {d: sum(1 for e, _ in whole if e == d) for d in want} == {d: v[1] for d, v in want.items()}


def test_decontamination_finds_whole_and_edited_copies(spark):
    rng = random.Random(9)
    items = [tables.random_text(rng, rng.randrange(15, 60), 4000) for _ in range(20)]
    edited = items[3].split()
    for k in range(4, len(edited), 6):
        edited[k] = "changed"
    del edited[2]
    noise = lambda n: tables.random_text(rng, n, 4000)
    rest = [None] * 5
    rows = [(0, noise(50) + " " + items[0].upper() + ". " + noise(30), *rest), (1, " ".join(edited) + " " + noise(20), *rest)]
    rows += [(2, noise(300), *rest), (3, None, *rest), (4, "", *rest), (None, items[5], *rest), (0, items[1] + " " + items[2], *rest)]
    rows += [(10 + i, f"{noise(5)} {items[7]} {noise(5)}", *rest) for i in range(30)]
    bench = [(i, t) for i, t in enumerate(items)] + [(20, None), (21, ""), (22, "two words"), (7, items[7])]
    found = decontaminate.contaminated(tables.docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = {(0, 0), (1, 3), (None, 5), (0, 1), (0, 2)} | {(10 + i, 7) for i in range(30)}
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
    assert all(r.score == 1.0 for r in found if (r.doc_id, r.item_id) != (1, 3))
    left = decontaminate.clean(tables.docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4] and left.columns == tables.docs(spark, rows).columns
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(tables.docs(spark, rows), empty).count() == 0
    assert decontaminate.contaminated(tables.docs(spark, []), spark.createDataFrame(bench, "item_id long, text string")).count() == 0


def test_edited_copies_of_a_hot_item_are_found(spark):
    """Copies that share one or two seeds, of an item that many documents hold."""
    item = [f"w{k}" for k in range(16)]
    two = [w if k not in (3, 7, 13) else "edited" for k, w in enumerate(item)]  # words 8 to 12 have two seeds
    one = [w if k not in (3, 7, 12) else "edited" for k, w in enumerate(item)]  # 8 to 11, and 13 to 15 have none
    last = [w if k in (0, 1, 2, 3) else "other" for k, w in enumerate(item)]  # a seed, but too little of the item
    rest = [None] * 5
    rows = [(i, f"before{i} {' '.join(item)} after{i}", *rest) for i in range(40)]
    rows += [(100, "x y " + " ".join(two) + " z", *rest), (101, "x y " + " ".join(one) + " z", *rest), (102, " ".join(last), *rest)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r.score for r in decontaminate.contaminated(tables.docs(spark, rows), bench).collect()}
    assert sorted(found) == [*range(40), 100, 101] and found[100] == found[101] == 23 / 32
    alone = decontaminate.contaminated(tables.docs(spark, [rows[40]]), bench).collect()
    assert [(r.doc_id, r.score) for r in alone] == [(100, 23 / 32)]


def test_alignment_equals_plain_dynamic_programming():
    rng = random.Random(4)
    a = [[rng.randrange(6) for _ in range(rng.randrange(1, 12))] for _ in range(60)]
    b = [[rng.randrange(6) for _ in range(rng.randrange(1, 25))] for _ in range(60)]

    def plain(x, y):
        best, above = 0, [0] * (len(y) + 1)
        for i in x:
            row = [0]
            for k, j in enumerate(y):
                step = decontaminate.MATCH if i == j else decontaminate.MISMATCH
                row.append(max(0, above[k] + step, above[k + 1] + decontaminate.GAP, row[k] + decontaminate.GAP))
            best, above = max(best, *row), row
        return best

    got, _ = decontaminate.align([np.array(x, np.uint64) for x in a], [np.array(y, np.uint64) for y in b])
    assert got.tolist() == [plain(x, y) for x, y in zip(a, b)]


def _bench(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_short_items_are_found_by_their_whole_sequence(spark):
    docs = tables.docs(spark, [(1, "x solo y", *[None] * 5), (2, "twin words here", *[None] * 5), (3, "words twin", *[None] * 5), (4, None, *[None] * 5)])
    found = decontaminate.contaminated(docs, _bench(spark, ["Solo!", "twin words", "", "...", "three words only"])).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in found) == [(1, 0, 1.0), (2, 1, 1.0)]


def test_recall_of_edited_copies_against_aligning_all_pairs(spark):
    """Items with words changed, left out or put in at random, and every fourth word changed; the same pairs as aligning every pair."""
    rng = random.Random(11)
    items = [tables.random_text(rng, rng.randrange(8, 40)) for _ in range(25)]
    rows = []
    for i in range(150):
        words = rng.choice(items).split()
        if i % 5 == 0:
            words = [("edit" + str(i) if k % 4 == 3 else w) for k, w in enumerate(words)]
        else:
            for _ in range(rng.randrange(0, len(words) // 2)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["new"], [words[at], "more"]]) if len(words) > 2 else words[at : at + 1]
        rows.append((i, " ".join([tables.random_text(rng, 30), *words, tables.random_text(rng, 20)]), *[None] * 5))
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(tables.docs(spark, rows), _bench(spark, items)).collect()}
    hashed = [[hash(w) & (2**63 - 1) for w in t.split()] for t in items]
    every = {}
    for doc_id, text, *_ in rows:
        target = np.array([hash(w) & (2**63 - 1) for w in text.split()], np.uint64)
        score, _ = decontaminate.align([np.array(h, np.uint64) for h in hashed], [target] * len(items))
        every |= {(doc_id, i): s / (2 * len(h)) for i, (s, h) in enumerate(zip(score.tolist(), hashed)) if s >= len(h)}
    assert len(every) > 120 and set(found) <= set(every)
    assert len(found) >= 0.95 * len(every)
    assert all(found[p] <= every[p] for p in found)
    fourth = [p for p in every if p[0] % 5 == 0]
    assert set(fourth) <= set(found)


def test_a_template_opening_in_all_items_and_many_times_in_a_text(spark):
    rng = random.Random(12)
    opening = "which of the following statements about it is"
    items = [f"{opening} {tables.random_text(rng, 15, 5000)}" for _ in range(2000)]
    text = pa.array([" ".join([opening] * 200), f"{opening} {items[3]} {opening}", "nothing of it", None])
    found = decontaminate._hits(decontaminate.Items(list(range(2000)), pa.array(items)), text, 0.5)
    assert [[h["item_id"] for h in hits] for hits in found] == [[], [3], [], []]


def test_annotate_refuses_a_column_that_is_there(spark):
    docs = tables.docs(spark).withColumnRenamed("_id", "Contamination")
    with pytest.raises(ValueError):
        decontaminate.annotate(docs, _bench(spark, ["a b c"]))
    named = tables.docs(spark).withColumnRenamed("_id", "_contamination")
    assert decontaminate.clean(named, _bench(spark, ["a b c"])).columns == named.columns


def test_one_of_each_keeps_one_of_equal_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, text, *[None] * 5)] * 3 + [(2, text, *[None] * 5), (None, text, *[None] * 5), (None, text, *[None] * 5), (3, None, *[None] * 5)]
    kept = [r.doc_id for r in jaccard.one_of_each(tables.docs(spark, rows)).collect()]
    assert sorted(kept, key=str) == [1, 3, None, None]
