"""Mixing, top-k, token shards and the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventmart.llm import mixing, shards, subwords, topk
from eventmart.llm.queries import QUERIES, word_tokenizer
from tests.conftest import SMALL
from tests.llm import tables
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(spark, name):
    run, sql = QUERIES[name]
    assert differences(run(spark, SMALL), connect(SMALL), sql) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def _plain_targets(sizes, weights, share, epochs):
    left, target, open_ = share * sum(sizes), {}, set(range(len(sizes)))
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if epochs * sizes[i] <= level * weights[i]}
        if not over:
            return {**target, **{i: level * weights[i] for i in open_}}
        for i in over:
            target[i] = float(epochs * sizes[i])
            left -= epochs * sizes[i]
        open_ -= over
    return target


def test_targets_equal_plain_water_filling(spark):
    rng = random.Random(6)
    for n in (1, 2, 5, 12):
        sizes = [rng.choice([0, 3, 50, 900, 4000]) for _ in range(n)]
        sources = mixing.cycled_weights(spark.createDataFrame([(f"s{i:02d}", z) for i, z in enumerate(sizes)], "source string, source_size long"), (5, 2, 1))
        got = {r.source: r.target for r in mixing.targets(sources, 1.5, 2).collect()}
        want = _plain_targets(sizes, [(5, 2, 1)[i % 3] for i in range(n)], 1.5, 2)
        assert {k: pytest.approx(v) for k, v in got.items()} == {f"s{i:02d}": v for i, v in want.items()}


def test_mix_meets_its_targets(spark):
    rows = tables.doc_rows()
    got = mixing.mix_sources(tables.docs(spark, rows)).collect()
    assert sorted(tuple(r) for r in got if r.source) == sorted(tuple(r) for r in mixing.mix_sources(tables.docs(spark, rows, 5)).collect() if r.source)
    assert len(got) == len(rows)
    for source in {r.source for r in got}:
        part = [r for r in got if r.source == source]
        assert {r.source_size for r in part} == {sum(len(tables.words(x[1])) for x in rows if x[3] == source)}
        assert abs(sum(r.taken for r in part) - part[0].target) <= max(r.size for r in part)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    mixed = mixing.repeat_rows(tables.docs(spark, rows), mixing.mix_sources(tables.docs(spark, rows)))
    assert mixed.columns == tables.docs(spark, rows).columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in got for _ in range(r.repeats))
    assert mixing.mix_sources(tables.docs(spark, [])).count() == 0


def test_top_k_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4], 0) for i in range(130)]
    rows += [(200 + i, rows[7][1], 0) for i in range(30)] + [(300, None, 0), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (500, [float("nan")] * 6, 0), (None, [1.0] * 6, 0)]
    rows += [rows[5], (600, [2.0, 1.0], 0), (700, [float("inf")] * 6, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    vectors = {i: [int(np.floor(1024 * x)) for x in v] for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in vectors if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    for lists in (1, 2, 3):
        assert sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 100 == 0, lists=lists).collect()) == sorted(want)
    few = topk.top_k(table.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [r.rank for r in sorted(few)] == [1, 2]
    assert topk.top_k(table.limit(0), F.col("vec_id") == 0).count() == 0
    alone = topk.top_k(table.where("vec_id = 0"), F.col("vec_id") == 0)
    assert alone.count() == 0


def _encode(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer()).encode(text or "", add_special_tokens=False).ids


def test_ids_word_by_word_equal_whole_texts():
    texts = ["It's 3rd-rate, don't! <|endoftext|> a<|startoftext|>b", "Straße ÄÖÜ ñandú x İstanbul ΑΣ", "日本語 текст été", "²½ ªµ x\x1cy \x7f", "a" * 700]
    texts += [None, "", " \n"] + [r[1] for r in tables.doc_rows()[:20]]
    flat, n = subwords.encode_texts(pa.array(texts), word_tokenizer(), 1)
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [_encode(t) + [1] for t in texts]


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 9, 1000):
        keys = np.unique(rng.integers(-(2**62), 2**62, n))
        pilots, slots = shards.build_index(keys)
        assert sorted(slots.tolist()) == list(range(len(keys)))
        prints = shards._hash(keys).astype("<u4")[slots] if n else np.zeros(0, np.uint32)
        assert (keys[slots[shards.find(keys, pilots, prints)]] == keys).all()
        assert (shards.find(np.arange(50), pilots, prints) < 0).all()


def test_shards_round_trip(spark, tmp_path):
    rest = [None] * 5
    rows = tables.doc_rows() + [(None, "no key", *rest), (5, "again", *rest), (-7, "below", *rest)]
    path = f"file://{tmp_path}/shards"
    shards.write_shards(tables.docs(spark, rows), path, word_tokenizer(), 1, shard_ids=500)
    got = sorted(shards.read_digests(spark, path).collect(), key=lambda r: r.start)
    key = lambda i: (i is not None, i or 0)
    assert [key(r.doc_id) for r in got] == sorted(key(r[0]) for r in rows)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    want = sorted((r[0] is not None, r[0] or 0, len(ids := _encode(r[1]) + [1]), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in rows)
    assert sorted((*key(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    asked = shards.lookup(spark, path, [3, 5, -7, 123456]).collect()
    assert sorted((r.doc_id, r.ids) for r in asked) == sorted((r[0], _encode(r[1]) + [1]) for r in rows if r[0] in (3, 5, -7))
    shards.write_shards(tables.docs(spark, []), f"{path}-none", word_tokenizer(), 1)
    assert shards.read_digests(spark, f"{path}-none").count() == 0


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, counts = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == names
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > 0
    final = corpus_pipeline.write_tokens(spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in final) == sorted(r.doc_id for r in docs.collect())
