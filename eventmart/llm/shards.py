"""Token ids in shard files with a minimal perfect hash index.

A shard is one row of a Parquet table (so it can lie in any store Spark
writes to): a raw little-endian id payload of documents in ascending doc_id
order, the ends of the documents in it, and an index from doc_id to document.
The index is a minimal perfect hash: keys fall into small buckets, and each
bucket stores the first pilot number that sends its keys to free slots. A
slot holds a fingerprint of its key, and where the key's documents are. A
lookup computes one slot and compares one fingerprint.

Equal keys are neighbours; a key's run may continue in the next shard. Null
keys come first and are counted apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.subwords import encode_texts
from eventmart.llm.textbytes import blocks, mix

#: Ids after which a shard is closed.
SHARD_IDS = 1 << 18
_PER_BUCKET = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "part int, shard int, first_key long, last_key long, n_docs long, n_ids long, start_in_part long, n_null long, "
    "width int, pilots binary, fingerprints binary, slot_first binary, slot_rows binary, ends binary, keys binary, payload binary"
)


def _hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + _STEP)


def _slots(hashes: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes ^ mix(pilots.astype(np.uint64) + np.uint64(1))) % np.uint64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots and, by slot, the index of its key, for distinct int64 keys."""
    n = len(keys)
    pilots, slots = np.zeros(max(1, -(-n // _PER_BUCKET)), np.uint32), np.full(n, -1, np.int64)
    if not n:
        return pilots, slots
    hashes = _hash(keys)
    bucket = (hashes >> np.uint64(32)) % np.uint64(len(pilots))
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket.astype(np.int64), minlength=len(pilots))
    begin = np.cumsum(size) - size
    for b in np.argsort(-size, kind="stable"):
        if not size[b]:
            break
        members = order[begin[b] : begin[b] + size[b]]
        base, found = 0, -1
        while found < 0:
            trial = np.arange(base, base + 256)
            at = _slots(hashes[members][None, :], trial[:, None], n)
            good = (slots[at] < 0).all(axis=1)
            if size[b] > 1:
                inside = np.sort(at, axis=1)
                good &= (inside[:, 1:] != inside[:, :-1]).all(axis=1)
            if good.any():
                found = int(good.argmax())
                slots[at[found]], pilots[b] = members, base + found
            base += 256
    return pilots, slots


def find(keys: np.ndarray, pilots: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    """Slots of keys, -1 where the stored fingerprint is another's."""
    if not len(fingerprints) or not len(keys):
        return np.full(len(keys), -1, np.int64)
    hashes = _hash(keys)
    bucket = (hashes >> np.uint64(32)) % np.uint64(len(pilots))
    slot = _slots(hashes, pilots[bucket.astype(np.int64)], len(fingerprints))
    return np.where(fingerprints[slot] == hashes.astype(np.uint32), slot, -1)


def _shard(part: int, shard: int, start: int, keys: list, ids: list[np.ndarray]) -> dict:
    n_null = sum(k is None for k in keys)
    known = np.array(keys[n_null:], np.int64)
    distinct, first, rows = np.unique(known, return_index=True, return_counts=True)
    pilots, slots = build_index(distinct)
    payload = np.concatenate(ids)
    width = 2 if not len(payload) or payload.max() < 1 << 16 else 4
    return {
        "part": part, "shard": shard, "first_key": keys[0], "last_key": keys[-1], "n_docs": len(keys),
        "n_ids": len(payload), "start_in_part": start, "n_null": n_null, "width": width,
        "pilots": pilots.astype("<u4").tobytes(), "fingerprints": _hash(distinct).astype("<u4")[slots].tobytes(),
        "slot_first": (first[slots] + n_null).astype("<u4").tobytes(), "slot_rows": rows[slots].astype("<u4").tobytes(),
        "ends": np.cumsum([len(x) for x in ids]).astype("<u8").tobytes(), "keys": known.astype("<i8").tobytes(),
        "payload": payload.astype(f"<u{width}").tobytes(),
    }


_ARROW = pa.schema(
    [(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in SCHEMA.split(", ")]
)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_ids: int = SHARD_IDS) -> None:
    """Encodes every row of ``docs`` (doc_id, text) and writes the shards under ``path``.

    Rows are dealt out by ranges of doc_id, rows of one doc_id further by their
    text, so neither a repeated nor a null key fills one task. Null texts are
    empty: their payload is the end id alone. An empty table gives no shard.
    Other columns are not looked at.
    """
    dealt = docs.select("doc_id", "text").withColumn("_tie", F.xxhash64("text"))
    dealt = dealt.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie")
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie").select(F.col("doc_id").cast("long"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, start, keys, ids, held = TaskContext.get().partitionId(), 0, 0, [], [], 0
        for block in blocks(batches, "text"):
            flat, n = encode_texts(block.column("text"), tokenizer, end_id)
            for key, x in zip(block.column("doc_id").to_pylist(), np.split(flat, np.cumsum(n)[:-1])):
                if held + len(x) > shard_ids and keys:
                    yield pa.RecordBatch.from_pylist([_shard(part, shard, start, keys, ids)], _ARROW)
                    shard, start, keys, ids, held = shard + 1, start + held, [], [], 0
                keys.append(key)
                ids.append(x)
                held += len(x)
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, shard, start, keys, ids)], _ARROW)

    dealt.mapInArrow(encode, SCHEMA).write.parquet(path)


def part_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """Ids before each range of keys. There are as many ranges as the writing job had tasks."""
    totals = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for part, n in totals:
        starts[part], total = total, total + n
    return starts


def _documents(row: dict, keys: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(key, ids before it in the shard, ids) of each document of the keys, by the shard's index."""
    u4 = lambda name: np.frombuffer(row[name], "<u4")
    payload, ends = np.frombuffer(row["payload"], f"<u{row['width']}"), np.frombuffer(row["ends"], "<u8").astype(np.int64)
    slots = find(keys, u4("pilots"), u4("fingerprints"))
    first, rows = u4("slot_first"), u4("slot_rows")
    for key, slot in zip(keys.tolist(), slots.tolist()):
        for d in range(first[slot], first[slot] + rows[slot]) if slot >= 0 else ():
            begin = int(ends[d - 1]) if d else 0
            yield key, begin, payload[begin : ends[d]]


def _nulls(row: dict) -> Iterator[tuple[None, int, np.ndarray]]:
    payload, ends = np.frombuffer(row["payload"], f"<u{row['width']}"), np.frombuffer(row["ends"], "<u8").astype(np.int64)
    for d in range(row["n_null"]):
        begin = int(ends[d - 1]) if d else 0
        yield None, begin, payload[begin : ends[d]]


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, looked up in the shards by its key."""
    starts = part_starts(spark, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                base = starts[row["part"]] + row["start_in_part"]
                keys = np.unique(np.frombuffer(row["keys"], "<i8"))
                found = [
                    (key, base + begin, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for source in (_nulls(row), _documents(row, keys))
                    for key, begin, ids in source
                ]
                key, start, n, crc = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (key, start, n, crc)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, path: str, keys: Iterable[int]) -> DataFrame:
    """doc_id and ids of the documents with the given keys. Only shards whose key range holds one are read.

    A key that was never written passes a fingerprint by chance once in 2^32
    times; the stored keys then decide.
    """
    wanted = np.unique(np.array(list(keys), np.int64))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                held = wanted[np.isin(wanted, np.frombuffer(row["keys"], "<i8"))]
                found = [(key, ids.tolist()) for key, _, ids in _documents(row, held)]
                if found:
                    key, ids = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    shards = spark.read.schema(SCHEMA).parquet(path)
    if len(wanted):
        shards = shards.where((F.col("last_key") >= int(wanted[0])) & (F.coalesce("first_key", "last_key") <= int(wanted[-1])))
    else:
        shards = shards.where("false")
    return shards.mapInArrow(fetch, "doc_id long, ids array<long>")
