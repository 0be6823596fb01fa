"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersections.

A text's set holds the hashes of its 5-word shingles. Two texts are linked if
their sets' Jaccard similarity is 0.75 or more. Links are found exactly:

1. One pass gives each text its set's size and digest, and counts shingles in
   a table of fixed size. That table orders all shingles, rare ones first.
2. Linked sets share one of the first few shingles of that order (a quarter of
   the set and one more). Each set is listed under those. Sorted by size, the
   sets under a shingle fall into bands whose neighbours' sizes may be linked;
   sets alone in their band are dropped. A band is named after its least member.
3. The members of a band meet in tiles, first as parity bitmaps of their sets,
   a few bytes each: bit counts bound every overlap from above, and members
   that can be linked with no other are dropped.
4. The texts of the rest meet in tiles. Pairs that pass the bound are
   intersected exactly unless they are already connected. A tile returns a
   spanning tree of its links.

Large bands are cut into blocks, and every two blocks are a tile, so no task
holds more than two blocks. Equal sets are one member from the start. Sets are
told apart by 64-bit digests, and shingles by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.graph import components
from eventmart.llm.storage import materialize, unused
from eventmart.llm.textbytes import Words, blocks, mix, text_bytes

SHINGLE = 5
#: Links: NUMERATOR / DENOMINATOR of the union at least.
NUMERATOR, DENOMINATOR = 3, 4
#: Size of the table of shingle counts (log 2), pieces it travels in, members of a block of a band, bits of the tiles' bitmaps.
COUNTS_LOG2, PIECES = 18, 16
BLOCK = 512
LEAST_BITS, MOST_BITS = 256, 1 << 15

_SHIFT = np.uint64(64 - COUNTS_LOG2)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, end to end, and where each text's begin (one more at the end)."""
    words = Words(*text_bytes(column))
    h, text = words.shingles(SHINGLE)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.searchsorted(text[new], np.arange(len(column) + 1))


def digests(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set; 0 for an empty one."""
    n = np.diff(first).astype(np.uint64)
    one, two = (np.concatenate(([np.uint64(0)], np.cumsum(v, dtype=np.uint64))) for v in (mix(values), mix(values ^ np.uint64(0x5DEECE66D))))
    both = mix(one[first[1:]] - one[first[:-1]]) ^ (two[first[1:]] - two[first[:-1]])
    return np.where(n > 0, mix(both + n), np.uint64(0)).view(np.int64)


def listed(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles each set is listed under, and the set of each."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((values, counts[(values >> _SHIFT).astype(np.int64)], owner))
    place = np.arange(len(values)) - np.repeat(first[:-1], n)
    most = n - (-(-NUMERATOR * n // DENOMINATOR)) + 1
    keep = place < most[owner]
    return values[order][keep], owner[keep]


def bitmaps(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Parity bitmaps: bit j is the parity of the shingles whose hash is j modulo the width, a power of 2 of twice the set at least."""
    n = np.diff(first)
    width = np.clip(2 ** np.ceil(np.log2(np.maximum(2 * n, 1))), LEAST_BITS, MOST_BITS).astype(np.int64)
    begin = np.cumsum(width) - width
    bit = np.repeat(begin, n) + (values & np.repeat(width - 1, n).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(bit, minlength=int(width.sum())) & 1).astype(np.uint8)).tobytes()
    return [packed[b // 8 : (b + w) // 8] for b, w in zip(begin.tolist(), width.tolist())]


def _folded(maps: list[bytes]) -> np.ndarray:
    """The bitmaps as rows of 64-bit words, all folded to the least width among them."""
    width = min(map(len, maps))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(m, np.uint64).reshape(-1, width // 8), axis=0) for m in maps])


def _possible(n: np.ndarray, bitmap: np.ndarray, side: np.ndarray, i: int, top: int, one: bool) -> np.ndarray:
    """Rows after ``i`` that may be linked with it, the nearest first; rows come by size, and those up to ``top`` have a size for it."""
    other = np.arange(i + 1, top)
    if not one:
        other = other[side[other] != side[i]]
    apart = np.bitwise_count(bitmap[other] ^ bitmap[i]).sum(axis=1, dtype=np.int64)
    both = n[i] + n[other]
    # overlap <= (both - apart) / 2, and a link needs overlap >= NUMERATOR / (NUMERATOR + DENOMINATOR) * both
    may = np.flatnonzero((NUMERATOR + DENOMINATOR) * (both - apart) >= 2 * NUMERATOR * both)
    return other[may[np.argsort(apart[may], kind="stable")]]


def _describe(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n_shingles, digest and bitmap of every row; and the table of shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTS_LOG2, np.int64)
        for batch in blocks(batches, "text"):
            values, first = shingle_sets(batch.column("text"))
            counts += np.bincount((values >> _SHIFT).astype(np.int64), minlength=len(counts))
            n = batch.num_rows
            columns = [batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(digests(values, first))]
            columns += [pa.array(bitmaps(values, first), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        pieces = [p.astype("<u4").tobytes() for p in np.split(np.minimum(counts, 2**32 - 1), PIECES)]
        empty = pa.nulls(PIECES, pa.int64())
        columns = [empty, empty, empty, pa.nulls(PIECES, pa.binary()), pa.array(range(PIECES), pa.int32()), pa.array(pieces)]
        yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_shingles", "digest", "bitmap", "piece", "counts"]
    seen = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest long, bitmap binary, piece int, counts binary"
    )
    seen = materialize(seen, "jaccard-sets")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(counts.as_buffer(), "<u4")
                total[piece] = total.get(piece, np.zeros(len(part), np.int64)) + part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["piece", "total"])

    summed = seen.where("piece is not null").select("piece", "counts").repartition(PIECES, "piece").mapInArrow(add, "piece int, total binary")
    counts = np.zeros((PIECES, (1 << COUNTS_LOG2) // PIECES), np.int64)
    for piece, total in summed.collect():
        counts[piece] = np.frombuffer(total, np.int64)
    return seen.where("piece is null").select("doc_id", "n_shingles", "digest", "bitmap"), counts.ravel()


def _bands(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """band (digest of its least member) and digest of the members of all bands of two or more."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            values, first = shingle_sets(batch.column("text"))
            digest, n = digests(values, first), np.diff(first)
            shingle, owner = listed(values, first, shared.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingle.view(np.int64)), pa.array(n[owner].astype(np.int32)), pa.array(digest[owner])], ["shingle", "n", "digest"]
            )

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by shingle, size and digest; ``last`` is the row before, with its band and whether that was named
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            shingle, n, digest = (batch.column(i).to_numpy() for i in range(3))
            n = n.astype(np.int64)
            if last is not None:
                shingle, n, digest = np.r_[last[0], shingle], np.r_[last[1], n], np.r_[last[2], digest]
            linked = np.zeros(len(n), bool)
            linked[1:] = (shingle[1:] == shingle[:-1]) & (DENOMINATOR * n[:-1] >= NUMERATOR * n[1:])
            start = np.flatnonzero(~linked)
            of = np.cumsum(~linked) - 1
            name = digest[start]
            if last is not None:
                name[0] = last[3]
            several = np.zeros(len(start), bool)
            several[of[np.flatnonzero(digest != name[of])]] = True
            if last is not None:
                several[0] |= last[4]
            out = several[of]
            if last is not None:
                out[0] = several[0] and not last[4]
            pairs = np.unique(np.stack([name[of][out], digest[out]]), axis=1)
            if last is not None and several[0] and not last[4]:
                pairs = np.unique(np.concatenate([pairs, [[last[3]], [last[3]]]], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["band", "digest"])
            last = (shingle[-1:], n[-1:], digest[-1:], name[of[-1]], bool(several[of[-1]]))

    posted = docs.select("text").mapInArrow(post, "shingle long, n int, digest long")
    return posted.repartition(F.col("shingle")).sortWithinPartitions("shingle", "n", "digest").mapInArrow(band, "band long, digest long").distinct()


def _tile(ids: np.ndarray, values: np.ndarray, first: np.ndarray, side: np.ndarray) -> tuple[list[int], list[int]]:
    """Spanning stars (least id, other id) of the links between texts of different sides, or of all if there is one side."""
    order = np.lexsort((ids, np.diff(first)))
    ids, n, side = ids[order], np.diff(first)[order], side[order]
    maps = bitmaps(values, first)
    bitmap = _folded([maps[i] for i in order])
    sets = [values[first[i] : first[i + 1]] for i in order]
    root, one = np.arange(len(n)), bool(side.min() == side.max())
    top = np.searchsorted(n, DENOMINATOR * n // NUMERATOR, "right")
    for i in range(len(n)):
        if (root[i + 1 : top[i]] == root[i]).all():
            continue
        for j in _possible(n, bitmap, side, i, top[i], one).tolist():
            if root[i] == root[j]:
                continue
            a, b = sets[i], sets[j]
            common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common):
                low, high = min(root[i], root[j]), max(root[i], root[j])
                root[root == high] = low
    left, right = [], []
    for r in np.unique(root):
        members = np.sort(ids[root == r])
        left += [int(members[0])] * (len(members) - 1)
        right += members[1:].tolist()
    return left, right


def _tiles(members: DataFrame, *columns: str) -> DataFrame:
    """Members (band, doc_id, ...) dealt to tiles (band, low, high): every two blocks of a band meet in one. ``_block``: a row's own."""
    size = members.groupBy("band").agg(F.count("*").alias("_size"))
    dealt = members.join(size, "band").where("_size > 1").withColumn("_blocks", F.ceil(F.col("_size") / BLOCK).cast("int"))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("_blocks")).cast("int"))
    dealt = dealt.select("band", "doc_id", *columns, "_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_with"))
    return dealt.select("band", F.least("_block", "_with").alias("low"), F.greatest("_block", "_with").alias("high"), "_block", "doc_id", *columns)


def _may_be_linked(members: DataFrame) -> DataFrame:
    """band and doc_id of the members (band, doc_id, n_shingles, bitmap) whose bitmaps allow a link within the band."""

    def bound(table: pa.Table) -> pa.Table:
        n = table.column("n_shingles").to_numpy()
        order = np.argsort(n, kind="stable")
        n, side = n[order], table.column("_block").to_numpy()[order]
        maps = table.column("bitmap").to_pylist()
        bitmap, one = _folded([maps[i] for i in order]), bool(side.min() == side.max())
        top, able = np.searchsorted(n, DENOMINATOR * n // NUMERATOR, "right"), np.zeros(len(n), bool)
        for i in range(len(n)):
            if top[i] > i + 1:
                found = _possible(n, bitmap, side, i, top[i], one)
                able[found] = True
                able[i] |= len(found) > 0
        keep = pa.array(order[able])
        return pa.table({"band": table.column("band").take(keep), "doc_id": table.column("doc_id").take(keep)})

    tiles = _tiles(members, "n_shingles", "bitmap")
    return tiles.groupBy("band", "low", "high").applyInArrow(bound, "band long, doc_id long").distinct()


def _links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """a, b: links enough to connect what is linked. ``members``: band, doc_id."""

    def join(table: pa.Table) -> pa.Table:
        values, first = shingle_sets(table.column("text").combine_chunks())
        left, right = _tile(table.column("doc_id").to_numpy(), values, first, table.column("_block").to_numpy())
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # members grow with the documents, so they are never broadcast: the plan is the same at every size
    return texts.join(_tiles(members).hint("merge"), "doc_id").groupBy("band", "low", "high").applyInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of linked rows of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the least doc_id reachable by links, itself included. Texts
    of fewer than five words have one shingle, their whole sequence of words. A
    null or wordless text has none and is linked with nothing. A row without a
    doc_id has no component. Repeated rows are repeated in the result, in one
    class; texts that differ must not share a doc_id. An empty table gives an
    empty result; other columns are not looked at.
    """
    described, counts = _describe(docs)
    heads = described.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap")
    )
    bands = _bands(docs.where("doc_id is not null"), counts)
    members = bands.join(heads, "digest").select("band", F.col("head").alias("doc_id"), "n_shingles", "bitmap")
    members = materialize(members, "jaccard-bands")
    able = materialize(_may_be_linked(members), "jaccard-able")
    linked = components(_links(docs, able))
    classes = heads.join(linked, heads["head"] == linked["node"], "left").select("digest", F.coalesce("component", "head").alias("_class"))
    joined = described.join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_class"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, of the least doc_id, with its columns. Of rows that repeat that doc_id one stays. Rows without a doc_id stay."""
    key = unused("_id", docs)
    heads = near_duplicates(docs).where("component_id = doc_id").select(F.col("doc_id").alias(key)).distinct()
    kept = docs.join(heads, F.col("doc_id").cast("long") == F.col(key)).dropDuplicates([key]).drop(key)
    return kept.unionByName(docs.where("doc_id is null"))
