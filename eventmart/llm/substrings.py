"""Removal of byte strings that occur in an earlier document, by refining buckets of positions.

A string of ``LENGTH`` bytes that starts in a document with a smaller doc_id is
removed wherever it occurs. Suffix-array style, positions are put into buckets
by their first bytes, and buckets are refined by the bucket identifiers of
later offsets until they stand for whole strings; a bucket with one document
left is dropped at once. Sorting all positions of a corpus is not needed:

1. Of the q-grams in each string one is its anchor: the one with the least
   hash, the last one of equals. Equal strings have equal anchors at equal
   places. Anchors (one position in 14 or so) are the initial buckets; those
   that only one document has are dropped.
2. For the rest, the bytes around the anchor travel to its bucket. There each
   string is refined: identifiers of q-grams are joined to identifiers of 2q
   bytes, those to identifiers of the string, each round reusing the last.
3. Buckets of anchors that occur very often would be too large for one task. A
   sample of the documents tells which anchors those are; it decides where a
   bucket is handled, not what is found. Their rows are spread in step 1. In
   step 2 whole windows (all strings of an anchor's place) are refined first:
   of equal ones an aggregate finds the least document, and later documents are
   covered whole. Only one row of each different window is cut into strings,
   each a key of its own, again with the least document by an aggregate.
4. Strings that an earlier document has are intervals of their document, which
   are merged and cut out of the text.

Identifiers are 64-bit hashes, those of step 3 128-bit ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.storage import materialize
from eventmart.llm.textbytes import blocks, mix, text_bytes

LENGTH, Q = 50, 24
#: Windows of a bucket task refined at once.
WINDOWS = 1 << 19
#: One document in SAMPLE is looked at for hot anchors: those that occur HOT times there. Their rows are dealt to SPREAD keys.
SAMPLE, HOT, SPREAD = 64, 64, 4096
#: Hot anchors sent to all tasks at most; with more text they must occur more often.
MOST_HOT = 1 << 22

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Identifiers of the q-grams at all positions that have one; Q is a multiple of 8."""
    x = data.astype(np.uint64)
    for shift in (1, 2, 4):
        x = x[:-shift] | x[shift:] << np.uint64(8 * shift)
    n = len(data) - Q + 1
    out = mix(x[:n] + _C2)
    for k in range(8, Q, 8):
        out = mix(out * _C1 ^ x[k : k + n])
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor positions, their identifiers and texts, and the first and last start of the strings each stands for."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.astype(np.uint64), none, none, none
    ids, wide = gram_ids(data), LENGTH - Q + 1
    key = ids & np.uint64(0xFFFFFFFF00000000) | (np.uint64(0xFFFFFFFF) - np.arange(len(ids), dtype=np.uint64))
    pad = -len(key) % wide
    rows = np.concatenate([key, np.full(pad, 0xFFFFFFFFFFFFFFFF, np.uint64)]).reshape(-1, wide)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(ids) - wide + 1
    least = np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n])
    size = np.diff(offsets)
    strings = np.maximum(size - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(size)), strings)
    start = np.arange(len(text)) - np.repeat(np.cumsum(strings) - strings, strings) + offsets[text]
    place = (np.uint64(0xFFFFFFFF) - (least[start] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    if not len(place):
        return none, none.astype(np.uint64), none, none, none
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    return place[first], ids[place[first]], text[first], start[first], start[last]


def _distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The different anchors of each text, and their texts."""
    _, ids, text, _, _ = anchors(*text_bytes(batch.column("text")))
    order = np.lexsort((ids, text))
    ids, text = ids[order], text[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (text[1:] != text[:-1])
    return ids[new], text[new]


def _hot(docs: DataFrame) -> np.ndarray:
    """Anchors that occur often in the sampled documents, in order; at most ``MOST_HOT``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            kinds, n = np.unique(anchors(*text_bytes(batch.column("text")))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], ["anchor", "n"])

    some = docs.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(SAMPLE)) == 0).select("text")
    # every anchor takes a byte at least, so no more than MOST_HOT can occur that often
    size = some.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    often = max(HOT, -(-size // MOST_HOT))
    found = some.mapInArrow(find, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= often)
    return np.sort(found.select("anchor").toArrow()["anchor"].to_numpy())


def _repeated(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """doc_id, anchor and salt of all anchors that more than one document has. Rows of ``hot`` anchors have a salt of 0 or more, others -1."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            ids, text = _distinct(batch)
            doc, anchor = batch.column("doc_id").to_numpy()[text], ids.view(np.int64)
            salt = np.where(np.isin(anchor, shared.value), (mix(doc.view(np.uint64)) % np.uint64(SPREAD)).astype(np.int64), -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(doc), pa.array(salt)], ["anchor", "doc_id", "salt"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by anchor and doc_id; ``last`` is the row before, and whether its bucket already has two documents.
        # A hot anchor's bucket is spread, and has them elsewhere
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, doc, salt = (batch.column(i).to_numpy() for i in range(3))
            if last is not None:
                anchor, doc, salt = np.r_[last[0], anchor], np.r_[last[1], doc], np.r_[last[3], salt]
            start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            size = np.diff(np.append(start, len(anchor)))
            end = start + size - 1
            several = (doc[end] != doc[start]) | (salt[start] >= 0)
            if last is not None:
                several[0] |= last[2]
            out = np.repeat(several, size)
            if last is not None:
                out[0] = several[0] and not last[2]  # else it was sent with its batch
            yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(anchor[out]), pa.array(salt[out])], ["doc_id", "anchor", "salt"])
            last = (anchor[-1:], doc[-1:], bool(several[-1]), salt[-1:])

    found = docs.mapInArrow(find, "anchor long, doc_id long, salt int")
    return found.repartition("anchor", "salt").sortWithinPartitions("anchor", "doc_id").mapInArrow(keep, "doc_id long, anchor long, salt int")


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class _Bucket:
    """Strings of a bucket that earlier batches had, and the first document of each."""

    def __init__(self) -> None:
        self.anchor, self.ids, self.doc = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)


def _refine(batch: pa.RecordBatch, state: _Bucket) -> pa.RecordBatch:
    """Intervals (doc_id, version, start, end) of the strings in a batch (by anchor and doc_id) that an earlier document has."""
    anchor, doc, version, place, before, count = (batch.column(i).to_numpy() for i in range(6))
    data, offsets = _binary(batch.column(6))
    ids = gram_ids(data) if len(data) >= LENGTH else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(anchor)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = offsets[row] + step
    relative = (before[row] - step).astype(np.uint64)
    bucket = mix(anchor.view(np.uint64)[row] + relative * _C2)
    # identifiers of 2q bytes; strings alone with theirs in this batch, whose bucket was not begun before, need no more
    pair = mix(ids[at] * _C1 + ids[at + Q])
    _, which, n = np.unique(mix(bucket ^ pair), return_inverse=True, return_counts=True)
    open_ = anchor[row] == state.anchor if state.anchor is not None else np.zeros(len(row), bool)
    final = anchor[row] == anchor[-1]
    live = np.flatnonzero((n[which] > 1) | open_ | final)
    row, step, at, bucket, pair = row[live], step[live], at[live], bucket[live], pair[live]
    later = at + LENGTH - 2 * Q
    whole = mix(bucket ^ mix(pair * _C1 + mix(ids[later] * _C1 + ids[later + Q])))
    # documents ascend within a bucket, so the first row of a string has its least document
    owner = doc[row]
    names = np.concatenate([state.ids, whole])
    owners = np.concatenate([state.doc, owner])
    _, first, which = np.unique(names, return_index=True, return_inverse=True)
    least = owners[first]
    covered = least[which[len(state.ids) :]] < owner
    stays = final[live]
    if state.anchor is not None and state.anchor != anchor[-1]:
        state.ids, state.doc = state.ids[:0], state.doc[:0]
    keep, one = np.unique(np.concatenate([state.ids, whole[stays]]), return_index=True)
    state.doc = np.concatenate([state.doc, owner[stays]])[one]
    state.ids, state.anchor = keep, anchor[-1]
    row, start = row[covered], (place[row] - before[row] + step)[covered]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    end = start[np.append(at[1:], len(row)) - 1] + LENGTH if len(row) else start
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[row[at]]), pa.array(version[row[at]]), pa.array(start[at]), pa.array(end)], ["doc_id", "version", "start", "end"]
    )


def _asked(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """As ``anchors``, those in the batch's lists (``anchors``) only."""
    place, ids, text, lo, hi = anchors(data, offsets)
    asked = batch.column("anchors")
    n = np.diff(asked.offsets.to_numpy())
    pairs = np.stack([np.repeat(np.arange(len(n)), n).astype(np.uint64), asked.flatten().to_numpy().view(np.uint64)])
    have = np.unique(mix(pairs[1]) + pairs[0] * _C2)
    live = np.flatnonzero(np.isin(mix(ids) + text.astype(np.uint64) * _C2, have))
    return place[live], ids[live], text[live], lo[live], hi[live]


def _with_anchors(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    lists = wanted.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    return docs.join(lists, "doc_id").select("doc_id", F.xxhash64("text").alias("version"), "text", "anchors")


def _hot_intervals(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """As ``_intervals``, by whole windows and then by strings of different windows: no task gets a whole bucket."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", 1 << 19):
            data, offsets = text_bytes(batch.column("text"))
            _, _, text, lo, hi = _asked(batch, data, offsets)
            raw, base = data.tobytes(), offsets[text]
            found = [raw[a : b + LENGTH] for a, b in zip(lo.tolist(), hi.tolist())]
            columns = [pa.array([hashlib.md5(x).digest() for x in found], pa.binary())]
            columns += [pa.array(batch.column(c).to_numpy()[text]) for c in ("doc_id", "version")]
            columns += [pa.array(lo - base), pa.array(hi - base + LENGTH), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["window", "doc_id", "version", "start", "end", "bytes"])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _binary(batch.column("bytes"))
            n = np.diff(offsets) - LENGTH + 1
            row = np.repeat(np.arange(len(n)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, ids = offsets[row] + step, gram_ids(data)
            later = at + LENGTH - 2 * Q
            names = [mix(mix(ids[at] * c ^ ids[at + Q]) * c + mix(ids[later] * c ^ ids[later + Q])) for c in (_C1, _C2)]
            columns = [pa.array(x.view(np.int64)) for x in names] + [batch.column(c).take(pa.array(row)) for c in ("window", "least")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(step)], ["string", "check", "window", "least", "step"])

    texts = _with_anchors(docs, wanted)
    found = materialize(texts.mapInArrow(windows, "window binary, doc_id long, version long, start long, end long, bytes binary"), "substring-hot")
    different = found.groupBy("window").agg(F.min("doc_id").alias("least"), F.first("bytes").alias("bytes"))
    different = materialize(different, "substring-hot-windows")
    cut = materialize(
        different.mapInArrow(strings, "string long, check long, window binary, least long, step long"), "substring-hot-strings"
    )
    key = ["string", "check"]
    owners = cut.groupBy(*key).agg(F.min("least").alias("owner"), F.max("least").alias("_greatest")).where("owner < _greatest")
    shared = cut.join(materialize(owners.select(*key, "owner"), "substring-hot-first"), key).where("owner < least")
    # a window has as many strings as bytes around an anchor at most
    steps = shared.groupBy("window").agg(F.collect_list("step").alias("steps"))
    known = materialize(different.select("window", "least").join(steps, "window", "left"), "substring-hot-least")
    inside = F.transform("steps", lambda k: F.struct((F.col("start") + k).alias("start"), (F.col("start") + k + LENGTH).alias("end")))
    whole = F.array(F.struct("start", "end"))
    spans = F.when(F.col("least") < F.col("doc_id"), whole).otherwise(inside)
    return found.drop("bytes").join(known, "window").where("least < doc_id or steps is not null").select("doc_id", "version", F.inline(spans))


def _intervals(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, version, start and end of strings that an earlier document has. ``wanted``: doc_id and its repeated anchors."""

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            place, ids, text, lo, hi = _asked(batch, data, offsets)
            size = hi - lo + LENGTH
            total = np.cumsum(size)
            at = np.arange(total[-1] if len(total) else 0) + np.repeat(lo - (total - size), size)
            bytes_ = pa.Array.from_buffers(
                pa.large_binary(), len(lo), [None, pa.py_buffer(np.append(0, total).astype(np.int64)), pa.py_buffer(data[at])]
            ).cast(pa.binary())
            where = place - offsets[text]
            columns = [ids.view(np.int64), batch.column("doc_id").to_numpy()[text], batch.column("version").to_numpy()[text]]
            columns += [where.astype(np.int64), (place - lo).astype(np.int32), (hi - lo + 1).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), bytes_], names)

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Bucket()
        for batch in batches:
            strings = np.cumsum(batch.column("strings").to_numpy().astype(np.int64))
            start = 0
            while start < batch.num_rows:
                base = strings[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(strings, base + WINDOWS, "right")))
                yield _refine(batch.slice(start, end - start), state)
                start = end

    names = ["anchor", "doc_id", "version", "place", "before", "strings", "bytes"]
    placed = _with_anchors(docs, wanted).mapInArrow(
        around, "anchor long, doc_id long, version long, place long, before int, strings int, bytes binary"
    )
    placed = placed.repartition(F.col("anchor")).sortWithinPartitions("anchor", "doc_id")
    return placed.mapInArrow(refine, "doc_id long, version long, start long, end long")


def deduplicate(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) without repeated strings: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` is the remaining bytes. Texts are judged as they came, not as they
    are left. A document with the same text as an earlier one goes whole, if it
    has ``LENGTH`` bytes. Null texts are empty; texts shorter than ``LENGTH``
    stay as they are. Rows without a doc_id neither lose anything nor count as
    earlier. Rows that repeat a doc_id are not earlier than each other. An empty
    table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where("doc_id is not null")
    long_enough = F.octet_length("text") >= LENGTH
    named = known.where(long_enough).select("doc_id", F.xxhash64("text").alias("version"), F.md5(F.col("text").cast("binary")).alias("_md5"))
    heads = named.groupBy("_md5").agg(F.min("doc_id").alias("_head"))
    copies = materialize(
        named.join(heads, "_md5").where(F.col("_head") < F.col("doc_id")).select("doc_id", "version").distinct(), "substring-copies"
    )
    known = known.where(long_enough)
    hot = _hot(known)
    repeated = materialize(_repeated(known, hot), "substring-anchors")
    wanted = repeated.join(copies, "doc_id", "left_anti")
    found = materialize(_intervals(known, wanted.where("salt < 0")), "substring-intervals")
    if len(hot):
        found = found.unionByName(materialize(_hot_intervals(known, wanted.where("salt >= 0")), "substring-hot-intervals"))
    spans = found.unionByName(copies.withColumns({"start": F.lit(0).cast("long"), "end": F.lit(2**62).cast("long")}))
    spans = spans.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode()
                kept, removed, n_spans, at = [], 0, 0, 0
                for start, end in sorted((s["start"], min(s["end"], len(raw))) for s in spans or ()):
                    if start > at or not n_spans:
                        kept.append(raw[at:start])
                        n_spans += 1
                        at = start
                    removed += max(0, end - at)
                    at = max(at, end)
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append((len(raw), removed, n_spans, hashlib.sha256(left).hexdigest(), left))
            n, removed, n_spans, sha, left = zip(*out)
            longs = [pa.array(x, pa.int64()) for x in (n, removed, n_spans)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *longs, pa.array(sha), pa.array(left, pa.binary())], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    joined = rows.withColumn("version", F.xxhash64("text")).join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
