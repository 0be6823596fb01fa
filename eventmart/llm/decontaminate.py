"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are compared in lower case and without marks. Runs of ``SEED`` words of
the test items are seeds. A document is paired with every item it shares a seed
with: most seeds are rare and pair few, but common ones count as well, so the
verdict on a document does not depend on the others. Pairs whose item has too
few words in common with the document to reach the threshold under any
alignment are dropped by a look at each item's words; only for the rest the
places of the seeds are opened, and the item is aligned with the words around
them. The score is the alignment's share of a perfect one.

Items are taken in blocks, so what is sent to tasks is bounded by the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.storage import unused
from eventmart.llm.textbytes import MARKS, Words, blocks, text_bytes

SEED = 3
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: Bytes of item text in a block.
ITEM_BYTES = 16 << 20
#: Cells of an alignment row, or words of items, handled at once.
CELLS = 1 << 20

HITS = "array<struct<item_id:bigint,score:double,seeds:bigint,at_word:bigint>>"
_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("seeds", pa.int64()), ("at_word", pa.int64())]))


def _seeds(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, and of each run of ``size`` words its hash, text and first word. Shorter texts have none."""
    h, counts = words.hashes(), words.counts()
    runs = np.maximum(counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + words.first[text]
    seed = np.full(len(at), size, np.uint64)
    for k in range(size):
        seed = seed * np.uint64(0xD6E8FEB86659FD93) + h[at + k]
    return h, seed, text, at


class Items:
    """A block of test items: their words, and their seeds by kind and by item.

    An item of fewer than ``SEED`` words has one seed, its whole sequence.
    """

    def __init__(self, ids: list[int | None], texts: pa.Array):
        words = Words(*text_bytes(texts), between=MARKS)
        self.ids, self.first, self.words = ids, words.first, words.hashes()
        size, parts = np.diff(self.first), []
        self.sizes = [n for n in range(1, SEED + 1) if (size == n).any() or (n == SEED and (size > n).any())]
        for n in self.sizes:
            _, seed, item, at = _seeds(words, n)
            mine = (size[item] == n) | ((n == SEED) & (size[item] > n))
            parts.append((seed[mine], item[mine], (at - self.first[item])[mine]))
        seed, item, place = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
        self.kinds, kind = np.unique(seed, return_inverse=True)
        # one row per (item, kind), with the first and the last place of the seed in the item
        key, row = np.unique(item * np.int64(len(self.kinds) + 1) + kind, return_inverse=True)
        self.item, self.kind = np.divmod(key, np.int64(len(self.kinds) + 1))
        self.low, self.high = np.full(len(key), np.iinfo(np.int64).max), np.full(len(key), -1)
        np.minimum.at(self.low, row, place)
        np.maximum.at(self.high, row, place)
        self.of_item = np.searchsorted(self.item, np.arange(len(size) + 1))
        order = np.argsort(self.kind, kind="stable")
        self.with_kind = self.item[order]
        self.of_kind = np.searchsorted(self.kind[order], np.arange(len(self.kinds) + 1))
        self.vocabulary, self.word = np.unique(self.words, return_inverse=True)

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kind, text and first word of every run of a block's words that is a seed, by text and kind."""
        parts = []
        for n in self.sizes:
            _, seed, text, at = _seeds(words, n)
            kind = np.minimum(np.searchsorted(self.kinds, seed), len(self.kinds) - 1)
            same = np.flatnonzero(self.kinds[kind] == seed)
            parts.append((kind[same], text[same], at[same]))
        kind, text, at = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((at, kind, text))
        return kind[order], text[order], at[order]

    def sharing(self, kinds: np.ndarray) -> np.ndarray:
        """The items that have one of the kinds; memory is bounded by the block's items and ``CELLS``."""
        mark = np.zeros(len(self.ids), bool)
        upto = np.cumsum(self.of_kind[kinds + 1] - self.of_kind[kinds])
        start = 0
        while start < len(kinds):
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CELLS, "right")))
            k = kinds[start:end]
            n = self.of_kind[k + 1] - self.of_kind[k]
            mark[self.with_kind[np.repeat(self.of_kind[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())]] = True
            start = end
        return np.flatnonzero(mark)

    def may_reach(self, chosen: np.ndarray, hashes: np.ndarray, threshold: float) -> np.ndarray:
        """Of the chosen items those with so many words among the hashes that an alignment may reach the threshold."""
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        present = np.zeros(len(self.vocabulary), np.int64)
        present[place[self.vocabulary[place] == hashes]] = 1
        out, n = [], np.diff(self.first)[chosen]
        upto, start = np.cumsum(n), 0
        while start < len(chosen):
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CELLS, "right")))
            c, size = chosen[start:end], n[start:end]
            begin = np.cumsum(size) - size
            inside = present[self.word[np.arange(size.sum()) + np.repeat(self.first[c] - begin, size)]]
            out.append(c[np.add.reduceat(inside, begin) >= threshold * size])
            start = end
        return np.concatenate(out) if out else chosen


def align(queries: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores of pairs of hash arrays, and the word of the target where the best alignment ends."""
    best, where = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
    order = np.argsort([len(t) for t in targets], kind="stable")
    start = 0
    while start < len(order):
        size = max(1, CELLS // (len(targets[order[start]]) + 1))
        group = order[start : start + size]
        while len(group) > 1 and len(group) * len(targets[group[-1]]) > 2 * CELLS:
            group = group[: len(group) // 2]
        start += len(group)
        wide, tall = max(len(targets[g]) for g in group), max(len(queries[g]) for g in group)
        target = np.zeros((len(group), wide), np.uint64)
        valid = np.zeros((len(group), wide), bool)
        query = np.zeros((len(group), tall), np.uint64)
        for r, g in enumerate(group):
            target[r, : len(targets[g])], valid[r, : len(targets[g])] = targets[g], True
            query[r, : len(queries[g])] = queries[g]
        rows = np.array([len(queries[g]) for g in group])
        slope = -GAP * np.arange(wide)
        above = np.zeros((len(group), wide + 1), np.int64)
        for i in range(tall):
            same = valid & (target == query[:, i : i + 1]) & (i < rows)[:, None]
            here = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), above[:, 1:] + GAP)
            here = np.maximum(here, 0)
            here = np.maximum.accumulate(here + slope, axis=1) - slope
            here[~valid] = 0
            top = here.max(axis=1)
            better = (top > best[group]) & (i < rows)
            best[group[better]], where[group[better]] = top[better], here[better].argmax(axis=1)
            above[:, 1:] = here
    return best, where


class _Jobs:
    """Alignments to do; they are done whenever ``CELLS`` words of text are waiting."""

    def __init__(self, items: Items, threshold: float):
        self.items, self.threshold, self.best = items, threshold, {}
        self.jobs, self.queries, self.targets, self.waiting = [], [], [], 0

    def add(self, doc: int, item: int, seeds: int, low: int, target: np.ndarray) -> None:
        query = self.items.words[self.items.first[item] : self.items.first[item + 1]]
        self.jobs.append((doc, item, seeds, low))
        self.queries.append(query)
        self.targets.append(target)
        self.waiting += len(target)
        if self.waiting >= CELLS:
            self.done()

    def done(self) -> dict:
        """Per (doc, item) its best share, the seeds and the place, of those that reach the threshold."""
        score, where = align(self.queries, self.targets)
        for (doc, item, seeds, low), query, s, at in zip(self.jobs, self.queries, score.tolist(), where.tolist()):
            share = s / (MATCH * len(query))
            if share >= self.threshold and ((doc, item) not in self.best or share > self.best[doc, item][0]):
                self.best[doc, item] = (share, seeds, low + at)
        self.jobs, self.queries, self.targets, self.waiting = [], [], [], 0
        return self.best


def _windows(
    items: Items, chosen: np.ndarray, kinds: np.ndarray, first: np.ndarray, size: np.ndarray, places: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Item, window and number of shared seeds of the chosen items, in parts of about ``CELLS`` places.

    ``kinds``: those of a text; their ``size`` places begin at ``first`` in ``places``.
    A window is four item lengths around a place where the item would begin.
    Places of a seed inside an item are less than its length apart, so the
    first and the last of them lead to all windows.
    """
    n = items.of_item[chosen + 1] - items.of_item[chosen]
    row = np.repeat(items.of_item[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    have = np.minimum(np.searchsorted(kinds, items.kind[row]), len(kinds) - 1)
    shared = kinds[have] == items.kind[row]
    row, have = row[shared], have[shared]
    length, n = np.diff(items.first), size[have]
    seeds = np.bincount(items.item[row], minlength=len(items.ids))
    upto, start = np.cumsum(n), 0
    while start < len(row):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CELLS, "right")))
        r, h, k = row[start:end], have[start:end], n[start:end]
        place = places[np.arange(k.sum()) + np.repeat(first[h] - (np.cumsum(k) - k), k)]
        item = np.repeat(items.item[r], k)
        # a window is -1 at least, as a place inside an item is less than its length
        found = np.concatenate([(place - np.repeat(x[r], k)) // length[item] for x in (items.low, items.high)]) + 1
        wide = np.int64(found.max(initial=0) + 1)
        item, window = np.divmod(np.unique(np.tile(item, 2) * wide + found), wide)
        yield item, window - 1, seeds[item]
        start = end


def _hits(items: Items, column: pa.Array, threshold: float) -> list[list[dict]]:
    """Contaminating items of each text.

    Text by text: the items that share a seed, of those the ones with enough
    words in common, and only for these the places of the seeds.
    """
    words = Words(*text_bytes(column), between=MARKS)
    out: list[list[dict]] = [[] for _ in range(len(column))]
    kind, text, at = items.found(words)
    if not len(kind):
        return out
    hashes, length, jobs = words.hashes(), np.diff(items.first), _Jobs(items, threshold)
    docs, begin = np.unique(text, return_index=True)
    for d, lo, hi in zip(docs.tolist(), begin.tolist(), np.append(begin[1:], len(text)).tolist()):
        mine = hashes[words.first[d] : words.first[d + 1]]
        kinds, first = np.unique(kind[lo:hi], return_index=True)
        size, places = np.diff(np.append(first, hi - lo)), at[lo:hi] - words.first[d]
        chosen = items.may_reach(items.sharing(kinds), np.unique(mine), threshold)
        for item, window, seeds in _windows(items, chosen, kinds, first, size, places):
            # items of one length share their windows, so each window is looked at once for all of them
            group = np.lexsort((item, window, length[item]))
            item, window, seeds = item[group], window[group], seeds[group]
            new = np.flatnonzero(np.r_[True, (window[1:] != window[:-1]) | (length[item][1:] != length[item][:-1])])
            for s, e in zip(new.tolist(), np.append(new[1:], len(item)).tolist()):
                n, w = int(length[item[s]]), int(window[s])
                low = max(0, w * n - n)
                target = mine[low : (w + 3) * n]
                for i in items.may_reach(item[s:e], target, threshold).tolist():
                    jobs.add(d, i, int(seeds[s + np.searchsorted(item[s:e], i)]), low, target)
    for (d, i), (share, seeds, at_word) in sorted(jobs.done().items()):
        out[d].append({"item_id": items.ids[i], "score": share, "seeds": seeds, "at_word": at_word})
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, column: str = "contamination") -> DataFrame:
    """Every row of ``docs`` with all its columns, and the test items it holds.

    ``benchmark``: item_id, text. Each entry of the new array has item_id, score
    (0 to 1, ``threshold`` at least), seeds (different ones shared) and at_word
    (where the best alignment ends). An item of fewer than ``SEED`` words is
    found by its whole sequence; null items and those without words are in no
    document; rows that repeat an item count once. A null or empty text holds no
    item. Rows of ``docs`` are independent of each other. Repeats of an item in
    a long text are aligned one by one. ``column`` must not be a column of
    ``docs``.
    """
    if unused(column, docs) != column:
        raise ValueError(f"the table has a column {column} already")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks, spark = max(1, -(-size // ITEM_BYTES)), docs.sparkSession
    out, names = docs.withColumn(column, F.array().cast(HITS)), docs.columns
    for b in range(n_blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).toArrow().combine_chunks()
        if not len(part):
            continue
        items = Items(part["item_id"].to_pylist(), part["text"].combine_chunks())
        shared = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in blocks(batches, "text"):
                found = _hits(shared.value, batch.column("text"), threshold)
                before = batch.column(column).to_pylist()
                arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([x + y for x, y in zip(before, found)], _HITS)], batch.schema.names)

        out = out.mapInArrow(search, out.schema)
    return out.select(*names, column)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, seeds, at_word."""
    marked = annotate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, threshold)
    return marked.select("doc_id", F.explode("contamination").alias("c")).select("doc_id", "c.*")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns."""
    name = unused("_contamination", docs)
    return annotate(docs, benchmark, threshold, name).where(F.size(name) == 0).drop(name)
