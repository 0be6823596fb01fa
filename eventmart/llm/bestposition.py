"""Ranked lexical search by the Best Position Algorithm.

The documents' counts of the items' terms are written once. With the statistics
of all documents, a term's impact on each document is a whole number; a task
takes a shard of documents and has, per term, the list of its documents by
falling impact. For an item the lists of its terms are read in step. A document
met in one of them is looked up directly in all others, which also tells its
positions there. A list's best position is the last one up to which all are
seen, by either way; no document unseen so far can score more than the impacts
at the best positions together. Reading stops when that sum is strictly below
the k-th best score, so ties are all seen. The best of all shards are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.storage import materialize
from eventmart.llm.textbytes import MARKS, Words, blocks, text_bytes

#: Bytes of item text sent to tasks at once, and counts of terms in a shard of documents.
ITEM_BYTES = 8 << 20
SHARD_COUNTS = 2_000_000
#: Positions of each list read first; twice as many each time after that.
DEPTH = 8
#: Weight of a term: floor(WEIGHT * ln((2N + 2) / (2 df + 1))). Impact: weight * (SCALE * tf div (1000 * tf + SOFT * m)).
WEIGHT, SCALE, SOFT = 1000, 1_000_000_000, 12
#: m: 100 - LENGTH + (LENGTH * n * N) div L.
LENGTH = 25


class Items:
    """A block of items: the vocabulary of their terms, and per item its terms and how often it repeats each."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        words = Words(*text_bytes(texts), between=MARKS)
        terms = words.strings().dictionary_encode()
        self.ids, self.vocabulary, self.terms = ids, terms.dictionary, []
        number = terms.indices.to_numpy()
        for a, b in zip(words.first, words.first[1:]):
            self.terms.append(np.unique(number[a:b], return_counts=True))


def _counts(vocabulary: pa.Array):
    """Per document: doc_id, n (its terms), and number and tf of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            words = Words(*text_bytes(batch.column("text")), between=MARKS)
            terms = words.strings().dictionary_encode()
            known = pc.fill_null(pc.index_in(terms.dictionary, value_set=vocabulary), -1).to_numpy()
            number = known[terms.indices.to_numpy()].astype(np.int64) if len(terms) else np.zeros(0, np.int64)
            inside = number >= 0
            key, tf = np.unique(words.text_of()[inside] * np.int64(len(vocabulary)) + number[inside], return_counts=True)
            text, number = np.divmod(key, max(len(vocabulary), 1))
            offsets = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(words.counts(), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(number, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of a shard's documents, and each document's place in them."""

    def __init__(self, lengths: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int):
        self.doc_begin = np.concatenate(([0], np.cumsum(lengths)))
        doc = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((doc, -impact, term))
        self.list_begin = np.searchsorted(term[order], np.arange(terms + 1))
        self.doc, self.impact = doc[order], impact[order]
        self.term, self.value = term, impact  # by document
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.seen = np.zeros(len(order), bool)
        self.met = np.zeros(len(lengths), bool)
        self.repeats = np.zeros(terms, np.int64)

    def best(self, terms: np.ndarray, repeats: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The k documents of highest score, ties by ``keys``: their numbers, their scores, and the positions read in all lists."""
        here = self.list_begin[terms] < self.list_begin[terms + 1]
        terms, repeats = terms[here], repeats[here]
        begin, end = self.list_begin[terms], self.list_begin[terms + 1]
        self.repeats[terms] = repeats
        best, read, depth = begin.copy(), begin.copy(), DEPTH
        docs, scores, met, touched, accesses = np.zeros(0, np.int64), np.zeros(0, np.int64), [], [], 0
        while len(terms):
            upto = np.minimum(np.maximum(read, best) + depth, end)
            new = np.concatenate([self.doc[b:u] for b, u in zip(best, upto)])
            accesses += len(new)
            read, depth = upto, depth * 2
            new = np.unique(new[~self.met[new]])
            self.met[new] = True
            met.append(new)
            n = self.doc_begin[new + 1] - self.doc_begin[new]
            at = np.arange(n.sum()) + np.repeat(self.doc_begin[new] - (np.cumsum(n) - n), n)
            owner = np.repeat(np.arange(len(new)), n)
            times = self.repeats[self.term[at]]
            mine = np.flatnonzero(times)
            at, owner = at[mine], owner[mine]
            score = np.zeros(len(new), np.int64)
            np.add.at(score, owner, times[mine] * self.value[at])
            places = self.place[at]
            self.seen[places] = True
            touched.append(places)
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
            keep = np.lexsort((keys[docs], -scores))[:k]
            docs, scores = docs[keep], scores[keep]
            bound = 0
            for i in range(len(terms)):
                rest = self.seen[best[i] : end[i]]
                step = int(rest.argmin()) if len(rest) and not rest.all() else len(rest)
                best[i] += step
                if best[i] < end[i]:
                    bound += int(repeats[i]) * int(self.impact[best[i] - 1])
            if (best == end).all() or (len(docs) == k and bound < scores[-1]):
                break
        self.repeats[terms] = 0
        for x in met:
            self.met[x] = False
        for x in touched:
            self.seen[x] = False
        some = scores > 0
        return docs[some], scores[some], accesses


def _search(items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def shard(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = table["doc_id"].combine_chunks()
        keys = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()
        terms, tfs = table["terms"].combine_chunks(), table["tfs"].combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy().astype(np.int64)
        term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()
        m = 100 - LENGTH + (LENGTH * table["n"].to_numpy() * n_docs) // max(n_terms, 1)
        impact = weights[term] * ((SCALE * tf) // (1000 * tf + SOFT * np.repeat(m, lengths)))
        lists = Shard(lengths, term, impact, len(weights))
        item, doc, score = [], [], []
        for i, (number, repeats) in enumerate(items.terms):
            d, s, _ = lists.best(number, repeats, keys, k)
            item.append(np.full(len(d), i))
            doc.append(d)
            score.append(s)
        item, doc, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (item, doc, score))
        return pa.RecordBatch.from_arrays(
            [items.ids.take(pa.array(item, pa.int64())), ids.take(pa.array(doc, pa.int64())), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
            if size >= SHARD_COUNTS:
                yield shard(parts)
                parts, size = [], 0
        if parts:
            yield shard(parts)

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item_id, rank (from 1), doc_id, score.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are not
    looked at. Equal scores go by ascending doc_id, a null one last. A null text
    has no terms. Every row of ``docs`` is a document, so repeated rows take
    ranks of their own; of an item_id with several texts the greatest counts,
    and rows with a null item_id are one item. An item without terms, or whose
    terms no document holds, has no rows; nor has any if a table is empty.
    """
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.groupBy("item_id").agg(F.max("text").alias("text")).where("text is not null")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks, found = max(1, -(-size // ITEM_BYTES)), None
    for b in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64(F.lit(1), "item_id"), F.lit(n_blocks)) == b).toArrow().combine_chunks()
        if not len(part):
            continue
        block = Items(part["item_id"].combine_chunks(), part["text"].combine_chunks())
        counts = materialize(texts.mapInArrow(_counts(block.vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), "search-counts")
        n_docs, n_terms = counts.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(block.vocabulary), np.int64)
        for number, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the block at most
            weights[number] = weight(n_docs, df)
        best = counts.where("n > 0").mapInArrow(_search(block, weights, n_docs, n_terms, k), "item_id long, doc_id long, score long")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
