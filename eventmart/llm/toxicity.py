"""Toxicity from averaged subword embeddings and a linear softmax.

A word is a bag of hashed byte n-grams (with its borders), so misspelt and
unseen forms share vectors with the words they resemble. The vectors of a
passage's words are averaged and go through a linear softmax; embeddings and
softmax are trained jointly in numpy. A text is as toxic as its worst passage:
training marks the worst passage of each toxic text, and the worst and random
passages of clean ones. A last one-dimensional logistic fit, on texts kept out
of that training, turns the worst passage's margin into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.sampling import key_remainder, per_label
from eventmart.llm.textbytes import BLOCK_BYTES, LOWER, Words, blocks, text_bytes

#: Hashed n-grams (16 bits at most), their lengths in bytes, dimensions, words of a passage, training texts of each label.
BUCKETS_LOG2 = 16
NGRAMS = (3, 4, 5, 6)
DIM = 8
PASSAGE = 8
SAMPLE_PER_LABEL = {1: 1300, 0: 2200}
#: Bytes whose n-grams are hashed at once.
HASHED = 1 << 17

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MODEL = ["value", "bias", "scale", "shift"]


class Passages:
    """N-grams of all words of a block, and its passages: runs of ``PASSAGE`` words, half overlapping, one at least per text."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        spaced = pc.binary_join_element_wise(pc.fill_null(column, ""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        data, offsets = text_bytes(spaced)
        words = Words(data, offsets)
        self.start, self.end = words.start, words.end + 2  # with a border byte on either side, in the padded bytes
        padded = np.full(len(data) + 2, 0x20, np.uint8)
        padded[1:-1] = LOWER[data]
        inner = padded < 0x21
        padded[inner] = 0x20
        self.hashes = {n: np.empty(len(padded), np.uint16) for n in NGRAMS}
        for at in range(0, len(padded), HASHED):  # 64-bit codes of a part of the bytes at a time
            part = padded[at : at + HASHED + max(NGRAMS) - 1].astype(np.uint64)
            code = np.zeros(len(part), np.uint64)
            for n in range(1, max(NGRAMS) + 1):
                code[: max(0, len(part) - n + 1)] |= part[n - 1 :] << np.uint64(8 * (n - 1))
                if n in NGRAMS:
                    hashed = (code[:HASHED] + np.uint64(n)) * _ODD >> np.uint64(64 - BUCKETS_LOG2)
                    self.hashes[n][at : at + HASHED] = hashed
        self.grams = sum(np.maximum(self.end - self.start - n + 1, 0) for n in NGRAMS)
        first, counts = words.first[:-1], words.counts()
        half = PASSAGE // 2
        per_text = np.maximum(1, -(-(counts - half) // half))
        self.text = np.repeat(np.arange(len(counts)), per_text)
        step = np.arange(len(self.text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        self.lo = first[self.text] + half * step
        self.hi = np.minimum(self.lo + PASSAGE, (first + counts)[self.text])
        self.first_passage = np.cumsum(per_text) - per_text

    def margins(self, value: np.ndarray, bias: float) -> np.ndarray:
        """Softmax margin of each passage; ``value``: margin of each n-gram bucket."""
        words = np.zeros(len(self.start))
        for n, h in self.hashes.items():
            total = np.zeros(len(h) + 1)
            np.cumsum(value[h], dtype=np.float64, out=total[1:])
            last = np.maximum(self.end - n + 1, self.start)
            words += total[last] - total[self.start]
        total = np.concatenate(([0.0], np.cumsum(words / np.maximum(self.grams, 1))))
        return bias + (total[self.hi] - total[self.lo]) / np.maximum(self.hi - self.lo, 1)

    def worst(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the highest margin, and the passage that has it."""
        if not len(self.first_passage):
            return np.zeros(0), np.zeros(0, int)
        top = np.maximum.reduceat(margins, self.first_passage)
        at = np.flatnonzero(margins == top[self.text])
        _, one = np.unique(self.text[at], return_index=True)
        return top, at[one]

    def bag(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into ``passages``, bucket, weight) of all n-grams of the passages; a passage's weights sum to 1."""
        size = self.hi[passages] - self.lo[passages]
        which = np.repeat(np.arange(len(passages)), size)
        word = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + self.lo[passages][which]
        out = []
        for n, h in self.hashes.items():
            k = np.maximum(self.end[word] - self.start[word] - n + 1, 0)
            w = np.repeat(np.arange(len(word)), k)
            at = np.arange(len(w)) - np.repeat(np.cumsum(k) - k, k) + self.start[word][w]
            share = (1.0 / (self.grams[word] * size[which])).astype(np.float32)
            out.append((which[w].astype(np.int32), h[at], share[w]))
        return tuple(np.concatenate(x) for x in zip(*out))


class ToxicityModel:
    """``value``: what each n-gram bucket adds to the margin, embeddings times softmax weights."""

    def __init__(self, texts: pa.Array, toxic: np.ndarray, share: float, seed: int = 5):
        self.value, self.bias, self.scale, self.shift = np.zeros(1 << BUCKETS_LOG2, np.float32), 0.0, 0.0, self._log_odds(share)
        if toxic.min(initial=1) == toxic.max(initial=0) or len(toxic) < 8:
            return  # nothing to tell apart: every text has the share of toxic ones
        rng = np.random.default_rng(seed)
        # blocks are taken apart anew in each turn, so that the n-grams of one are held at a time
        columns = [b.column("text") for b in blocks([pa.record_batch([texts], ["text"])], "text")]
        sizes = np.cumsum([0] + [len(c) for c in columns])
        fits = rng.random(len(toxic)) < 0.75
        embedding = rng.normal(0, 0.1, (1 << BUCKETS_LOG2, DIM)).astype(np.float32)
        weight, bias = rng.normal(0, 0.1, DIM).astype(np.float32), 0.0
        square_e, square_w, square_b = np.full_like(embedding, 1e-8), np.full_like(weight, 1e-8), 1e-8
        for turn in range(5):
            value, bags, labels = embedding @ weight, [], []
            for p, begin, end in zip(map(Passages, columns), sizes, sizes[1:]):
                y, fit = toxic[begin:end], fits[begin:end]
                if turn:
                    _, worst = p.worst(p.margins(value, bias))
                    chosen = worst[fit]
                else:
                    chosen = np.zeros(0, int)
                many = np.diff(np.append(p.first_passage, len(p.text)))
                draws = [p.first_passage + (rng.random(len(many)) * many).astype(int) for _ in range(3 if turn else 6)]
                for d in draws:
                    chosen = np.concatenate([chosen, d[fit & ((y == 0) | (turn == 0))]])
                bags.append(p.bag(chosen))
                labels.append(y[p.text[chosen]])
            y = np.concatenate(labels).astype(np.float64)
            lengths = np.cumsum([0] + [len(x) for x in labels])
            which = np.concatenate([b[0] + np.int32(s) for b, s in zip(bags, lengths)])
            bucket, part = np.concatenate([b[1] for b in bags]), np.concatenate([b[2] for b in bags])
            del bags
            balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
            for _ in range(60):
                value = embedding @ weight
                margin = bias + np.bincount(which, value[bucket] * part, minlength=len(y))
                error = balance * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
                slope = np.bincount(bucket, error[which] * part, minlength=len(value)).astype(np.float32)
                grad_e, grad_w, grad_b = np.outer(slope, weight), embedding.T @ slope, error.sum()
                square_e += grad_e**2
                square_w += grad_w**2
                square_b += grad_b**2
                embedding -= 0.3 * grad_e / np.sqrt(square_e)
                weight -= 0.3 * grad_w / np.sqrt(square_w)
                bias -= 0.3 * grad_b / np.sqrt(square_b)
            del which, bucket, part, p
        self.value, self.bias = (embedding @ weight).astype(np.float32), float(bias)
        top = np.concatenate([p.worst(p.margins(self.value, self.bias))[0] for p in map(Passages, columns)])
        self.scale, self.shift = self._calibrate(top[~fits], toxic[~fits], share)

    @staticmethod
    def _log_odds(share: float) -> float:
        share = min(max(share, 1e-4), 1 - 1e-4)
        return float(np.log(share / (1 - share)))

    def _calibrate(self, top: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
        """Logistic fit of the label on the worst margin, with the labels in their true shares."""
        if not len(y) or y.min() == y.max():
            return 1.0, 0.0
        centre, spread = top.mean(), top.std() + 1e-9
        x, a, b = (top - centre) / spread, 1.0, 0.0
        w = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum())
        for _ in range(400):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            error, curve = w * (p - y), w * p * (1 - p) + 1e-6 * w
            h = np.array([[(curve * x * x).sum() + 1e-4, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-6]])
            step = np.linalg.solve(h, [(error * x).sum() + 1e-4 * a, error.sum()])
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        return float(a / spread), float(b - a * centre / spread)

    def score(self, column: pa.Array) -> np.ndarray:
        passages = Passages(column)
        top, _ = passages.worst(passages.margins(self.value, self.bias))
        return 1 / (1 + np.exp(-np.clip(self.scale * top + self.shift, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, folds: int, held: int) -> ToxicityModel:
    """Learns from at most ``SAMPLE_PER_LABEL`` texts of each label whose key remainder is not ``held``."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (key_remainder(folds) != held))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    chosen = None
    for label, most in SAMPLE_PER_LABEL.items():
        part = per_label(known.where(F.col("toxic") == label), "toxic", most)
        chosen = part if chosen is None else chosen.unionByName(part)
    one = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = one.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    share = counts.get(1, 0) / max(1, sum(counts.values()))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        del parts
        table = table.take(pa.array(np.argsort(table["doc_id"].to_numpy(), kind="stable"))).combine_chunks()
        m = ToxicityModel(table["text"].combine_chunks(), table["toxic"].to_numpy().astype(int), share)
        yield pa.RecordBatch.from_arrays([pa.array([m.value.tobytes()], pa.binary()), *(pa.array([float(x)]) for x in (m.bias, m.scale, m.shift))], _MODEL)

    model = ToxicityModel(pa.array([], pa.string()), np.zeros(0, int), share)
    # the sample is bounded, so one task trains; texts and n-grams stay out of the driver, which gets one number a bucket
    for row in sample.repartition(1).mapInArrow(fit, "value binary, bias double, scale double, shift double").collect():
        model.value = np.frombuffer(row["value"], np.float32)
        model.bias, model.scale, model.shift = row["bias"], row["scale"], row["shift"]
    return model


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Toxicity of every row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from ``labels`` (doc_id, toxic) whose key remainder is not ``held``;
    of a doc_id labelled more than once, the higher label counts, and of one
    with several texts the greatest text. Null and empty texts have the score
    of a passage without words. With labels of one kind only, or fewer than 8,
    all scores are the share of toxic ones. A null doc_id has the remainder of
    the empty text. Repeated rows give repeated results; other columns are not
    looked at.
    """
    model = train(docs, labels, folds, held)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES // 2):
            p = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64()), pa.array(p >= 0.5).cast(pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), (key_remainder(folds) == held).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_clean(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """The rows of ``docs`` whose score is under 0.5, with their columns. Learns as ``score`` does."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES // 2):
            yield batch.filter(pa.array(shared.value.score(batch.column("text")) < 0.5))

    return docs.mapInArrow(run, docs.schema)
