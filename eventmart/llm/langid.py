"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. For each place of the code a
binary logistic classifier over hashed byte n-grams predicts the bit. A text
gets the language whose codeword has the least loss under the predicted
margins, each place weighted by how well its classifier does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.sampling import key_remainder, per_label
from eventmart.llm.textbytes import LOWER, blocks, text_bytes

#: Hashed n-gram features, n-gram lengths in bytes, training documents in all, least places of the code.
FEATURES = 4096
NGRAMS = (1, 2, 3, 4)
SAMPLE_DOCS = 2400
PLACES = 15
#: Below this share of the decoding weight the language is flagged as ambiguous.
AMBIGUOUS_BELOW = 0.6
UNKNOWN = "und"

_ODD = np.uint64(0x9E3779B97F4A7C15)


def featurize(column: pa.Array) -> np.ndarray:
    """One row per text: the square roots of its n-gram shares, of length 1 (0 for an empty text)."""
    data, offsets = text_bytes(column)
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n) * FEATURES, size)
    left = np.repeat(offsets[1:], size) - np.arange(len(data))
    low, code = LOWER[data].astype(np.uint64), np.zeros(len(data), np.uint64)
    counts = np.zeros(n * FEATURES)
    for length in range(1, max(NGRAMS) + 1):
        code[: len(data) - length + 1] |= low[length - 1 :] << np.uint64(8 * (length - 1))
        if length in NGRAMS:
            whole = left >= length
            bucket = ((code[whole] + np.uint64(length)) * _ODD >> np.uint64(52)).astype(np.int64)
            counts += np.bincount(row[whole] + bucket, minlength=n * FEATURES)
    x = np.sqrt(counts.reshape(n, FEATURES).astype(np.float32))
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def codewords(languages: int, places: int = PLACES, seed: int = 11) -> np.ndarray:
    """One row of +1/-1 per language: of many random codes the one whose closest rows differ most. No column is constant."""
    if languages == 1:
        return np.ones((1, 1), np.float32)
    places = max(places, int(np.ceil(4 * np.log2(languages))))
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (languages, places))
        for c in np.flatnonzero(np.abs(code.sum(axis=0)) == languages):
            code[rng.integers(languages), c] *= -1
        apart = (places - code @ code.T) // 2 + places * np.eye(languages, dtype=int)
        if apart.min() > far:
            best, far = code, apart.min()
    return best.astype(np.float32)


def train_bits(x: np.ndarray, bits: np.ndarray, steps: int = 120, rate: float = 40.0, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic classifiers of all places at once, by accelerated gradient descent."""
    w, b = np.zeros((x.shape[1], bits.shape[1]), np.float32), np.zeros(bits.shape[1], np.float32)
    vw, vb = w.copy(), b.copy()
    for _ in range(steps):
        ahead_w, ahead_b = w + 0.9 * vw, b + 0.9 * vb
        error = -bits / (1 + np.exp(np.clip(bits * (x @ ahead_w + ahead_b), -30, 30))) / len(x)
        vw = 0.9 * vw - rate * 0.1 * (x.T @ error + decay * ahead_w)
        vb = 0.9 * vb - rate * 0.1 * 0.1 * error.sum(axis=0)
        w, b = w + vw, b + vb
    return w.astype(np.float32), b.astype(np.float32)


def has_letter(texts: list[str | None], column: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    data, offsets = text_bytes(column)
    letter = (LOWER[data] >= 97) & (LOWER[data] <= 122)
    total = np.concatenate(([0], np.cumsum(letter)))
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in texts[i] or "")
    return found


class LanguageModel:
    """Learned languages (in code point order), their codewords and the classifiers of the places."""

    def __init__(self, texts: pa.Array, languages: list[str]):
        self.names = sorted(set(languages))
        if not self.names:
            return
        self.code = codewords(len(self.names))
        parts = [featurize(b.column("text")) for b in blocks([pa.record_batch([texts], ["text"])], "text", 1 << 19)]
        x = np.vstack(parts)
        y = np.searchsorted(self.names, languages)
        # every language counts the same, however many samples it has
        self.w, self.b = train_bits(x, self.code[y])
        right = ((x @ self.w + self.b) * self.code[y] > 0).mean(axis=0)
        self.weight = np.maximum(right - 0.5, 0.01) / np.maximum(right - 0.5, 0.01).sum()

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, share of the decoding weight, and whether that is ambiguous, of each text."""
        texts = column.to_pylist()
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        margins = featurize(column) @ self.w + self.b
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.weight).sum(axis=2)
        odds = np.exp(-len(self.weight) * (loss - loss.min(axis=1, keepdims=True)))
        odds /= odds.sum(axis=1, keepdims=True)
        best, known = loss.argmin(axis=1), has_letter(texts, column)
        score = np.where(known, odds[np.arange(len(texts)), best], 0.0)
        return [self.names[i] if k else UNKNOWN for i, k in zip(best, known)], score, known & (score < AMBIGUOUS_BELOW)


def train(labelled: DataFrame) -> LanguageModel:
    """Learns from at most ``SAMPLE_DOCS`` rows of (doc_id, text, lang) in all, dealt evenly to the languages."""
    ids = labelled.where(F.col("lang").isNotNull()).select("doc_id", "lang")
    languages = max(1, ids.select("lang").distinct().count())
    chosen = per_label(ids, "lang", max(8, SAMPLE_DOCS // languages)).select("doc_id").distinct()
    rows = labelled.where(F.col("lang").isNotNull()).join(F.broadcast(chosen), "doc_id", "left_semi")
    sample = rows.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")).toArrow()
    order = np.lexsort((sample["lang"].to_numpy(zero_copy_only=False), sample["doc_id"].to_numpy()))
    sample = sample.take(pa.array(order)).combine_chunks()
    return LanguageModel(sample["text"].combine_chunks(), sample["lang"].to_pylist())


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, ambiguous.

    Rows whose key remainder is ``held`` are not learned from. ``lang`` is a
    label only. Null texts, and texts without a letter, are ``und`` with score
    0; so is everything if there is nothing to learn from. A null doc_id has
    the remainder of the empty text and is not learned from. Repeated rows give
    repeated results; other columns are not looked at.
    """
    rest = key_remainder(folds)
    model = train(docs.select("doc_id", "text", "lang").where(rest != held))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", 1 << 19):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names, score, unsure = shared.value.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(unsure)],
                    ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    return docs.select(F.col("doc_id").cast("long"), (rest == held).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )
