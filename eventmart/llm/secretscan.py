"""Secrets in texts: all rules in one automaton, one pass over the bytes.

The rules' expressions are compiled on the driver into minimal deterministic
automata (``automaton``). One automaton of all rules goes over every byte of a
block and tells in which texts a match of any rule ends. Only in those texts a
second one, for the bytes in reverse, marks where matches begin; from the
leftmost beginning of a rule its longest match is taken, then from the leftmost
one after that.

For the rules here the longest match is the one a backtracking search finds, as
at every byte of them at most one part of the rule can go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.automaton import SEPARATOR, Automaton
from eventmart.llm.storage import unused
from eventmart.llm.textbytes import blocks, text_bytes


class Rule(NamedTuple):
    """``pattern``: what is matched, leftmost first and without overlaps. ``only``: of those matches the ones that are kept."""

    kind: str
    pattern: str
    only: str | None = None


_ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]"""
#: Kinds the contract names; their order breaks ties between spans.
BASE = (
    Rule("assign", _ASSIGNED + "+", _ASSIGNED + "{8,}"),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{12,}"),
    # a run that is too short holds no longer one, so this needs no second test
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Key formats with a fixed opening. Lengths are tested by ``only``: a counter for each would multiply the states.
MORE = (
    Rule("private_key", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", r"gh[pousr]_[A-Za-z0-9]{16,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", r"xox[abprs]-[A-Za-z0-9\-]{10,}"),
    Rule("login", r"(https?|ftp|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~%\-]+:[A-Za-z0-9._~%\-]+@"),
)
RULES = BASE + MORE

SPANS = "array<struct<start:bigint,stop:bigint,kind:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())]))


class Scanner:
    """The automata of some rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        patterns = [r.pattern for r in rules]
        self.ends = Automaton(patterns, anywhere=True)
        self.begins = Automaton(patterns, anywhere=True, backwards=True)
        extra = [r.only for r in rules if r.only is not None]
        #: bits a match needs to be kept, in the automaton that begins at the match
        self.needs, place = [], len(rules)
        for i, r in enumerate(rules):
            self.needs.append(1 << i | (1 << place if r.only is not None else 0))
            place += r.only is not None
        self.from_start = Automaton(patterns + extra, anywhere=False)

    def spans(self, column: pa.Array) -> list[list[dict]]:
        """The kept spans of each text in code points, by start, then by the order of the rules."""
        data, offsets = text_bytes(column)
        out: list[list[dict]] = [[] for _ in range(len(column))]
        # a separator after each text
        spread = np.full(len(data) + len(out), SEPARATOR, np.uint8)
        spread[np.arange(len(data)) + np.repeat(np.arange(len(out)), np.diff(offsets))] = data
        offsets = offsets + np.arange(len(offsets))
        hits = np.unique(np.searchsorted(offsets, np.flatnonzero(self.ends.scan(spread)), "right") - 1)
        if not len(hits):
            return out
        texts = [spread[offsets[t] : offsets[t + 1]] for t in hits]
        joined = np.concatenate(texts)
        begins = self.begins.scan(joined[::-1])[::-1]
        at = np.flatnonzero(begins)
        which = begins[at]
        # code points before each byte; bytes 0x80 to 0xBF continue one
        points = np.concatenate(([0], np.cumsum((joined & 0xC0) != 0x80)))
        low = 0
        for t, text in zip(hits.tolist(), texts):
            high = low + len(text)
            here = slice(*np.searchsorted(at, [low, high]))
            out[t] = self._of_text(text[:-1].tobytes(), at[here] - low, which[here], points[low:high])
            low = high
        return out

    def _of_text(self, text: bytes, at: np.ndarray, which: np.ndarray, points: np.ndarray) -> list[dict]:
        found = []
        for i, rule in enumerate(self.rules):
            free = 0
            for begin in at[(which >> i & 1).astype(bool)].tolist():
                if begin < free:
                    continue
                free, held = self.from_start.longest(text, begin, i)
                if held & self.needs[i] == self.needs[i]:
                    found.append((int(points[begin] - points[0]), i, int(points[free] - points[0])))
        return [{"start": s, "stop": e, "kind": self.rules[i].kind} for s, i, e in sorted(found)]


def annotate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, column: str = "secrets") -> DataFrame:
    """Every row of ``docs`` with all its columns, and the spans of secrets in its ``text``.

    ``column``: array of start, stop (code points, stop exclusive) and kind, by
    start, then by the order of the rules. A null or empty text has none. Rows
    are independent of each other, so repeated rows give repeated results and an
    empty table an empty one. ``column`` must not be a column of ``docs``.
    """
    if unused(column, docs) != column:
        raise ValueError(f"the table has a column {column} already")
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))
    names, place = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            spans = pa.array(shared.value.spans(batch.column(place)), _SPANS)
            yield pa.RecordBatch.from_arrays([*batch.columns, spans], [*names, column])

    return docs.mapInArrow(run, docs.withColumn(column, F.lit(None).cast(SPANS)).schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by ``mark``; overlapping spans become one mark. Null texts stay null."""
    name = unused("_secrets", docs)
    # pieces between the furthest stop so far and the next start
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("upto"))

    def step(acc: Column, span: Column) -> Column:
        before = F.when(
            span["start"] >= acc["upto"],
            F.concat(acc["done"], F.substring("text", (acc["upto"] + 1).cast("int"), (span["start"] - acc["upto"]).cast("int")), F.lit(mark)),
        ).otherwise(acc["done"])
        return F.struct(before.alias("done"), F.greatest(acc["upto"], span["stop"]).alias("upto"))

    rest = lambda acc: F.concat(acc["done"], F.substring("text", (acc["upto"] + 1).cast("int"), F.char_length("text")))
    marked = annotate(docs, rules, name)
    clean = F.when(F.size(name) == 0, F.col("text")).otherwise(F.aggregate(name, start, step, rest))
    return marked.withColumn("text", F.when(F.col("text").isNotNull(), clean)).drop(name)


def _digest(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))


def counts(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = tuple(r.kind for r in BASE)) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, the number of spans of each base kind, base_sha256 and spans.

    ``base_sha256`` is the SHA-256 of the base spans as ``kind:start:stop``,
    comma-joined; ``spans`` are all spans, joined likewise.
    """
    found = annotate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rules)
    def of_kind(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    per_kind = [of_kind(kind) for kind in base]
    of_base = F.filter("secrets", lambda s: s["kind"].isin(*base))
    return found.select("doc_id", *per_kind, F.sha2(_digest(of_base), 256).alias("base_sha256"), _digest(F.col("secrets")).alias("spans"))
