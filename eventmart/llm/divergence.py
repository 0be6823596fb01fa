"""How far the word use of sources differs: exact distances of smoothed shares.

Per language the counts of its frequent terms by group (source) form a matrix,
most of it zero. Terms are dealt over tiles; in a task the cells of a tile
become K²-trees: quadtrees of ``SIDE`` groups by ``SIDE`` terms that keep one
bit per quadrant, whether it holds any count, and dense leaves for those that
do. Two trees are traversed jointly for all pairs of their groups at once:
quadrants that are zero in both are priced by their width alone, as all their
shares of a group are the same; leaves are compared cell by cell, with a zero
quadrant on the other side standing for that group's share of a count of 0.

All arithmetic is on whole numbers. A share is
``1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))``, by long division.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.storage import materialize
from eventmart.llm.textbytes import Words, blocks, text_bytes

#: Documents of a language that must hold a term; smoothing; what shares are multiplied with, in steps.
LEAST_DOCS = 30
SMOOTH = 5
SCALE_STEPS = (1000, 1000, 1000)
#: Ranks of the terms of a group that are reported.
TOP_TERMS = 50
#: Groups and terms of a tree, groups and terms of a leaf, and terms of a tile on average.
SIDE, LEAF = 256, 16
TILE_TERMS = 2048
#: Pairs of leaves compared at once.
LEAF_PAIRS = 256

#: Everything but ASCII letters and the bytes of longer characters.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: lang, source, term, its occurrences and the rows that hold it."""
    for batch in blocks(batches, "text"):
        words = Words(*text_bytes(batch.column("text")), between=NOT_LETTERS)
        if not len(words.start):
            continue
        terms = words.strings().dictionary_encode()
        term, kinds = terms.indices.to_numpy().astype(np.int64), len(terms.dictionary)
        lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        in_text, n = np.unique(words.text_of() * kinds + term, return_counts=True)
        key = group[in_text // kinds] * kinds + in_text % kinds
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        key = key[order[first]]
        of_lang, of_source = np.divmod(key // kinds, len(source.dictionary))
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(of_lang)), source.dictionary.take(pa.array(of_source)),
                terms.dictionary.take(pa.array(key % kinds)).cast(pa.string()),
                pa.array(np.add.reduceat(n[order], first), pa.int64()), pa.array(np.diff(np.append(first, len(order))), pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term and n (occurrences, above 0) of the terms that ``least_docs`` rows of their language hold.

    Nulls in text, lang and source are empty. Every row of ``docs`` counts as a document.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    cells = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # summed by group first, so that a frequent term is one row per group before its groups meet
    cells = cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return cells.withColumn("held", held).where(F.col("held") >= least_docs).select("lang", "source", "term", "n")


def share_column(count: Column, whole: Column, smooth: int = SMOOTH) -> Column:
    """The scaled share of ``count`` in a group of ``whole`` = N + smooth * V, exact for whole < 2^53."""
    quotient, rest = F.lit(0).cast("long"), count + smooth
    for step in SCALE_STEPS:
        digits = F.call_function("div", rest * step, whole)
        quotient, rest = quotient * step + digits, rest * step - digits * whole
    return quotient + 1


def shares(count: np.ndarray, whole: np.ndarray, smooth: int = SMOOTH) -> np.ndarray:
    """As ``share_column``."""
    quotient, rest = np.zeros(len(count), np.int64), count + smooth
    for step in SCALE_STEPS:
        digits, left = np.divmod(rest * step, whole)
        quotient, rest = quotient * step + digits, left
    return quotient + 1


class QuadTree:
    """A K²-tree (K = 2) over cells (row, col, value > 0) of a ``SIDE`` by ``SIDE`` matrix.

    ``child[l][4 * node + quadrant]``: the node below, or -1 where all is zero.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray):
        self.child: list[np.ndarray] = []
        node, nodes, half = np.zeros(len(row), np.int64), 1, SIDE // 2
        while half >= LEAF:
            quadrant = node * 4 + (row // half & 1) * 2 + (col // half & 1)
            bits = np.zeros(nodes * 4, bool)
            bits[quadrant] = True
            self.child.append(np.where(bits, np.cumsum(bits) - 1, -1))
            node, nodes, half = self.child[-1][quadrant], int(bits.sum()), half // 2
        self.leaves = np.zeros((nodes + 1, LEAF, LEAF), np.int64)  # the last one stands for a zero quadrant
        self.leaves[node, row % LEAF, col % LEAF] = value


def joint_distances(a: QuadTree, b: QuadTree, zero_a: np.ndarray, zero_b: np.ndarray, width: int) -> np.ndarray:
    """Sum over ``width`` terms of the differences of all pairs of a row of ``a`` and a row of ``b``.

    ``zero_a``, ``zero_b``: what a zero cell of each row is worth.
    """
    rows_a, rows_b = len(zero_a), len(zero_b)
    worth_a, worth_b = np.zeros(SIDE, np.int64), np.zeros(SIDE, np.int64)
    worth_a[:rows_a], worth_b[:rows_b] = zero_a, zero_b
    zeros = np.zeros((SIDE, SIDE), np.int64)  # terms that are zero in both rows
    node_a = node_b = at_a = at_b = at = np.zeros(1, np.int64)
    half = SIDE // 2
    for child_a, child_b in zip(a.child, b.child):
        parts = []
        for i in range(8):
            down_a, down_b, right = i >> 2, i >> 1 & 1, i & 1
            parts.append((
                np.where(node_a >= 0, child_a[4 * np.maximum(node_a, 0) + 2 * down_a + right], -1),
                np.where(node_b >= 0, child_b[4 * np.maximum(node_b, 0) + 2 * down_b + right], -1),
                at_a * 2 + down_a, at_b * 2 + down_b, at * 2 + right,
            ))
        node_a, node_b, at_a, at_b, at = (np.concatenate(x) for x in zip(*parts))
        inside = (at_a * half < rows_a) & (at_b * half < rows_b) & (at * half < width)
        both = inside & (node_a < 0) & (node_b < 0)
        level = np.zeros((SIDE // half, SIDE // half), np.int64)
        np.add.at(level, (at_a[both], at_b[both]), np.minimum(half, width - at[both] * half))
        zeros += level.repeat(half, axis=0).repeat(half, axis=1)
        go_on = inside & ~both
        node_a, node_b, at_a, at_b, at = (x[go_on] for x in (node_a, node_b, at_a, at_b, at))
        half //= 2
    out = zeros * np.abs(worth_a[:, None] - worth_b[None, :])
    blocked = np.zeros((SIDE // LEAF, SIDE // LEAF, LEAF, LEAF), np.int64)
    worth_a, worth_b = worth_a.reshape(-1, LEAF), worth_b.reshape(-1, LEAF)
    for s in range(0, len(at), LEAF_PAIRS):
        i, j, c = at_a[s : s + LEAF_PAIRS], at_b[s : s + LEAF_PAIRS], at[s : s + LEAF_PAIRS]
        leaf_a, leaf_b = a.leaves[node_a[s : s + LEAF_PAIRS]], b.leaves[node_b[s : s + LEAF_PAIRS]]
        leaf_a = np.where(leaf_a > 0, leaf_a, worth_a[i][:, :, None])
        leaf_b = np.where(leaf_b > 0, leaf_b, worth_b[j][:, :, None])
        part = np.abs(leaf_a[:, :, None, :] - leaf_b[:, None, :, :])
        part *= (c[:, None] * LEAF + np.arange(LEAF) < width)[:, None, None, :]
        np.add.at(blocked, (i, j), part.sum(axis=3))
    return (out + blocked.transpose(0, 2, 1, 3).reshape(SIDE, SIDE))[:rows_a, :rows_b]


_PAIRS = "lang string, a int, b int, value long"


def _tile(key: tuple, table: pa.Table) -> pa.Table:
    """Distances of all pairs of groups of two blocks over the terms of a tile. Rows without a term are the groups."""
    lang, block_a, block_b = key[0].as_py(), key[2].as_py(), key[3].as_py()
    listed = pc.is_null(table["term"])
    groups, cells = table.filter(listed), table.filter(pc.invert(listed))
    number, whole = groups["g"].to_numpy(), groups["whole"].to_numpy()
    order = np.argsort(number)
    number, whole = number[order], whole[order]
    sides = []
    zero = shares(np.zeros(len(whole), np.int64), np.maximum(whole, 1))
    terms = cells["term"].combine_chunks().dictionary_encode()
    terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
    col, g = terms.indices.to_numpy().astype(np.int64), cells["g"].to_numpy()
    at = np.searchsorted(number, g)
    value = shares(cells["n"].to_numpy(), whole[at])
    for block in (block_a, block_b):
        sides.append((number // SIDE == block, g // SIDE == block))
    (mine_a, cells_a), (mine_b, cells_b) = sides
    total = np.zeros((mine_a.sum(), mine_b.sum()), np.int64)
    for start in range(0, len(terms.dictionary), SIDE):
        width = min(SIDE, len(terms.dictionary) - start)
        here = (col >= start) & (col < start + width)
        trees = [QuadTree(g[m] % SIDE, col[m] - start, value[m]) for m in (here & cells_a, here & cells_b)]
        total += joint_distances(*trees, zero[mine_a], zero[mine_b], width)
    i, j = np.nonzero(number[mine_a][:, None] < number[mine_b][None, :])
    return pa.table(
        {
            "lang": pa.array([lang] * len(i), pa.string()), "a": pa.array(number[mine_a][i], pa.int32()),
            "b": pa.array(number[mine_b][j], pa.int32()), "value": pa.array(total[i, j], pa.int64()),
        }
    )


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Per group (lang, source) of ``docs`` its distance to each other source of the language, and the terms it uses more.

    lang, source, part, item, value, rank. Part ``pair``: item is the other
    source, value the sum over the language's kept terms of the differences of
    the two groups' shares (0 if it keeps none). Part ``term``: item is a term
    of the group whose share is above that in the whole language, value the
    difference, the ``top_terms`` highest. Ranks go from 1 by falling value,
    then by item in UTF-8 order.

    Null text, lang and source are empty; a group whose texts hold no term still
    takes part. Every row counts as a document, repeated ones too. Other columns
    are not looked at. An empty table gives an empty result.
    """
    cells = materialize(term_counts(docs, least_docs), "divergence-counts")
    totals = cells.groupBy("lang", "term").agg(F.sum("n").alias("total"))
    langs = totals.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    found = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    v = F.coalesce("v", F.lit(0).cast("long"))
    groups = found.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g"),
        v.alias("v"), (F.coalesce("n_group", F.lit(0).cast("long")) + SMOOTH * v).alias("whole"),
        (F.coalesce("n_lang", F.lit(0).cast("long")) + SMOOTH * v).alias("whole_lang"),
        F.greatest(F.lit(1).cast("long"), F.ceil(v / TILE_TERMS)).alias("tiles"),
        (F.call_function("div", F.count("*").over(Window.partitionBy("lang")) - 1, F.lit(SIDE)) + 1).alias("blocks"),
    )
    groups = materialize(groups, "divergence-groups")
    named = cells.join(groups, ["lang", "source"])

    rising = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    excess = share_column(F.col("n"), F.col("whole")) - share_column(F.col("total"), F.col("whole_lang"))
    terms = (
        named.join(totals, ["lang", "term"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess.alias("value"))
        .where(F.col("value") > 0).withColumn("rank", F.row_number().over(rising)).where(F.col("rank") <= top_terms)
    )

    # a cell goes to every pair of blocks that its group's block is in, a group also to every tile
    block = F.call_function("div", F.col("g"), F.lit(SIDE)).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other")
    sent = named.select(
        "lang", F.pmod(F.xxhash64("term"), F.col("tiles")).alias("tile"), "g", "term", "n", "whole", block.alias("block"), other
    ).unionByName(
        groups.select("lang", "tiles", "g", "whole", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"))
        .select("lang", "tile", "g", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "whole", block.alias("block"), other)
    )
    sent = sent.withColumn("block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other")).drop("block", "other")
    summed = sent.groupBy("lang", "tile", "block_a", "block_b").applyInArrow(_tile, _PAIRS).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = summed.select("lang", F.explode(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("h")), F.struct(F.col("b").alias("g"), F.col("a").alias("h")))).alias("p"), "value")
    pairs = (
        both.select("lang", "p.*", "value")
        .join(groups.select("lang", "g", "source"), ["lang", "g"])
        .join(groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(rising))
    )
    return pairs.unionByName(terms)
