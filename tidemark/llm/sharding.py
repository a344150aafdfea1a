"""Sharding by histogram sort.

The sort key is (hash of the text, doc_id, hash of the row), so that equal texts lie side by side, whatever
their source. A splitter is the key below which an equal share of the bytes lies. Splitters are found by counting:
each round counts bytes and rows in the cells between candidate boundaries, in parallel where the keys
lie, and refines only the cells in which a splitter falls, until the bytes below a boundary are within
``TOLERANCE`` of a shard of the target or the cell is one single key. Each shard is split further by the
same counts into parts that a task can sort. Then the rows are exchanged once, part by part, and a row's slot is
its place in its part plus the rows of the shard's earlier parts.

The law is ``bytes``: shard sizes differ by at most twice the tolerance and one row (or the rows that are equal in
every column). Equal texts are in one shard or, where a splitter falls among them, in neighbouring ones.

Defined cases: a null text counts 16 bytes and has a null checksum; rows equal in every column share a key and stay
together; a null doc_id sorts first; an empty table gives an empty result; extra columns pass
through, whatever their names, after the result's own columns.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.settings import stored

SHARDS = 40
OVERHEAD = 16
#: Bytes below a splitter may differ from the target by this share of a shard.
TOLERANCE = 0.002
#: Bytes that one part is planned for, and parts of a shard at most.
PART_BYTES = 64 << 20
PARTS = 256
#: Bits of the key that one round looks at.
BITS = 12
#: The key has three words of 63 bits.
WORDS = ("k0", "k1", "k2")
WORD_BITS = 63


def keyed(df: DataFrame) -> DataFrame:
    """``df`` as a struct column ``row`` with its size and the three words of its key."""
    positive = lambda c: c.bitwiseAND(F.lit((1 << WORD_BITS) - 1))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        size.alias("size"),
        positive(F.xxhash64(F.coalesce("text", F.lit("")))).alias("k0"),
        positive(F.coalesce(F.xxhash64(F.col("doc_id")), F.lit(0))).alias("k1"),
        positive(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in ("text",)], F.lit(7))).alias("k2"),
    )


class _Cell:
    """Keys with a common prefix of ``depth`` bits: those bits, and bytes and rows before the cell and in it."""

    def __init__(self, depth: int, prefix: tuple[int, ...], before: tuple[int, int], inside: tuple[int, int]):
        self.depth, self.prefix, self.before, self.inside = depth, prefix, before, inside


def _pieces(depth: int) -> list[tuple[str, int, int]]:
    """(word, shift, bits) that each round up to ``depth`` rounds looks at, from the key's first bits."""
    out = []
    for word in WORDS:
        left = WORD_BITS
        while left > 0:
            bits = min(BITS, left)
            left -= bits
            out.append((word, left, bits))
    return out[:depth]


def _digit(word: str, shift: int, bits: int):
    return F.shiftrightunsigned(F.col(word), shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


ROUNDS = len(_pieces(10**6))


def splitters(keys: DataFrame, targets: list[int], slack: int) -> list[tuple[tuple[int, int, int], int, int]]:
    """For each target (bytes below), the boundary as the words of a key, with the bytes and rows below it.

    Rows with smaller keys are below a boundary. Rounds go on for the targets whose best boundary is not within
    ``slack``. A round collects at most 2 ** BITS cells for each open cell, and once no open cell
    has more rows than that, its keys themselves, which ends the search.
    """
    found: dict[int, tuple[tuple[int, int, int], int, int]] = {}
    open_: dict[tuple[int, ...], list[int]] = {(): sorted(set(targets))}
    start: dict[tuple[int, ...], tuple[int, int, int]] = {(): (0, 0, keys.count())}
    for depth in range(1, ROUNDS + 1):
        if not open_:
            break
        digits = [_digit(*p).alias(f"d{i}") for i, p in enumerate(_pieces(depth))]
        named, above = keys.select("*", *digits), [f"d{i}" for i in range(depth - 1)]
        if depth > 1:  # only rows in cells that a splitter falls in
            wanted = keys.sparkSession.createDataFrame(list(open_), ", ".join(f"{d} int" for d in above))
            named = named.join(F.broadcast(wanted), above, "left_semi")
        last = depth == ROUNDS or max(start[p][2] for p in open_) <= 1 << BITS
        by = WORDS if last else (f"d{depth - 1}",)
        counted = named.groupBy(*above, *by).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        inside: dict[tuple[int, ...], list] = {}
        for r in counted.collect():
            key = tuple(r[c] for c in by)
            inside.setdefault(tuple(r[d] for d in above), []).append((key, r["bytes"], r["rows"]))
        next_open: dict[tuple[int, ...], list[int]] = {}
        next_start: dict[tuple[int, ...], tuple[int, int, int]] = {}
        for prefix, wanted_targets in open_.items():
            ordered = sorted(inside[prefix])
            below, rows, _ = start[prefix]
            edges = [(below, rows)]
            for _, b, n in ordered:
                below, rows = below + b, rows + n
                edges.append((below, rows))
            sums = [e[0] for e in edges]
            for target in wanted_targets:
                at = min(max(bisect_left(sums, target), 1), len(ordered))  # the cell ordered[at - 1] holds it
                low, high, key = edges[at - 1], edges[at], ordered[at - 1][0]
                upper = abs(high[0] - target) < abs(low[0] - target)
                if last:
                    found[target] = ((*key[:2], key[2] + 1), *high) if upper else (key, *low)
                elif min(abs(low[0] - target), abs(high[0] - target)) <= slack:
                    found[target] = (_below((*prefix, key[0] + upper)), *(high if upper else low))
                else:
                    cell = (*prefix, key[0])
                    next_open.setdefault(cell, []).append(target)
                    next_start[cell] = (*low, ordered[at - 1][2])
        open_, start = next_open, next_start
    return [found[t] for t in targets]


def _below(boundary: tuple[int, ...]) -> tuple[int, int, int]:
    """A boundary's digits as the three words of the smallest key that is not below it."""
    words, pieces = [0, 0, 0], _pieces(len(boundary))
    for digit, (word, shift, _) in zip(boundary, pieces, strict=True):
        words[WORDS.index(word)] += digit << shift
    for i in (2, 1):  # a digit one above the largest carries over
        if words[i] >> WORD_BITS:
            words[i] -= 1 << WORD_BITS
            words[i - 1] += 1
    return tuple(words)


def shard(df: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``df`` with law, shard, slot and grown_shard; needs the columns doc_id and text."""
    keys = stored(keyed(df).drop("row"), "keys")
    totals = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    per_shard = totals["bytes"] / shards
    parts = max(1, min(PARTS, int(-(-per_shard // PART_BYTES))))
    n = shards * parts
    targets = [round(totals["bytes"] * i / n) for i in range(1, n)]
    cuts = splitters(keys, targets, int(TOLERANCE * per_shard)) if totals["rows"] else []
    edges = sorted({(*c[0], c[2]) for c in cuts if c[2]})
    # Which part starts where: several splitters on one key leave the parts between them empty.
    bounds = [(0, 0, 0, 0)] + edges
    first_of = {}
    for i, c in enumerate(cuts, 1):
        first_of[(*c[0], c[2])] = i
    part_at = [0] + [first_of[e] for e in edges]
    rows_below = {}
    for at, bound in zip(part_at, bounds, strict=True):
        rows_below.setdefault(at // parts, bound[3])
    named = [(i, p // parts, b[3] - rows_below[p // parts]) for i, (p, b) in enumerate(zip(part_at, bounds, strict=True))]

    rows = keyed(df)
    place = F.lit(0)
    if edges:  # the boundary list is fixed by shards and PARTS; a binary search over it finds the part
        place = _search([e[:3] for e in edges])(*WORDS)
    spark = df.sparkSession
    offsets = F.broadcast(spark.createDataFrame(named, "part int, shard int, base long"))
    exchanged = rows.withColumn("part", place).repartition(max(1, len(bounds)), "part")
    order = Window.partitionBy("part").orderBy(*WORDS)
    out = exchanged.withColumn("at", F.row_number().over(order) - 1).join(offsets, "part")
    own = ["doc_id", "size", "law", "shard", "slot", "grown_shard"]
    others = [F.col("row").getField(c).alias(c) for c in df.columns if c not in own]
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("base") + F.col("at")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *others,
    )


def _search(edges: list[tuple[int, int, int]]):
    """A function of the key's words: how many of the sorted edges are at or below the key."""
    first = np.array([e[0] for e in edges], np.int64)

    @F.pandas_udf("int")
    def part(k0: pd.Series, k1: pd.Series, k2: pd.Series) -> pd.Series:
        low, high = np.searchsorted(first, k0, "left"), np.searchsorted(first, k0, "right")
        for i in np.flatnonzero(low != high):  # edges on this very first word: compare the others
            key = (int(k0.iloc[i]), int(k1.iloc[i]), int(k2.iloc[i]))
            low[i] += bisect_right(edges[low[i] : high[i]], key)
        return pd.Series(low, dtype="int32")

    return part


def sharded_digests(documents: DataFrame) -> DataFrame:
    return shard(documents.select("doc_id", "text")).select(
        "doc_id", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), "law", "shard", "slot", "grown_shard"
    )
