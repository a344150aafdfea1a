"""Near-duplicates by one-permutation MinHash, banded buckets and star-shaped candidates.

A document's set holds its distinct shingles (runs of k words; A-Z in lower case, words between ASCII white
space). One hash deals the set over ``BINS`` bins, the least hash of a bin is its value, and an empty bin
takes the value of the first filled bin in an order of its own (optimal densification), so that any two bins
still agree with the probability of the Jaccard similarity. ``BANDS`` bands of ``ROWS`` bins make the buckets:
two sets of similarity 0.8 share none with a probability of about 1e-9.

Equal sets become one representative first. In a bucket, each member is a candidate of the smallest
only: a star, as many pairs as members. Candidates are confirmed on their full sets, and each leaves its
difference from the centre: what it lacks of the centre's set and what it has besides. Two members may be linked
though neither is like their centre; so where the members of a centre are in more than one
component, those outside the largest are compared with all others, in blocks. From the differences the
intersection of two members' full sets follows exactly, and only links that join two components
leave a block. Components follow from the confirmed links.

Defined cases: with fewer words than k the whole sequence is one shingle; a null, empty or blank text has an
empty set and is linked with nothing; rows with the same doc_id are one node; a row with a null doc_id is linked
with nothing and kept; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    MIX,
    compact,
    free_name,
    hashes_of,
    in_batches,
    mix,
    rows_at_once,
    salted_join,
    shingles,
    signed,
    slices,
    texts,
    words_of,
)
from tidemark.llm.components import components
from tidemark.settings import stored

BINS, BANDS, ROWS = 256, 51, 5
PERCENT = 80
#: Members of a centre that are compared with so many others at a time.
BLOCK = 1_000
PAIR = "a long, b long, linked boolean, centre_size int, lacks binary, more binary"


def _orders() -> np.ndarray:
    """For each bin, the order in which it looks for a filled one."""
    return np.stack([np.random.default_rng(1000 + i).permutation(BINS) for i in range(BINS)]).astype(np.int64)


ORDERS = _orders()


def shingle_set(text: str, k: int) -> np.ndarray:
    return np.unique(shingles(hashes_of(words_of(text)), k))


def signature(found: np.ndarray) -> np.ndarray:
    """The bins' values of a sorted set that is not empty."""
    bins = (found >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    values, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], filled[bins[first]] = found[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = ORDERS[empty]
        values[empty] = values[order[np.arange(len(empty)), np.argmax(filled[order], axis=1)]]
    return values


def buckets(values: np.ndarray) -> np.ndarray:
    """One key for each band."""
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    table = values[: BANDS * ROWS].reshape(BANDS, ROWS)
    for i in range(ROWS):
        out = mix(out * MIX + table[:, i])
    return out


def _describe(k: int):
    def run(batches):
        for batch in slices(batches):
            n, keys, bands = [], [], []
            for text in texts(batch):
                found = shingle_set(text, k)
                n.append(len(found))
                if not len(found):
                    keys.append(None), bands.append(None)
                    continue
                keys.append(xxhash.xxh3_128_hexdigest(found.tobytes()))
                bands.append(signed(buckets(signature(found))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.string()),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    return run


def _confirm(k: int, percent: int):
    """Rows of PAIR: whether the full sets are similar enough, and how b's differs from a's."""

    def run(batches):
        recent: dict[int, np.ndarray] = {}
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(4)]
            for a, x, y in zip(batch.column("a").to_pylist(), texts(batch, "text_a"), texts(batch), strict=True):
                one = recent.get(a)
                if one is None:
                    if len(recent) >= 16:
                        recent.clear()
                    one = recent[a] = shingle_set(x, k)
                two = shingle_set(y, k)
                lacks = np.flatnonzero(~np.isin(one, two, assume_unique=True))
                more = two[~np.isin(two, one, assume_unique=True)]
                common = len(one) - len(lacks)
                linked = common > 0 and 100 * common >= percent * (len(one) + len(more))
                for column, value in zip(
                    out, (linked, len(one), lacks.astype("<u4").tobytes(), more.tobytes()), strict=True
                ):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(out[0], pa.bool_()), pa.array(out[1], pa.int32()),
                 pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                ["a", "b", "linked", "centre_size", "lacks", "more"],
            )

    return run


def confirmed(pairs: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows of PAIR for the pairs (a, b) of doc_ids, from their texts shingled anew."""
    pairs = stored(pairs, "pairs")
    total = pairs.count()
    # All documents are shuffled once, for the texts that take part; both sides are joined with those. The list
    # of ids has no bound, so it is never broadcast, and the plan is the same at every size.
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    wanted = compact(documents.join(wanted.hint("merge"), "doc_id"), "texts")
    with_b = compact(pairs.join(wanted.toDF("b", "text"), "b"), "texts")
    centre = wanted.toDF("a", "text_a")
    whole = salted_join(with_b, centre, "a", total).select("a", "text_a", "b", "text")
    return compact(in_batches(whole, _confirm(k, percent), PAIR), "links")


def linked_members(
    size: int, lacks: list[np.ndarray], more: list[np.ndarray], label: np.ndarray, turn: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Pairs (i, j) of members that are linked and join two components; i only where ``turn`` says so.

    With L and M for what a member lacks of the centre's ``size`` shingles and has besides, two members have
    size - |L1| - |L2| + |L1 and L2| + |M1 and M2| shingles in common.
    """
    n = len(lacks)
    owner = np.repeat(np.arange(n), [len(x) + len(y) for x, y in zip(lacks, more, strict=True)])
    parts = [z for x, y in zip(lacks, more, strict=True) for z in (x.astype(np.uint64), y)]
    _, item = np.unique(np.concatenate(parts), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    order = np.argsort(item, kind="stable")
    holders, ends = owner[order], np.concatenate([[0], np.cumsum(np.bincount(item))])
    short = np.array([len(x) for x in lacks])
    sizes = size - short + np.array([len(x) for x in more])
    root = {int(x): int(x) for x in np.unique(label)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in np.flatnonzero(turn):
        own = item[begin[i] : begin[i + 1]]
        shared = np.zeros(n, np.int64)
        if len(own):
            shared += np.bincount(np.concatenate([holders[ends[x] : ends[x + 1]] for x in own]), minlength=n)
        common = size - short[i] - short + shared
        hit = (common > 0) & (100 * common >= percent * (sizes[i] + sizes - common)) & (label != label[i])
        for j in np.flatnonzero(hit):
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(i), int(j)))
    return out


def _links_of_members(pairs: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one centre that join two components."""
    named = pairs.drop("linked").join(labels.select(F.col("node").alias("b"), "label"), "b", "left")
    named = named.withColumn("label", F.coalesce("label", "b"))
    by_label = named.groupBy("a", "label").count()
    largest = by_label.groupBy("a").agg(
        F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("n"), F.count("*").alias("labels")
    )
    open_ = stored(
        largest.where("labels > 1").select("a", "n", (F.col("n") - F.col("top.count")).alias("others"), "top.label")
        .withColumnRenamed("label", "top"),
        "open",
    )
    if open_.isEmpty():
        return open_.select("a", F.col("a").alias("b")).where("false")
    members = compact(named.join(open_, "a"), "members")
    groups = max(1, members.count() // (4 * BLOCK))
    number = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    place = lambda c: F.pmod(F.xxhash64("b"), number(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), number(c) - 1))
    outside = members.where("label <> top").withColumn("asks", F.lit(True))
    outside = outside.withColumn("x", place("others")).withColumn("y", every("n"))
    whole = members.withColumn("asks", F.lit(False)).withColumn("y", place("n")).withColumn("x", every("others"))
    met = outside.unionByName(whole)
    alone = (number("n") == 1) & (number("others") == 1)
    where = F.when(alone, F.pmod(F.xxhash64("a"), F.lit(groups))).otherwise(F.xxhash64("a", "x", "y"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, part in frame.groupby(["a", "x", "y"]):
            part = part.sort_values(["asks", "b"], ascending=[False, True]).drop_duplicates("b")
            node = part["b"].to_numpy()
            pairs_ = linked_members(
                int(part["centre_size"].iloc[0]),
                [np.frombuffer(x, "<u4") for x in part["lacks"]],
                [np.frombuffer(x, np.uint64) for x in part["more"]],
                part["label"].to_numpy(), part["asks"].to_numpy(), percent,
            )
            found += [(min(node[i], node[j]), max(node[i], node[j])) for i, j in pairs_]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rows_at_once(members, 2_000)
    met = met.select("a", "b", "label", "centre_size", "lacks", "more", "asks", "x", "y", where.alias("place"))
    return met.groupBy("place").applyInPandas(compare, "a long, b long")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents``."""
    documents = documents.select("doc_id", "text")
    described = in_batches(
        documents, _describe(k),
        "doc_id long, n_shingles long, set_key string, bands array<long>",
    )
    described = stored(described, "signatures")
    rows = described.select("doc_id", "n_shingles", "set_key")
    sets = described.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    reps = stored(sets.groupBy("set_key").agg(F.min("doc_id").alias("node")), "representatives")
    by_node = sets.select(
        F.col("doc_id").alias("node"), "bands", "set_key"
    ).dropDuplicates(["node", "set_key"])
    nodes = stored(by_node.join(reps, ["node", "set_key"]).drop("set_key"), "nodes")

    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    stars = banded.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n"))
    stars = stored(stars.where("n > 1").select("bucket", "a"), "stars")
    candidates = banded.join(stars, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    pairs = confirmed(candidates, documents, k, percent)
    links = pairs.where("linked").select("a", "b").distinct()
    labels = components(links)
    more = stored(_links_of_members(pairs, labels, percent), "more")
    if not more.isEmpty():
        labels = components(links.union(more))

    final = stored(reps.join(labels, "node", "left").select(
        "set_key", F.coalesce("label", "node").alias("component")
    ), "components")
    out = salted_join(rows, final, "set_key", how="left")
    component = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def kept_documents(documents: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` of which one per group of near-duplicates stays, with all their columns."""
    gone_id = free_name(documents.columns, "gone_id")
    gone = near_duplicates(documents, k, percent).where(~F.col("kept")).select(F.col("doc_id").alias(gone_id))
    return documents.join(gone.distinct().hint("merge"), F.col("doc_id") == F.col(gone_id), "left_anti")
