"""Approximate nearest neighbours along shifted Hilbert curves.

A bounded sample of ``SAMPLE`` vectors gives a centre and the principal directions, which are dealt over ``CURVES``
curves: curve c takes the directions c, c + CURVES, ..., at most ``DIMS`` of them. A vector's projection, shifted by
the curve's own random offset, falls into a cell of a grid whose Hilbert index is its key on that curve. Spark
range-partitions (curve, key, vector, vec_id); each partition packs its rows in order into blocks of ``BLOCK``, a row
as one byte a component with its scale and the exact length of what rounding lost.

A query's window are the ``reach`` places before and after its own on each curve; the queries of a block share a
window, and the windows of all curves are merged. Rounded rows give a lower and an upper bound of each distance, so
only rows that may be among the k nearest of the windows leave a block; those are reranked on the original vectors
in double precision.

``reach`` is measured, not set: up to ``TRIALS`` queries (those of smallest hash) are compared with every row, and
``reach`` is the smallest one whose windows hold ``RECALL`` of their true neighbours. Tables without structure need
wide windows for that, and get them.

Every row is indexed. Of rows with equal vectors no neighbour list can hold more than the k + 1 smallest ids, so a
run of equal vectors keeps that many in each partition, and a large group of copies does not push others out of a
window; its other rows still ask.

Defined cases: a row whose id or vector is null, or whose vector is zero, empty or holds null or non-finite
components takes no part; missing components of shorter vectors count as zero; rows with the query's own vec_id are
not its candidates; of rows that share a vec_id all are asked and indexed, and a pair counts once, at its smallest
distance; equal distances go to the smaller vec_id; a query without candidates has no rows. Extra columns play no
part. Distances beyond the range of doubles are infinite.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import salted_join
from tidemark.settings import stored

CURVES = 4
DIMS = 8
BITS = 7
BLOCK = 2_048
SAMPLE = 4_096
TRIALS = 256
RECALL = 0.95
SEED = 20
#: Vectors turned into numbers at a time.
CHUNK = 4_096


def usable(vectors: DataFrame, is_query: Column) -> DataFrame:
    """(vec_id, v array<double>, asks) of the rows that take part."""
    fine = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    zero = F.expr("forall(embedding, x -> x = 0)")
    takes_part = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    return vectors.where(takes_part & fine & ~zero).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as one matrix, shorter ones filled with zeros, longer ones cut off."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = np.asarray(lists.flatten(), dtype=float)
    sizes = np.diff(np.asarray(lists.offsets))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    begin = np.cumsum(sizes) - sizes
    for i, (at, size) in enumerate(zip(begin, np.minimum(sizes, width))):
        out[i, :size] = flat[at : at + size]
    return out


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The Hilbert index of each row of whole-number coordinates below 2**bits; columns * bits is at most 63.

    Bit by bit from the highest, a row's octant is written down as a Gray code and the lower bits are
    reflected and swapped into the orientation of that octant.
    """
    rest = cells.astype(np.uint64, copy=True)
    rows, dims = rest.shape
    if not dims:
        return np.zeros(rows, np.int64)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        low = (one << np.uint64(level)) - one
        for d in range(dims):
            inside = (rest[:, d] >> np.uint64(level)) & one == 1
            swapped = np.where(inside, np.uint64(0), (rest[:, 0] ^ rest[:, d]) & low)
            rest[:, 0] ^= np.where(inside, low, swapped)
            rest[:, d] ^= swapped
    rest = np.bitwise_xor.accumulate(rest, axis=1)
    turned = np.zeros(rows, np.uint64)
    for level in range(bits - 1, 0, -1):
        last = (rest[:, -1] >> np.uint64(level)) & one == 1
        turned ^= np.where(last, (one << np.uint64(level)) - one, np.uint64(0))
    rest ^= turned[:, None]
    key = np.zeros(rows, np.uint64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << one) | ((rest[:, d] >> np.uint64(level)) & one)
    return key.astype(np.int64)


class Curves:
    """Centre, directions and offsets of the curves, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, width: int, curves: int = CURVES):
        with np.errstate(all="ignore"):
            self.width = width
            self.centre = np.nan_to_num(sample.mean(0)) if len(sample) else np.zeros(width)
            spread = np.nan_to_num(sample - self.centre)
            scale = np.abs(spread).max(initial=0) or 1.0
            _, columns = np.linalg.eigh((spread / scale).T @ (spread / scale))
            columns = columns[:, ::-1]
            self.turns = [columns[:, c % width :: curves][:, :DIMS] for c in range(curves)]
            random = np.random.default_rng(SEED)
            reach = [np.abs(spread @ t).max(initial=0) for t in self.turns]
            self.half = (max(reach) or 1.0) * 1.05
            self.offsets = [random.random(t.shape[1]) * 2 * self.half for t in self.turns]

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        """Keys on one curve; what lies outside the grid belongs to the cells of its edge."""
        with np.errstate(all="ignore"):
            cells = ((x - self.centre) @ self.turns[curve] + self.half + self.offsets[curve]) / (4 * self.half)
            cells = np.clip(np.nan_to_num(cells), 0, 1 - 1e-12) * (1 << BITS)
        return hilbert_keys(cells.astype(np.uint64), BITS)


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, loss): scale * codes is within ``loss`` of each row."""
    with np.errstate(all="ignore"):
        scale = (np.abs(x).max(axis=1, initial=0) / 127).astype(np.float32)
    scale[(scale < 1e-30) | ~np.isfinite(scale)] = 1.0
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    # The lengths are rounded up a little, as they are computed in floating point.
    loss = np.sqrt(((x - codes * scale[:, None].astype(float)) ** 2).sum(1)) * (1 + 1e-9)
    return codes, scale, np.nextafter(loss.astype(np.float32), np.float32(np.inf))


def bounds(q: np.ndarray, codes: np.ndarray, scale: np.ndarray, loss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between exact and rounded rows."""
    with np.errstate(all="ignore"):
        near = codes * scale[:, None].astype(float)
        squares = (q * q).sum(1)[:, None] + (near * near).sum(1)[None, :]
        between = squares - 2 * (q @ near.T)
        slack = 1e-12 * squares * max(1, q.shape[1])
        low = np.sqrt(np.maximum(between - slack, 0)) * (1 - 1e-12) - loss
        high = np.sqrt(np.maximum(between + slack, 0)) * (1 + 1e-12) + loss
    wild = ~np.isfinite(low)
    low[wild], high[wild] = 0.0, np.inf
    return low, high


ENTRY = "curve int, key long, same int, vec_id long, scale float, loss float, code binary, q binary"
BLOCKS = pa.schema(
    [("curve", pa.int32()), ("part", pa.int32()), ("number", pa.int32()), ("n", pa.int32())]
    + [(c, pa.binary()) for c in ("ids", "codes", "scale", "loss", "q_ids", "q_at", "q", "q_limit")]
)


def _entries(curves: Curves):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x = matrix(batch.column("v"), curves.width)
                codes, scale, loss = rounded(x)
                asks = np.asarray(batch.column("asks").to_numpy(zero_copy_only=False), bool)
                code = pa.array([c.tobytes() for c in codes], pa.binary())
                exact = pa.array([v.tobytes() if a else None for v, a in zip(x, asks)], pa.binary())
                for curve in range(len(curves.turns)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(x), curve, np.int32)), pa.array(curves.keys(x, curve)),
                            batch.column("same"), batch.column("vec_id"), pa.array(scale), pa.array(loss), code, exact,
                        ],
                        ["curve", "key", "same", "vec_id", "scale", "loss", "code", "q"],
                    )

    return run


class _Block:
    """Neighbouring rows of one curve, with the queries among them and what their own block promises them."""

    def __init__(self, curve: int, part: int, number: int):
        self.curve, self.part, self.number = curve, part, number
        self.ids, self.codes, self.scale, self.loss = [], [], [], []
        self.q_ids, self.q_at, self.q = [], [], []

    def row(self, width: int, k: int) -> dict:
        ids, scale, loss = np.array(self.ids, np.int64), np.array(self.scale, np.float32), np.array(self.loss, np.float32)
        codes, q_ids, q = b"".join(self.codes), np.array(self.q_ids, np.int64), b"".join(self.q)
        _, high = bounds(_rows(q, float, width), _rows(codes, np.int8, width), scale, loss)
        high[q_ids[:, None] == ids[None, :]] = np.inf
        return {
            "curve": self.curve, "part": self.part, "number": self.number, "n": len(ids), "ids": ids.tobytes(),
            "codes": codes, "scale": scale.tobytes(), "loss": loss.tobytes(), "q_ids": q_ids.tobytes(),
            "q_at": np.array(self.q_at, np.int32).tobytes(), "q": q, "q_limit": kth_distinct(high, ids, k).tobytes(),
        }


def _rows(raw: bytes, kind, width: int) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(-1, width)


def _packs(width: int, k: int, size: int):
    """Packs a partition in order into blocks; a run of equal vectors keeps its first k + 1 ids."""

    def run(batches):
        block, last, kept, last_id = None, None, 0, None
        for batch in batches:
            done = []
            for curve, key, same, vec_id, scale, loss, code, q, part in zip(*[c.to_pylist() for c in batch.columns]):
                if block is None or block.curve != curve or len(block.ids) >= size:
                    if block is not None:
                        done.append(block.row(width, k))
                    number = block.number + 1 if block is not None and block.curve == curve else 0
                    block = _Block(curve, part, number)
                alike = (curve, key, same, code, scale, loss)
                if alike != last:
                    last, kept, last_id = alike, 0, None
                if kept <= k and vec_id != last_id:
                    kept += 1
                    block.ids.append(vec_id)
                    block.codes.append(code)
                    block.scale.append(scale)
                    block.loss.append(loss)
                if q is not None and vec_id != last_id:
                    block.q_ids.append(vec_id)
                    block.q_at.append(max(0, len(block.ids) - 1))
                    block.q.append(q)
                last_id = vec_id
                if len(block.q_ids) >= size:  # a run of copies that all ask
                    done.append(block.row(width, k))
                    block = _Block(curve, part, block.number + 1)
            if done:
                yield pa.RecordBatch.from_pylist(done, BLOCKS)
        if block is not None:
            yield pa.RecordBatch.from_pylist([block.row(width, k)], BLOCKS)

    return run


def kth_distinct(high: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th smallest of each row over distinct ids; infinite where there are fewer."""
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0]) if len(ids) else []
    if len(starts) < k:
        return np.full(len(high), np.inf)
    best = np.minimum.reduceat(high[:, order], starts, axis=1)
    return np.partition(best, k - 1, axis=1)[:, k - 1]


def _nearest_sample(asked: list[tuple[int, list[float]]], width: int, k: int):
    """Up to k nearest rows of a partition for each sampled query, by exact distance."""
    ids = np.array([i for i, _ in asked], np.int64)
    q = np.zeros((len(asked), width))
    for i, (_, v) in enumerate(asked):
        q[i, : len(v)] = v

    def run(batches):
        held = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                             "score": pd.Series(dtype=float)})
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x, own = matrix(batch.column("v"), width), batch.column("vec_id").to_numpy()
                found = [held]
                for i in range(len(ids)):
                    with np.errstate(all="ignore"):
                        d = np.sqrt(((x - q[i]) ** 2).sum(1))
                    other = own != ids[i]
                    if not other.any():
                        continue
                    limit = np.partition(d[other], min(k, other.sum()) - 1)[min(k, other.sum()) - 1]
                    near = np.flatnonzero(other & (d <= limit))
                    found.append(pd.DataFrame({"query_id": ids[i], "vec_id": own[near], "score": d[near]}))
                held = pd.concat(found).sort_values(["query_id", "score", "vec_id"])
                held = held[~held.duplicated(["query_id", "vec_id"])].groupby("query_id").head(k)
        if len(held):
            yield pa.RecordBatch.from_pandas(held, preserve_index=False)

    return run


def _places(wanted: np.ndarray):
    """Where the wanted ids lie: (curve, part, number, row, vec_id), as candidates and as queries."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                for ids, at in (
                    (np.frombuffer(r["ids"], np.int64), None),
                    (np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_at"], np.int32)),
                ):
                    here = np.flatnonzero(np.isin(ids, wanted))
                    for i in here:
                        row = int(i if at is None else at[i])
                        out.append((r["curve"], r["part"], r["number"], row, int(ids[i]), at is not None))
            names = ["curve", "part", "number", "row", "vec_id", "asks"]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def _survivors(width: int, k: int):
    """The rows of a block that may be among the k nearest of the queries that meet it."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
                scale, loss = np.frombuffer(r["scale"], np.float32), np.frombuffer(r["loss"], np.float32)
                low, high = bounds(_rows(r["q"], float, width), _rows(r["codes"], np.int8, width), scale, loss)
                own = q_ids[:, None] == ids[None, :]
                high[own] = np.inf
                limit = np.minimum(kth_distinct(high, ids, k), np.frombuffer(r["q_limit"], float))
                rows, columns = np.nonzero((low <= limit[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[rows]), pa.array(ids[columns]), pa.array(low[rows, columns]),
                     pa.array(high[rows, columns])],
                    ["query_id", "vec_id", "low", "high"],
                )

    return run


class Index:
    """Blocks of rows along every curve, and the place at which each block starts."""

    def __init__(self, vectors: DataFrame, is_query: Column, k: int = 10, curves: int = CURVES):
        self.k = k
        self.rows = usable(vectors, is_query)
        self.asked = self.rows.where("asks")
        self.width = self.rows.agg(F.max(F.size("v"))).first()[0] or 1
        sample = self.rows.select("v").orderBy(F.xxhash64("vec_id", "v"), "v").limit(SAMPLE).toArrow()  # a fixed number
        fitted = Curves(matrix(sample.column("v"), self.width), self.width, curves)
        places = ["curve", "key", "same", "vec_id"]
        entries = (
            self.rows.withColumn("same", F.hash("v"))
            .mapInArrow(_entries(fitted), ENTRY)
            .repartitionByRange(*places)
            .sortWithinPartitions(*places)
            .withColumn("part", F.spark_partition_id())
        )
        types = ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in BLOCKS)
        packed = stored(entries.mapInArrow(_packs(self.width, k, BLOCK), types), "curves")
        # Places run on over the partitions of a curve, of which there are as many as tasks wrote.
        sizes = packed.groupBy("curve", "part").agg(F.sum("n").alias("n"))
        before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        first = sizes.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
        inside = Window.partitionBy("curve", "part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
        inner = packed.select(
            "curve", "part", "number", "n", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inner")
        )
        starts = inner.join(first, ["curve", "part"])
        starts = starts.select("curve", "part", "number", "n", (F.col("first") + F.col("inner")).alias("start"))
        self.packed, self.starts = packed, stored(starts, "starts")

    def reach(self, recall: float = RECALL, trials: int = TRIALS) -> int:
        """The smallest reach whose windows hold ``recall`` of the true neighbours of the sampled queries."""
        chosen = self.asked.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(trials).collect()
        asked = list({r["vec_id"]: (r["vec_id"], r["v"]) for r in chosen}.values())
        if not asked:
            return 0
        near = self.rows.select("vec_id", "v").mapInArrow(
            _nearest_sample(asked, self.width, self.k), "query_id long, vec_id long, score double"
        )
        near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        true = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= self.k).toPandas()  # trials * k
        wanted = np.unique(np.r_[true["vec_id"], true["query_id"]].astype(np.int64))
        found = self.packed.select("curve", "part", "number", "ids", "q_ids", "q_at").mapInArrow(
            _places(wanted), "curve int, part int, number int, row int, vec_id long, asks boolean"
        )
        found = found.join(self.starts, ["curve", "part", "number"])
        found = found.select("curve", "vec_id", "asks", (F.col("start") + F.col("row")).alias("place")).toPandas()
        mine = found[found["asks"]].rename(columns={"vec_id": "query_id"})
        both = true.merge(mine, on="query_id").merge(found[~found["asks"]], on=["vec_id", "curve"])
        gap = (both["place_x"] - both["place_y"]).abs().groupby([both["query_id"], both["vec_id"]]).min()
        gaps = np.sort(gap.to_numpy())
        return int(gaps[max(0, int(np.ceil(recall * len(gaps))) - 1)]) if len(gaps) else 0

    def nearest(self, reach: int) -> DataFrame:
        """query_id, rank, vec_id, score: the k nearest rows in the windows of each query."""
        placed = self.packed.join(self.starts.select("curve", "part", "number", "start"), ["curve", "part", "number"])
        # A block is filed under the slot in which it starts, so a window looks one slot further down.
        slot = F.floor(F.col("start") / BLOCK).cast("long")
        blocks = placed.where(F.col("n") > 0).select("curve", slot.alias("slot"), "ids", "codes", "scale", "loss")
        lowest = F.greatest(F.floor((F.col("start") - reach) / BLOCK) - 1, F.lit(0)).cast("long")
        highest = F.floor((F.col("start") + F.col("n") + reach) / BLOCK).cast("long")
        asking = placed.where(F.length("q_ids") > 0)
        visits = asking.select(
            "curve", "q_ids", "q", "q_limit", F.explode(F.sequence(lowest, highest)).alias("slot")
        )
        met = visits.join(blocks, ["curve", "slot"])
        pairs = met.mapInArrow(
            _survivors(self.width, self.k), "query_id long, vec_id long, low double, high double"
        )
        pairs = pairs.groupBy("query_id", "vec_id").agg(F.min("low").alias("low"), F.min("high").alias("high"))
        by_high = Window.partitionBy("query_id").orderBy("high", "vec_id")
        whole = Window.partitionBy("query_id")
        limit = F.min(F.when(F.col("at") == self.k, F.col("high"))).over(whole)
        pairs = pairs.withColumn("at", F.row_number().over(by_high)).withColumn("limit", limit)
        pairs = pairs.where(F.col("limit").isNull() | (F.col("low") <= F.col("limit"))).select("query_id", "vec_id")
        pairs = stored(pairs, "pairs")

        # Reranked on the original vectors; a vector that many queries share is joined in parts.
        c = self.rows.select("vec_id", F.col("v").alias("c"))
        q = self.asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
        full = salted_join(pairs, c, "vec_id").join(q, "query_id")
        zero = F.lit(0.0)
        parts = F.zip_with("q", "c", lambda a, b: F.coalesce(a, zero) - F.coalesce(b, zero))
        score = F.sqrt(F.aggregate(parts, zero, lambda total, d: total + d * d))
        scored = full.select("query_id", "vec_id", score.alias("score")).groupBy("query_id", "vec_id")
        best = Window.partitionBy("query_id").orderBy("score", "vec_id")
        ranked = scored.agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(best))
        return ranked.where(F.col("rank") <= self.k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, recall: float = RECALL,
                       curves: int = CURVES) -> DataFrame:
    """query_id, rank, vec_id, score: up to k near rows of each row for which ``is_query`` holds."""
    index = Index(vectors, is_query, k, curves)
    return index.nearest(index.reach(recall))
