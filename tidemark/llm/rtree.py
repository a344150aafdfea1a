"""Hard negatives by best-first search in an R-tree packed by sort-tile-recursive.

Components are floor(256 * x), scores whole-number inner products. Spark tiles the rows of each label: the
coordinate of largest variance cuts them into slabs of equal counts, the second each slab, the third each of those,
until a tile holds about ``SUBTREE`` rows; a tile that ties left larger is dealt by hash. Each tile becomes a subtree,
packed in numpy by the same rule over the next coordinates into leaves of ``LEAF`` rows. Leaves and subtrees have
minimum bounding boxes; boxes of subtrees lie in directory pages of ``PAGE``.

A box gives an interval for each coordinate's product with an anchor, and their sums bound the scores inside. A box is
opened only if for some wanted window the bounds meet the window and the upper one is not strictly below the k-th
best score so far. The best boxes are opened first: inside a subtree in waves of 1, 2, 4, ... leaves an anchor, and
over subtrees in two waves, about the square root of their number first, then what the better bounds leave.

Positives: the first search, one unbounded window over the anchor's own label, begun in the anchor's own subtree.
Negatives: the second, one window for each positive over the other labels. Anchors of one subtree travel as a block, and blocks meet
directory pages and subtrees through equi-joins.

Defined cases: a row whose id, label or vector is null, or whose vector holds null or non-finite components, takes
no part; an empty vector has the score 0 with all; missing components of shorter vectors count as zero; of rows that
share a vec_id the one of smallest (label, numbers) takes part, so repeated rows count once; equal scores go to the
smaller vec_id; an anchor without positives, and a positive without negatives, has no rows; where scores may leave
64 bits they wrap, and nothing is pruned by the boxes. Extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.settings import stored

SCALE = 256
SUBTREE = 4_096
LEAF = 128
PAGE = 256
#: Slabs of a label are told apart by so many quantiles; larger tiles are dealt by hash.
GRID = 64
EXACT = float(1 << 53)
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
KEY = ["label", "tile", "chunk"]
KEY_DDL = "label long, tile long, chunk int"
FOUND_DDL = f"{KEY_DDL}, anchor_id long, wanted int, vec_id long, score long"


def usable(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """(vec_id, label, v array<long>, asks) of the rows that take part."""
    fine = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return vectors.where(takes_part & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )


def _matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _moments(batches):
    for batch in batches:
        x = _matrix(batch.column("v")).astype(float)
        at = np.arange(x.shape[1], dtype=np.int32)
        sums = [x.sum(0), (x * x).sum(0), np.abs(x).max(axis=0, initial=0)]
        yield pa.RecordBatch.from_arrays([pa.array(at), *map(pa.array, sums)], ["at", "s", "ss", "most"])


def _codes(width: int, kind, axes: list[int]):
    """Rows as bytes, with the coordinates by which they are tiled."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            code = pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "asks")), code, *(pa.array(x[:, a]) for a in axes)],
                ["vec_id", "label", "asks", "code", *(f"c{i}" for i in range(len(axes)))],
            )

    return run


# -- searching one subtree ------------------------------------------------------------------


def products(q: np.ndarray, c: np.ndarray, exact: bool) -> np.ndarray:
    """Whole-number products; through floats where those are exact."""
    return (q.astype(float) @ c.T.astype(float)).astype(np.int64) if exact else q @ c.T


def is_exact(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> bool:
    """Whether all products with rows inside the boxes are whole numbers that floats hold exactly."""
    sides = np.maximum(np.abs(lo.astype(float)), np.abs(hi.astype(float))).max(axis=0, initial=0)
    return float((np.abs(q.astype(float)) * sides).sum(1).max(initial=0)) < EXACT


def intervals(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each query with any row in each box."""
    if not is_exact(q, lo, hi):
        whole = np.full((len(q), len(lo)), np.inf)
        return -whole, whole
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    lo, hi = lo.astype(float), hi.astype(float)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def open_boxes(least, greatest, low, high, kth) -> np.ndarray:
    """Which boxes may hold a row of some window that is not strictly below the window's k-th best."""
    out = np.zeros(least.shape, bool)
    for j in range(low.shape[1]):
        wanted = (low[:, j] <= high[:, j])[:, None]
        meets = (greatest >= low[:, j, None]) & (least <= high[:, j, None])
        out |= wanted & meets & (np.minimum(greatest, high[:, j, None]) >= kth[:, j, None])
    return out


def best(asker: np.ndarray, wanted: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each (asker, window), in order."""
    order = np.lexsort((ids, ~scores, wanted, asker))
    group = (asker[order] != np.roll(asker[order], 1)) | (wanted[order] != np.roll(wanted[order], 1))
    if len(order):
        group[0] = True
    begin = np.flatnonzero(group)
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.r_[begin, len(order)]))
    return order[rank < k]


def search(q_ids, q, low, high, kth, k, ids, codes, starts, lo, hi):
    """(asker, window, id, score) of the k best rows of one subtree in each window of each asker.

    ``low``, ``high`` and ``kth`` are (askers, windows); rows below ``kth`` are of no use. ``starts`` are the first
    rows of the leaves, ``lo`` and ``hi`` their boxes.
    """
    least, greatest = intervals(q, lo, hi)
    exact = is_exact(q, lo, hi)
    ends = np.r_[starts[1:], len(ids)]
    kth, closed = kth.copy(), np.ones(least.shape, bool)
    held = [np.zeros(0, np.int64) for _ in range(4)]
    wave = 1
    while True:
        alive = open_boxes(least, greatest, low, high, kth) & closed
        if not alive.any():
            break
        rank = np.where(alive, -greatest, np.inf)
        if wave < rank.shape[1]:
            limit = np.partition(rank, wave - 1, axis=1)[:, wave - 1]
            alive &= rank <= limit[:, None]
        wave *= 2
        closed &= ~alive
        floor = np.maximum(low, kth)
        least_wanted = np.where(low <= high, floor, HIGHEST).min(axis=1)
        most_wanted = np.where(low <= high, high, LOWEST).max(axis=1)
        found = [held]
        for leaf in np.flatnonzero(alive.any(0)):
            rows = np.flatnonzero(alive[:, leaf])
            at = slice(starts[leaf], ends[leaf])
            scores = products(q[rows], codes[at], exact)
            r, c = np.nonzero((scores >= least_wanted[rows, None]) & (scores <= most_wanted[rows, None]))
            score, asker, other = scores[r, c], rows[r], ids[at][c]
            for j in range(low.shape[1]):
                good = (score >= floor[asker, j]) & (score <= high[asker, j]) & (other != q_ids[asker])
                found.append([asker[good], np.full(int(good.sum()), j), other[good], score[good]])
        held = [np.concatenate(x) for x in zip(*found)]
        kept = best(*held, k)
        held = [x[kept] for x in held]
        last = np.flatnonzero(np.r_[(np.diff(held[0]) != 0) | (np.diff(held[1]) != 0), True]) if len(kept) else []
        if len(kept):
            size = np.diff(np.r_[-1, last])
            full = last[size == k]
            kth[held[0][full], held[1][full]] = np.maximum(kth[held[0][full], held[1][full]], held[3][full])
    return held


# -- packing ------------------------------------------------------------------------------


def _tiles(x: np.ndarray, rows: np.ndarray, axes: np.ndarray, leaves: int) -> list[np.ndarray]:
    """Sort-tile-recursive: rows cut into slabs of equal counts along one axis after the other."""
    if leaves <= 1 or len(rows) <= 1:
        return [rows]
    if not len(axes):
        return np.array_split(rows, leaves)
    slabs = int(np.ceil(leaves ** (1 / min(len(axes), 3)) - 1e-9))
    ordered = rows[np.argsort(x[rows, axes[0]], kind="stable")]
    out = []
    for slab in np.array_split(ordered, max(2, slabs)):
        out += _tiles(x, slab, axes[1:], -(-leaves // max(2, slabs)))
    return out


def leaves_of(ids: np.ndarray, x: np.ndarray, size: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of rows, first row of each leaf, least and greatest corner of each leaf)."""
    order = np.argsort(ids, kind="stable")
    axes = np.argsort(-x.astype(float).var(0), kind="stable")
    tiles = [t for t in _tiles(x, order, axes, -(-len(ids) // size)) if len(t)]
    starts = np.cumsum([0] + [len(t) for t in tiles[:-1]])
    rows = np.concatenate(tiles)
    return rows, starts, np.minimum.reduceat(x[rows], starts, axis=0), np.maximum.reduceat(x[rows], starts, axis=0)


PACKED = (
    f"{KEY_DDL}, ids binary, codes binary, starts binary, lo binary, hi binary, box_lo binary, box_hi binary, "
    "q_ids binary, q binary, kth binary"
)


def _pack(width: int, kind, positives: int, leaf: int):
    def run(key, rows):
        ids = rows.column("vec_id").to_numpy()
        x = np.frombuffer(b"".join(rows.column("code").to_pylist()), kind).reshape(-1, width).astype(np.int64)
        asks = rows.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        order, starts, lo, hi = leaves_of(ids, x, leaf)
        ids, x, asks = ids[order], x[order], asks[order]
        q_ids, q = ids[asks], x[asks]
        # What the anchor's own subtree promises: its k-th best positive there.
        free = np.full((len(q), 1), LOWEST)
        held = search(q_ids, q, free, np.full((len(q), 1), HIGHEST), free, positives, ids, x, starts, lo, hi)
        kth = free.copy()
        last = np.flatnonzero(np.r_[np.diff(held[0]) != 0, True]) if len(held[0]) else np.zeros(0, int)
        full = last[np.diff(np.r_[-1, last]) == positives]
        kth[held[0][full], 0] = held[3][full]
        row = {
            "ids": ids.tobytes(), "codes": x.astype(kind).tobytes(), "starts": starts.astype(np.int64).tobytes(),
            "lo": lo.tobytes(), "hi": hi.tobytes(), "box_lo": lo.min(0).tobytes(), "box_hi": hi.max(0).tobytes(),
            "q_ids": q_ids.tobytes(), "q": q.astype(kind).tobytes(), "kth": kth.tobytes(),
        }
        head = [pa.array([key[0].as_py()], pa.int64()), pa.array([key[1].as_py()], pa.int64()),
                pa.array([key[2].as_py()], pa.int32())]
        return pa.table(head + [pa.array([v], pa.binary()) for v in row.values()], names=KEY + list(row))

    return run


def _numbers(raw: bytes, kind=np.int64, width: int | None = None) -> np.ndarray:
    out = np.frombuffer(raw, kind)
    return out if width is None else out.reshape(-1, width).astype(np.int64)


class Tree:
    """The packed subtrees of all labels, their directory pages, and the blocks of anchors."""

    def __init__(self, vectors: DataFrame, is_anchor: Column, positives: int = 5):
        self.spark, self.positives = vectors.sparkSession, positives
        rows = usable(vectors, is_anchor)
        moments = rows.select("v").mapInArrow(_moments, "at int, s double, ss double, most double")
        moments = moments.groupBy("at").agg(F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.max("most").alias("most"))
        # One row for each component.
        by_axis = sorted(moments.collect(), key=lambda r: r["at"])
        n = max(1, rows.count())
        self.width = width = max(1, len(by_axis))
        most = max([r["most"] for r in by_axis], default=0)
        self.kind = kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
        spread = sorted(by_axis, key=lambda r: (-(r["ss"] - r["s"] ** 2 / n), r["at"]))
        axes = [r["at"] for r in spread[:3]]
        axes += [0] * (3 - len(axes))
        coded = rows.mapInArrow(
            _codes(width, kind, axes),
            "vec_id long, label long, asks boolean, code binary, c0 long, c1 long, c2 long",
        )
        one = coded.groupBy("vec_id").agg(F.min(F.struct("label", "code", "asks", "c0", "c1", "c2")).alias("r"))
        self.rows = stored(one.select("vec_id", "r.*"), "vectors")
        self.packed = stored(self._tiled().groupBy(*KEY).applyInArrow(_pack(width, kind, positives, LEAF), PACKED), "subtrees")
        self.subtrees = self.packed.select(*KEY, "ids", "codes", "starts", "lo", "hi")
        self.blocks = self.packed.where(F.length("q_ids") > 0).select(*KEY, "q_ids", "q", "kth")
        self.pages = max(1, -(-self.packed.count() // PAGE))

    def _tiled(self) -> DataFrame:
        """Rows with ``tile`` and ``chunk``: slabs along three coordinates, then hash where ties made them large."""
        sizes = self.rows.groupBy("label").agg(F.count("*").alias("n"))
        tiles = F.ceil(F.col("n") / SUBTREE)
        first = F.ceil(F.cbrt(tiles) - 1e-9)
        second = F.ceil(F.sqrt(tiles / first) - 1e-9)
        cuts = F.array(first, second, F.ceil(tiles / (first * second)))
        plan = stored(sizes.select("label", F.transform(cuts, lambda x: F.least(x, F.lit(GRID))).alias("cuts")), "cuts")
        # Tables of quantiles are written first, so that the planner broadcasts them only when they are small.
        tiled, known = self.rows.join(plan, "label").withColumn("tile", F.lit(0).cast("long")), ["label", "tile"]
        for i in range(3):
            share = F.percentile_approx(f"c{i}", [j / GRID for j in range(1, GRID)], 10_000).alias("grid")
            needed = tiled.where(F.col("cuts")[i] > 1)
            grid = stored(needed.groupBy(*known).agg(share), "grid")
            place = F.size(F.filter(F.coalesce("grid", F.array().cast("array<bigint>")), lambda g: g < F.col(f"c{i}")))
            slab = F.floor(place * F.col("cuts")[i] / GRID)
            tiled = tiled.join(grid, known, "left").withColumn("tile", F.col("tile") * GRID + slab).drop("grid")
        chunks = stored(
            tiled.groupBy(*known).agg(F.ceil(F.count("*") / F.lit(SUBTREE)).cast("int").alias("chunks")), "chunks"
        )
        chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks").cast("long")).cast("int")
        return tiled.join(chunks, known).select(*KEY[:2], chunk.alias("chunk"), "vec_id", "asks", "code")

    # -- searching ------------------------------------------------------------------------

    def _visits(self, blocks: DataFrame, same_label: bool) -> DataFrame:
        """(block key, s_label, s_tile, s_chunk, promise): the subtrees that a block has to open."""
        width, kind = self.width, self.kind
        boxes = self.packed.select(*[F.col(c).alias(f"s_{c}") for c in KEY], "box_lo", "box_hi")
        page = F.pmod(F.xxhash64("s_label", "s_tile", "s_chunk"), F.lit(self.pages)).cast("int")
        members = F.collect_list(F.struct("s_label", "s_tile", "s_chunk", "box_lo", "box_hi")).alias("boxes")
        directory = boxes.withColumn("page", page).groupBy("page").agg(members)
        asked = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(self.pages - 1))))

        def run(batches):
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    own = tuple(r[c] for c in KEY)
                    boxes = [
                        b for b in r["boxes"]
                        if (b["s_label"] == own[0]) == same_label and (b["s_label"], b["s_tile"], b["s_chunk"]) != own
                    ]
                    if not boxes:
                        continue
                    lo, hi = (_numbers(b"".join(b[c] for b in boxes), width=width) for c in ("box_lo", "box_hi"))
                    q = _numbers(r["q"], kind, width)
                    low, high, kth = (_numbers(r[c]).reshape(len(q), -1) for c in ("low", "high", "kth"))
                    least, greatest = intervals(q, lo, hi)
                    alive = open_boxes(least, greatest, low, high, kth)
                    for i in np.flatnonzero(alive.any(0)):
                        b = boxes[i]
                        promise = float(greatest[alive[:, i], i].max())
                        out.append((*own, b["s_label"], b["s_tile"], b["s_chunk"], promise))
                if out:
                    names = [*KEY, "s_label", "s_tile", "s_chunk", "promise"]
                    types = [pa.int64(), pa.int64(), pa.int32()] * 2 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names)

        return asked.join(directory, "page").select(*blocks.columns, "boxes").mapInArrow(
            run, f"{KEY_DDL}, s_label long, s_tile long, s_chunk int, promise double"
        )

    def _opened(self, visits: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
        """What the visited subtrees hold for the anchors of the blocks."""
        width, kind = self.width, self.kind
        subtrees = self.subtrees.withColumnsRenamed({c: f"s_{c}" for c in KEY})

        def run(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    r = batch.slice(at, 1).to_pylist()[0]
                    q = _numbers(r["q"], kind, width)
                    low, high, kth = (_numbers(r[c]).reshape(len(q), -1) for c in ("low", "high", "kth"))
                    q_ids = _numbers(r["q_ids"])
                    asker, wanted, ids, scores = search(
                        q_ids, q, low, high, kth, k, _numbers(r["ids"]), _numbers(r["codes"], kind, width),
                        _numbers(r["starts"]), _numbers(r["lo"], width=width), _numbers(r["hi"], width=width),
                    )
                    own = [pa.array([r[c]] * len(asker), t) for c, t in zip(KEY, (pa.int64(), pa.int64(), pa.int32()))]
                    columns = [*own, pa.array(q_ids[asker]), pa.array(wanted.astype(np.int32)), pa.array(ids), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, [*KEY, "anchor_id", "wanted", "vec_id", "score"])

        met = visits.join(blocks, KEY).join(subtrees, ["s_label", "s_tile", "s_chunk"])
        return met.drop("s_label", "s_tile", "s_chunk").mapInArrow(run, FOUND_DDL)

    @staticmethod
    def _best(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor_id", "wanted").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def positive_rows(self) -> DataFrame:
        """(block key, anchor_id, rank, vec_id, score): the best rows of the anchor's own label."""

        def unbounded(batches):
            for batch in batches:
                n = [len(x) // 8 for x in batch.column("kth").to_pylist()]
                low = pa.array([np.full(m, LOWEST).tobytes() for m in n], pa.binary())
                high = pa.array([np.full(m, HIGHEST).tobytes() for m in n], pa.binary())
                columns = [*batch.columns, low, high]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "low", "high"])

        blocks = self.blocks.mapInArrow(unbounded, f"{KEY_DDL}, q_ids binary, q binary, kth binary, low binary, high binary")
        own = [F.col(c).alias(f"s_{c}") for c in KEY]
        visits = self._visits(blocks, True).drop("promise").unionByName(self.blocks.select(*KEY, *own))
        return self._best(self._opened(visits, blocks, self.positives), self.positives).drop("wanted")

    def negative_rows(self, positives: DataFrame, negatives: int, least_percent: int, most_percent: int) -> DataFrame:
        """(anchor_id, wanted, vec_id, score, rank): per positive rank the best rows of its score window."""
        width, ranks = self.width, self.positives
        asked = positives.groupBy(*KEY).agg(F.collect_list(F.struct("anchor_id", "rank", "score")).alias("positives"))

        def windows(batches):
            for batch in batches:
                done = []
                for r in batch.to_pylist():
                    ids, at, score = (np.array([p[c] for p in r["positives"]], np.int64) for c in ("anchor_id", "rank", "score"))
                    q_ids = np.unique(ids)
                    all_ids = _numbers(r["q_ids"])
                    place = np.argsort(all_ids)[np.searchsorted(np.sort(all_ids), q_ids)]
                    low, high = np.full((len(q_ids), ranks), HIGHEST), np.full((len(q_ids), ranks), LOWEST)
                    row = np.searchsorted(q_ids, ids)
                    hundreds, rest = score // 100, score % 100
                    low[row, at - 1] = hundreds * least_percent - (-(rest * least_percent) // 100)
                    high[row, at - 1] = hundreds * most_percent + rest * most_percent // 100
                    size = len(r["q"]) // len(all_ids)
                    q = b"".join(r["q"][p * size : (p + 1) * size] for p in place)
                    kth = np.full(low.shape, LOWEST)
                    done.append([*(r[c] for c in KEY), q_ids.tobytes(), q, kth.tobytes(), low.tobytes(), high.tobytes()])
                if done:
                    types = [pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 5
                    names = [*KEY, "q_ids", "q", "kth", "low", "high"]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names)

        schema = f"{KEY_DDL}, q_ids binary, q binary, kth binary, low binary, high binary"
        blocks = stored(self.blocks.drop("kth").join(asked, KEY).mapInArrow(windows, schema), "windows")
        order = Window.partitionBy(*KEY).orderBy(F.desc("promise"), "s_label", "s_tile", "s_chunk")
        counted = F.count("*").over(Window.partitionBy(*KEY))
        visits = self._visits(blocks, False).withColumn("turn", F.row_number().over(order)).withColumn("many", counted)
        visits = stored(visits.withColumn("early", F.col("turn") <= F.ceil(F.sqrt("many"))).drop("turn", "many"), "visits")
        first = stored(
            self._best(self._opened(visits.where("early").drop("promise", "early"), blocks, negatives), negatives), "first"
        )
        reached = first.where(F.col("rank") == negatives).groupBy(*KEY).agg(
            F.collect_list(F.struct("anchor_id", "wanted", "score")).alias("reached")
        )

        def raised(batches):
            for batch in batches:
                kths = []
                for ids, kth, marks in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "kth", "reached"))):
                    ids = _numbers(ids)
                    kth = _numbers(kth).reshape(len(ids), ranks).copy()
                    for m in marks or []:
                        kth[np.searchsorted(ids, m["anchor_id"]), m["wanted"]] = m["score"]
                    kths.append(kth.tobytes())
                names = [*KEY, "q_ids", "q", "kth", "low", "high"]
                columns = {c: batch.column(c) for c in names} | {"kth": pa.array(kths, pa.binary())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names)

        better = blocks.join(reached, KEY, "left").mapInArrow(raised, schema)
        rest = self._opened(visits.where(~F.col("early")).drop("promise", "early"), better, negatives)
        return self._best(first.drop("rank").unionByName(rest), negatives)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   least_percent: int = 50, most_percent: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding. An anchor's positives are the best rows of its label; each has up to
    ``negatives`` rows of other labels whose score is from ``least_percent`` to ``most_percent`` of the positive's.
    """
    tree = Tree(vectors, is_anchor, positives)
    near = stored(tree.positive_rows(), "positives")
    found = tree.negative_rows(near, negatives, least_percent, most_percent)
    found = found.select(
        "anchor_id", (F.col("wanted") + 1).alias("at"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    near = near.select("anchor_id", F.col("rank").alias("at"), F.col("vec_id").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    return near.join(found, ["anchor_id", "at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
