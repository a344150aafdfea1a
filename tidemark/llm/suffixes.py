"""Exact removal of repeated 100-byte strings with a logarithmic family of sparse suffix arrays.

A repeated string is found through one suffix of it that its bytes alone choose: of the ``MER``-byte runs in a
window of ``WINDOW`` bytes, the one with the least hash (the leftmost of equals). Neighbouring windows mostly
choose the same suffix; such a group, an entry, is a stretch of window starts around its anchor. Equal windows
have the same anchor at the same offset, so entries with different anchor runs share no window.

Entries are dealt by the hash of their anchor run and reach a task in document order. The task keeps a family of
suffix arrays, sorted by anchor run and then by the whole stretch, both as fingerprints: each batch gets its own
array, is merge-scanned against the existing levels, and levels of equal size merge, so that n entries lie in
about log n levels. An entry whose whole stretch is in an earlier array repeats in all its windows. A window holds
``SIDE`` bytes to the left of its anchor run or as many to the right, so what is left are entries that share the
anchor run with the bytes on one side of it, but not the whole stretch: their bytes are cut out of the texts and
compared from the anchor to both sides, pair by pair in small groups and window by window, through
128-bit hashes, in groups of more than ``GROUP``. Those that share the anchor run by chance, which most do in
a large table, end here.

Before the shuffle, a task folds equal stretches of its own texts, and sends at most ``SPREAD`` stretches with one
anchor run to the arrays; more of them are known to repeat and go to the comparison at once, with all entries of
that anchor run. So no hot string gathers its rows in one task.

Defined cases: a null text is empty; matches never cross documents; a text below 100 bytes loses nothing; of
equal strings the first by (doc_id, start) stays; of rows with the same doc_id, and of those with a null one,
the row numbers that Spark gives decide (a null doc_id comes first); an empty table gives an empty result; extra
columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import compact, discard, in_batches, mix, rows_at_once, salted_join, signed, slices, texts
from tidemark.settings import stored

WINDOW, MER = 100, 24
WIDTH = WINDOW - MER + 1
#: A window has this many bytes at least on one side of its anchor run.
SIDE = (WINDOW - MER) // 2
#: Bytes of a text that are looked at together; the next piece starts with the next window.
PIECE = 1 << 18
#: Text that a task folds together before it sends entries on.
FOLD_BYTES = 8 << 20
SPREAD = 64
GROUP = 64
#: Entries of a new batch in the family of arrays, and those planned for one task.
BATCH = 1 << 16
TASK_ENTRIES = 600_000
ENTRY = "mer long, ctx long, doc_id long, span long, sides long"
#: A stretch of windows as one number: the first start and how many (at most WIDTH). HOT says of an entry that others
#: with its anchor run went to the comparison at once.
SHIFT, HOT = 8, 1 << 7
LOW = np.uint64(0xFFFFFFFF)

_random = np.random.default_rng(42)
TABLES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, np.uint64(b), np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


POWERS = [_powers(b, PIECE + 2 * WINDOW) for b in BASES]


class Prints:
    """Fingerprints of any stretch of some bytes from sums of powers."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        self.up, self.down = POWERS[which]
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(TABLES[which][raw] * self.up[: len(raw)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])

    def runs(self, n: int) -> np.ndarray:
        """Of all stretches of n bytes."""
        return mix((self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n])


def entries(raw: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(mer, ctx, first start, number of windows, anchor, sides) of all entries of a text, piece by piece.

    ``sides`` has 32 bits each of the anchor run with SIDE bytes to its left and to its right, 0 where no window of the
    entry holds these.
    """
    data = np.frombuffer(raw, np.uint8)
    low = np.uint64((1 << 20) - 1)
    for offset in range(0, len(data) - WINDOW + 1, PIECE):
        part = data[offset : offset + PIECE + WINDOW - 1]
        prints = Prints(part)
        mers = prints.runs(MER)
        least = (mers & ~low) | np.arange(len(mers), dtype=np.uint64)
        span = 1
        while 2 * span <= WIDTH:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < WIDTH:
            rest = WIDTH - span
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & low).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.concatenate([begin[1:], [len(anchor)]])
        at = anchor[begin]
        ctx = prints.of(begin, end + WINDOW - 1) ^ mix((at - begin).astype(np.uint64))
        left = prints.of(np.maximum(at - SIDE, 0), at + MER) >> np.uint64(32) | np.uint64(1)
        right = prints.of(at, np.minimum(at + MER + SIDE, len(part))) >> np.uint64(32) | np.uint64(1)
        left[at - begin < SIDE], right[at - end + 1 > SIDE] = 0, 0
        yield mers[at], ctx, begin + offset, end - begin, at + offset, left << np.uint64(32) | right


def _fold(mer, ctx, doc, span) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(covered, direct, hot): rows whose stretch an earlier row has, stretches beyond SPREAD with one anchor run, and the
    others with that anchor run."""
    order = np.lexsort((span, doc, ctx, mer))
    m, c = mer[order], ctx[order]
    new_mer = np.concatenate([[True], m[1:] != m[:-1]])
    new = new_mer | np.concatenate([[True], c[1:] != c[:-1]])
    covered = np.zeros(len(mer), bool)
    covered[order[~new]] = True
    kept, starts = order[new], np.flatnonzero(new_mer[new])
    sizes = np.diff(np.append(starts, len(kept)))
    place = np.arange(len(kept)) - np.repeat(starts, sizes)
    direct, hot = np.zeros(len(mer), bool), np.zeros(len(mer), bool)
    direct[kept[place >= SPREAD]] = True
    hot[kept[(place < SPREAD) & np.repeat(sizes > SPREAD, sizes)]] = True
    return covered, direct, hot


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ENTRY. A folded row has no mer: ctx 0 says covered, ctx 1 to be compared; deal spreads them."""
    held: list[list[np.ndarray]] = []
    size = 0

    def flush():
        mer, ctx, doc, span, sides = (np.concatenate(x) for x in zip(*held, strict=True))
        covered, direct, hot = _fold(mer, ctx, doc, span)
        folded = covered | direct
        span = np.where(hot, span | HOT, span)
        ctx = np.where(folded, direct.astype(np.uint64), ctx)
        deal = np.where(folded, mix(doc.view(np.uint64)), mer)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(mer), mask=folded), pa.array(signed(ctx)), pa.array(doc), pa.array(span),
             pa.array(signed(sides), mask=folded), pa.array((deal >> np.uint64(33)).astype(np.int64))],
            ["mer", "ctx", "doc_id", "span", "sides", "deal"],
        )

    for batch in slices(batches):
        for doc, text in zip(batch.column("row").to_pylist(), texts(batch), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            size += len(raw)
            for mer, ctx, first, n, _, sides in entries(raw):
                held.append([mer, ctx, np.full(len(mer), doc, np.int64), (first << SHIFT) | n, sides])
            if size >= FOLD_BYTES:
                if held:
                    yield flush()
                held, size = [], 0
    if held:
        yield flush()


class Levels:
    """A family of suffix arrays of growing size over (mer, ctx)."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, ...]] = []  # (key, mer, ctx, doc, span, sides), largest first
        self.hot: list[np.ndarray] = []  # anchor runs of which entries went to the comparison at once

    @staticmethod
    def key(mer: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """Orders by the leading half of both fingerprints; whole ones are compared where keys meet."""
        high = np.uint64(0xFFFFFFFF00000000)
        return (mer & high) | (ctx >> np.uint64(32))

    def add(self, mer, ctx, doc, span, sides=None) -> np.ndarray:
        """Which rows of a batch, in document order, repeat an earlier stretch; the others enter the family. Without
        ``sides``, entries with one anchor run count as sharing them."""
        key = self.key(mer, ctx)
        sides = np.full(len(key), 1, np.uint64) if sides is None else sides
        if (hot := span & HOT != 0).any():
            self.hot.append(np.unique(mer[hot]))
            span = span & ~HOT
        order = np.lexsort((np.arange(len(key)), ctx, mer, key))
        mer, ctx, doc, span, key, sides = (x[order] for x in (mer, ctx, doc, span, key, sides))
        hit = np.concatenate([[False], (mer[1:] == mer[:-1]) & (ctx[1:] == ctx[:-1])])
        for level in self.levels:
            at = np.minimum(np.searchsorted(level[0], key), len(level[0]) - 1)
            hit |= (level[1][at] == mer) & (level[2][at] == ctx)
        fresh = ~hit
        if fresh.any():
            self.levels.append(tuple(x[fresh] for x in (key, mer, ctx, doc, span, sides)))
            while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
                self.merge()
        out = np.zeros(len(hit), bool)
        out[order] = hit
        return out

    def merge(self) -> None:
        a, b = self.levels.pop(-2), self.levels.pop()
        at = np.searchsorted(a[0], b[0], "right")
        self.levels.append(tuple(np.insert(x, at, y) for x, y in zip(a, b, strict=True)))

    def shared(self) -> tuple[np.ndarray, np.ndarray]:
        """(doc, span) of the entries whose anchor run another one has, with the bytes on one side of it; and of all those of a
        hot anchor run."""
        while len(self.levels) > 1:
            self.merge()
        if not self.levels:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        _, mer, _, doc, span, sides = self.levels[0]
        both = np.isin(mer, np.unique(np.concatenate(self.hot))) if self.hot else np.zeros(len(mer), bool)
        for side in (sides >> np.uint64(32), sides & LOW):
            at = np.flatnonzero(side)
            at = at[np.lexsort((side[at], mer[at]))]
            same = np.flatnonzero((mer[at[1:]] == mer[at[:-1]]) & (side[at[1:]] == side[at[:-1]]))
            both[at[same]] = both[at[same + 1]] = True
        return doc[both], span[both]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in document order to (doc_id, span, covered)."""
    family = Levels()

    def out(doc, span, covered: bool):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(span), pa.array(np.full(len(doc), covered))], ["doc_id", "span", "covered"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        mer_column = batch.column("mer")
        doc, span = batch.column("doc_id").to_numpy(), batch.column("span").to_numpy()
        ctx = batch.column("ctx").to_numpy()
        folded = mer_column.is_null().to_numpy(zero_copy_only=False)
        for kind, covered in ((0, True), (1, False)):
            which = folded & (ctx == kind)
            if which.any():
                yield out(doc[which], span[which], covered)
        own = ~folded
        if own.any():
            mer = mer_column.fill_null(0).to_numpy()[own].view(np.uint64)
            doc, span = doc[own], span[own]
            sides = batch.column("sides").fill_null(0).to_numpy()[own].view(np.uint64)
            hit = family.add(mer, ctx[own].view(np.uint64), doc, span, sides)
            if hit.any():
                yield out(doc[hit], span[hit] & ~HOT, True)
    doc, span = family.shared()
    for i in range(0, len(doc), BATCH):
        yield out(doc[i : i + BATCH], span[i : i + BATCH], False)


# -- entries that share an anchor run only ---------------------------------------------------------------


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted entries of each text with their anchor run, its offset and their bytes."""
    for batch in slices(batches):
        out: list[list] = [[] for _ in range(5)]
        for doc, text, wanted in zip(
            batch.column("row").to_pylist(), texts(batch), batch.column("spans").to_pylist(), strict=True
        ):
            raw, wanted = text.encode("utf-8", "surrogatepass"), np.array(wanted, np.int64)
            for mer, _, first, n, anchor, _ in entries(raw):
                span = (first << SHIFT) | n
                for i in np.flatnonzero(np.isin(span, wanted)).tolist():
                    b = int(first[i])
                    row = (int(mer[i].view(np.int64)), doc, int(span[i]), int(anchor[i]) - b,
                           raw[b : b + int(n[i]) + WINDOW - 1])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.int32()), pa.array(out[4], pa.binary())],
            ["mer", "doc_id", "span", "anchor", "bytes"],
        )


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut-outs sorted by (mer, doc_id, span) to the repeated windows of each but the first of a group."""
    group: list[tuple] = []
    current = None
    for batch in batches:
        docs, spans = [], []
        for mer, doc, span, anchor, raw in zip(*(batch.column(c).to_pylist() for c in
                                                 ("mer", "doc_id", "span", "anchor", "bytes")), strict=True):
            if mer != current:
                current, group = mer, []
            left, right, first = raw[:anchor][::-1], raw[anchor:], span >> SHIFT
            for left_, right_ in group:
                low = max(anchor - _common(left, left_), 0)
                high = min(anchor + _common(right, right_), len(raw)) - WINDOW
                if high >= low:
                    docs.append(doc)
                    spans.append(((first + low) << SHIFT) | (high - low + 1))
            group.append((left, right))
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(spans, pa.int64())], ["doc_id", "span"]
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of each cut-out: (x, y) as 128 bits of its content, doc_id and start."""
    for batch in batches:
        docs, starts, x, y = [], [], [], []
        for doc, span, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "span", "bytes")), strict=True):
            data = np.frombuffer(raw, np.uint8)
            x.append(Prints(data, 0).runs(WINDOW))
            y.append(Prints(data, 1).runs(WINDOW))
            starts.append((span >> SHIFT) + np.arange(len(x[-1])))
            docs.append(np.full(len(x[-1]), doc, np.int64))
        if docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate(x))), pa.array(signed(np.concatenate(y))),
                 pa.array(np.concatenate(docs)), pa.array(np.concatenate(starts))],
                ["x", "y", "doc_id", "start"],
            )


def _compared(cuts: DataFrame) -> DataFrame:
    """(doc_id, span) of the windows that repeat, stored, from the cut-outs (mer, doc_id, span, anchor, bytes)."""
    large = stored(cuts.groupBy("mer").count().where(F.col("count") > GROUP).select("mer"), "large")
    small = cuts.join(large, "mer", "left_anti").repartition("mer").sortWithinPartitions("mer", "doc_id", "span")
    rows_at_once(cuts, 5_000)
    by_pair = small.mapInArrow(_pairs, "doc_id long, span long")
    windows = cuts.join(large, "mer", "left_semi").select("doc_id", "span", "bytes").mapInArrow(
        _windows, "x long, y long, doc_id long, start long"
    )
    windows = compact(windows.select(F.struct("x", "y").alias("content"), "doc_id", "start"), "windows")
    if windows.isEmpty():
        return compact(by_pair, "compared")
    first = windows.groupBy("content").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").select("content", "first"), "first")
    by_window = salted_join(windows, first, "content").where(F.struct("doc_id", "start") > F.col("first"))
    both = by_pair.union(by_window.select("doc_id", (F.shiftleft("start", SHIFT) + 1).alias("span")))
    both = compact(both, "compared")
    discard(windows, first)
    return both


# -- the whole -------------------------------------------------------------------------------------------


def merged(spans: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs (begin, end) from stretches of window starts."""
    packed = np.unique(np.array(spans, np.int64))
    begin = packed >> SHIFT
    end = np.maximum.accumulate(begin + (packed & ((1 << SHIFT) - 1)) + WINDOW - 1)
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(begin)]]) - 1
    return begin[new], end[last]


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        columns: list[list] = [[] for _ in range(4)]
        for text, spans in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
            raw, gone, n = text.encode("utf-8", "surrogatepass"), 0, 0
            kept = hashlib.sha256()
            at = 0
            if spans:
                begins, ends = merged(spans)
                n, gone = len(begins), int((ends - begins).sum())
                for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
                    kept.update(raw[at:b])
                    at = e
            kept.update(raw[at:])
            for column, value in zip(columns, (len(raw), gone, n, kept.hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated(documents: DataFrame) -> DataFrame:
    """(row, span): stretches of window starts, packed, that repeat an earlier string. ``documents``: row, text."""
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size * 2 // ((WIDTH + 1) * TASK_ENTRIES))
    )
    dealt = in_batches(documents, _entries, f"{ENTRY}, deal long")
    dealt = dealt.repartition(tasks, "deal").drop("deal").sortWithinPartitions("doc_id", "span")
    rows_at_once(dealt, BATCH)
    found = compact(dealt.mapInArrow(_index, "doc_id long, span long, covered boolean"), "entries")
    wanted = found.where(~F.col("covered")).groupBy(F.col("doc_id").alias("row")).agg(
        F.collect_list("span").alias("spans")
    )
    cuts = in_batches(
        documents.join(wanted, "row"), _cut_out,
        "mer long, doc_id long, span long, anchor int, bytes binary",
    )
    cuts = compact(cuts, "cuts")
    more = _compared(cuts)
    discard(cuts)
    return found.where("covered").select("doc_id", "span").union(more).toDF("row", "span")


def removed(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = documents.select("doc_id", "text")
    if rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        rows = rows.select("doc_id", "text", F.col("doc_id").cast("long").alias("row"))
    else:  # number the rows in order of doc_id, so that rows with one doc_id stay apart; written, so numbers stay
        ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        rows = stored(ordered.withColumn("row", F.monotonically_increasing_id()), "numbered")
    spans = repeated(rows.select("row", "text"))
    spans = spans.groupBy("row").agg(F.collect_list("span").alias("spans"))
    kind = documents.select("doc_id").schema[0].dataType.simpleString()
    return in_batches(
        rows.join(spans, "row", "left").select("doc_id", "text", "spans"), _result,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )
