"""Packing of tokenised documents into fixed windows by non-negative least squares.

A document longer than a window is cut into whole windows and a rest. The rests' lengths make a histogram of at
most ``window`` bins. Combinations of up to three lengths that fill a window exactly are enumerated, the
repeat counts x >= 0 that bring (combinations x counts) closest to the histogram are solved for, and rounded
down until no bin is overdrawn. What is left is packed greedily: lengths in falling order are laid end to
end and cut where a window ends, so that only the last window has padding.

The solver sees lengths only. A rest finds its place through its rank among the rests of its length: the
plan says which ranks of a length go to which slot of which combination, and ranks are counted over small
buckets of documents and summed, so no length gathers in one task.

Defined cases: a null text is empty, its document is the end id alone; repeated rows are packed once each;
a document's pieces keep its order by ``start``; an empty table gives no pieces. Rows with the same doc_id are
told apart by a row key of their own.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bpe import byte_symbols
from tidemark.llm.common import compact, in_batches, slices, texts

WINDOW = 4096
END = 2
#: Lengths that may take part in combinations; the most frequent ones, for the enumeration to stay shallow.
LENGTHS = 1024
#: Combinations kept per length, and steps of the solver.
PARTNERS = 12
STEPS = 400
#: Rests of one length in one bucket of documents that one task ranks.
BUCKET_ROWS = 50_000

#: Words of more characters are not cached, and a cache of more entries starts anew.
CACHED_CHARS = 40
CACHE_ENTRIES = 600_000
#: White space to Python's str.split that is none to the tokenizer.
ODD = re.compile("[\x1c-\x1f]")
#: Letters that normalisation keeps and whose lower case is one letter, and marks that follow them.
LATIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\\[-`{-~]*)")


# -- ids ---------------------------------------------------------------------------------------------


class WordIds(dict):
    """Ids of words between white space as packed 32-bit numbers, from the tokenizer.

    The tokenizer's normaliser and pre-tokenizer never look across white space, so a text's ids are those of
    its words one after the other. A word of Latin letters in lower case is one pre-token that the
    normaliser leaves alone, so it goes to the merge model directly; all other words take the whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        self.symbols = {b: c for b, c in byte_symbols().items() if b >= 128}

    def letters(self, word: str) -> bytes:
        found = self.get(word)
        if found is None:
            symbols = word
            if not word.isascii():
                symbols = "".join(chr(b) if b < 128 else self.symbols[b] for b in word.encode())
            found = self[word] = array("I", [t.id for t in self.merge(symbols)]).tobytes()
        return found

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        parts = LATIN.fullmatch(word)
        if parts is None:
            found = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        else:
            found = self.letters(parts[1].lower())
            if parts[2]:
                found += self[parts[2]]
        if len(word) <= CACHED_CHARS:
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if ODD.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def tokenise(documents: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, row_key, start, length, doc_tokens, ids) for each piece of at most a window of each document.

    ``ids`` are little-endian unsigned 32-bit numbers; the end id follows each document. ``row_key`` tells rows
    with the same doc_id apart.
    """
    rows = documents.select("doc_id", "text").withColumn("row_key", F.monotonically_increasing_id())

    def run(batches):
        words = _words(path)
        end = np.array([END], "<u4").tobytes()
        for batch in slices(batches, 1 << 20):
            out: dict[str, list] = {k: [] for k in ("row", "start", "length", "doc_tokens", "ids")}
            for row, text in enumerate(texts(batch)):
                blob = words.encode(text) + end
                total = len(blob) // 4
                for start in range(0, total, window):
                    piece = blob[4 * start : 4 * (start + window)]
                    for k, v in zip(out, (row, start, len(piece) // 4, total, piece), strict=True):
                        out[k].append(v)
            at = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("row_key").take(at),
                 pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()),
                 pa.array(out["doc_tokens"], pa.int64()), pa.array(out["ids"], pa.binary())],
                ["doc_id", "row_key", "start", "length", "doc_tokens", "ids"],
            )

    kind = documents.select("doc_id").schema[0].dataType.simpleString()
    return in_batches(
        rows, run, f"doc_id {kind}, row_key long, start long, length long, doc_tokens long, ids binary"
    )


# -- the plan over lengths -----------------------------------------------------------------------------


def combinations(histogram: dict[int, int], window: int) -> list[tuple[int, ...]]:
    """Lengths that fill a window: pairs, triples and, where a length divides it, repeats of one length."""
    lengths = sorted(sorted(histogram, key=lambda n: (-histogram[n] * n, n))[:LENGTHS])
    known, found = set(lengths), set()
    for a in lengths:
        if window % a == 0:
            found.add((a,) * (window // a))
        if window - a in known and a <= window - a:
            found.add((a, window - a))
        partners = 0
        for b in sorted(known, key=lambda n: -histogram[n]):
            c = window - a - b
            if c in known and partners < PARTNERS:
                found.add(tuple(sorted((a, b, c))))
                partners += 1
            if partners == PARTNERS:
                break
    return sorted(found)


def repeat_counts(combos: list[tuple[int, ...]], histogram: dict[int, int]) -> np.ndarray:
    """Non-negative least squares by projected coordinate steps on the sparse columns, then rounded down."""
    if not combos:
        return np.zeros(0, np.int64)
    need: list[dict[int, int]] = [{n: combo.count(n) for n in set(combo)} for combo in combos]
    left = {n: float(c) for n, c in histogram.items()}
    x = np.zeros(len(combos))
    norm = [sum(v * v for v in column.values()) for column in need]
    for _ in range(STEPS):
        moved = 0.0
        for j, column in enumerate(need):
            step = max(-x[j], sum(v * left[n] for n, v in column.items()) / norm[j])
            if step:
                x[j] += step
                for n, v in column.items():
                    left[n] -= v * step
                moved = max(moved, abs(step))
        if moved < 0.05:
            break
    counts = np.floor(x + 1e-9).astype(np.int64)
    spare = dict(histogram)
    for j in sorted(range(len(combos)), key=lambda j: -counts[j]):  # no length may be used more often than it occurs
        fits = min(spare[n] // v for n, v in need[j].items())
        counts[j] = min(int(counts[j]), fits)
        for n, v in need[j].items():
            spare[n] -= v * int(counts[j])
    for j, column in enumerate(need):  # whole windows that rounding has left
        more = min(spare[n] // v for n, v in column.items())
        if more > 0:
            counts[j] += more
            for n, v in column.items():
                spare[n] -= v * more
    return counts


def plan(histogram: dict[int, int], window: int, first: int):
    """Rows (length, rank_from, rank_to, sequence, step, offset) of the combinations, and
    (length, rank_from, tokens_from) of the lengths that are laid end to end behind them.

    Ranks [rank_from, rank_to) of a length go to the sequences from ``sequence`` on, one each, at ``offset``.
    """
    combos = combinations(histogram, window)
    counts = repeat_counts(combos, histogram)
    used = {n: 0 for n in histogram}
    slots, sequence = [], first
    for combo, count in zip(combos, counts.tolist(), strict=True):
        if not count:
            continue
        offset = 0
        for n in combo:
            slots.append((n, used[n], used[n] + count, sequence, offset))
            used[n] += count
            offset += n
        sequence += count
    rest, tokens = [], 0
    for n in sorted(histogram, reverse=True):
        if histogram[n] > used[n]:
            rest.append((n, used[n], tokens))
            tokens += n * (histogram[n] - used[n])
    return slots, rest, sequence


def pack(documents: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's ids, little-endian unsigned 32-bit.
    """
    spark = documents.sparkSession
    pieces = compact(tokenise(documents, path, window), "pieces")
    rests = pieces.where(F.col("length") < window)
    histogram = {r["length"]: r["count"] for r in rests.groupBy("length").count().collect()}  # < window rows
    most = max(histogram.values(), default=0)
    buckets = max(1, -(-most // BUCKET_ROWS)) * 4

    # Ranks: of whole windows over all, of rests by length; counted per bucket, then within it.
    keyed = pieces.select(
        "doc_id", "row_key", "start", "length", "doc_tokens",
        F.pmod(F.xxhash64("row_key", "start"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    whole = F.col("length") == window
    spread = F.when(whole, F.pmod(F.xxhash64("row_key", "start", F.lit(1)), F.lit(256))).otherwise(0).cast("int")
    keyed = keyed.withColumn("part", spread)
    group = ["length", "bucket", "part"]
    sizes = keyed.groupBy(*group).count()
    order = Window.partitionBy("length").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*group, F.coalesce(F.sum("count").over(order), F.lit(0)).alias("base"))
    place = Window.partitionBy(*group).orderBy("row_key", "start")
    ranked = keyed.withColumn("at", F.row_number().over(place) - 1).join(bases, group)
    ranked = ranked.select(
        "doc_id", "row_key", "start", "length", "doc_tokens", (F.col("base") + F.col("at")).alias("rank")
    )

    wholes = pieces.where(whole).count()
    slots, rest, behind = plan(histogram, window, wholes)
    found = spark.createDataFrame(
        [(n, a, b, s, o, None) for n, a, b, s, o in slots]
        + [(n, a, histogram[n], behind, 0, t) for n, a, t in rest],
        "length long, rank_from long, rank_to long, sequence long, offset long, tokens_from long",
    )
    # A few rows for each length below the window: the plan's size does not depend on the documents.
    by_length = found.groupBy("length").agg(
        F.array_sort(
            F.collect_list(F.struct("rank_from", "rank_to", "sequence", "offset", "tokens_from"))
        ).alias("slots")
    )
    placed = ranked.join(F.broadcast(by_length), "length", "left").withColumn(
        "slot", F.expr("filter(slots, s -> s.rank_from <= rank and rank < s.rank_to)[0]")
    )
    steps = F.col("rank") - F.col("slot.rank_from")
    tokens = F.col("slot.tokens_from") + steps * F.col("length")
    into = F.pmod(tokens, F.lit(window))
    first = F.least(F.col("length"), window - into)
    full = F.struct(
        F.col("start").alias("start"), F.col("length").alias("length"),
        F.col("rank").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    combined = F.struct(
        F.col("start").alias("start"), F.col("length").alias("length"),
        (F.col("slot.sequence") + steps).alias("sequence_id"), F.col("slot.offset").alias("offset"),
    )
    sequence = F.col("slot.sequence") + F.floor(tokens / window)
    head = F.struct(
        F.col("start").alias("start"), first.alias("length"),
        sequence.alias("sequence_id"), into.alias("offset"),
    )
    tail = F.struct(
        (F.col("start") + first).alias("start"), (F.col("length") - first).alias("length"),
        (sequence + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    laid = F.when(F.col("length") > first, F.array(head, tail)).otherwise(F.array(head))
    where = (
        F.when(F.col("length") == window, F.array(full))
        .when(F.col("slot.tokens_from").isNull(), F.array(combined))
        .otherwise(laid)
    )
    places = placed.select("row_key", F.col("start").alias("piece"), where.alias("places"))
    ids = pieces.select("doc_id", "row_key", F.col("start").alias("piece"), "doc_tokens", "ids")
    return (
        ids.join(places, ["row_key", "piece"])
        .select("doc_id", "doc_tokens", "piece", "ids", F.explode("places").alias("p"))
        .select(
            "doc_id", F.col("p.start").alias("start"), F.col("p.length").alias("length"), "doc_tokens",
            F.col("p.sequence_id").alias("sequence_id"), F.col("p.offset").alias("offset"),
            F.expr("substring(ids, cast(4 * (p.start - piece) + 1 as int), cast(4 * p.length as int))").alias("ids"),
        )
    )


def packed_digests(documents: DataFrame, path: str) -> DataFrame:
    return pack(documents, path).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
