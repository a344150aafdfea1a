"""Phrase collocations by dynamic itemset counting.

Texts are lower-cased in A-Z, split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and tabs into words. All
counts are per ``lang`` (null: ``und``).

Documents are dealt by hash into ``SHARDS`` shards, which are scanned in turn, over and over. Words are counted from
the first scan on. A longer phrase becomes active before the first scan at which both its subphrases (without its
last, without its first word) have been counted ``LEAST`` times; it is counted in that scan and the next
``SHARDS`` - 1, so in every shard once, and then rests. So lengths interleave, and the scans end when no phrase is
within its cycle.

Tasks know what is active from a Bloom filter of ``FILTER_BITS`` bits with the phrases that have reached the threshold,
which only grows: a phrase is within its cycle if both subphrases pass the filter of this scan, and not both passed
the one of ``SHARDS`` scans ago. A false hit therefore only activates a phrase early: its cycle is still one whole
cycle and its count exact. The filter's size is fixed; a corpus whose phrases fill it is counted more, not wrongly.

Most pairs of frequent words are rare pairs. Before the scans one pass adds up all pairs in a table of saturating bytes
by hash; a pair whose byte stays below the threshold cannot reach it, and is left out. The table grows with the
corpus (``LOAD`` words a byte, up to ``MOST_BYTES``); beyond ``FULL`` words a byte nearly every byte would be full, so the
pass is left out and all active pairs are counted.

Phrases travel as two 64-bit hashes (with the language in both), counted in the task before they are shuffled. Once
the counts are final, the phrases that reached the threshold get their texts from as much of the corpus as that
takes, and scores, cuts and coverage are joins on them.

Defined cases: null texts are empty; a null language is ``und``; a repeated row counts each time; a word may be of
any length; equal scores are ordered by count, then by the phrase's UTF-8 bytes; an empty table gives no rows; extra
columns, whatever their names, play no part. A score is floor(2000000 a / (l + r)) in whole numbers of 38 digits.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import MIX, mix, salted_join, signed
from tidemark.settings import shared_folder, stored

SHARDS = 3
LEAST = 30
LONGEST = 4
FIRST = 2_000
COVERED = 80
FILTER_BITS = 1 << 25
PROBES = 2
#: The table of pairs: words for each of its bytes, its bounds, and the bytes that travel together.
LOAD, FULL = 8, 20
LEAST_BYTES, MOST_BYTES, CHUNK = 1 << 16, 1 << 27, 1 << 16
#: Tables of so many tasks are added up at a time.
FAN = 64
#: Distinct phrases a task holds before it hands them on, those it remembers to have named, bytes of text at a time.
HELD = 1 << 20
REMEMBERED = 1 << 19
TEXT_BYTES = 1 << 20
#: Longer words, in bytes, are hashed one by one.
SHORT = 64
UNKNOWN = "und"

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: What ends a piece, and what separates words.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Every byte lower-cased, with ends as line feeds and gaps as spaces.
PLAIN = bytes(10 if b in ENDS else 32 if b in GAPS else LOWER[b] for b in range(256))
COUNTS = "h1 long, h2 long, n int, c long"


class _Powers:
    """Powers of an odd number modulo 2**64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            self.known = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.base)], dtype=np.uint64)
        return self.known[:n]


class _Lane:
    """Hashes of all words of a buffer at once: sums of a random number a byte times powers of an odd base."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.seed = seed
        self.bytes = random.integers(0, 1 << 64, 256, np.uint64)
        base = int(random.integers(0, 1 << 64, dtype=np.uint64)) | 1
        self.up, self.down = _Powers(base), _Powers(pow(base, -1, 1 << 64))

    def hashes(self, plain: bytes, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(buffer)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.bytes[buffer] * self.up.upto(n), out=sums[1:])
        out = (sums[ends] - sums[starts]) * self.down.upto(n + 1)[starts] + (ends - starts).astype(np.uint64)
        for i in np.flatnonzero(ends - starts > SHORT):
            out[i] = xxhash.xxh3_64_intdigest(plain[starts[i] : ends[i]], seed=self.seed)
        return out


def language_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=1)


@dataclass
class Words:
    """The words of some texts: where they lie, their hashes, and how many follow in their piece (itself included)."""

    plain: bytes
    starts: np.ndarray
    ends: np.ndarray
    lanes: tuple[np.ndarray, np.ndarray]
    room: np.ndarray
    langs: list[str]
    document: np.ndarray

    def text(self, at: int, n: int) -> bytes:
        return b" ".join(self.plain[self.starts[i] : self.ends[i]] for i in range(at, at + n))


def _bounded(batches, most: int):
    """Batches cut where their texts take more than ``most`` bytes; a row stays whole."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
        begin = 0
        while begin < batch.num_rows:
            base = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, base + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


class Splitter:
    """Words of batches, a bounded number of bytes at a time; longer texts are cut between pieces."""

    def __init__(self, most: int):
        self.most, self.lane = most, _Lane(2)

    def __call__(self, batches):
        for batch in _bounded(batches, self.most):
            texts = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist()]
            langs = [UNKNOWN if x is None else x for x in batch.column("lang").to_pylist()]
            begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
            whole = b"\n".join(texts).translate(PLAIN)
            begin = 0
            while begin < len(whole):
                end = whole.find(b"\n", begin + self.most)
                end = len(whole) if end < 0 else end
                yield self._words(whole[begin:end], begins - begin, langs)
                begin = end

    def _words(self, plain: bytes, begins: np.ndarray, langs: list[str]) -> Words:
        buffer = np.frombuffer(plain, np.uint8)
        ends_piece = buffer == 10
        inside = ~(ends_piece | (buffer == 32))
        edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
        starts, ends = edges[::2], edges[1::2]
        piece = np.cumsum(ends_piece)[starts]
        last = np.flatnonzero(np.r_[piece[1:] != piece[:-1], True]) if len(piece) else piece
        room = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(len(piece)) + 1
        document = np.searchsorted(begins, starts, "right") - 1
        seeds = np.array([language_seed(lang) for lang in langs], np.uint64)[document]
        hashes = self.lane.hashes(plain, buffer, starts, ends)
        # The second hash adds the first eight bytes themselves, which for most words is all of them.
        eight = np.ndarray(len(plain), "<u8", plain + bytes(8), strides=(1,))[starts]
        eight &= ~np.uint64(0) >> (np.uint64(8) * (8 - np.minimum(ends - starts, 8)).astype(np.uint64))
        lanes = mix(hashes + seeds), mix((hashes ^ mix(eight)) * MIX + seeds)
        return Words(plain, starts, ends, lanes, room, langs, document)


def longer(lanes: tuple, words: tuple, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases of n words at the places ``at``, from those of n - 1 words there."""
    return tuple(mix(lane[at] * MIX + word[at + n - 1] + np.uint64(n)) for lane, word in zip(lanes, words))


def bits_of(h1: np.ndarray, h2: np.ndarray, size: int) -> list[np.ndarray]:
    """The bits of phrases in a filter of ``size`` bits, a power of two."""
    mask = np.uint64(size - 1)
    return [((h1 + np.uint64(i) * (h2 | np.uint64(1))) >> np.uint64(20)) & mask for i in range(PROBES)]


def passes(filter_: np.ndarray | None, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    if filter_ is None:
        return np.zeros(len(h1), bool)
    out = np.ones(len(h1), bool)
    for bit in bits_of(h1, h2, 64 * len(filter_)):
        out &= (filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out


def _sums(h1, h2, n, c) -> tuple[np.ndarray, ...]:
    """Equal phrases added up: neighbours in the order of one hash that agree in all; others stay apart."""
    order = np.argsort(h1)
    h1, h2, n, c = h1[order], h2[order], n[order], c[order]
    new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (n[1:] != n[:-1])] if len(h1) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    return h1[begin], h2[begin], n[begin], np.add.reduceat(c, begin) if len(begin) else c


def pair_place(h1: np.ndarray, size: int) -> np.ndarray:
    """The byte of a pair in a table of ``size`` bytes, a power of two."""
    return ((h1 * MIX) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _pairs(size: int, least: int, most: int):
    """A task's table of pairs: how often each byte was hit, up to ``least``, in compressed chunks."""

    def run(batches):
        table = np.zeros(size, np.uint8)
        for words in Splitter(most)(batches):
            lane, at = words.lanes[:1], np.flatnonzero(words.room >= 2)
            place, hits = np.unique(pair_place(longer(lane, lane, at, 2)[0], size), return_counts=True)
            table[place] = np.minimum(table[place] + hits, least)
        chunks, task = table.reshape(-1, CHUNK), TaskContext.get().partitionId()
        for number in np.flatnonzero(chunks.any(axis=1)):
            packed = zlib.compress(chunks[number].tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([task], pa.int32()), pa.array([packed], pa.binary())],
                ["chunk", "task", "bytes"],
            )

    return run


def _added(least: int):
    def run(key, rows):
        total = np.zeros(CHUNK, np.int64)
        for raw in rows.column("bytes").to_pylist():
            total = np.minimum(total + np.frombuffer(zlib.decompress(raw), np.uint8), least)
        packed = zlib.compress(total.astype(np.uint8).tobytes(), 1)
        chunk, task = (pa.array([k.as_py()], pa.int32()) for k in key)
        return pa.table({"chunk": chunk, "task": task, "bytes": pa.array([packed], pa.binary())})

    return run


def heavy_pairs(docs: DataFrame, least: int = LEAST) -> np.ndarray | None:
    """Which bytes of the table of pairs were hit ``least`` times or more, as bits; None where it would be full."""
    words = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    size = max(LEAST_BYTES, min(MOST_BYTES, 1 << max(0, (words // LOAD).bit_length())))
    if words > FULL * size:
        return None
    schema = "chunk int, task int, bytes binary"
    tables = stored(docs.select("text", "lang").mapInArrow(_pairs(size, least, TEXT_BYTES), schema), "pairs")
    most = (tables.agg(F.max("task")).first()[0] or 0) + 1
    while most > 1:
        # Of many tasks' tables a fixed number meet in one group at a time.
        most = -(-most // FAN)
        dealt = tables.withColumn("task", F.pmod("task", F.lit(most)))
        tables = stored(dealt.groupBy("chunk", "task").applyInArrow(_added(least), schema), "pairs")
    bits = np.zeros(size, bool)
    for chunk, _, raw in tables.collect():  # the table itself, of a bounded size
        bits[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(zlib.decompress(raw), np.uint8) >= least
    return np.packbits(bits)


def packed(numbers: np.ndarray | None) -> bytes | None:
    """A filter for a broadcast: few bits are set, so it packs well."""
    return None if numbers is None else zlib.compress(numbers.tobytes(), 1)


def unpacked(raw: bytes | None, kind) -> np.ndarray | None:
    return None if raw is None else np.frombuffer(zlib.decompress(raw), kind)


def is_heavy(heavy: np.ndarray | None, h1: np.ndarray) -> np.ndarray:
    if heavy is None:
        return np.ones(len(h1), bool)
    place = pair_place(h1, len(heavy) * 8)
    return (heavy[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def active(lanes, room, now, before, heavy, longest: int):
    """(n, places, lanes) of the phrases of two words and more that are within their cycle."""
    passed = [passes(f, *lanes) for f in (now, before)]
    at, current = np.arange(len(room)), lanes
    for n in range(2, longest + 1):
        fits = room[at] >= n
        at = at[fits]
        if not len(at):
            return
        # ``current`` and ``passed`` are by place; phrases that do not fit are never looked at.
        on = at[passed[0][at] & passed[0][at + 1]]
        if n == 2:
            on = on[is_heavy(heavy, longer(lanes[:1], lanes[:1], on, n)[0])]
        grown = longer(current, lanes, on, n)
        was_on = passed[1][on] & passed[1][on + 1]
        yield n, on[~was_on], tuple(g[~was_on] for g in grown)
        current = tuple(np.zeros(len(room), np.uint64) for _ in range(2))
        for whole, part in zip(current, grown):
            whole[on] = part
        # A phrase counts as known only where its subphrases were: the filters then say the same at every scan.
        tested = [passes(now, *grown), passes(before, *grown) & was_on]
        passed = [np.zeros(len(room) + 1, bool) for _ in range(2)]
        for whole, part in zip(passed, tested):
            whole[on] = part
        at = on


def _scan(filters, heavy, first_cycle: bool, longest: int, most: int):
    """Counts of what is within its cycle, words included in the first one."""

    def run(batches):
        now, before = (unpacked(f, np.uint64) for f in filters.value)
        able = unpacked(heavy.value, np.uint8)
        held, size, totals = [], 0, {}

        def out(rows):
            h1, h2, n, c = rows
            columns = [pa.array(signed(h1)), pa.array(signed(h2)), pa.array(n.astype(np.int32)), pa.array(c)]
            return pa.RecordBatch.from_arrays(columns, ["h1", "h2", "n", "c"])

        for words in Splitter(most)(batches):
            parts = [(1, None, words.lanes)] if first_cycle else []
            if first_cycle:
                for at, many in zip(*np.unique(words.document, return_counts=True)):
                    totals[words.langs[at]] = totals.get(words.langs[at], 0) + int(many)
            if now is not None:
                parts += active(words.lanes, words.room, now, before, able, longest)
            for n, at, (h1, h2) in parts:
                if len(h1):
                    held.append(_sums(h1, h2, np.full(len(h1), n, np.int8), np.ones(len(h1), np.int64)))
                    size += len(held[-1][0])
            if size > HELD:
                held = [_sums(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
                if size > HELD * 3 // 4:
                    yield out(held[0])
                    held, size = [], 0
        if held:
            yield out(_sums(*(np.concatenate(x) for x in zip(*held))))
        if totals:
            # The words of a language, under its name's hash and the length 0.
            seeds = np.array([language_seed(lang) for lang in totals], np.uint64)
            yield out((seeds, seeds, np.zeros(len(seeds)), np.array(list(totals.values()), np.int64)))

    return run


def _filter_with(known: np.ndarray | None, reached: DataFrame) -> np.ndarray:
    """The filter with the phrases of ``reached`` added; what comes to the driver is at most the filter itself."""

    size = FILTER_BITS if known is None else 64 * len(known)

    def run(batches):
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            bits = np.unique(np.concatenate(bits_of(h1, h2, size)))
            at = np.flatnonzero(np.r_[True, np.diff(bits >> np.uint64(6)) != 0]) if len(bits) else np.zeros(0, int)
            value = np.left_shift(np.uint64(1), bits & np.uint64(63))
            value = np.bitwise_or.reduceat(value, at) if len(at) else value
            yield pa.RecordBatch.from_arrays(
                [pa.array((bits[at] >> np.uint64(6)).astype(np.int32)), pa.array(signed(value))], ["place", "value"]
            )

    filter_ = np.zeros(size // 64, np.uint64) if known is None else known.copy()
    added = reached.select("h1", "h2").mapInArrow(run, "place int, value long")
    found = added.groupBy("place").agg(F.bit_or("value").alias("value")).toArrow()
    filter_[found.column("place").to_numpy()] |= found.column("value").to_numpy().view(np.uint64)
    return filter_


def dealt(docs: DataFrame, shards: int) -> list[DataFrame]:
    """The texts in shards, by hash, each in files of its own."""
    folder = shared_folder(docs.sparkSession, "shards")
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    texts = docs.select("text", "lang", shard.alias("shard"))
    texts.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    whole = docs.sparkSession.read.schema(texts.schema).parquet(folder)
    return [whole.where(F.col("shard") == i).drop("shard") for i in range(shards)]


def count_phrases(spark: SparkSession, docs: DataFrame, texts: list[DataFrame], least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(h1, h2, n, c) of all phrases that occur ``least`` times or more, by dynamic itemset counting.

    Rows of length 0 hold the number of words of a language, under the hash of its name.
    """
    heavy, shards = heavy_pairs(docs, least), len(texts)
    heavy = spark.sparkContext.broadcast(packed(heavy))
    state, done = None, []
    filters: list[np.ndarray | None] = [None]
    scan, last_start = 0, 0
    while scan <= last_start + shards - 1:
        now, before = filters[scan], filters[scan - shards] if scan >= shards else None
        sent = spark.sparkContext.broadcast((packed(now), packed(before)))
        counted = texts[scan % shards].mapInArrow(_scan(sent, heavy, scan < shards, longest, TEXT_BYTES), COUNTS)
        counted = counted.withColumn("since", F.lit(scan))
        if state is not None:
            counted = counted.withColumn("was", F.lit(0).cast("long")).unionByName(state)
        else:
            counted = counted.withColumn("was", F.lit(0).cast("long"))
        total = counted.groupBy("h1", "h2", "n").agg(
            F.sum("c").alias("c"), F.min("since").alias("since"), F.max("was").alias("was")
        )
        # Whoever was first seen a cycle ago has been counted in every shard by now.
        over = F.col("since") <= scan - shards + 1
        total = stored(total.where(~over | (F.col("c") >= least) | (F.col("n") == 0)), "counts")
        sent.unpersist()
        fresh = total.where((F.col("c") >= least) & (F.col("was") < least) & F.col("n").between(1, longest - 1))
        done.append(total.where(over).select("h1", "h2", "n", "c"))
        state = total.where(~over).select("h1", "h2", "n", "c", "since", F.col("c").alias("was"))
        filters.append(_filter_with(now, fresh))
        if now is None or (filters[-1] != now).any():
            last_start = scan + 1
        scan += 1
    # Every cycle has ended. A phrase leaves the state once, so it is in one of these tables.
    out = state.where((F.col("c") >= least) | (F.col("n") == 0)).select("h1", "h2", "n", "c")
    for part in done:
        out = out.unionByName(part)
    return stored(out, "frequent")


def _named(filter_, longest: int, most: int):
    """Texts of the phrases in the filter, most of them once a task."""

    def run(batches):
        wanted = unpacked(filter_.value, np.uint64)
        # What was told last under a slot; what is overwritten is told again.
        told = np.zeros((2, REMEMBERED), np.uint64)
        names = ["h1", "h2", "n", "lang", "phrase"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary()]
        for words in Splitter(most)(batches):
            room, current, rows = words.room, words.lanes, []
            for n in range(1, longest + 1):
                at = np.flatnonzero(room >= n)
                if n > 1:
                    grown = longer(current, words.lanes, at, n)
                    current = tuple(np.zeros(len(room), np.uint64) for _ in range(2))
                    for whole, part in zip(current, grown):
                        whole[at] = part
                h1, h2 = (lane[at] for lane in current)
                good = passes(wanted, h1, h2)
                h1, h2, at = h1[good], h2[good], at[good]
                slot = (h1 % np.uint64(REMEMBERED)).astype(np.int64)
                new = (told[0, slot] != h1) | (told[1, slot] != h2)
                h1, h2, at, slot = h1[new], h2[new], at[new], slot[new]
                told[0, slot], told[1, slot] = h1, h2
                _, first = np.unique(h1, return_index=True)
                first = np.union1d(first, np.flatnonzero(told[0, slot] != h1))
                for i, one, two in zip(first, signed(h1[first]).tolist(), signed(h2[first]).tolist()):
                    rows.append((one, two, n, words.langs[words.document[at[i]]], words.text(at[i], n)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def _languages(batches):
    for batch in batches:
        seeds = [language_seed(x) for x in batch.column("lang").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(signed(np.array(seeds, np.uint64)))], ["lang", "h1"]
        )


def named_phrases(spark: SparkSession, docs: DataFrame, texts: list[DataFrame], frequent: DataFrame,
                  longest: int = LONGEST):
    """(lang, phrase binary, n, c) of the frequent phrases, and (lang, words) of each language.

    Any occurrence tells a phrase's text, so a part of the first shard is read for all of them, the shard for
    those without a text yet, and the other shards for what is left then.
    """
    phrases, found = frequent.where("n > 0"), None
    few = texts[0].where(F.pmod(F.xxhash64("text"), F.lit(4)) == 0)
    rest = texts[1:2]
    for part in texts[2:]:
        rest = [rest[0].unionByName(part)]
    for part in (few, texts[0], *rest):
        left = phrases if found is None else stored(phrases.join(found, ["h1", "h2", "n"], "left_anti"), "nameless")
        if left.isEmpty():
            break
        wanted = spark.sparkContext.broadcast(packed(_filter_with(None, left)))
        told = part.mapInArrow(_named(wanted, longest, TEXT_BYTES), "h1 long, h2 long, n int, lang string, phrase binary")
        # A phrase has one language and one text; those that only the filter took for wanted are dropped.
        told = told.dropDuplicates(["h1", "h2", "n"]).join(left.select("h1", "h2", "n"), ["h1", "h2", "n"], "left_semi")
        found = told if found is None else found.unionByName(told)
        found = stored(found, "names")
    if found is None:
        found = spark.createDataFrame([], "h1 long, h2 long, n int, lang string, phrase binary")
    named = stored(phrases.join(found, ["h1", "h2", "n"]).select("lang", "phrase", "n", "c"), "named")
    langs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang")).distinct()
    totals = frequent.where("n = 0").select("h1", F.col("c").alias("words"))
    return named, langs.mapInArrow(_languages, "lang string, h1 long").join(totals, "h1").select("lang", "words")


def _parts(phrase: bytes) -> list[bytes]:
    return phrase.split(b" ")


def _cuts(batches):
    """(lang, phrase, a, k, which, part): the two parts of each cut of each phrase."""
    names = ["lang", "phrase", "a", "k", "first", "rest"]
    types = [pa.string(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    for batch in batches:
        rows = []
        for lang, phrase, c in zip(*(batch.column(x).to_pylist() for x in ("lang", "phrase", "c"))):
            words = _parts(phrase)
            for k in range(1, len(words)):
                rows.append((lang, phrase, c, k, b" ".join(words[:k]), b" ".join(words[k:])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _inner(batches):
    """(lang, phrase, longer): the shorter phrases of two words and more inside each phrase, with its count."""
    names, types = ["lang", "phrase", "longer"], [pa.string(), pa.binary(), pa.int64()]
    for batch in batches:
        rows = []
        for lang, phrase, c in zip(*(batch.column(x).to_pylist() for x in ("lang", "phrase", "c"))):
            words = _parts(phrase)
            for n in range(2, len(words)):
                rows += [(lang, part, c) for part in {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST,
                 covered: int = COVERED, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two to ``longest`` words of each language."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "lang")
    texts = dealt(docs, shards)
    frequent = count_phrases(spark, docs, texts, least, longest)
    named, totals = named_phrases(spark, docs, texts, frequent, longest)
    candidates = named.where("n > 1")

    inside = candidates.where("n > 2").mapInArrow(_inner, "lang string, phrase binary, longer long")
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    hidden = F.coalesce(F.col("longer").cast("decimal(38,0)") * 100 >= F.col("c").cast("decimal(38,0)") * covered, F.lit(False))
    kept = candidates.join(inside, ["lang", "phrase"], "left").where(~hidden).select("lang", "phrase", "n", "c")

    cuts = stored(
        kept.mapInArrow(_cuts, "lang string, phrase binary, a long, k int, first binary, rest binary")
        .withColumns({"first_key": F.struct("lang", "first"), "rest_key": F.struct("lang", "rest")}), "cuts"
    )
    # A frequent word begins or ends many phrases, so its key is salted.
    counts = named.select(F.struct("lang", F.col("phrase").alias("first")).alias("first_key"), F.col("c").alias("l"))
    counts_r = named.select(F.struct("lang", F.col("phrase").alias("rest")).alias("rest_key"), F.col("c").alias("r"))
    both = stored(salted_join(cuts, counts, "first_key"), "first_parts")
    both = salted_join(both, counts_r, "rest_key")
    twice = F.lit(2_000_000).cast("decimal(38,0)") * F.col("a").cast("decimal(20,0)")
    score = F.call_function("div", twice, F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))
    scored = both.select("lang", "phrase", "a", "k", "l", "r", score.alias("score"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.decode("phrase", "utf-8").alias("phrase"),
        "a", "l", "r", F.col("words").alias("n"), "score",
    )
