"""Language ID with language-bitmask n-gram filters.

The model is a Bloom filter whose slots hold language bitmasks instead of bits: slot s of word w has bit i set
if some n-gram of language 64 * w + i hashes to s. The AND of an n-gram's ``PROBES`` slots is the set of all
languages whose n-grams contain it (and false positives). A text's n-grams are looked up at once; each
language's hits are counted, what its filter would hit by chance is taken off, and the largest count decides.

Learning counts n-grams where the documents lie and keeps, per language, the ``GRAMS`` n-grams found in most
of its sample documents among those at least ``SHARE`` as frequent as in any other language. An n-gram must be
in ``FLOOR`` sample documents of the language, or in all its learning documents if they are fewer. The
sample takes all documents of a language up to about ``SAMPLE_DOCS``, by a hash of the id.

Defined cases: a null, empty or letterless text is ``und`` with score 0; a text without any known n-gram
gets the language with most learning rows and score 0; equal counts go to the language that sorts first;
without learning rows every text is ``und``. Texts of any length are read whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import MIX, in_batches, mix, signed, slices, texts
from tidemark.settings import stored

UNKNOWN = "und"
SIZES = (2, 3, 4)
SLOTS = 1 << 19
PROBES = 3
GRAMS = 20_000
SHARE = 0.5
SAMPLE_DOCS = 4_000
#: Sample documents that an n-gram must be in.
FLOOR = 3


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def points(text: str) -> np.ndarray:
    """Code points in lower case, one blank for each run of others, a blank at both ends; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.uint32)
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    out = codes[keep]
    head = [] if out[0] == 32 else [np.array([32], np.uint32)]
    tail = [] if out[-1] == 32 else [np.array([32], np.uint32)]
    return np.concatenate([*head, out, *tail])


def grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams of all sizes."""
    wide = codes.astype(np.uint64)
    out = []
    for size in SIZES:
        n = len(wide) - size + 1
        if n <= 0:
            continue
        h = np.full(n, np.uint64(size), np.uint64)
        for i in range(size):
            h = h * MIX + wide[i : i + n]
        out.append(mix(h))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _probes(h: np.ndarray) -> list[np.ndarray]:
    """Double hashing: slot i is first + i * step."""
    first, step = h & np.uint64(SLOTS - 1), (h >> np.uint64(32)) | np.uint64(1)
    return [((first + np.uint64(i) * step) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(PROBES)]


class LanguageFilters:
    """Bit-sliced filters of any number of languages, 64 to a plane."""

    def __init__(self, languages: list[str], grams_of: dict[str, np.ndarray], usual: str | None):
        self.languages = sorted(languages)
        self.usual = usual
        planes = max(1, -(-len(self.languages) // 64))
        width = np.uint8 if len(self.languages) <= 8 else np.uint64
        self.planes = [np.zeros(SLOTS, width) for _ in range(planes)]
        for i, language in enumerate(self.languages):
            plane, bit = self.planes[i // 64], width(1 << (i % 64))
            for at in _probes(grams_of[language]):
                plane[at] |= bit
        self.chance = np.array(
            [np.mean(self.planes[i // 64] >> np.array(i % 64, width) & width(1)) ** PROBES
             for i in range(len(self.languages))]
        )

    def counts(self, codes: np.ndarray) -> tuple[int, np.ndarray]:
        """The number of n-grams and each language's hits, read in pieces that overlap by an n-gram's length."""
        hits, total, piece = np.zeros(len(self.languages), np.int64), 0, 1 << 18
        overlap = max(SIZES) - 1
        for begin in range(0, len(codes), piece):
            h = grams(codes[begin : begin + piece + overlap])
            if begin + piece + overlap < len(codes) or begin:
                h = _own_grams(codes, begin, piece)
            total += len(h)
            at = _probes(h)
            for p, plane in enumerate(self.planes):
                sets = plane[at[0]]
                for other in at[1:]:
                    sets = sets & plane[other]
                if plane.dtype == np.uint8:
                    found = np.bincount(sets, minlength=256)
                    values = np.arange(256)
                    for i in range(min(8, len(self.languages))):
                        hits[i] += found[(values >> i) & 1 == 1].sum()
                else:
                    for i in range(64 * p, min(64 * p + 64, len(self.languages))):
                        hits[i] += int((sets >> np.uint64(i % 64) & np.uint64(1)).sum())
        return total, hits

    def decide(self, text: str) -> tuple[str, float]:
        codes = points(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        total, hits = self.counts(codes)
        real = np.maximum(0, (hits - total * self.chance) / np.maximum(1e-9, 1 - self.chance))
        if not real.any():
            return self.usual, 0.0
        best = int(np.argmax(real))
        return self.languages[best], float(min(1.0, real[best] / real.sum()))


def _own_grams(codes: np.ndarray, begin: int, piece: int) -> np.ndarray:
    """The n-grams that start in a piece, none twice."""
    out = []
    wide = codes[begin : begin + piece + max(SIZES) - 1].astype(np.uint64)
    for size in SIZES:
        n = min(piece, len(wide) - size + 1)
        if n <= 0:
            continue
        h = np.full(n, np.uint64(size), np.uint64)
        for i in range(size):
            h = h * MIX + wide[i : i + n]
        out.append(mix(h))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _documents_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, documents that hold it), added up within a batch."""
    for batch in slices(batches):
        by: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
            by.setdefault(lang, []).append(np.unique(grams(points(text))))
        for lang, found in by.items():
            values, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values), pa.string()), pa.array(signed(values)), pa.array(n.astype(np.int64))],
                ["lang", "gram", "n"],
            )


def learn(rows: DataFrame) -> LanguageFilters:
    """Filters from the columns doc_id, text and lang; rows with a null text or lang are left out."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters([], {}, None)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, SAMPLE_DOCS / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    sample = rows.where(draw < share)
    counted = in_batches(sample.select("lang", "text"), _documents_grams, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    docs = F.lit(1.0)
    for lang, n in sizes.items():
        docs = F.when(F.col("lang") == lang, float(min(n, SAMPLE_DOCS))).otherwise(docs)
    counted = counted.where(F.col("n") >= F.least(F.lit(float(FLOOR)), docs))
    counted = stored(counted.withColumn("rate", F.col("n") / docs), "grams")
    # One or two documents of a rare language never push an n-gram out of another's filter.
    top = counted.groupBy("gram").agg(F.coalesce(F.max(F.when(F.col("n") >= FLOOR, F.col("rate"))), F.lit(0.0)).alias("top"))
    # The sample is bounded, and so is what one language's window holds.
    best = Window.partitionBy("lang").orderBy(F.desc("rate"), "gram")
    kept = (
        counted.join(top, "gram")
        .where(F.col("rate") >= SHARE * F.col("top"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= GRAMS)
    )
    found: dict[str, list[int]] = {lang: [] for lang in sizes}
    for r in kept.select("lang", "gram").toLocalIterator():
        found[r["lang"]].append(r["gram"])
    usual = min(sizes, key=lambda x: (-sizes[x], x))
    return LanguageFilters(list(sizes), {k: np.array(v, np.int64).view(np.uint64) for k, v in found.items()}, usual)


def predict(
    documents: DataFrame, model: LanguageFilters, columns: list[str], lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``columns`` of ``documents`` with two more, named by ``lang`` and ``score``; reads the column text besides."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a fixed size per 64 languages
    kept = documents.select(*columns) if "text" in columns else documents.select(*columns, "text")

    def run(batches):
        for batch in slices(batches):
            decided = [shared.value.decide(x) for x in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns],
                 pa.array([d[0] for d in decided], pa.string()), pa.array([d[1] for d in decided], pa.float64())],
                [*columns, lang, score],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*columns).schema)
    return in_batches(kept, run, f"{schema}, `{lang}` string, `{score}` double")


def held_out(column: str = "doc_id"):
    """Rows that learning never sees."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learnt from the rows that are not held out."""
    model = learn(documents.where(~held_out()))
    return predict(documents, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
