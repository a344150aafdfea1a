"""Helpers shared by the operators: tables, Arrow batches, words, and joins with hot keys."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.settings import shared_folder, shuffles_removed
from tidemark.sources.files import Files

#: Rows of one key that one task may get in a join before the key is salted, at least.
HOT_ROWS = 2_000
#: Most keys that may be salted; the row limit rises with the table so that there are never more.
MOST_HOT = 10_000
#: Rows and bytes of text that go to Python at a time.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)
MASK63 = (1 << 63) - 1


def free_name(columns: list[str], base: str) -> str:
    """``base``, lengthened until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_batches(df: DataFrame, function: Callable, schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``df.mapInArrow`` with small batches, so that a task never holds many long texts at once."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def rows_at_once(df: DataFrame, rows: int) -> DataFrame:
    """Sets the Arrow batch size for a narrow table that goes to Python next."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES, column: str = "text"):
    """Cuts batches further where their texts take more than ``most`` bytes; a row stays whole."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.cumsum([0 if x is None else len(x) for x in batch.column(column).to_pylist()])
        begin = 0
        while begin < batch.num_rows:
            base = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, base + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal values stay equal, all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words; of the whole sequence if it is shorter; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = mix(out * MIX + hashes[i : n - k + 1 + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def compact(df: DataFrame, purpose: str, *by: str) -> DataFrame:
    """As ``stored``, for wide rows: compressed more tightly, in folders by the last columns if some are named."""
    folder = shared_folder(df.sparkSession, purpose)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of tables that are no longer referred to.

    Spark does so when the driver collects garbage, which a driver with little to do may put off for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables made by ``stored`` or ``compact`` that nothing reads any more."""
    for table_ in tables:
        for folder in {name.rsplit("/", 1)[0] for name in table_.inputFiles()}:
            Files(table_.sparkSession, folder).remove(folder)


def salted_join(many: DataFrame, one: DataFrame, key: str, total: int | None = None, how: str = "inner") -> DataFrame:
    """Joins ``many`` with ``one``, whose keys are unique, on ``key``; no task gets an unbounded group.

    A key with more than ``max(HOT_ROWS, rows / MOST_HOT)`` rows in ``many`` is spread over as many copies
    of its row in ``one`` as it fills. At most MOST_HOT such keys exist, so their list is small.
    ``many`` is read twice: give a stored table. ``total`` is its row count, if known. Null keys match nothing.
    """
    spark = many.sparkSession
    total = many.count() if total is None else total
    limit = max(HOT_ROWS, total // MOST_HOT)
    hot = []
    if total > limit:
        counted = many.groupBy(key).count().where((F.col("count") > limit) & F.col(key).isNotNull())
        hot = counted.select(key, F.ceil(F.col("count") / limit).cast("int").alias("_copies")).collect()
    if not hot:
        return many.join(one, key, how)
    small = F.broadcast(spark.createDataFrame(hot, many.select(key).withColumn("_copies", F.lit(1)).schema))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in many.columns]), F.coalesce("_copies", F.lit(1)).cast("long"))
    left = many.join(small, key, "left").withColumn("_salt", spread.cast("int")).drop("_copies")
    right = one.join(small, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    ).drop("_copies")
    return left.join(right, [key, "_salt"], how).drop("_salt")
