"""Exact deduplication with an index of live digests behind cuckoo filters.

A text's digest is the SHA-256 of its normalised form (each run of ASCII white space as one space; null
counts as empty). Digests are dealt over shards by their leading bits, so many that a shard stays small.
A shard holds a cuckoo filter (four 16-bit fingerprints a bucket, two buckets a digest) and, bucket by
bucket, the whole digests. A lookup that the filter denies is new; one that it allows is verified against
the digests of the bucket. An insertion that finds no place after ``KICKS`` moves makes the shard grow to
twice the buckets, filled again from the stored digests. Deleting the last live row of a digest takes
its fingerprint out.

Defined cases: null and empty texts are one group; repeated rows count once each; of rows with the same smallest
doc_id all stay; a null doc_id never wins against another (a group of null ids keeps null); an empty
table gives an empty result; extra columns, whatever their names, pass through ``kept_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, rows_at_once, salted_join
from tidemark.settings import stored

SPACE = r"[\x20\x09-\x0D]+"
SLOTS = 4
KICKS = 200
#: Digests that a shard is planned for; a shard that gets more grows.
SHARD_DIGESTS = 50_000
#: Rows that may reach the index for one digest: so many salts combine copies before the shuffle by digest.
SALTS = 8
INDEX = "shard int, digest string, keep_id long, live long, buckets int, filter binary"


def digest(text) -> F.Column:
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256)


class CuckooShard:
    """One shard: a filter of fingerprints and the digests by bucket, each with its kept id and live rows."""

    def __init__(self, buckets: int = 16):
        self.reset(buckets)
        self.found = self.false_hits = self.grown = 0

    def reset(self, buckets: int) -> None:
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.content: dict[int, dict[str, list]] = {}

    def places(self, digest: str) -> tuple[int, int, int]:
        """The fingerprint, never 0, and the home bucket with its partner."""
        print_ = int(digest[-4:], 16) or 1
        home = int(digest[16:32], 16) & (self.buckets - 1)
        return print_, home, self.partner(home, print_)

    def partner(self, bucket: int, print_: int) -> int:
        return bucket ^ ((print_ * 0x5BD1E995) & (self.buckets - 1))

    def find(self, digest: str) -> list | None:
        print_, home, other = self.places(digest)
        table = self.table
        if print_ not in table[home].tolist() and print_ not in table[other].tolist():
            return None
        entry = self.content.get(home, {}).get(digest)  # a hit of the filter is only a hint
        if entry is None:
            self.false_hits += 1
        else:
            self.found += 1
        return entry

    def insert(self, digest: str, keep_id, live: int = 1) -> bool:
        """Whether the digest is new."""
        entry = self.find(digest)
        if entry is not None:
            entry[1] += live
            if entry[0] is None or (keep_id is not None and keep_id < entry[0]):
                entry[0] = keep_id
            return False
        home = self.places(digest)[1]
        self.content.setdefault(home, {})[digest] = [keep_id, live]
        if not self.place(digest):
            self.grow()
        return True

    def place(self, digest: str) -> bool:
        print_, bucket, other = self.places(digest)
        for spot in (bucket, other):
            free = np.flatnonzero(self.table[spot] == 0)
            if len(free):
                self.table[spot, free[0]] = print_
                return True
        for kick in range(KICKS):
            slot = (kick * 7 + print_) % SLOTS
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
            bucket = self.partner(bucket, print_)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = print_
                return True
        return False

    def grow(self) -> None:
        """Twice the buckets until all stored digests fit, filled from the digests themselves."""
        kept = [x for bucket in self.content.values() for x in bucket.items()]
        buckets = self.buckets
        while True:
            buckets *= 2
            self.grown += 1
            self.reset(buckets)
            for key, entry in kept:
                self.content.setdefault(self.places(key)[1], {})[key] = entry
            if all(self.place(key) for key, _ in kept):
                return

    def delete(self, digest: str, live: int = 1) -> bool:
        """Takes live rows of a digest away; whether it is gone. An unknown digest is left as it is."""
        entry = self.find(digest)
        if entry is None:
            return False
        entry[1] -= live
        if entry[1] > 0:
            return False
        print_, home, other = self.places(digest)
        del self.content[home][digest]
        for spot in (home, other):
            at = np.flatnonzero(self.table[spot] == print_)
            if len(at):
                self.table[spot, at[0]] = 0
                return True
        return True

    def rows(self, shard: int) -> pd.DataFrame:
        """The digests, and the filter in a row of its own."""
        entries = [(k, v[0], v[1]) for bucket in self.content.values() for k, v in bucket.items()]
        none = [None] * len(entries)
        return pd.DataFrame({
            "shard": [shard] * (len(entries) + 1),
            "digest": [None, *(e[0] for e in entries)],
            "keep_id": pd.array([None, *(e[1] for e in entries)], "Int64"),
            "live": pd.array([None, *(e[2] for e in entries)], "Int64"),
            "buckets": pd.array([self.buckets, *none], "Int64"),
            "filter": [self.table.tobytes(), *none],
        })

    @classmethod
    def load(cls, rows: pd.DataFrame) -> CuckooShard:
        shard = cls()
        if not len(rows):
            return shard
        head = rows[rows["digest"].isna()].iloc[0]
        shard.reset(int(head["buckets"]))
        shard.table = np.frombuffer(head["filter"], np.uint16).reshape(-1, SLOTS).copy()
        known = rows[rows["digest"].notna()]
        for key, keep, live in zip(known["digest"], known["keep_id"], known["live"], strict=True):
            shard.content.setdefault(shard.places(key)[1], {})[key] = [None if pd.isna(keep) else int(keep), int(live)]
        return shard


def shards_for(digests: int) -> int:
    return max(8, -(-digests // SHARD_DIGESTS))


def _shard(shards: int):
    return F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def combined(changes: DataFrame) -> DataFrame:
    """``(digest, doc_id, change)`` with equal digests added up under a few salts, so that no digest is hot."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    adds = F.sum(F.when(F.col("change") > 0, F.col("change")).otherwise(0))
    return changes.groupBy("digest", salt.alias("salt")).agg(
        F.min(F.when(F.col("change") > 0, F.col("doc_id"))).alias("keep_id"),
        adds.alias("added"),
        (F.sum("change") - adds).alias("removed"),
    ).drop("salt")


class CuckooIndex:
    """Live digests as a table of shards. ``change`` gives the next version; versions are written tables."""

    def __init__(self, spark: SparkSession, table: DataFrame | None = None, shards: int = 8):
        self.spark, self.shards = spark, shards
        self.table = table if table is not None else spark.createDataFrame([], INDEX)

    def change(self, rows: DataFrame) -> CuckooIndex:
        """``rows``: digest, doc_id, change (+1: insert, -1: delete); insertions of a batch go first."""
        batch = combined(rows).withColumn("shard", _shard(self.shards))
        rows_at_once(batch, 10_000)

        def apply(key, index: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
            shard = CuckooShard.load(index)
            for d, keep, added in zip(changes["digest"], changes["keep_id"], changes["added"], strict=True):
                if added:
                    shard.insert(d, None if pd.isna(keep) else int(keep), int(added))
            for d, removed in zip(changes["digest"], changes["removed"], strict=True):
                if removed:
                    shard.delete(d, -int(removed))
            return shard.rows(int(key[0]))

        new = self.table.groupBy("shard").cogroup(batch.groupBy("shard")).applyInPandas(apply, INDEX)
        return CuckooIndex(self.spark, stored(new, "cuckoo"), self.shards)

    def digests(self) -> DataFrame:
        return self.table.where(F.col("digest").isNotNull()).select("digest", "keep_id", "live")


def duplicates(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(documents.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    total = rows.count()
    index = CuckooIndex(documents.sparkSession, shards=shards_for(total)).change(rows.withColumn("change", F.lit(1)))
    return salted_join(rows, index.digests(), "digest", total).select(
        "doc_id",
        "keep_id",
        F.col("live").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def kept_documents(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    gone_id, gone_digest = (free_name(documents.columns, c) for c in ("gone_id", "gone_digest"))
    gone = duplicates(documents).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_digest)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (digest(F.col("text")) == F.col(gone_digest))
    return documents.join(gone.hint("merge"), same, "left_anti")
