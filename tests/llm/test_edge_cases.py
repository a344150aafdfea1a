"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chaining, cuckoo, inner_products, language, minhash, packing, sharding, suffixes, toxicity
from tidemark.llm import bpe as transducer
from tidemark.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, rank int, bucket long"


def passage(seed: int, n: int) -> str:
    random = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in random.integers(0, 26, random.integers(2, 9))) for _ in range(n))


def odd_rows():
    long_ = passage(1, 30_000)
    shared = passage(2, 80)
    return [
        (1, None, "en", None, None, "x", 1, 1),
        (2, "", "en", "a", 0, None, None, None),
        (3, " \t\n ", None, "a", 3, "y", 2, 2),
        (4, long_, "en", "a", len(long_), "y", 2, 2),
        (5, long_, "en", "a", len(long_), "y", 2, 2),
        (6, "x", "en", "a", 1, "z", 3, 3),
        (7, "ab" * 40_000, "de", "a", 1, "z", 3, 3),
        (8, "1234 !!! ###", "de", "a", 1, "z", 3, 3),
        (9, passage(3, 40) + " " + shared + " " + passage(4, 40), "fr", "a", 1, "z", 3, 3),
        (10, shared + " " + passage(5, 60), "fr", "a", 1, "z", 3, 3),
        (11, "Ünïcödé 　 漢字 😀 <|endoftext|> it's\x1c\x85", "fr", "b", 1, "z", 3, 3),
        (12, "same", "fr", "b", 1, "z", 3, 3),
        (12, "same", "fr", "b", 1, "z", 3, 3),
    ]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd") / "documents")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 0, 1), (9, 1, 0), (9, None, None), (77, 0, 1)], "doc_id long, quality int, toxic int")


RUNS = {
    "shard": lambda d, _: sharding.sharded_digests(d),
    "identify": lambda d, _: language.identify(d),
    "duplicates": lambda d, _: cuckoo.duplicates(d),
    "toxicity": lambda d, labels: toxicity.toxicity(d, labels),
    "passages": lambda d, _: chaining.passages(d),
    "without_passages": lambda d, _: chaining.without_passages(d),
    "pack": lambda d, _: packing.pack(d, vocabulary("word_bpe_49k.json")),
    "encode": lambda d, _: transducer.encode(d, vocabulary("byte_bpe_50k.json")),
    "removed": lambda d, _: suffixes.removed(d),
    "near_duplicates": lambda d, _: minhash.near_duplicates(d),
    "kept_exact": lambda d, _: cuckoo.kept_documents(d),
    "kept_near": lambda d, _: minhash.kept_documents(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(none, labels, name):
    assert RUNS[name](none, labels).count() == 0


@pytest.mark.parametrize("name", [n for n in RUNS if n not in ("passages", "pack", "kept_exact", "kept_near")])
def test_one_row_for_each_row(documents, labels, name):
    ids = sorted(r["doc_id"] for r in RUNS[name](documents, labels).select("doc_id").collect())
    assert ids == sorted(r[0] for r in odd_rows())


@pytest.mark.parametrize("name", ["without_passages", "kept_exact", "kept_near"])
def test_columns_stay(documents, labels, name):
    assert RUNS[name](documents, labels).columns == documents.columns


def test_null_ids_do_not_crash(spark, labels):
    rows = spark.createDataFrame([(None, "a b c d e f", "en"), (None, None, None), (3, "a b c d e f", "en")], "doc_id long, text string, lang string")
    for name in ("shard", "identify", "duplicates", "toxicity", "removed", "near_duplicates", "without_passages"):
        assert RUNS[name](rows, labels).count() == 3, name
    assert RUNS["passages"](rows, labels).count() == 0


def test_shards_are_gapless_and_even(spark):
    rows = spark.range(4_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    out = sharding.sharded_digests(rows).collect()
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        text = "hot" if r["doc_id"] % 3 == 0 else str(r["doc_id"])
        assert r["text_crc32"] == zlib.crc32(text.encode()) and r["size"] == len(text) + 16
    assert len(out) == 4_000 and set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 40 + 40


def test_und_only_without_letters(documents):
    told = {r["doc_id"]: r for r in language.identify(documents).collect()}
    for doc, text in {r[0]: r[1] for r in odd_rows()}.items():
        assert (told[doc]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= told[doc]["score"] <= 1


def test_repeated_rows_are_packed_once_each(documents):
    path = vocabulary("word_bpe_49k.json")
    pieces, sequences = defaultdict(int), defaultdict(list)
    for r in packing.pack(documents, path).collect():
        pieces[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    assert pieces[1] == pieces[2] == pieces[3] == 1 and pieces[12] == 2 * 2
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    padding = sum(packing.WINDOW - sum(n for _, n in p) for p in sequences.values())
    assert padding < packing.WINDOW


def test_products_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [float("inf"), 1.0]), (5, [0.5, 0.5]),
            (6, [0.5, 0.5]), (7, []), (8, [3.0]), (100, [-1.0, -1.0]), (None, [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = inner_products.top_products(vectors, F.pmod("vec_id", F.lit(100)) == 0).collect()
    usable = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if i in (0, 5, 6, 7, 8, 100)}
    for q in (0, 100):
        scores = sorted(
            (-sum(a * b for a, b in zip(usable[q], v, strict=False)), i) for i, v in usable.items() if i != q
        )
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert mine == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert {r["query_id"] for r in found} == {0, 100}
    empty = inner_products.top_products(vectors.where("vec_id = 1"), F.col("vec_id") == 1)
    assert empty.count() == 0


def test_no_local_library_paths():
    assert os.path.exists(vocabulary("byte_bpe_50k.json"))
