"""What grows with the input: blocks are not broadcast, shuffles go when a table is written, chance costs little."""

import time

import numpy as np
from pyspark.sql import functions as F

from tests.llm.test_against_brute_force import brute_removed
from tidemark.llm import chaining, common, inner_products, suffixes, toxicity
from tidemark.settings import stored


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_vectors_are_never_broadcast(spark, monkeypatch):
    """The packed blocks take little room in their files, and much in memory."""
    plans, stored = {}, inner_products.stored
    monkeypatch.setattr(
        inner_products, "stored", lambda df, purpose: plans.update({purpose: plan_of(df)}) or stored(df, purpose))
    random = np.random.default_rng(61)
    vectors = random.integers(-900, 900, (700, 8)) / 1024
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(inner_products, "QUERY_ROWS", 3, raising=False)
    found = inner_products.top_products(table, F.col("vec_id") % 70 == 0, k=3).collect()
    assert "SortMergeJoin" in plans["products"] and "Broadcast" not in plans["products"]
    scores = np.floor(1024 * vectors) @ np.floor(1024 * vectors).T
    for q in range(0, 700, 70):
        own = sorted((-scores[q, c], c) for c in range(700) if c != q)[:3]
        assert [(-r["score"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == own


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffles_of_stored_tables_go_with_the_write(spark):
    for store in (stored, common.compact):
        before = shuffle_files(spark)
        kept = [store(spark.range(5_000).repartition(7, "id").groupBy((F.col("id") % 99).alias("k")).count(), "t")]
        for _ in range(40):
            if not (left := shuffle_files(spark) - before):
                break
            time.sleep(0.25)
        assert not left
        assert kept[0].count() == 99


def test_anchor_runs_shared_by_chance_are_not_compared(spark, monkeypatch):
    """Texts share lines of 30 bytes, which hold anchor runs but no window; few share a window."""
    random = np.random.default_rng(62)
    letters = lambda n: "".join(chr(97 + c) for c in random.integers(0, 26, n))
    lines = [letters(30) for _ in range(6)]
    texts = {d: "".join(letters(150) + lines[i] for i in random.integers(0, 6, 8)) for d in range(60)}
    cuts, compared = [], suffixes._compared
    monkeypatch.setattr(suffixes, "_compared", lambda c: cuts.append(c.count()) or compared(c))
    table = lambda: spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r["n_removed"] for r in suffixes.removed(table()).collect()} == {0}
    assert cuts == [0]
    for d in range(1, 30):  # windows at all places beside the lines
        at, n = int(random.integers(0, 1_000)), int(random.integers(100, 180))
        texts[d + 30] = texts[d + 30][:at] + texts[d][at : at + n] + texts[d + 30][at + n :]
    for spread, group in ((2, 3), (suffixes.SPREAD, suffixes.GROUP)):
        monkeypatch.setattr(suffixes, "SPREAD", spread)
        monkeypatch.setattr(suffixes, "GROUP", group)
        assert {r["doc_id"]: r["n_removed"] for r in suffixes.removed(table()).collect()} == brute_removed(texts)


def test_every_window_is_told_by_a_side():
    """Entries of two texts that share a window share the anchor run and one side of it."""
    random = np.random.default_rng(63)
    for _ in range(200):
        shared = random.bytes(100)
        sides = []
        for _ in range(2):
            raw = random.bytes(int(random.integers(0, 90))) + shared + random.bytes(int(random.integers(0, 90)))
            found = {}
            for mer, _, _, _, _, both in suffixes.entries(raw):
                for m, x in zip(mer.tolist(), both.tolist(), strict=True):
                    found.setdefault(m, set()).update({("left", x >> 32), ("right", x & 0xFFFFFFFF)} - {("left", 0), ("right", 0)})
            sides.append(found)
        assert any(sides[0][m] & sides[1][m] for m in sides[0].keys() & sides[1].keys())


def test_passages_are_the_same_in_parts(spark, monkeypatch):
    """Where pairs and contexts would take more than the words, they are done in parts, and nothing else changes."""
    random = np.random.default_rng(64)
    some = lambda n: ["".join(chr(97 + c) for c in random.integers(0, 26, 7)) for _ in range(n)]
    line, copied, texts = some(8), [some(60) for _ in range(4)], []
    for d in range(40):
        own = list(copied[d % 4]) if d % 3 else some(20)
        if d % 5 == 0:
            own[7::9] = some(len(own[7::9]))
        texts.append((d, " ".join([*some(60), *line, *some(60), *own, *some(30)])))
    table = spark.createDataFrame(texts, "doc_id long, text string")
    chained, met, tables = [], [], {}
    chains_of = chaining._chains_of
    meetings = chaining._beside_words
    monkeypatch.setattr(chaining, "_chains_of", lambda found: chained.append(1) or chains_of(found))
    monkeypatch.setattr(
        chaining, "_beside_words", lambda *a: met.append(a[3] is chaining._contexts) or meetings(*a))
    for parts in (1, 2):
        monkeypatch.setattr(chaining, "_rounds", lambda size, room: parts, raising=False)
        chained.clear(), met.clear()
        tables[parts] = {tuple(r) for r in chaining.passages(table).collect()}, len(chained), sum(met)
    assert len(tables[1][0]) > 20 and tables[1][0] == tables[2][0]
    assert tables[1][1:] == (2, 1) and tables[2][1:] == (3, 2)


def test_parts_grow_with_the_pairs():
    room = chaining.LEAST_ROOM
    assert [chaining._rounds(n, 0) for n in (0, 1, room, room + 1)] == [1, 1, 1, 2]
    assert chaining._rounds(9 * room, 3 * room) == 3


def test_large_tables_are_learnt_from_as_often_as_small_ones(spark, monkeypatch):
    rounds, round_ = [], toxicity._round
    monkeypatch.setattr(toxicity, "_round", lambda *a: rounds.append(1) or round_(*a))
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 100, raising=False)
    documents = spark.range(900).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "some vile words").otherwise("some fair words").alias("text")
    )
    model = toxicity.learn(documents, documents.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic")))
    assert len(rounds) == toxicity.EPOCHS
    assert model.score("some vile words") >= toxicity.THRESHOLD > model.score("some fair words")
