"""Hilbert windows, packed R-trees and dynamic itemsets, against brute force and on odd input."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, duckdb_result, spark_result
from tidemark.llm import hilbert, phrases, rtree
from tidemark.llm.queries import ORACLE, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, key string, rank int, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "k", 1, 2)
                                  for i, v, l in rows], VECTORS)


def every(n):
    return F.pmod("vec_id", F.lit(n)) == 0


# -- Hilbert windows ----------------------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 6)])
def test_hilbert_keys_visit_neighbours(dims, bits):
    """Every cell has a key of its own, and the cells of following keys touch."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 20)) * 10.0 ** rng.integers(-3, 4, size=(300, 1))
    q = rng.normal(size=(40, 20))
    codes, scale, loss = hilbert.rounded(x)
    low, high = hilbert.bounds(q, codes, scale, loss)
    true = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    assert (low <= true).all() and (true <= high).all()


def nearest(x, ids, asked, k=10):
    out = {}
    for i in asked:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[ids == ids[i]] = np.inf
        order = np.lexsort((ids, d))[: min(k, int(np.isfinite(d).sum()))]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def found_by(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall_over_small_blocks(spark, monkeypatch, clusters):
    monkeypatch.setattr(hilbert, "BLOCK", 64)
    rng = np.random.default_rng(clusters)
    x = rng.normal(size=(3_000, 16))
    if clusters:
        x = 0.1 * x + rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 3_000)]
    x = x.astype(np.float32).astype(float)
    rows = vectors(spark, [(i, v, 0) for i, v in enumerate(x)]).repartition(5)
    index = hilbert.Index(rows, every(20))
    reach = index.reach()
    got = found_by(index.nearest(reach))
    want = nearest(x, np.arange(3_000), range(0, 3_000, 20))
    share = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    assert share >= 0.9
    # Clustered rows need narrow windows; what is found has its exact distance.
    assert not clusters or reach < 900
    for q in got:
        for i, score in got[q]:
            assert score == pytest.approx(np.sqrt(((x[q] - x[i]) ** 2).sum()), abs=1e-12)


def test_copies_do_not_crowd_a_window(spark, monkeypatch):
    """A third of the rows is one vector: its askers get the smallest ids, others still find their own."""
    monkeypatch.setattr(hilbert, "BLOCK", 32)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 6)).astype(np.float32).astype(float)
    x[::3] = x[0]
    ids = np.arange(900)
    index = hilbert.Index(vectors(spark, [(int(i), v, 0) for i, v in zip(ids, x)]).repartition(4), every(10))
    got, want = found_by(index.nearest(400)), nearest(x, ids, range(0, 900, 10))
    for q in want:
        if q % 3 == 0:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and got[q][0][1] == 0
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) > 0.9


ODD = [
    (None, [1, 1], 0), (0, None, 0), (10, [], 0), (20, [0, 0], 0), (30, [1, None], 0), (40, [float("nan"), 1], 0),
    (50, [float("inf"), 1], 0), (60, [1, 2, 3], 0), (1, [1, 2], 1), (2, [1, 2], None), (3, [1, 2], 2), (3, [1, 2], 2),
    (70, [1, 2], 0), (71, [3e38, 3e38], 1), (72, [-3e38, 3e38], 0), (4, [1e-40, 0], 3),
]


def test_odd_vectors(spark):
    got = found_by(hilbert.nearest_neighbours(vectors(spark, ODD), every(10)))
    assert set(got) == {60, 70}
    assert [i for i, _ in got[70]][:3] == [1, 2, 3] and [s for _, s in got[70]][:3] == [0, 0, 0]
    assert sorted(i for i, _ in got[60]) == [1, 2, 3, 4, 70, 71, 72]
    assert dict(got[60])[70] == 3.0
    empty = hilbert.nearest_neighbours(vectors(spark, []), every(10))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    assert hilbert.nearest_neighbours(vectors(spark, [(10, [1, 2], 0)]), every(10)).count() == 0


def test_query_of_neighbours(spark):
    sf = os_folder()
    got = found_by(QUERIES["op11_hilbert_windows"](spark, sf))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    want = nearest(x, ids, np.flatnonzero(ids % 100 == 0))
    # So few rows are one block: the windows hold all of them.
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def os_folder():
    import os

    return os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


# -- R-tree -------------------------------------------------------------------------------------------


def brute_negatives(rows, step, positives=5, negatives=3):
    """Straight from the rule."""
    v = {}
    for i, x, label in rows:
        if i is not None and x is not None and label is not None and all(c is not None and np.isfinite(c) for c in x):
            w = [int(np.floor(256 * float(np.float32(c)))) for c in x]
            v[i] = min(v.get(i, (label, w)), (label, w))
    out = []
    for a in v:
        if a % step:
            continue
        score = {b: sum(x * y for x, y in zip(v[a][1], v[b][1])) for b in v if b != a}
        best = sorted((b for b in score if v[b][0] == v[a][0]), key=lambda b: (-score[b], b))[:positives]
        for p in best:
            fine = [b for b in score if v[b][0] != v[a][0] and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            for rank, n in enumerate(sorted(fine, key=lambda b: (-score[b], b))[:negatives], 1):
                out.append((a, p, rank, n, score[p], score[n]))
    return sorted(out)


@pytest.mark.parametrize("seed,labels,spread", [(0, 3, 1.0), (1, 8, 0.2), (2, 2, 0.02)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, seed, labels, spread):
    """Small subtrees, leaves and pages, so that every level is walked; a third of the rows has one label."""
    monkeypatch.setattr(rtree, "SUBTREE", 60)
    monkeypatch.setattr(rtree, "LEAF", 8)
    monkeypatch.setattr(rtree, "PAGE", 3)
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(900):
        x = rng.normal(size=5) * spread + (1 if seed == 2 else 0)
        if i % 50 == 7:
            x = np.ones(5)  # ties
        rows.append((i, [float(np.float32(c)) for c in x], 0 if rng.random() < 0.34 else int(rng.integers(labels))))
    got = rtree.hard_negatives(vectors(spark, rows).repartition(4), every(20))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 20)


def test_boxes_bound_and_prune():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, size=(2_000, 6)) + 1_000 * rng.integers(0, 2, size=(2_000, 1))
    ids = rng.permutation(2_000)
    order, starts, lo, hi = rtree.leaves_of(ids, x)
    assert sorted(order.tolist()) == list(range(2_000)) and len(starts) >= 2_000 // rtree.LEAF
    q = rng.integers(-100, 100, size=(30, 6))
    least, greatest = rtree.intervals(q, lo, hi)
    ends = np.r_[starts[1:], len(ids)]
    for j, (b, e) in enumerate(zip(starts, ends)):
        s = q @ x[order][b:e].T
        assert (least[:, j] <= s.min(1)).all() and (s.max(1) <= greatest[:, j]).all()
    low, high = np.full((30, 1), 5_000), np.full((30, 1), 20_000)
    opened = rtree.open_boxes(least, greatest, low, high, np.full((30, 1), rtree.LOWEST))
    assert 0 < opened.mean() < 1
    held = rtree.search(np.full(30, -1), q, low, high, np.full((30, 1), rtree.LOWEST), 4, ids[order], x[order], starts, lo, hi)
    for a in range(30):
        s = q[a] @ x.T
        fine = sorted((-v, i) for v, i in zip(s.tolist(), ids.tolist()) if 5_000 <= v <= 20_000)[:4]
        mine = held[0] == a
        assert sorted(zip((-held[3][mine]).tolist(), held[2][mine].tolist())) == fine


def test_scores_beyond_floats_are_exact(spark):
    big = 1 << 20  # products beyond 2 ** 53, and within 64 bits
    rows = [(0, [big, 1], 0), (1, [big, 2], 0), (2, [big - 2, 5], 1), (3, [big - 2, 4], 1), (4, [big // 2, 3], 2)]
    got = rtree.hard_negatives(vectors(spark, rows), every(20))
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 20)


def test_odd_rows_of_negatives(spark):
    rows = [r for r in ODD if r[0] not in (71, 72)] + [(80, [], 1), (20, [1, 1], 0), (5, [0.7, 1.4], 1), (6, [0.8, 1], 2)]
    got = rtree.hard_negatives(vectors(spark, rows), every(10))
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10)
    assert rtree.hard_negatives(vectors(spark, []), every(10)).count() == 0
    assert rtree.hard_negatives(vectors(spark, [(1, [1, 2], 0)]), every(10)).count() == 0


# -- dynamic itemsets ---------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, phrase string, rank int, n long, h1 long"


def brute_phrases(rows, least, first=2_000, covered=80):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    many = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    hidden = set()
    for p, a in many.items():
        for i, j in itertools.combinations(range(1, len(p) + 1), 2):
            part = (p[0], *p[i:j])
            if 2 <= j - i < len(p) - 1 and 100 * a >= covered * counts[part]:
                hidden.add(part)
    out = {}
    for p, a in many.items():
        if p not in hidden:
            cuts = [(2_000_000 * a // (counts[p[: k + 1]] + counts[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            row = (" ".join(p[1:]), a, counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])], totals[p[0]], score)
            out.setdefault(p[0], []).append(row)
    return sorted(
        (lang, rank, *row) for lang, rows_ in out.items()
        for rank, row in enumerate(sorted(rows_, key=lambda r: (-r[5], -r[1], r[0].encode()))[:first], 1)
    )


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, t, lang in rows], DOCS)


def counted(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shards", [1, 3, 4])
@pytest.mark.parametrize("table", ["pairs", "none"])
def test_phrases_match_brute_force(spark, monkeypatch, shards, table):
    """Phrases that come late, in one shard only, in every shard; with and without the table of pairs."""
    if table == "none":
        monkeypatch.setattr(phrases, "FULL", -1)
    rng = np.random.default_rng(shards)
    rows = []
    for i in range(240):
        words = [f"w{int(w)}" for w in rng.zipf(1.6, 60) if w < 60]
        if i % 3 == 0:
            words += ["New", "york", "CITY", "hall"]
        text = " ".join(words) + rng.choice([". ", "\n", ";", " \t "]) + "rare pair here"
        rows.append((i, text, [None, "en", "de"][int(rng.integers(3))] if i < 200 else "late"))
    got = phrases.collocations(documents(spark, rows), least=12, shards=shards)
    assert counted(got) == brute_phrases(rows, 12)


def test_first_of_each_language(spark):
    rows = [(i, "a b c d " * 5 + "x y, " * i, "en" if i % 2 else "de") for i in range(20)]
    got = phrases.collocations(documents(spark, rows), least=5, first=3)
    assert counted(got) == brute_phrases(rows, 5, first=3)


def test_a_saturated_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)
    rows = [(i, f"one two three four u{i} v{i % 7} one two", "en") for i in range(60)]
    assert counted(phrases.collocations(documents(spark, rows), least=8)) == brute_phrases(rows, 8)


def test_odd_texts_of_phrases(spark):
    long_ = "word " * 3_000 + "x" * 70_000 + " end " + "ü é ß " * 2_000
    rows = [
        (1, None, "en"), (2, "", None), (3, " \t\n ", "en"), (4, long_, "en"), (4, long_, "en"), (None, "null id null id", None),
        (5, "ÀB àb ÀB àb İi", "fr"), (6, "..,,;;", "en"), (7, "zero\x00byte zero\x00byte\x85 a b", "fr"), (8, long_.upper(), "en"),
        (9, "y" * 100 + " tail " + "y" * 100 + " tail", "de"),
    ]
    got = phrases.collocations(documents(spark, rows), least=2)
    assert counted(got) == brute_phrases(rows, 2)
    assert phrases.collocations(documents(spark, []), least=2).count() == 0


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TEXT_BYTES", 100)
    rows = [(i, "alpha beta gamma delta. " * 40 + "alpha " * 60, "en") for i in range(3)]
    assert counted(phrases.collocations(documents(spark, rows), least=3)) == brute_phrases(rows, 3)


# -- the queries against SQL ----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_dynamic_itemsets", "op13_rtree_negatives"])
def test_query_matches_sql(spark, name):
    folder = os_folder()
    assert spark_result(QUERIES[name](spark, folder)) == duckdb_result(connect(folder), ORACLE[name])


def test_settings_are_left_alone(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]
    for name in ("op11_hilbert_windows", "op13_rtree_negatives"):
        QUERIES[name](spark, os_folder()).count()
    assert [spark.conf.get(k) for k in keys] == before
