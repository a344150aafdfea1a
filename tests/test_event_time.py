"""Ordering, the late-data rule and watermarks, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import micros, tag_window, tumbling
from tidemark.operators import ordering, watermarks
from tidemark.operators.running import running


def brute_positions(rows):
    """(key, time, arrival) -> place in the key's order."""
    places, seen = {}, {}
    for key, time, arrival in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2])):
        seen[key] = seen.get(key, 0) + 1
        places[key, arrival] = seen[key]
    return places


@pytest.mark.parametrize("seed,spread", [(1, 10_000), (2, 3), (3, 1), (4, 60)])
def test_position_in_slices_matches_brute_force(spark, seed, spread):
    """A third of the rows share a key, and with a small spread many share an event time."""
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < 0.34 else None if rng.random() < 0.2 else f"k{rng.randrange(40)}",
         None if rng.random() < 0.02 else rng.randrange(spread), arrival)
        for arrival in range(3_000)
    ]
    df = spark.createDataFrame(rows, "k string, t bigint, a bigint")
    got = ordering.with_position(df, "k", "t", "a", rows_per_slice=20 if seed == 1 else 100)
    assert {(r.k, r.a): r.position for r in got.collect()} == brute_positions(rows)


def test_many_cold_keys(spark):
    rows = [(f"k{i % 50}", i, i) for i in range(1_000)]
    df = spark.createDataFrame(rows, "k string, t bigint, a bigint")
    few = ordering.with_position(df, "k", "t", "a", rows_per_slice=100)
    assert {(r.k, r.a): r.position for r in few.collect()} == brute_positions(rows)


def test_more_ranges_than_any_cap(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", i % 5, i) for i in range(6_000)]
    df = spark.createDataFrame(rows, "k string, t bigint, a bigint")
    got = ordering.with_position(df, "k", "t", "a", rows_per_slice=15)
    assert {(r.k, r.a): r.position for r in got.collect()} == brute_positions(rows)


def test_ranges_stay_small_with_a_hot_key_and_a_hot_time(spark):
    rows = [("hot", 5 if i % 2 else i, i) for i in range(4_000)]
    df = spark.createDataFrame(rows, "k string, t bigint, a bigint")
    ranged = df.repartitionByRange(40, "k", "t", "a").groupBy(F.spark_partition_id()).count()
    assert ranged.agg(F.max("count")).first()[0] <= 400


def test_positions_far_from_zero(spark):
    """Many bounds, in numbers that doubles round."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 11}", (1 << 61) + rng.randrange(300_000), i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, t bigint, a bigint")
    got = ordering.with_position(df, "k", "t", "a", rows_per_slice=20)
    assert {(r.k, r.a): r.position for r in got.collect()} == brute_positions(rows)


def test_range_order_splits_a_hot_key(spark):
    rows = [("hot" if i % 3 else "cold", (i * 7919) % 1000, i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, t bigint, a bigint")
    ordered = ordering.in_event_time_order(df, "k", "t", "a", partitions=8)
    got = ordered.withColumn("p", F.spark_partition_id()).collect()
    hot = [(r.p, r.t, r.a) for r in got if r.k == "hot"]
    assert len({p for p, _, _ in hot}) > 3
    assert [(t, a) for _, t, a in hot] == sorted((t, a) for _, t, a in hot)


@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("known", [None, 500])
def test_running_blocks(spark, how, inclusive, known):
    rng = random.Random(7)
    values = [("a" if i % 3 else "b", i, rng.randrange(1000)) for i in range(500)]
    df = spark.createDataFrame(values, "p string, o bigint, v bigint")
    got = running(df, "o", F.col("v"), "r", how=how, partition=["p"], inclusive=inclusive, block=16, rows_known=known)
    fold = sum if how == "sum" else max
    for r in got.collect():
        before = [v for p, o, v in values if p == r.p and (o < r.o or (inclusive and o == r.o))]
        assert r.r == (fold(before) if before else (0 if how == "sum" else None))


@pytest.mark.parametrize("kind", ["even", "dense and sparse", "single", "none"])
def test_first_at_or_after(spark, kind):
    rng = random.Random(11)
    marks = {
        "even": list(range(0, 100_000, 1_000)),
        "dense and sparse": sorted({rng.randrange(50) for _ in range(40)} | {10**6, 10**9, 10**12, 10**12 + 1}),
        "single": [5],
        "none": [],
    }[kind]
    steps = [(i + 1, m, marks[i - 1] if i else None) for i, m in enumerate(marks)]
    table = spark.createDataFrame(steps, "label bigint, mark bigint, previous bigint")
    values = sorted({rng.randrange(-10, 120_000) for _ in range(300)} | set(range(60)) | {10**9, 10**12, 10**12 + 1, 10**13})
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = watermarks.first_at_or_after(df, "v", table, "found").collect()
    assert sorted(r.v for r in got) == values
    for r in got:
        assert r.found == next((i for i, m, _ in steps if m >= r.v), None)


class Orderer:
    """The ordering rule, one event at a time: the brute force the queries are checked against."""

    def __init__(self):
        self.waiting, self.last, self.out, self.dropped = {}, {}, [], set()

    def event(self, key, time, tag):
        if time is None:
            self.out.append((key, tag))
        elif key in self.last and time <= self.last[key]:
            self.dropped.add(tag)
        else:
            self.waiting.setdefault((time, key), []).append(tag)

    def watermark(self, bound):
        for time, key in sorted((k for k in self.waiting if k[0] <= bound), key=lambda k: k[0]):
            self.out += [(key, tag) for tag in self.waiting.pop((time, key))]
            self.last[key] = time


def test_brute_force_follows_the_documented_cases():
    o = Orderer()
    for i, t in enumerate([1, 3, 2, 2, 4]):
        o.event("k", t, i)
    o.watermark(3)
    assert [tag for _, tag in o.out] == [0, 2, 3, 1]
    o.watermark(4)
    assert [tag for _, tag in o.out] == [0, 2, 3, 1, 4]
    o = Orderer()
    o.watermark(1)
    for i, t in enumerate([1, 3, 2, 1]):
        o.event("k", t, i)
    o.watermark(3)
    assert [tag for _, tag in o.out] == [0, 3, 2, 1]
    o.event("k", 2, 9)
    assert o.dropped == {9}


def arrivals(seed, count=1_500, epochs=40):
    rng = random.Random(seed)
    rows = []
    for offset in range(count):
        epoch = offset * epochs // count
        time = None if rng.random() < 0.02 else max(0, epoch * 25 - rng.randrange(200) + rng.randrange(40))
        key = "hot" if rng.random() < 0.34 else None if rng.random() < 0.1 else f"k{rng.randrange(15)}"
        rows.append((rng.randrange(3), offset, key, epoch * 3, time))
    return rows


def replayed(rows):
    """Dropped offsets and emitted order; a segment that is silent in an epoch keeps its newest time."""
    o, bound, marks, newest = Orderer(), None, [], {}
    for epoch in sorted({r[3] for r in rows}):
        for segment, offset, key, _, time in (r for r in rows if r[3] == epoch):
            o.event(key, time, offset)
            if time is not None:
                newest[segment] = max(newest.get(segment, time), time)
        if newest and (bound is None or min(newest.values()) > bound):
            bound = min(newest.values())
            marks.append((epoch, bound))
            o.watermark(bound)
    o.watermark(10**18)
    return o, marks


def log_of(spark, rows):
    return spark.createDataFrame(rows, "segment int, offset bigint, key string, epoch bigint, t bigint")


@pytest.mark.parametrize("seed", range(4))
def test_late_rule_matches_brute_force(spark, seed):
    rows = arrivals(seed)
    o, marks = replayed(rows)
    log = log_of(spark, rows)
    got = watermarks.mark_late(log, "key", "epoch", "t").collect()
    assert len(got) == len(rows)
    assert {r.offset for r in got if r.late} == o.dropped
    assert o.dropped
    advanced = watermarks.advances(watermarks.lower_bounds(log, "epoch", "t"), "epoch")
    assert sorted(map(tuple, advanced.collect())) == marks
    timed = {r[1]: r[4] for r in rows if r[4] is not None}
    emitted = watermarks.drop_late(log.filter("t IS NOT NULL"), "key", "epoch", "t")
    places = ordering.with_position(emitted, "key", "t", "offset", rows_per_slice=100)
    seen = {}
    for key, tag in o.out:
        if tag in timed:
            seen.setdefault(key, []).append(tag)
    assert {(r.key, r.offset): r.position for r in places.collect()} == {
        (k, tag): i + 1 for k, tags in seen.items() for i, tag in enumerate(tags)
    }


def test_a_silent_segment_holds_the_bound(spark):
    """Segment 1 pauses in the second epoch: its newest time, 5, still counts, and nothing is late."""
    rows = [(0, 0, "a", 0, 10), (1, 1, "a", 0, 5), (0, 2, "a", 1, 100), (0, 3, "b", 1, 7),
            (1, 4, "a", 2, 6), (1, 5, "b", 2, 8), (0, 6, "a", 2, 101), (1, 7, "c", 3, 200)]
    log = log_of(spark, rows)
    bounds = watermarks.lower_bounds(log, "epoch", "t").orderBy("epoch").collect()
    assert [(r.epoch, r.bound, r.in_force) for r in bounds] == [(0, 5, None), (1, 5, 5), (2, 8, 5), (3, 101, 8)]
    assert watermarks.drop_late(log, "key", "epoch", "t").count() == 8
    # With segments named that have not delivered yet, there is no bound at all.
    waiting = watermarks.lower_bounds(log, "epoch", "t", [0, 1, 2]).collect()
    assert {r.bound for r in waiting} == {None}


@pytest.mark.parametrize("seed", range(3))
def test_bounds_with_pauses_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, quiet = [], {}
    for n in range(600):
        epoch = n // 15
        quiet.setdefault(epoch, set(rng.sample(range(5), rng.randrange(4))))
        segment = rng.choice([s for s in range(5) if s not in quiet[epoch]])
        rows.append((segment, n, "k", epoch, None if rng.random() < 0.05 else epoch * 10 + rng.randrange(40)))
    expected, newest, bound = [], {}, None
    for epoch in range(40):
        before = bound
        for s, _, _, e, t in rows:
            if e == epoch and t is not None:
                newest[s] = max(t, newest.get(s, t))
        if newest:
            bound = min(newest.values()) if bound is None else max(bound, min(newest.values()))
        expected.append((epoch, bound, before))
    got = watermarks.lower_bounds(log_of(spark, rows), "epoch", "t")
    assert sorted(map(tuple, got.collect())) == expected


def test_late_rule_keeps_rows_below_the_watermark(spark):
    """At watermark 1 a row of time 1 is kept when its key has emitted nothing yet."""
    rows = [(0, 0, "other", 0, 1), (0, 1, "k", 1, 1), (0, 2, "k", 1, 3), (0, 3, "k", 1, 2), (0, 4, "k", 1, 1),
            (0, 5, "k", 2, 2), (0, 6, "k", 2, 4)]
    got = watermarks.mark_late(log_of(spark, rows), "key", "epoch", "t").collect()
    assert {r.offset for r in got if r.late} == {5}


def test_noted_marks(spark):
    rows = arrivals(9)
    log = log_of(spark, rows)
    marks = dict(replayed(rows)[1])
    noted, bound, expected = None, None, []
    for epoch in sorted({r[3] for r in rows}):
        times = [r[4] for r in rows if r[3] == epoch and r[4] is not None]
        if bound is not None and max(times) >= bound and (noted is None or bound > noted):
            noted = bound
            expected.append((epoch, bound, sum(r[3] == epoch for r in rows)))
        bound = marks.get(epoch, bound)
    assert sorted(map(tuple, watermarks.noted_marks(log, "epoch", "t").collect())) == expected


PRICES = [
    ("2.02", "Euro", "2019-12-12 00:00:01.001001"),
    ("1.11", "US Dollar", "2019-12-12 00:00:02.002001"),
    ("50", "Yen", "2019-12-12 00:00:03.004001"),
    ("3.1", "Euro", "2019-12-12 00:00:04.005001"),
    ("5.33", "US Dollar", "2019-12-12 00:00:05.006001"),
    ("0", "DUMMY", "2019-12-12 00:00:10"),
]


def prices(spark):
    df = spark.createDataFrame(PRICES, "price string, currency string, log_ts string")
    ts = F.date_trunc("MILLISECOND", F.col("log_ts").cast("timestamp_ntz")).cast("timestamp_ntz")
    return df.select(
        F.col("price").cast("decimal(38,18)").alias("price"), "currency",
        ts.alias("log_ts"), (ts + F.expr("INTERVAL 1 SECOND")).alias("ts"),
    )


def test_golden_windows(spark):
    got = tumbling(
        prices(spark).filter("currency <> 'DUMMY'"), "ts", "5 seconds",
        max_time=F.max(F.date_format("log_ts", "HH:mm:ss")), max_ts=F.max("ts"),
        n=F.count(F.lit(1)), max_price=F.max("price").cast("decimal(10,2)"),
    ).orderBy("window_end")
    assert [(str(r.window_end), r.max_time, str(r.max_ts)[:-3], r.n, str(r.max_price)) for r in got.collect()] == [
        ("2019-12-12 00:00:05", "00:00:03", "2019-12-12 00:00:04.004", 3, "50.00"),
        ("2019-12-12 00:00:10", "00:00:05", "2019-12-12 00:00:06.006", 2, "5.33"),
    ]


def test_window_tags_do_not_shuffle(spark):
    tagged = tag_window(prices(spark), "ts", "5 seconds")
    assert tagged.count() == 6
    assert "Exchange" not in tagged._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_micros_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The second hour repeats in New York on this night.
        texts = ["2023-11-05 01:30:00.000001", "2023-11-05 02:30:00", "1969-12-31 23:59:59.999999"]
        df = spark.createDataFrame([(t,) for t in texts], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        got = [r[0] for r in df.select(micros(df, "t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1699147800000001, 1699151400000000, -1]
