"""Sketches, sessions, joins and frames by time, ranks and groupings against plain versions."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.plans import series

SF_DIR = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    """The keys of every shuffle by hash, as text."""
    return re.findall(r"hashpartitioning\((.*?), \d+\)", plan(df))


def readings(spark, rows, more=""):
    return spark.createDataFrame(rows, f"device_id string, event_time timestamp, value double{more}")


def no_pairing(text):
    return "CartesianProduct" not in text and "NestedLoop" not in text


# --- Sketches ------------------------------------------------------------------


def test_sketch_quantiles_keep_their_stated_error(spark):
    n = 200_000
    rows = spark.range(n, numPartitions=7).select(
        F.lit("hot").alias("device_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") % 3600).alias("event_time"),
        (F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_003)), 2)).cast("double").alias("value"),
        (F.col("id") % 30_000).cast("string").alias("site"),
    )
    panes = op.sketch_panes(rows, 60, ["device_id"], ["site"])
    assert panes.count() == 60
    found = op.sketch_values(
        op.merged_sketches(panes, 3600, keys=["device_id"], distinct=["site"]),
        {"p1": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99},
        ["site"],
    ).first()
    assert found["value_count"] == n
    values = sorted(r["value"] for r in rows.select("value").collect())
    for name, q in (("p1", 0.01), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        below = sum(v <= found[name] for v in values) / n
        assert abs(below - q) <= op.rank_error() + 1 / n, name
    assert abs(found["site_count"] / 30_000 - 1) < 3 * op.distinct_error()
    assert op.rank_error() < 0.01 and op.distinct_error() < 0.02


def test_sketches_of_no_value_and_of_odd_values(spark):
    rows = readings(
        spark,
        [
            ("a", at(0), None),
            ("a", at(1), float("nan")),
            ("b", at(0), 5.0),
            ("b", at(70), None),
            ("b", None, 7.0),
            (None, at(0), 1.0),
        ],
    )
    panes = op.sketch_panes(rows, 60, ["device_id"], ["device_id"])
    found = op.sketch_values(op.merged_sketches(panes, 120, 60, ["device_id"], ["device_id"]), {"p50": 0.5}, ["device_id"])
    got = {(r["device_id"], r["window_start"]): (r["value_count"], r["p50"], r["device_id_count"]) for r in found.collect()}
    assert got == {
        ("a", at(0)): (0, None, 1),
        ("a", at(-60)): (0, None, 1),
        ("b", at(0)): (1, 5.0, 1),
        ("b", at(-60)): (1, 5.0, 1),
        ("b", at(60)): (0, None, 1),
        (None, at(0)): (1, 1.0, 0),
        (None, at(-60)): (1, 1.0, 0),
    }
    assert op.sketch_panes(rows.limit(0), 60, ["device_id"]).count() == 0


def test_sketches_are_partial_before_the_shuffle(spark):
    text = plan(series.sketch_windows(spark, SF_DIR))
    assert "partial_kll_sketch_agg_double" in text.split("Exchange")[-1]
    assert text.count("FileScan parquet") == 1


# --- Sessions ------------------------------------------------------------------


def random_readings(seed, n=400, span=40_000, devices=("a", "b", "c")):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        device = rng.choice(devices)
        second = rng.randrange(span) if rng.random() < 0.6 else rng.randrange(span // 400) * 400
        rows.append((device, at(second), float(rng.randrange(100))))
    return rows


@pytest.mark.parametrize("seed,gap,chunks", [(1, 60, (600, 7200)), (2, 100, (300,)), (3, 400, (500, 1000, 9000)), (4, 7000, ()), (5, 1, (50, 60))])
def test_sessions_equal_the_built_in_ones(spark, seed, gap, chunks):
    rows = readings(spark, random_readings(seed))
    found = op.session_totals(rows, gap, chunk_s=chunks).drop("last_reading")
    built_in = (
        rows.groupBy("device_id", F.session_window("event_time", f"{gap} seconds").alias("s"))
        .agg(F.sum("value").alias("value_sum"), F.count("value").alias("value_count"), F.count(F.lit(1)).alias("readings"))
        .select("device_id", "s.start", "s.end", "value_sum", "value_count", "readings")
    )
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, built_in.collect()))


def test_a_session_over_many_chunks_and_a_gap_per_device(spark):
    rows = [("long", at(30 * i), 1.0) for i in range(2000)] + [("short", at(30 * i), 1.0) for i in range(20)]
    rows += [("long", None, 1.0), (None, at(0), None), ("unknown", at(0), 1.0), ("long", at(80_000), None)]
    gaps = spark.createDataFrame([("long", 30), ("short", 29), (None, 5), ("unknown", None)], "device_id string, gap_s int")
    gaps = gaps.withColumnRenamed("device_id", "name")
    joined = readings(spark, rows).join(gaps, F.col("device_id").eqNullSafe(F.col("name"))).drop("name")
    found = op.session_totals(joined, "gap_s", chunk_s=(120, 3600)).collect()
    sizes = Counter((r["device_id"], r["readings"]) for r in found)
    assert sizes == {("long", 2000): 1, ("long", 1): 1, ("short", 1): 20, (None, 1): 1}
    (whole,) = [r for r in found if r["readings"] == 2000]
    assert (whole["session_start"], whole["last_reading"], whole["session_end"]) == (
        at(0), at(30 * 1999), at(30 * 2000),
    )
    (empty,) = [r for r in found if r["device_id"] is None]
    assert empty["value_sum"] is None and empty["value_count"] == 0
    assert op.session_totals(joined.limit(0), "gap_s").count() == 0


def test_sessions_shrink_before_the_shuffle_and_go_by_chunk(spark):
    df = series.session_windows(spark, SF_DIR)
    assert "partial_min" in plan(df).split("Exchange hashpartitioning")[-1]
    # After the buckets every shuffle of rows has a chunk in its key.
    assert all("_bucket" in k or "_group" in k for k in shuffles(df) if "device_id" in k)


# --- As-of joins ---------------------------------------------------------------


def plain_as_of(left, right, value):
    out = []
    for key, t, *rest in left:
        best = None
        if key is not None and t is not None:
            known = [r for r in right if r[0] == key and r[1] is not None and r[1] <= t]
            best = max(known, key=lambda r: (r[1], r[2]), default=None)
        out.append((key, t, *rest, *(value(best) if best else (None, None))))
    return Counter(out)


@pytest.mark.parametrize("seed,chunk", [(1, 10), (2, 300), (3, 3600), (4, 1_000_000)])
def test_as_of_equals_a_search(spark, seed, chunk):
    rng = random.Random(seed)
    keys = ["a", "a", "b", "c", None]

    def moment():
        return None if rng.random() < 0.05 else at(rng.randrange(-4000, 8000))

    left = [(rng.choice(keys), moment(), i) for i in range(300)]
    left += left[:20]
    right = [(rng.choice([*keys, "d"]), moment(), i, rng.choice([None, 1.5 * i])) for i in range(120)]
    right += [(k, t, i + 1000, v) for k, t, i, v in right[:40]]
    found = op.as_of(
        spark.createDataFrame(left, "k string, event_time timestamp, id int"),
        spark.createDataFrame(right, "k string, valid_from timestamp, n int, v double"),
        ["k"],
        ["v", "n"],
        tie=["n"],
        chunk_s=chunk,
    )
    assert found.columns == ["k", "event_time", "id", "v", "n"]
    assert Counter(map(tuple, found.collect())) == plain_as_of(left, right, lambda r: (r[3], r[2]))


def test_as_of_of_empty_sides(spark):
    left = spark.createDataFrame([("a", at(0))], "k string, event_time timestamp")
    right = spark.createDataFrame([], "k string, valid_from timestamp, v double")
    assert [tuple(r) for r in op.as_of(left, right, ["k"], ["v"]).collect()] == [("a", at(0), None)]
    assert op.as_of(left.limit(0), right, ["k"], ["v"]).count() == 0


def test_as_of_has_no_join_and_no_whole_series(spark):
    for name in ("asof_limits", "asof_last_view"):
        df = series.QUERIES[name](spark, SF_DIR)
        text = plan(df)
        assert "Join" not in text and no_pairing(text)
        # The only shuffle without the chunk is that of one row per chunk.
        whole = [k for k in shuffles(df) if "_chunk" not in k]
        assert len(whole) == 1


# --- Spans and near readings ---------------------------------------------------


@pytest.mark.parametrize("seed,bucket", [(1, 1), (2, 7), (3, 60), (4, 5000)])
def test_spans_equal_a_search(spark, seed, bucket):
    rng = random.Random(seed)
    points = [(rng.choice(["a", "b", None]), at(rng.randrange(-3000, 20_000)), i) for i in range(400)]
    points += [("a", None, -1), *points[:10]]
    spans = []
    for i in range(60):
        begin = rng.randrange(-4000, 20_000)
        length = rng.choice([0, 1, 5, 64, 500, 4096, 30_000, -10])
        spans.append((rng.choice(["a", "b", "c", None]), i, at(begin), at(begin + length)))
    spans += [("a", 100, None, at(5)), ("a", 101, at(5), None), spans[0]]
    found = op.within_spans(
        spark.createDataFrame(points, "k string, event_time timestamp, id int"),
        spark.createDataFrame(spans, "k string, span int, span_start timestamp, span_end timestamp"),
        ["k"],
        bucket_s=bucket,
    )
    expected = Counter(
        (*p, *s[1:])
        for p in points
        for s in spans
        if p[0] and p[0] == s[0] and None not in (p[1], s[2], s[3]) and s[2] <= p[1] < s[3]
    )
    assert Counter(map(tuple, found.collect())) == expected and expected


def test_a_long_span_is_few_rows_and_the_plan_pairs_nothing(spark):
    df = series.readings_in_spans(spark, SF_DIR)
    text = plan(df)
    assert no_pairing(text) and "_bucket" in text
    points = spark.createDataFrame([("a", at(86_400 * 180), 1)], "k string, event_time timestamp, id int")
    spans = spark.createDataFrame([("a", at(-86_400 * 365), at(86_400 * 365 * 2))], "k string, span_start timestamp, span_end timestamp")
    assert op.within_spans(points, spans, ["k"], bucket_s=60).count() == 1


@pytest.mark.parametrize("before,after,how", [(5, 5, "left_outer"), (0, 30, "inner"), (400, 0, "left_outer"), (0, 0, "inner")])
def test_near_readings_equal_a_search(spark, before, after, how):
    rng = random.Random(before + after)
    left = [(rng.choice(["a", "b", None]), at(rng.randrange(2000)), i) for i in range(150)]
    right = [(rng.choice(["a", "b", None]), at(rng.randrange(2000)), i) for i in range(150)]
    left, right = [*left, left[0], ("a", None, 900)], [*right, right[0], ("a", None, 901)]
    found = op.near_in_time(
        spark.createDataFrame(left, "k string, event_time timestamp, id int"),
        spark.createDataFrame(right, "k string, right_time timestamp, rid int"),
        before,
        after,
        keys=["k"],
        how=how,
    )
    assert found.columns == ["k", "event_time", "id", "right_time", "rid"]
    expected = Counter()
    for k, t, i in left:
        near = [
            (r[1], r[2])
            for r in right
            if k and r[0] == k and t and r[1] and -before <= (r[1] - t).total_seconds() <= after
        ]
        for r in near or ([(None, None)] if how == "left_outer" else []):
            expected[(k, t, i, *r)] += 1
    assert Counter(map(tuple, found.collect())) == expected
    assert no_pairing(plan(found))
    groups = op.near_in_time(
        spark.createDataFrame(left, "k string, event_time timestamp, id int"),
        spark.createDataFrame(right, "k string, right_time timestamp, rid int"),
        before,
        after,
        keys=["k"],
        grouped=True,
    )
    pairs = op.near_pairs(groups, how)
    assert pairs.columns == found.columns
    timed = Counter({k: n for k, n in expected.items() if k[1] is not None})
    assert Counter(map(tuple, pairs.collect())) == timed


def test_the_stream_of_near_readings_keeps_readings_and_not_pairs(spark, tmp_path, monkeypatch):
    # 300 views and clicks in ten minutes, most near each other, and some of their own.
    kinds = [("view", s) for s in range(0, 600, 2)] + [("click", s) for s in range(1, 601, 2)]
    kinds += [("view", 5000), ("click", 5301), ("view", 9000), ("click", 9300), ("view", 2_700_000), ("click", 2_700_300)]
    rows = [(i, at(s), i % 7, kind, i / 4, None) for i, (kind, s) in enumerate(kinds)]
    types = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, types).write.parquet(str(tmp_path / "events.parquet"))
    kept = []

    def appended(*args):
        kept.append(made(*args))
        return kept[-1]

    made = series._appended
    monkeypatch.setattr(series, "_appended", appended)
    found = series.stream_near_readings(spark, str(tmp_path))
    expected = series.near_readings(spark, str(tmp_path))
    assert found.columns == expected.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    assert found.count() > 60_000
    sizes = kept[0].select(F.sum(F.size("_lefts")), F.sum(F.size("_rights"))).first()
    assert sizes[0] == 303 and sizes[1] <= 2 * 303


# --- Frames by time ------------------------------------------------------------


@pytest.mark.parametrize("seed,before,after,chunk", [(1, 60, 0, None), (2, 500, 100, 50), (3, 0, 0, 10), (4, 0.5, 3000, 700)])
def test_time_frames_equal_a_search(spark, seed, before, after, chunk):
    rows = random_readings(seed, 250, 6000)
    rows += [("a", None, 1.0), ("a", at(100), None), (None, at(100), 2.0), *rows[:5]]
    df = readings(spark, rows)
    frames = {"low": F.min("value"), "total": F.sum("value"), "rows": F.count(F.lit(1)), "values": F.count("value")}
    found = op.time_frames(df, ["device_id"], frames, before, after, chunk_s=chunk)
    expected = Counter()
    for d, t, v in rows:
        if t is None:
            continue
        near = [r[2] for r in rows if r[0] == d and r[1] and -before <= (r[1] - t).total_seconds() <= after]
        values = [x for x in near if x is not None]
        expected[(d, t, v, min(values, default=None), sum(values) if values else None, len(near), len(values))] += 1
    assert Counter(map(tuple, found.collect())) == expected
    totals = op.time_totals(df, ["device_id"], before, after, chunk_s=chunk)
    totals = totals.select("device_id", "event_time", "value", "frame_sum", "frame_rows", "frame_values")
    assert Counter(map(tuple, totals.collect())) == Counter((*k[:3], *k[4:]) for k in expected.elements())


@pytest.mark.parametrize("seed,before,after,chunk", [(1, 60, 0, None), (2, 500, 100, 50), (3, 0, 0, 10), (4, 0.5, 3000, 700)])
def test_lowest_and_highest_equal_a_search(spark, seed, before, after, chunk):
    rows = random_readings(seed, 250, 6000)
    rows += [("a", None, 1.0), ("a", at(100), None), (None, at(100), 2.0), ("b", at(-3), float("nan")), *rows[:5]]
    df = readings(spark, rows).withColumn("rank", F.round("value"))
    found = op.time_frames(
        df, ["device_id"], {"rows": F.count(F.lit(1))}, before, after, chunk_s=chunk,
        lowest={"low": "value", "low_rank": "rank"}, highest={"high": "value"},
    )
    frames = [F.count(F.lit(1)), F.min("value"), F.min("rank"), F.max("value")]
    other = df.alias("o").select(F.col("device_id").alias("d"), F.col("event_time").alias("t"), F.struct("value", "rank").alias("v"))
    near = (
        F.col("d").eqNullSafe(F.col("device_id"))
        & (F.col("t") >= F.col("event_time") - F.make_dt_interval(secs=F.lit(before)))
        & (F.col("t") <= F.col("event_time") + F.make_dt_interval(secs=F.lit(after)))
    )
    numbered = df.withColumn("_n", F.monotonically_increasing_id()).localCheckpoint()
    met = numbered.join(other, near).drop("value", "rank").select("*", "v.value", "v.rank")
    sums = met.groupBy("_n").agg(*frames)
    expected = numbered.join(sums, "_n").drop("_n")

    def counted(df):
        return Counter(tuple(map(str, r)) for r in df.collect())

    assert counted(found) == counted(expected)


def test_extremes_go_through_no_frame_anew(spark):
    # A frame that begins at its first row is gone through anew for each row: its cost grows
    # with the square of the readings in an hour. Only frames that grow have a cost per row.
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]*),", plan(series.time_extremes(spark, SF_DIR)))
    assert frames and {begin for _, begin in frames} == {"unboundedpreceding$()"}


def test_frames_go_by_chunk_and_read_once(spark):
    for name in ("time_baseline", "time_extremes"):
        df = series.QUERIES[name](spark, SF_DIR)
        assert plan(df).count("FileScan parquet") == 1
        assert all("_chunk" in k for k in shuffles(df)) and len(shuffles(df)) == 1


# --- Ranks ---------------------------------------------------------------------


def keep(spark, path):
    def store(df):
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return store


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_equal_windows(spark, tmp_path, descending):
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(40)]), rng.choice(["x", "y", None]), i) for i in range(500)]
    rows += [(13, "x", 1000 + i) for i in range(300)]
    df = spark.createDataFrame(rows, "v int, s string, id int")
    found = op.global_ranks(df, ["v", "s"], keep(spark, str(tmp_path / "r")), descending=descending)
    w = Window.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in ("v", "s")])
    expected = df.select(
        "*",
        F.rank().over(w).cast("long"),
        F.dense_rank().over(w).cast("long"),
        F.percent_rank().over(w),
        F.cume_dist().over(w),
    )
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    # Windows are cut by range: none runs over the whole table.
    assert "SinglePartition" not in plan(found)


@pytest.mark.parametrize("rows,tiles", [(0, 4), (1, 4), (3, 4), (4, 4), (10, 4), (23, 7), (100, 1)])
def test_tiles_equal_windows(spark, tmp_path, rows, tiles):
    df = spark.range(rows).select(((F.col("id") * 37) % 101).alias("v"))
    found = op.global_ranks(df, ["v"], keep(spark, str(tmp_path / "t")), tiles=tiles)
    expected = df.select("v", F.ntile(tiles).over(Window.orderBy("v")))
    assert {(r["v"], r["ntile"]) for r in found.collect()} == set(map(tuple, expected.collect()))


def test_a_common_value_is_one_row_before_the_shuffle(spark, tmp_path):
    df = spark.range(20_000, numPartitions=4).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("v"))
    ranked = op.global_ranks(df, ["v"], keep(spark, str(tmp_path / "c")))
    assert ranked.where("v = -1").select("rank", "dense_rank").distinct().collect()[0] == (1, 1)
    assert ranked.agg(F.max("dense_rank")).first()[0] == 13_334


# --- Groupings and differences -------------------------------------------------


def test_groupings_expand_panes_not_readings(spark):
    df = series.grouped_days(spark, SF_DIR)
    text = plan(df)
    assert text.count("FileScan parquet") == 1 and text.count("Expand") == 1
    # From the scan upwards: partial panes, a shuffle, then the groupings.
    below = text.split("Exchange hashpartitioning")
    assert "Expand" not in below[-1] and "partial_sum" in below[-1]


def test_a_null_key_is_not_a_left_out_one(spark):
    rows = readings(spark, [("a", at(0), 1.0), (None, at(0), 2.0), ("a", at(90), None)])
    found = op.grouped_totals(rows, op.rollup_sets(["device_id"]), 60)
    got = {(r["device_id"], r["grouping_id"], r["window_start"]): (r["value_sum"], r["value_count"]) for r in found.collect()}
    assert got == {
        ("a", 0, at(0)): (1.0, 1),
        (None, 0, at(0)): (2.0, 1),
        (None, 1, at(0)): (3.0, 2),
        ("a", 0, at(60)): (None, 0),
        (None, 1, at(60)): (None, 0),
    }
    assert op.rollup_sets(["a", "b"]) == [["a", "b"], ["a"], []]


def test_multiset_difference_counts_repeats(spark):
    rng = random.Random(2)
    left = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, None])) for _ in range(200)]
    right = left[:150] + [("c", 1.0), ("a", 1.0)]
    a, b = (spark.createDataFrame(x, "k string, v double") for x in (left, right))
    found = op.multiset_difference(a, b).collect()
    n, m = Counter(left), Counter(right)
    assert {tuple(r) for r in found} == {(*k, n[k], m[k], n[k] - m[k]) for k in n | m if n[k] != m[k]}
    assert sum(r["excess"] for r in found if r["excess"] > 0) == a.exceptAll(b).count()
    assert -sum(r["excess"] for r in found if r["excess"] < 0) == b.exceptAll(a).count()
    assert op.multiset_difference(a, a).count() == 0
    assert "Join" not in plan(op.multiset_difference(a, b))
