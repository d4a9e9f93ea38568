from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fleetworks import functions as fn
from fleetworks.operators import (
    active_count_by_day,
    best_per_group,
    carry_forward,
    cluster_by_gap,
    conditional_pivot,
    exists_within,
    expand_days,
    frequency,
    gap_since_previous,
    next_at_or_after,
    number_rows,
    rank_and_accumulate,
    rolling_days,
)
from fleetworks.plans.telemetry import in_stretches, stab
from tests.conftest import day, tuples

BASE = day("2024-01-01")
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def at(n: int) -> dt.date:
    return BASE + dt.timedelta(days=n)


@few
@given(values=st.lists(st.integers(0, 5), min_size=1, max_size=40))
def test_global_rank_and_running_total(frame, values):
    df = frame("id long, v long", list(enumerate(values)))
    got = tuples(rank_and_accumulate(df, "v", "id", "rank", "running"), "id", "rank", "running")
    order = sorted(enumerate(values), key=lambda p: (-p[1], p[0]))
    running, want = 0, []
    for key, value in order:
        running += value
        want.append((key, 1 + sum(v > value for v in values), running))
    assert got == sorted(want, key=lambda r: str(r[0]))


def test_rank_when_one_value_fills_several_partitions(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 10, 100 - F.col("id")).otherwise(7).alias("v"))
    ranked = rank_and_accumulate(df, "v", "id", "rank", "running").cache()
    assert ranked.filter("v = 7").select("rank").distinct().collect()[0]["rank"] == 11
    last = ranked.orderBy(F.desc("running")).first()
    assert last["running"] == sum(range(91, 101)) + 7 * 2990 and last["id"] == 2999


def test_row_numbers_are_dense_over_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"))
    numbered = number_rows(df, ["k"], "n", start=0)
    assert numbered.filter("n != k").count() == 0 and numbered.count() == 5000


@few
@given(marks=st.sets(st.integers(0, 30)), days=st.sets(st.integers(0, 30), min_size=1))
def test_as_of_matches_brute_force(frame, marks, days):
    rows = frame("k int, d date", [(1, at(n)) for n in days])
    points = frame("k int, m date", [(1, at(n)) for n in marks] + [(2, at(3))])
    back = tuples(carry_forward(rows, points, ["k"], "d", "m", "got"), "d", "got")
    ahead = tuples(next_at_or_after(rows, points, ["k"], "d", "m", "got", unique=True), "d", "got")
    assert back == [(at(n), max((at(m) for m in marks if m <= n), default=None)) for n in sorted(days)]
    assert ahead == [(at(n), min((at(m) for m in marks if m >= n), default=None)) for n in sorted(days)]


def test_interval_exists_is_inclusive(frame):
    rows = frame("k int, d date, w int", [(1, at(0), 5), (1, at(1), 3), (2, at(0), 5), (1, None, 5), (1, at(0), None)])
    marks = frame("k int, m date", [(1, at(5)), (1, at(40)), (3, at(0))])
    got = exists_within(rows, marks, ["k"], "d", "m", F.col("w"), "hit")
    assert tuples(got, "k", "d", "w", "hit") == tuples(frame("k int, d date, w int, hit boolean", [
        (1, at(0), 5, True), (1, at(1), 3, False), (2, at(0), 5, False), (1, None, 5, False), (1, at(0), None, False)]))


def test_rolling_frame_skips_missing_days(frame):
    df = frame("k int, n int, v int", [(1, 1, 10), (1, 2, 20), (1, 9, 5)])
    got = df.withColumn("s", rolling_days("v", ["k"], "n", 7))
    assert tuples(got, "n", "s") == [(1, 10), (2, 30), (9, 5)]


def test_gaps_and_clusters(frame):
    df = frame("k int, d date", [(1, at(0)), (1, at(0)), (1, at(2)), (1, at(9)), (2, at(5))])
    assert tuples(gap_since_previous(df, ["k"], "d", "gap"), "k", "d", "n", "gap") == tuples(
        frame("k int, d date, n int, gap int", [
            (1, at(0), 2, None), (1, at(2), 1, 2), (1, at(9), 1, 7), (2, at(5), 1, None)]))
    visits = cluster_by_gap(df, ["k"], "d", 3, "visit")
    assert tuples(visits, "k", "d", "visit") == [
        (1, at(0), 1), (1, at(0), 1), (1, at(2), 1), (1, at(9), 2), (2, at(5), 1)]


@few
@given(spans=st.lists(st.tuples(st.integers(0, 20), st.integers(-2, 10)), min_size=1, max_size=8))
def test_active_counts_match_expansion(frame, spans):
    df = frame("k int, s date, e date", [(1, at(a), at(a + n)) for a, n in spans])
    want = expand_days(df, F.col("s"), F.col("e"), "date_id").groupBy("date_id").count()
    assert tuples(active_count_by_day(df, "s", "e", ["k"]), "date_id", "active") == tuples(want)


def test_stab_finds_every_interval_of_the_key(frame):
    points = frame("k int, d date", [(1, at(3)), (1, at(9)), (2, at(3))])
    spans = frame("k int, s date, e date, name string", [
        (1, at(0), at(3), "a"), (1, at(3), at(4), "b"), (1, at(5), None, "open"), (1, None, at(9), "never begun")])
    assert tuples(stab(points, spans, ["k"], "d", "s", "e"), "d", "name") == [
        (at(3), "a"), (at(3), "b"), (at(9), "open")]


@few
@given(days=st.lists(st.integers(0, 200), min_size=1, max_size=5),
       spans=st.lists(st.tuples(st.integers(-100, 250), st.one_of(st.none(), st.integers(-3, 150))), min_size=1, max_size=6))
def test_stab_matches_comparing_every_pair(frame, days, spans):
    points = frame("k int, d date, p int", [(1, at(d), i) for i, d in enumerate(days)])
    ranges = [(1, at(a), None if n is None else at(a + n), i) for i, (a, n) in enumerate(spans)]
    want = sorted((p, i) for p, d in enumerate(days) for _, s, e, i in ranges if s <= at(d) and (e is None or at(d) <= e))
    found = stab(points, frame("k int, s date, e date, i int", ranges), ["k"], "d", "s", "e").select("p", "i").collect()
    assert sorted(map(tuple, found)) == want


def test_grouping_helpers(frame):
    df = frame("k int, kind string, v int", [(1, "a", 3), (1, "b", 4), (2, "a", None), (2, "c", 9)])
    pivot = conditional_pivot(df, ["k"], "kind", "v", {"a": "a_sum", "b": "b_sum"})
    assert tuples(pivot, "k", "a_sum", "b_sum", "total") == [(1, 3, 4, 7), (2, 0, 0, 9)]
    assert tuples(frequency(df, "kind")) == [("a", 2), ("b", 1), ("c", 1)]
    first = best_per_group(df, ["k"], F.col("kind"), ["kind", "v"])
    assert tuples(first) == [(1, "a", 3), (2, "a", None)]


def test_functions(spark):
    d = F.lit("2024-12-29").cast("date")  # a Sunday
    start = F.lit("2024-01-01 08:00:00").cast("timestamp")
    row = spark.range(1).select(
        fn.iso_weekday(d).alias("dow"), fn.month_name(F.lit("2024-05-01").cast("date"), padded=True).alias("name"),
        fn.quarter_end(fn.quarter_start(d)).alias("q"),
        fn.hours_between(start, F.lit("2024-01-01 09:30:00").cast("timestamp")).alias("h"),
        fn.lookup({"a": 1}, F.lit("z")).alias("miss"), fn.lookup({"a": 1}, F.lit("z"), 5).alias("fallback"),
        fn.safe_ratio(F.lit(1.0), F.lit(0)).alias("ratio"),
        fn.prorate(F.lit("-1.00").cast("decimal(18,2)"), F.lit(1).cast("decimal(18,2)"), F.lit(8).cast("decimal(18,2)"))
        .alias("negative"),
        fn.logistic(F.lit(0.5), 0.1, 0.9, 0.5, 10.0).alias("mid")).first()
    assert (row["dow"], row["name"], row["q"], row["h"]) == (7, "May      ", day("2024-12-31"), 1.5)
    assert (row["miss"], row["fallback"], row["ratio"], row["negative"], row["mid"]) == (None, 5, None, D("-0.13"), 0.5)


def test_long_intervals_are_placed_in_few_stretches(spark):
    """Contracts of years, some without end, take at most three rows each on average, and short ones no more."""
    for length in ("cast(400 + id % 900 as int)", "cast(id % 5 as int)"):
        points = spark.range(2000).selectExpr("id p", "date_add(date'2015-01-01', cast(id * 2 as int)) d")
        spans = spark.range(300).selectExpr("id i", "date_add(date'2015-01-01', cast(id * 10 as int)) s").selectExpr(
            "i", "s", f"if(i % 7 = 0, null, date_add(s, {length.replace('id', 'i')})) e")
        placed = in_stretches(points, spans, "d", "s", "e")[1]
        assert 300 <= placed.count() <= 900


def test_draws_are_stable_and_spread(spark):
    ids = spark.range(20000).select(fn.coin(F.col("id"), 0, 0.15).alias("c"), fn.draw(F.col("id"), 1, 3).alias("d"))
    rate = ids.agg(F.avg(F.col("c").cast("int"))).first()[0]
    assert abs(rate - 0.15) < 0.01
    assert all(abs(r["count"] / 20000 - 1 / 3) < 0.02 for r in ids.groupBy("d").count().collect())
    huge = spark.sql("SELECT CAST(9223372036854775000 AS BIGINT) AS id")
    assert 0 <= huge.select(fn.draw(F.col("id"), 0, 10)).first()[0] < 10
