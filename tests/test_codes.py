from datetime import timedelta

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stayledger.functions import codes
from tests.helpers import table, ts

MICRO = timedelta(microseconds=1)


def local(spark, instants, rules="table"):
    df = table(spark, "n int, t timestamp_ntz", *enumerate(instants))
    return [r[0] for r in df.orderBy("n").select(codes.to_pacific("t", rules)).collect()]


def test_pacific_window_edges(spark):
    for lo, hi in codes.PACIFIC_SUMMER:
        lo, hi = ts(lo), ts(hi)
        inside, outside = timedelta(hours=7), timedelta(hours=8)
        got = local(spark, [lo - MICRO, lo, lo + MICRO, hi - MICRO, hi, hi + MICRO])
        assert got == [lo - MICRO - outside, lo - inside, lo + MICRO - inside,
                       hi - MICRO - inside, hi - inside, hi + MICRO - outside]


def test_pacific_table_differs_from_zone_rules_in_march_2020(spark):
    instant = [ts("2020-03-09 05:00:00")]
    assert local(spark, instant) == [ts("2020-03-08 21:00:00")]
    assert local(spark, instant, "tz") == [ts("2020-03-08 22:00:00")]


def test_pacific_outside_the_table_and_null(spark):
    assert local(spark, [ts("2015-07-01 12:00:00"), ts("2026-07-01 12:00:00"), None]) == [
        ts("2015-07-01 04:00:00"), ts("2026-07-01 04:00:00"), None]


def test_lob_group_order(spark):
    df = table(spark, "lob string, user string",
               ("Gaming Slots", "SYS1"), ("Unknown", "SYS1"), ("Hotel", "x"), ("Online", "x"),
               (None, None), ("Spa", None))
    got = [r[0] for r in df.select(codes.lob_group("lob", "user", "SYS")).collect()]
    assert got == ["Gaming", "Non-Gaming", "Non-Gaming", "Other", "Other", "Non-Gaming"]


def test_tiers_targets_and_numbers(spark):
    df = table(spark, "n string", ("Sapphire",), ("Pearl",), ("Gold",), ("Platinum",), ("X",),
               (None,))
    ranks = [r[0] for r in df.select(codes.tier_ordinal("n")).collect()]
    assert ranks == [1, 2, 3, 4, 5, 5]
    levels = table(spark, "t int", *((t,) for t in (1, 2, 3, 4, None)))
    assert [tuple(r) for r in levels.select(
        codes.target_credits("t"), codes.target_credits("t", otherwise=0)).collect()] == [
        (20000, 20000), (75000, 75000), (200000, 200000), (-1, 0), (-1, 0)]
    texts = table(spark, "x string", ("03 - Drop In",), ("1 ",), ("ab",), (None,), ("02",))
    assert [r[0] for r in texts.select(codes.coded_number("x")).collect()] == [
        3, None, None, None, 2]


def test_next_target_and_trip_buckets(spark):
    credits = table(spark, "c int", *((c,) for c in (0, 20000, 20001, 75000, 75001, 200000,
                                                     200001)))
    assert [r[0] for r in credits.select(codes.next_target("c")).collect()] == [
        20000, 20000, 75000, 75000, 200000, 200000, -1]
    trips = table(spark, "t int", *((t,) for t in (None, 1, 2, 3, 5, 6, 11, 12, 26, 27)))
    assert [r[0] for r in trips.select(codes.promo_trip_bucket("t")).collect()] == [
        0, 4, 4, 1, 1, 2, 2, 3, 3, 4]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=50))
def test_hash_bucket_depends_on_the_key_only(spark, keys):
    df = table(spark, "k bigint", *((k,) for k in keys))
    bucket = codes.hash_bucket("k", "s")
    one = {r.k: r.b for r in df.select("k", bucket.alias("b")).collect()}
    two = {r.k: r.b for r in df.repartition(7).select("k", bucket.alias("b")).collect()}
    assert one == two and all(0 <= b < 1000 for b in one.values())


def test_hash_bucket_is_even(spark):
    shares = spark.range(20000).groupBy((codes.hash_bucket("id") < 700).alias("low")).agg(
        F.count("*").alias("n"))
    assert abs({r.low: r.n for r in shares.collect()}[True] / 20000 - 0.7) < 0.02
