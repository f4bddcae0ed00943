"""Coded values of the loyalty programme as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# UTC instants between which the wall clock is seven hours behind
# (both ends included); it is eight hours behind at every other instant.
PACIFIC_SUMMER = (
    ("2016-03-13 01:59:59.999999", "2016-11-06 01:59:59.999999"),
    ("2017-03-12 01:59:59.999999", "2017-11-05 01:59:59.999999"),
    ("2018-03-11 01:59:59.999999", "2018-11-04 01:59:59.999999"),
    ("2019-03-10 01:59:59.999999", "2019-11-03 01:59:59.999999"),
    ("2020-03-10 01:59:59.999999", "2020-11-01 01:59:59.999999"),
    ("2021-03-14 01:59:59.999999", "2021-11-07 01:59:59.999999"),
    ("2022-03-13 01:59:59.999999", "2022-11-06 01:59:59.999999"),
    ("2023-03-12 01:59:59.999999", "2023-11-05 01:59:59.999999"),
    ("2024-03-10 01:59:59.999999", "2024-11-03 01:59:59.999999"),
    ("2025-03-09 01:59:59.999999", "2025-11-02 01:59:59.999999"),
)
# Tier names from the lowest tier up; any other name ranks fifth.
TIERS = ("Sapphire", "Pearl", "Gold", "Platinum")
# Credits that lift tier 1, 2 and 3 to the next tier.
LADDER = (20000, 75000, 200000)
# Lines of business booked as non-gaming.
NON_GAMING_LOBS = ("Coffee", "Entertainment", "FB", "Hotel", "Spa")
# Lodging states of a trip.
IN_HOUSE, LOCAL, DROP_IN = "01 - In House", "02 - Local", "03 - Drop In"
# Fixed value: the reason label of an earned promotion.
EARNED = "Tier Evaluation"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_pacific(ts: Column | str, rules: str = "table") -> Column:
    """UTC to Pacific wall clock, by the fixed table or by time-zone rules."""
    ts = col_of(ts).cast("timestamp_ntz")
    if rules == "tz":
        return F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), ts)
    if rules != "table":
        raise ValueError("rules must be 'table' or 'tz'")
    summer = reduce(
        lambda a, b: a | b,
        (ts.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))
         for lo, hi in PACIFIC_SUMMER))
    return (F.when(summer, ts - F.expr("INTERVAL '7' HOUR"))
            .otherwise(ts - F.expr("INTERVAL '8' HOUR")))


def lob_group(lob: Column | str, user: Column | str, system_user_prefix: str) -> Column:
    """Gaming first, then postings by the loyalty system itself, then the line of business."""
    return (F.when(col_of(lob).startswith("Gaming"), "Gaming")
            .when(col_of(user).startswith(system_user_prefix), "Non-Gaming")
            .when(col_of(lob).isin(*NON_GAMING_LOBS), "Non-Gaming")
            .otherwise("Other"))


def tier_ordinal(name: Column | str) -> Column:
    name = col_of(name)
    ranked = reduce(
        lambda acc, it: acc.when(name == it[1], it[0] + 1),
        list(enumerate(TIERS))[1:], F.when(name == TIERS[0], 1))
    return ranked.otherwise(len(TIERS) + 1)


def coded_number(text: Column | str) -> Column:
    """The number in codes such as ``02 - Local`` or ``03 - Gold``; null when there is none."""
    return F.substring(col_of(text), 2, 2).try_cast("int")


def target_credits(tier: Column | str, otherwise: int = -1) -> Column:
    tier = col_of(tier)
    rungs = F.when(tier == 1, LADDER[0])
    for level, credits in enumerate(LADDER[1:], start=2):
        rungs = rungs.when(tier == level, credits)
    return rungs.otherwise(otherwise)


def next_target(credits: Column | str) -> Column:
    """Rung above an amount of credits; -1 above the last one."""
    credits = col_of(credits)
    return (F.when(credits > LADDER[2], -1)
            .when(credits > LADDER[1], LADDER[2])
            .when(credits > LADDER[0], LADDER[1])
            .otherwise(LADDER[0]))


def promo_trip_bucket(trips: Column | str) -> Column:
    """Class of the number of trips a guest needed; one or two trips fall in the last class.
    The bounds are fixed values."""
    trips = col_of(trips)
    return (F.when(trips.isNull(), 0)
            .when(trips.between(3, 5), 1)
            .when(trips.between(6, 11), 2)
            .when(trips.between(12, 26), 3)
            .otherwise(4))


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-col_of(x)))


def hash_bucket(key: Column | str, salt: str = "", buckets: int = 1000) -> Column:
    """Bucket of a key that does not depend on partitioning, retries or row order."""
    digest = F.md5(F.concat(col_of(key).cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % buckets


def day(year: int, month: int, dom: int) -> Column:
    return F.lit(f"{year:04d}-{month:02d}-{dom:02d}").cast("date")


def midnight(year: int, month: int, dom: int) -> Column:
    return F.lit(f"{year:04d}-{month:02d}-{dom:02d} 00:00:00").cast("timestamp_ntz")
