"""Small typed tables for the tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def d(text: str) -> date:
    return date.fromisoformat(text)


def table(spark, ddl: str, *rows):
    return spark.createDataFrame(list(rows), ddl)


def ledger(spark, *rows):
    return table(spark, "player_id string, ts timestamp_ntz, credits decimal(18,4), "
                 "site_name string, lob_group string",
                 *((p, ts(t), Decimal(c), site, lob) for p, t, c, site, lob in rows))


def xref(spark, *pairs):
    return table(spark, "player_id string, guest_id bigint", *pairs)


def promotions(spark, *rows):
    """(player, before, after, instant) with an optional change reason."""
    return table(
        spark, "player_id string, tier_before int, tier_after int, changed_at timestamp_ntz, "
        "tier_reason string, tier_sub_reason string, change_reason string, "
        "change_sub_reason string",
        *((r[0], r[1], r[2], ts(r[3]), None, None, r[4] if len(r) > 4 else None, None)
          for r in rows))


def trips(spark, *rows):
    """Described trips: (guest, player, start, end, credits) with optional lodging and tier."""
    return table(
        spark, "guest_id bigint, player_id string, trip_id string, trip_start date, "
        "trip_end date, property string, credits decimal(18,4), tier string, "
        "gaming_credits decimal(18,4), non_gaming_credits decimal(18,4), gender string, age int, "
        "location string, lodging string, tenure int",
        *((r[0], r[1], f"{r[0]}_{r[2]}_{r[3]}", d(r[2]), d(r[3]), "Here", Decimal(r[4]),
           r[6] if len(r) > 6 else "01 - Sapphire", Decimal(r[4]), Decimal(0), "F", 40, "X",
           r[5] if len(r) > 5 else "01 - In House", 3) for r in rows))


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
