"""Nightly refresh: credit ledger of a year and tier history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stayledger.operators.ledger import build_ledger
from stayledger.operators.scale import tune
from stayledger.operators.tiers import build_tier_history
from stayledger.schemas import SOURCES, conform
from stayledger.sources import tables


def refresh(spark: SparkSession, src: Mapping[str, DataFrame], out: str, year: int, *,
            system_user_prefix: str, whole_last_day: bool = False, rules: str = "table") -> None:
    """Write both tables and log how fresh they are.

    Sources are brought to their contracts first. The log gets what the tasks of the write have
    counted; nothing is computed or read twice.
    """
    tune(spark)
    src = {name: conform(df, SOURCES[name]) for name, df in src.items()}
    ledger = build_ledger(src["activity"], src["accrual_item"], src["location"],
                          src["member_id_map"], src["purse_policy"], year,
                          system_user_prefix=system_user_prefix, whole_last_day=whole_last_day,
                          rules=rules)
    tables.log_run(tables.write_observed(ledger, f"{out}/ledger/calendar_year={year}", "ledger", "ts"), f"{out}/run_log")

    history = build_tier_history(src["member"], src["member_tier"], src["member_tier_history"],
                                 src["member_id_map"], src["merged_member"], rules)
    tables.log_run(tables.write_observed(history, f"{out}/tier_history", "tier_history", "changed_at"), f"{out}/run_log")
