"""Logical tables derived from the given test tables, whole tables each time.

Dates move by one shift so that 1997 and 1998 become 2023 and 2024. Codes come from
attributes of the rows; no row is left out to make a check cheaper.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayledger.functions.codes import DROP_IN, IN_HOUSE, LOCAL, TIERS
from stayledger.operators.ledger import of_years
from stayledger.operators.scale import materialize, milestones, work_path
from stayledger.sources.day_store import put_days, read_days

SHIFT_DAYS = 9496
ONLINE = "EUROPE"
PROPERTY = "MIDDLE EAST"
SYSTEM = "SYS"
SHARE = 0.5
LOBS = ("Gaming Slots", "Gaming Tables", "Hotel", "FB", "Online", "Other", "Spa", "Misc")
FIVE_TIERS = (*TIERS, "Invited")
EVENT_START = date(2024, 1, 1)

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def pick(values, index):
    """Value of a fixed list by a zero-based index column."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index + 1).cast("int"))


def quotient(c, n):
    return F.floor(c / n)


class StandIns:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}
        #: (path of the scaler, sequences) of the training plan, by kind of guests and of tables.
        self.trained: dict[tuple[bool, bool], tuple[str, DataFrame]] = {}
        #: Trips of the two years, once a run has stored them.
        self.stored_trips: DataFrame | None = None

    def t(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.schema(SCHEMAS[name]).parquet(
                f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def _order_ts(self):
        return (F.col("o_orderdate") + F.expr(f"INTERVAL '{SHIFT_DAYS}' DAY")
                + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int")))

    def _start(self):
        return F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)

    def _end(self):
        return F.date_add(self._start(), (F.col("o_orderkey") % 30 + 1).cast("int"))

    def _player(self, key: str):
        return (F.col(key) + 700000).cast("string")

    # raw loyalty tables -------------------------------------------------------------

    @cached_property
    def activity(self) -> DataFrame:
        key, price = F.col("o_orderkey"), F.col("o_totalprice")
        pending = F.col("o_orderstatus") == "P"
        urgent = F.col("o_orderpriority") == "1-URGENT"
        return self.t("orders").select(
            key.alias("activity_id"), F.col("o_custkey").alias("member_id"),
            (F.col("o_custkey") % 25).cast("int").alias("location_id"),
            self._order_ts().alias("activity_at"), self._order_ts().alias("created_at"),
            F.when(pending & urgent, "Error")
            .when(pending & (F.col("o_orderpriority") == "2-HIGH"), None)
            .otherwise("Posted").alias("activity_status"),
            F.when((F.col("o_orderstatus") == "F") & urgent, "Set Tier").otherwise("Earn")
            .alias("activity_type"),
            pick(LOBS, key % 8).alias("lob"),
            F.when(price > 400000, "SYS1").otherwise("AGENT").alias("user_id"),
            self._player("o_custkey").alias("loyalty_id"),
            F.when(price < 20000, "Y").otherwise("N").alias("delete_flag"))

    @cached_property
    def items(self) -> DataFrame:
        return self.t("lineitem").select(
            F.col("l_orderkey").alias("activity_id"), F.col("l_partkey").alias("policy_id"),
            F.round(F.col("l_extendedprice") * 2500).cast("long").alias("accrued_points"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), "Y")
            .otherwise("N").alias("delete_flag"))

    @cached_property
    def policies(self) -> DataFrame:
        credit = F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD")
        return self.t("part").select(
            F.col("p_partkey").alias("policy_id"),
            F.concat(F.when(credit, "Tier Credits ").otherwise("Points "), "p_type")
            .alias("policy_name"),
            F.when(F.col("p_size") == 50, "Y").otherwise("N").alias("delete_flag"))

    @cached_property
    def locations(self) -> DataFrame:
        return self.t("nation").select(
            F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("site_name"),
            F.when(F.col("n_regionkey") == 4, "Y").otherwise("N").alias("delete_flag"))

    @cached_property
    def id_map(self) -> DataFrame:
        other = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)
        return self.t("customer").select(
            F.col("c_custkey").alias("member_id"), self._player("c_custkey").alias("loyalty_id"),
            F.when(other, "Other").otherwise("PlayerId").alias("id_kind"),
            F.when(F.col("c_acctbal") > 9500, "Y").otherwise("N").alias("delete_flag"))

    def _enrolled(self):
        return F.lit("2016-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            (F.col("c_custkey") % 3600).cast("int"))

    @cached_property
    def members(self) -> DataFrame:
        return self.t("customer").select(
            F.col("c_custkey").alias("member_id"), self._enrolled().alias("enrolled_at"),
            F.when(F.col("c_acctbal").between(0, 100), "Y").otherwise("N").alias("delete_flag"))

    @cached_property
    def member_tiers(self) -> DataFrame:
        poor = F.col("c_acctbal") < 0
        segment = F.col("c_mktsegment")
        return self.t("customer").select(
            F.col("c_custkey").alias("member_id"),
            F.when(poor & (segment == "FURNITURE"), None)
            .otherwise(pick(TIERS, F.col("c_custkey") % 4)).alias("level_name"),
            F.when(poor & (segment == "BUILDING"), None)
            .otherwise(self._enrolled() + F.make_dt_interval(F.lit(30), F.lit(3)))
            .alias("achieved_at"),
            F.when(segment == "BUILDING", "3-MEDIUM").alias("reason"),
            F.when(segment == "HOUSEHOLD", "1-URGENT").alias("sub_reason"),
            F.lit("N").alias("delete_flag"))

    @cached_property
    def member_tier_history(self) -> DataFrame:
        price, key = F.col("o_totalprice"), F.col("o_orderkey")
        return self.t("orders").where(F.col("o_orderstatus") == "F").select(
            F.col("o_custkey").alias("member_id"),
            F.when(price < 30000, None).otherwise(pick(TIERS, key % 4)).alias("prev_level"),
            F.when(price.between(20000, 40000), None)
            .otherwise(pick(FIVE_TIERS, quotient(key, 4) % 5)).alias("new_level"),
            F.when(price > 490000, None).otherwise(self._order_ts()).alias("assigned_at"),
            F.col("o_orderpriority").alias("reason"),
            F.when(price > 450000, "2-HIGH").alias("sub_reason"),
            F.when(price > 480000, "Y").otherwise("N").alias("delete_flag"))

    @cached_property
    def merged(self) -> DataFrame:
        return self.t("customer").where(F.col("c_acctbal") < 0).select(
            F.col("c_custkey").alias("victim_id"), (F.col("c_custkey") + 1).alias("survivor_id"),
            F.when(F.col("c_mktsegment") == "FURNITURE", "Y").otherwise("N").alias("delete_flag"))

    @cached_property
    def enum(self) -> DataFrame:
        code = F.col("o_orderpriority")
        return (self.t("orders").where(code != "1-URGENT").groupBy(code.alias("enum_value"))
                .agg(F.count("*").alias("_n")).select(
                    "enum_value", F.when(F.col("enum_value") == "2-HIGH", "Goodwill")
                    .otherwise("Tier Evaluation").alias("label")))

    # derived loyalty tables ---------------------------------------------------------

    @cached_property
    def xref(self) -> DataFrame:
        return self.t("customer").select(self._player("c_custkey").alias("player_id"),
                                         F.col("c_custkey").alias("guest_id"))

    @cached_property
    def tier_history(self) -> DataFrame:
        price, key = F.col("o_totalprice"), F.col("o_orderkey")
        return self.t("orders").where(F.col("o_orderstatus") == "F").select(
            self._player("o_custkey").alias("player_id"),
            pick(TIERS, key % 4).alias("tier_from"),
            pick(FIVE_TIERS, quotient(key, 4) % 5).alias("tier_to"),
            self._order_ts().alias("changed_at"),
            F.when(price > 450000, "2-HIGH").alias("tier_reason"),
            F.when(price < 50000, "3-MEDIUM").alias("tier_sub_reason"),
            F.col("o_orderpriority").alias("change_reason"),
            F.when(price.between(50000, 100000), "4-NOT SPECIFIED").alias("change_sub_reason"))

    @cached_property
    def ledger(self) -> DataFrame:
        line = F.col("l_linenumber")
        lines = self.t("lineitem").join(
            self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
            F.col("l_orderkey") == F.col("o_orderkey"))
        return (self._with_region(lines)
                .select(
                    self._player("o_custkey").alias("player_id"),
                    (F.col("o_orderdate") + F.expr(f"INTERVAL '{SHIFT_DAYS}' DAY")
                     + F.make_dt_interval(line * 2, line)).alias("ts"),
                    (F.col("l_extendedprice").cast("decimal(16,2)") * Decimal("0.25"))
                    .cast("decimal(18,4)").alias("credits"),
                    F.col("r_name").alias("site_name"),
                    F.when(F.col("l_returnflag") == "R", "Gaming")
                    .when(F.col("l_returnflag") == "A", "Non-Gaming").otherwise("Other")
                    .alias("lob_group")))

    def _with_region(self, lines: DataFrame) -> DataFrame:
        """Supplier, nation and region one after the other, each a table of known size."""
        return (lines
                .join(self.t("supplier").select("s_suppkey", "s_nationkey"),
                      F.col("l_suppkey") == F.col("s_suppkey"))
                .join(self.t("nation").select("n_nationkey", "n_regionkey"),
                      F.col("s_nationkey") == F.col("n_nationkey"))
                .join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey")))

    # visits -------------------------------------------------------------------------

    @cached_property
    def visits(self) -> DataFrame:
        key = F.col("o_orderkey")
        lines = (self.t("lineitem")
                 .join(self.t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
                 .join(self.t("part").select("p_partkey", "p_type"),
                       F.col("l_partkey") == F.col("p_partkey")))
        return (self._with_region(lines)
                .select(
                    F.col("o_custkey").alias("guest_id"), F.col("r_name").alias("property"),
                    F.col("p_type").alias("department"), self._start().alias("trip_start"),
                    self._end().alias("trip_end"),
                    F.concat(F.lit("0"), (key % 4 + 1).cast("string"), F.lit(" - "),
                             pick(TIERS, key % 4)).alias("start_tier"),
                    F.col("l_quantity").cast("int").alias("gaming_days"),
                    F.when(F.col("r_name") == "AMERICA", "LAS").otherwise(F.col("r_name"))
                    .alias("site_group"),
                    F.trunc(self._start(), "month").alias("month"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", "Convention")
                    .when(F.col("o_orderpriority") != "5-LOW", "Leisure").alias("segment"),
                    (F.col("l_extendedprice").cast("decimal(16,2)")
                     * F.col("l_discount").cast("decimal(4,2)")).alias("net_gaming_revenue")))

    @cached_property
    def trip_demo(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.t("orders").select(
            F.col("o_custkey").alias("guest_id"), self._start().alias("trip_start"),
            self._end().alias("trip_end"),
            F.when(price < 50000, None).when(F.col("o_custkey") % 2 == 0, "F").otherwise("M")
            .alias("gender"),
            (F.col("o_custkey") % 60 + 20).cast("int").alias("age"),
            F.when(price <= 480000, F.concat(
                F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string"))).alias("location"),
            pick((IN_HOUSE, LOCAL, DROP_IN), F.col("o_orderkey") % 3).alias("lodging"),
            (F.col("o_custkey") % 10).cast("int").alias("tenure"))

    @cached_property
    def profiles(self) -> DataFrame:
        return self.t("customer").select(
            F.col("c_custkey").alias("guest_id"), F.col("c_mktsegment").alias("game_type"),
            F.to_date(self._enrolled()).alias("enrolled_on"))

    @cached_property
    def regional(self) -> DataFrame:
        return self.t("customer").select(
            F.col("c_custkey").alias("guest_id"), F.col("c_acctbal").alias("worth_18m"))

    @cached_property
    def linked(self) -> DataFrame:
        return self.t("customer").select(
            self._player("c_custkey").alias("player_id"),
            F.concat(F.lit("A"), quotient(F.col("c_custkey"), 3).cast("string"))
            .alias("account_id"),
            F.col("c_acctbal").cast("decimal(18,4)").alias("credits_earned"))

    # day level, from the event stream -------------------------------------------------

    @cached_property
    def event_ledger(self) -> DataFrame:
        return self.t("events").select(
            F.col("user_id").cast("string").alias("player_id"), "ts",
            (F.col("value").cast("decimal(14,2)") * Decimal(10)).cast("decimal(18,4)")
            .alias("credits"),
            F.lit("Online").alias("site_name"), F.lit("Gaming").alias("lob_group"))

    @cached_property
    def event_xref(self) -> DataFrame:
        return self.t("events").groupBy("user_id").agg(F.count("*").alias("_n")).select(
            F.col("user_id").cast("string").alias("player_id"),
            F.col("user_id").alias("guest_id"))

    @cached_property
    def day_trips(self) -> DataFrame:
        """Five-day blocks with activity; every tenth user overlaps into the next block."""
        block = quotient(F.date_diff(F.to_date("ts"), F.lit(EVENT_START)), 5).cast("int")
        start = F.date_add(F.lit(EVENT_START), F.col("block") * 5)
        return (self.t("events").select("user_id", block.alias("block")).distinct().select(
            F.col("user_id").alias("guest_id"), start.alias("trip_start"),
            F.date_add(start, F.when(F.col("user_id") % 10 == 0, 6).otherwise(4))
            .alias("trip_end"),
            F.concat(F.lit("0"), (F.col("user_id") % 4 + 1).cast("string"), F.lit(" - Level"))
            .alias("tier"),
            pick((IN_HOUSE, LOCAL, DROP_IN), F.col("block") % 3).alias("lodging"),
            F.col("user_id").cast("string").alias("player_id")))

    @cached_property
    def day_promotions(self) -> DataFrame:
        """First day a user's credits pass 32000; special when there is an error that day."""
        days = self.t("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
            F.sum(F.col("value").cast("decimal(14,2)") * Decimal(10)).alias("credits"),
            F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errors"))
        so_far = Window.partitionBy("user_id").orderBy("day")
        return (days.withColumn("running", F.sum("credits").over(so_far))
                .where(F.col("running") > 32000)
                .groupBy("user_id").agg(F.min_by(F.struct("day", "errors"), "day").alias("p"))
                .select(F.col("user_id").alias("guest_id"),
                        (F.col("p.day").cast("timestamp_ntz") + F.expr("INTERVAL '10' HOUR"))
                        .alias("changed_at"),
                        (F.col("user_id") % 3 + 1).cast("int").alias("promo_tier"),
                        (F.col("user_id") % 3 + 2).cast("int").alias("tier_after"),
                        (F.col("p.errors") == 1).alias("is_special")))

    @cached_property
    def player_days(self) -> DataFrame:
        """The stored player days: two years at once, and their last day once more, as a day is added."""
        path = work_path(self.spark, "player_days")
        with milestones():
            ledger = materialize(of_years(self.ledger, 2023, 2024), "ledger")  # joined once for both
            put_days(ledger, path, date(2023, 1, 1), date(2024, 12, 31), PROPERTY)
            put_days(ledger, path, date(2024, 12, 31), date(2024, 12, 31), PROPERTY)
        return read_days(self.spark, path)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {"visit": self.visits, "ledger": self.ledger, "member_xref": self.xref,
                "trip_demo": self.trip_demo, "tier_history": self.tier_history,
                "reason_enum": self.enum, "activity": self.activity}


#: Tables that ``staged`` writes.
STAGED = ("activity", "items", "policies", "locations", "id_map", "members", "member_tiers", "member_tier_history",
          "merged", "enum", "xref", "tier_history", "ledger", "visits", "trip_demo", "profiles", "regional",
          "linked", "event_ledger", "event_xref", "day_trips", "day_promotions")


def staged(x: StandIns) -> StandIns:
    """The same tables written as Parquet and read back, as a warehouse would hold them."""
    for name in STAGED:
        x.__dict__[name] = materialize(getattr(x, name), name)
    return x
