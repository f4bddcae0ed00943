"""SQL twin of every query, written for DuckDB over the same tables.

Each statement is a chain of common table expressions; only those a query needs are put in
front of it. The twins follow the plain definition of a result (row pairs, global windows,
nested subqueries), not the way the Spark side gets there.
"""

from __future__ import annotations

import re

from verification.queries import (
    AS_OF, BIAS, EVENT_FEATURES, MODEL_BIAS, NEW_GUEST_FEATURES, RETURNING_FEATURES, SPECS, WEIGHTS,
    model_weights)
from verification.shape import shape_sql

#: Local clock: the ten summers, both ends included.
PACIFIC_SUMMER = tuple((f"{a} 01:59:59.999999", f"{b} 01:59:59.999999") for a, b in (
    ("2016-03-13", "2016-11-06"), ("2017-03-12", "2017-11-05"), ("2018-03-11", "2018-11-04"),
    ("2019-03-10", "2019-11-03"), ("2020-03-10", "2020-11-01"), ("2021-03-14", "2021-11-07"),
    ("2022-03-13", "2022-11-06"), ("2023-03-12", "2023-11-05"), ("2024-03-10", "2024-11-03"),
    ("2025-03-09", "2025-11-02")))
OTS = "o_orderdate + INTERVAL 9496 DAY + to_hours(o_orderkey % 24)"
START = "CAST(o_orderdate + INTERVAL 9496 DAY AS DATE)"
END = f"({START} + CAST(o_orderkey % 30 + 1 AS INTEGER))"
TIERS4 = "['Sapphire', 'Pearl', 'Gold', 'Platinum']"
TIERS5 = "['Sapphire', 'Pearl', 'Gold', 'Platinum', 'Invited']"
LODGING = "['01 - In House', '02 - Local', '03 - Drop In']"


def player(key):
    return f"CAST({key} + 700000 AS VARCHAR)"


def pacific(ts):
    summer = " OR ".join(f"{ts} BETWEEN TIMESTAMP '{a}' AND TIMESTAMP '{b}'"
                         for a, b in PACIFIC_SUMMER)
    return f"({ts} - CASE WHEN {summer} THEN INTERVAL 7 HOUR ELSE INTERVAL 8 HOUR END)"


def ladder(tier, other=-1):
    return f"CASE {tier} WHEN 1 THEN 20000 WHEN 2 THEN 75000 WHEN 3 THEN 200000 ELSE {other} END"


def rank(name):
    return (f"CASE {name} WHEN 'Sapphire' THEN 1 WHEN 'Pearl' THEN 2 WHEN 'Gold' THEN 3 "
            "WHEN 'Platinum' THEN 4 ELSE 5 END")


def bucket(key, salt):
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 7))::BIGINT % 1000)"


def number(text):
    return f"TRY_CAST(substr({text}, 2, 2) AS INTEGER)"


REASONS = "tier_reason, tier_sub_reason, change_reason, change_sub_reason"
MAX_REASONS = ", ".join(f"max({r}) AS {r}" for r in REASONS.split(", "))
CUMULATIVE = "ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEST = ("gaming_credits", "non_gaming_credits", "credits", "trips", "trip_days",
        "first_trip_age", "lodger_trips", "local_trips")
MAX_BEST = ", ".join(f"max({c}) AS {c}" for c in BEST)
EARNED = " AND ".join(f"({c} IS NULL OR {c} = 'Tier Evaluation')" for c in (
    "tier_label", "tier_sub_label", "change_label", "change_sub_label"))


def labelled(source):
    return f"""SELECT p.*, a.label AS tier_label, b.label AS tier_sub_label,
        c.label AS change_label, d.label AS change_sub_label
      FROM {source} p
      LEFT JOIN fx_enum a ON p.tier_reason = a.enum_value
      LEFT JOIN fx_enum b ON p.tier_sub_reason = b.enum_value
      LEFT JOIN fx_enum c ON p.change_reason = c.enum_value
      LEFT JOIN fx_enum d ON p.change_sub_reason = d.enum_value
      WHERE p.changed_at IS NOT NULL"""


def credits_of_trips(source, year):
    return f"""SELECT x.guest_id, l.player_id, t.trip_id, t.trip_start, t.trip_end, t.property,
        sum(l.credits) AS credits, max(t.start_tier) AS tier,
        sum(CASE WHEN l.lob_group = 'Gaming' THEN l.credits ELSE 0 END) AS gaming_credits,
        sum(CASE WHEN l.lob_group = 'Non-Gaming' THEN l.credits ELSE 0 END) AS non_gaming_credits
      FROM {source} t
      JOIN fx_xref x ON t.guest_id = x.guest_id
      JOIN fx_ledger l ON l.player_id = x.player_id
        AND CAST(l.ts AS DATE) BETWEEN t.trip_start AND t.trip_end
      WHERE year(t.trip_start) = {year} AND year(l.ts) = {year}
      GROUP BY ALL"""


def described(source):
    return f"""SELECT t.*, d.gender, d.age, d.location, d.lodging, d.tenure
      FROM {source} t JOIN fx_demo d USING (guest_id, trip_start, trip_end)
      WHERE d.trip_start BETWEEN DATE '2020-01-01' AND DATE '2025-12-31'"""


def promotions(year):
    return f"""SELECT player_id, tier_before, tier_after, changed_at, {REASONS}
      FROM st_ranked WHERE tier_before < tier_after AND tier_after <> 5
        AND changed_at BETWEEN TIMESTAMP '{year}-01-01' AND TIMESTAMP '{year}-12-31'"""


def periods(source, year):
    return f"""SELECT *, {ladder('trip_tier')} AS target_credits FROM (
      SELECT guest_id, calendar_year, changed_at, count(*) AS trips,
        date_diff('day', min(trip_start), DATE '{year}-12-31') AS first_trip_age,
        sum(date_diff('day', trip_start, trip_end) + 1) AS trip_days,
        sum(credits) AS credits, sum(gaming_credits) AS gaming_credits,
        sum(non_gaming_credits) AS non_gaming_credits,
        count(*) FILTER (lodging = '01 - In House') AS lodger_trips,
        count(*) FILTER (lodging = '02 - Local') AS local_trips,
        count(*) FILTER (lodging = '03 - Drop In') AS drop_in_trips,
        min(tier) AS tier, max(tier_before) AS promo_tier, max(tier_after) AS tier_after,
        {MAX_REASONS}, coalesce(max(tier_before), {number('min(tier)')}) AS trip_tier
      FROM {source} GROUP BY guest_id, calendar_year, changed_at)
    WHERE {ladder('trip_tier')} <> -1"""


def history(labelled_periods, periods_name):
    """Natural promotions, both halves, their sum and the special-only guests."""
    natural = f"""SELECT p.*, x.player_id FROM (
        SELECT *, CAST(credits AS DOUBLE) / target_credits AS earned_share
        FROM {labelled_periods}) p
      LEFT JOIN fx_xref x USING (guest_id)
      WHERE {EARNED} AND CAST(changed_at AS DATE) <> DATE '2023-02-01' AND earned_share > 0.8
        AND NOT EXISTS (SELECT 1 FROM fx_activity s WHERE s.activity_type = 'Set Tier'
          AND year(s.created_at) = 2023 AND s.loyalty_id = x.player_id
          AND s.created_at = p.changed_at)"""
    success = "SELECT guest_id, max(trip_tier) + 1 AS top_tier, " + MAX_BEST + \
        " FROM {natural} GROUP BY guest_id"
    unsuccess = f"SELECT guest_id, max(trip_tier) AS top_tier, {MAX_BEST} FROM {periods_name} " \
        "WHERE changed_at IS NULL GROUP BY guest_id"
    return natural, success, unsuccess


COMBINED = """SELECT guest_id, max(top_tier) AS top_tier,
    CASE WHEN sum(credits) = 0 THEN 0 ELSE CAST(sum(gaming_credits) AS DOUBLE)
      / CAST(sum(credits) AS DOUBLE) END AS gaming_share,
    CASE WHEN sum(credits) = 0 THEN 0 ELSE CAST(sum(non_gaming_credits) AS DOUBLE)
      / CAST(sum(credits) AS DOUBLE) END AS non_gaming_share,
    sum(credits) AS hist_credits, sum(trips) AS hist_trips, sum(trip_days) AS hist_trip_days,
    max(first_trip_age) AS hist_first_trip_age,
    CAST(sum(lodger_trips) AS DOUBLE) / CAST(sum(trips) AS DOUBLE) AS lodger_share,
    CAST(sum(local_trips) AS DOUBLE) / CAST(sum(trips) AS DOUBLE) AS local_share
  FROM (FROM {success} UNION ALL FROM {unsuccess}) GROUP BY guest_id"""


def intervals(natural, year):
    return f"""SELECT guest_id, CAST(coalesce(lag(changed_at) OVER (
          PARTITION BY guest_id ORDER BY changed_at), TIMESTAMP '{year - 1}-12-31') AS DATE)
          AS prev_changed_on, CAST(changed_at AS DATE) AS changed_on, promo_tier
      FROM {natural}
      UNION ALL
      SELECT guest_id, CAST(max(changed_at) AS DATE), DATE '{year + 1}-01-01', max(tier_after)
      FROM {natural} GROUP BY guest_id"""


def in_trips(days, trips, tier):
    return f"""SELECT d.*, date_diff('day', t.trip_start, t.trip_end) + 1 AS trip_length,
        date_diff('day', t.trip_start, d.day) + 1 AS trip_day, {tier} AS trip_tier, t.lodging
      FROM {days} d JOIN {trips} t ON d.guest_id = t.guest_id
        AND d.day BETWEEN t.trip_start AND t.trip_end"""


def labels(rows, spans, year):
    lifted = "CASE WHEN r.trip_tier < i.promo_tier THEN i.promo_tier ELSE r.trip_tier END"
    return f"""SELECT r.* EXCLUDE (trip_tier, lodging), i.prev_changed_on, i.changed_on,
        i.promo_tier, {lifted} AS trip_tier, {ladder(lifted)} AS target_credits,
        coalesce({number('lodging')}, 0) AS lodging_code,
        CASE WHEN r.day > i.changed_on - 7 AND year(i.changed_on) = {year} THEN 1 ELSE 0 END
          AS label
      FROM {rows} r LEFT JOIN {spans} i ON r.guest_id = i.guest_id
        AND r.day BETWEEN i.prev_changed_on AND i.changed_on
      WHERE {ladder(lifted)} > 0"""


def numbered_days(source):
    return f"""SELECT *, row_number() OVER (PARTITION BY guest_id ORDER BY day) AS day_no,
        sum(credits) OVER (PARTITION BY guest_id {CUMULATIVE}) AS running_credits
      FROM {source}"""


ROW_ORDER = "day, trip_day DESC, trip_length, lodging_code, trip_tier, changed_on NULLS LAST"


def shares(source):
    parts = ", ".join(
        f"CAST(count(*) FILTER (lodging_code = {code}) OVER so_far AS DOUBLE) "
        f"/ count(*) OVER so_far AS {name}"
        for code, name in ((1, "lodger_share"), (2, "local_share")))
    return f"""SELECT *, {parts} FROM {source} WINDOW so_far AS (PARTITION BY guest_id
      ORDER BY {ROW_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


NO_PROMOTION_DAY = "(changed_on <> day OR changed_on IS NULL)"
CELL = ", ".join(f"CAST(CAST(round({f} * 100) AS BIGINT) AS VARCHAR)" for f in EVENT_FEATURES)
STEP = f"concat_ws(',', {CELL})"

#: Names of common table expressions.
NAMES = r"\b(?:fx|st|ci|ni|wi|wr|wn)_\w+"
CTES: dict[str, str] = {
    # stand-ins
    "fx_activity": f"""SELECT o_orderkey AS activity_id, o_custkey AS member_id,
        CAST(o_custkey % 25 AS INTEGER) AS location_id, {OTS} AS activity_at,
        {OTS} AS created_at,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'Error'
          WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL
          ELSE 'Posted' END AS activity_status,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'Set Tier'
          ELSE 'Earn' END AS activity_type,
        ['Gaming Slots', 'Gaming Tables', 'Hotel', 'FB', 'Online', 'Other', 'Spa', 'Misc'][
          CAST(o_orderkey % 8 AS INTEGER) + 1] AS lob,
        CASE WHEN o_totalprice > 400000 THEN 'SYS1' ELSE 'AGENT' END AS user_id,
        {player('o_custkey')} AS loyalty_id,
        CASE WHEN o_totalprice < 20000 THEN 'Y' ELSE 'N' END AS delete_flag FROM orders""",
    "fx_items": """SELECT l_orderkey AS activity_id, l_partkey AS policy_id,
        CAST(round(l_extendedprice * 2500) AS BIGINT) AS accrued_points,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'Y' ELSE 'N' END AS delete_flag
      FROM lineitem""",
    "fx_policies": """SELECT p_partkey AS policy_id,
        CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'STANDARD') THEN 'Tier Credits ' ELSE 'Points '
          END || p_type AS policy_name,
        CASE WHEN p_size = 50 THEN 'Y' ELSE 'N' END AS delete_flag FROM part""",
    "fx_locations": """SELECT n_nationkey AS location_id, n_name AS site_name,
        CASE WHEN n_regionkey = 4 THEN 'Y' ELSE 'N' END AS delete_flag FROM nation""",
    "fx_idmap": f"""SELECT c_custkey AS member_id, {player('c_custkey')} AS loyalty_id,
        CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'Other' ELSE 'PlayerId' END
          AS id_kind,
        CASE WHEN c_acctbal > 9500 THEN 'Y' ELSE 'N' END AS delete_flag FROM customer""",
    "fx_members": """SELECT c_custkey AS member_id,
        TIMESTAMP '2016-01-01' + to_days(CAST(c_custkey % 3600 AS INTEGER)) AS enrolled_at,
        CASE WHEN c_acctbal BETWEEN 0 AND 100 THEN 'Y' ELSE 'N' END AS delete_flag
      FROM customer""",
    "fx_member_tiers": f"""SELECT c_custkey AS member_id,
        CASE WHEN c_acctbal < 0 AND c_mktsegment = 'FURNITURE' THEN NULL
          ELSE {TIERS4}[CAST(c_custkey % 4 AS INTEGER) + 1] END AS level_name,
        CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN NULL
          ELSE TIMESTAMP '2016-01-01' + to_days(CAST(c_custkey % 3600 AS INTEGER) + 30)
            + INTERVAL 3 HOUR END AS achieved_at,
        CASE WHEN c_mktsegment = 'BUILDING' THEN '3-MEDIUM' END AS reason,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '1-URGENT' END AS sub_reason,
        'N' AS delete_flag FROM customer""",
    "fx_member_history": f"""SELECT o_custkey AS member_id,
        CASE WHEN o_totalprice < 30000 THEN NULL
          ELSE {TIERS4}[CAST(o_orderkey % 4 AS INTEGER) + 1] END AS prev_level,
        CASE WHEN o_totalprice BETWEEN 20000 AND 40000 THEN NULL
          ELSE {TIERS5}[CAST((o_orderkey // 4) % 5 AS INTEGER) + 1] END AS new_level,
        CASE WHEN o_totalprice > 490000 THEN NULL ELSE {OTS} END AS assigned_at,
        o_orderpriority AS reason,
        CASE WHEN o_totalprice > 450000 THEN '2-HIGH' END AS sub_reason,
        CASE WHEN o_totalprice > 480000 THEN 'Y' ELSE 'N' END AS delete_flag
      FROM orders WHERE o_orderstatus = 'F'""",
    "fx_merged": """SELECT c_custkey AS victim_id, c_custkey + 1 AS survivor_id,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Y' ELSE 'N' END AS delete_flag
      FROM customer WHERE c_acctbal < 0""",
    "fx_enum": """SELECT DISTINCT o_orderpriority AS enum_value,
        CASE WHEN o_orderpriority = '2-HIGH' THEN 'Goodwill' ELSE 'Tier Evaluation' END AS label
      FROM orders WHERE o_orderpriority <> '1-URGENT'""",
    "fx_xref": f"SELECT {player('c_custkey')} AS player_id, c_custkey AS guest_id FROM customer",
    "fx_tier_history": f"""SELECT {player('o_custkey')} AS player_id,
        {TIERS4}[CAST(o_orderkey % 4 AS INTEGER) + 1] AS tier_from,
        {TIERS5}[CAST((o_orderkey // 4) % 5 AS INTEGER) + 1] AS tier_to, {OTS} AS changed_at,
        CASE WHEN o_totalprice > 450000 THEN '2-HIGH' END AS tier_reason,
        CASE WHEN o_totalprice < 50000 THEN '3-MEDIUM' END AS tier_sub_reason,
        o_orderpriority AS change_reason,
        CASE WHEN o_totalprice BETWEEN 50000 AND 100000 THEN '4-NOT SPECIFIED' END
          AS change_sub_reason FROM orders WHERE o_orderstatus = 'F'""",
    "fx_regions": """SELECT s_suppkey, r_name FROM supplier
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_ledger": f"""SELECT {player('o_custkey')} AS player_id,
        o_orderdate + INTERVAL 9496 DAY + to_days(l_linenumber * 2) + to_hours(l_linenumber)
          AS ts,
        CAST(CAST(l_extendedprice AS DECIMAL(16, 2)) * CAST(0.25 AS DECIMAL(2, 2))
          AS DECIMAL(18, 4)) AS credits, r_name AS site_name,
        CASE l_returnflag WHEN 'R' THEN 'Gaming' WHEN 'A' THEN 'Non-Gaming' ELSE 'Other' END
          AS lob_group
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN fx_regions ON l_suppkey = s_suppkey""",
    "fx_visits": f"""SELECT o_custkey AS guest_id, r_name AS property, p_type AS department,
        {START} AS trip_start, {END} AS trip_end,
        '0' || (o_orderkey % 4 + 1) || ' - ' || {TIERS4}[CAST(o_orderkey % 4 AS INTEGER) + 1]
          AS start_tier, CAST(l_quantity AS INTEGER) AS gaming_days,
        CASE WHEN r_name = 'AMERICA' THEN 'LAS' ELSE r_name END AS site_group,
        CAST(date_trunc('month', {START}) AS DATE) AS month,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Convention' WHEN '5-LOW' THEN NULL
          ELSE 'Leisure' END AS segment,
        CAST(l_extendedprice AS DECIMAL(16, 2)) * CAST(l_discount AS DECIMAL(4, 2))
          AS net_gaming_revenue
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      JOIN fx_regions ON l_suppkey = s_suppkey""",
    "fx_demo": f"""SELECT o_custkey AS guest_id, {START} AS trip_start, {END} AS trip_end,
        CASE WHEN o_totalprice < 50000 THEN NULL WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END
          AS gender, o_custkey % 60 + 20 AS age,
        CASE WHEN o_totalprice <= 480000 THEN 'NATION_' || (o_custkey % 25) END AS location,
        {LODGING}[CAST(o_orderkey % 3 AS INTEGER) + 1] AS lodging, o_custkey % 10 AS tenure
      FROM orders""",
    "fx_daily": """SELECT user_id AS guest_id, CAST(ts AS DATE) AS day,
        sum(CAST(CAST(value AS DECIMAL(14, 2)) * 10 AS DECIMAL(18, 4))) AS credits,
        max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors
      FROM events GROUP BY ALL""",
    "st_daily": """SELECT guest_id, day, credits,
        date_diff('day', day, DATE '2024-12-31') AS days_left FROM fx_daily
      WHERE year(day) = 2024""",
    "st_running": numbered_days("st_daily"),
    "fx_day_trips": f"""SELECT DISTINCT user_id AS guest_id, {{s}} AS trip_start,
        {{s}} + CASE WHEN user_id % 10 = 0 THEN 6 ELSE 4 END AS trip_end,
        '0' || (user_id % 4 + 1) || ' - Level' AS tier,
        {LODGING}[CAST((date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5) % 3
          AS INTEGER) + 1] AS lodging FROM events""".replace(
        "{s}", "(DATE '2024-01-01' + CAST(date_diff('day', DATE '2024-01-01', "
               "CAST(ts AS DATE)) // 5 * 5 AS INTEGER))"),
    "fx_day_promos": f"""SELECT guest_id, min(day) + INTERVAL 10 HOUR AS changed_at,
        guest_id % 3 + 1 AS promo_tier, guest_id % 3 + 2 AS tier_after,
        arg_min(errors, day) = 1 AS is_special
      FROM (SELECT *, sum(credits) OVER (PARTITION BY guest_id {CUMULATIVE}) AS running
            FROM fx_daily) WHERE running > 32000 GROUP BY guest_id""",
    "st_natural_days": "SELECT * FROM fx_day_promos WHERE NOT is_special",
    "st_day_in_trip": in_trips("st_running", "fx_day_trips", number("t.tier")),
    "st_day_intervals": intervals("st_natural_days", 2024),
    "st_day_labels": labels("st_day_in_trip", "st_day_intervals", 2024),
    "st_scores": """SELECT r.guest_id, r.day, r.days_left,
        round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(CAST(running_credits AS DOUBLE) / 20000.0::DOUBLE
          - days_left / 365.0::DOUBLE))), 6) AS score,
        CASE WHEN r.day BETWEEN CAST(p.changed_at AS DATE) - 6 AND CAST(p.changed_at AS DATE)
          THEN 1 ELSE 0 END AS label
      FROM st_running r LEFT JOIN fx_day_promos p USING (guest_id)""",
    "st_scored_rows": """SELECT r.*, s.label FROM st_running r
      JOIN st_scores s USING (guest_id, day)""",
    "st_fp": """SELECT r.*, s.score FROM st_scored_rows r
      JOIN st_scores s USING (guest_id, days_left)
      WHERE r.guest_id NOT IN (SELECT guest_id FROM st_scored_rows WHERE label = 1)
        AND r.guest_id IN (SELECT guest_id FROM st_scores WHERE score > 0.5)""",
    "st_fp_profile": """SELECT f.*, c.c_mktsegment AS game_type, c.c_acctbal AS worth_18m,
        CAST(TIMESTAMP '2016-01-01' + to_days(CAST(c_custkey % 3600 AS INTEGER)) AS DATE)
          AS enrolled_on
      FROM st_fp f JOIN customer c ON f.guest_id = c.c_custkey""",
    # ledger and tiers
    "st_ids": """SELECT member_id, loyalty_id AS player_id FROM fx_idmap
      WHERE id_kind = 'PlayerId' AND delete_flag = 'N'""",
    "st_members": """SELECT m.member_id, i.player_id, m.enrolled_at, t.level_name, t.achieved_at,
        t.reason AS tier_reason, t.sub_reason AS tier_sub_reason
      FROM fx_members m JOIN fx_member_tiers t USING (member_id) JOIN st_ids i USING (member_id)
      WHERE m.delete_flag = 'N' AND t.delete_flag = 'N'""",
    "st_without": """SELECT member_id, player_id, enrolled_at, level_name AS tier_from,
        level_name AS tier_to, achieved_at AS changed_at,
        coalesce(level_name, 'NA') AS current_tier,
        coalesce(achieved_at, TIMESTAMP '9999-12-31') AS current_tier_at, tier_reason,
        tier_sub_reason, CAST(NULL AS VARCHAR) AS change_reason,
        CAST(NULL AS VARCHAR) AS change_sub_reason FROM st_members
      WHERE member_id NOT IN (SELECT member_id FROM fx_member_history WHERE delete_flag = 'N')""",
    "st_with": """SELECT m.member_id, player_id, enrolled_at,
        coalesce(prev_level, 'Sapphire') AS tier_from,
        coalesce(new_level, prev_level, 'Sapphire') AS tier_to,
        coalesce(assigned_at, achieved_at) AS changed_at,
        coalesce(level_name, 'NA') AS current_tier,
        coalesce(achieved_at, TIMESTAMP '9999-12-31') AS current_tier_at, tier_reason,
        tier_sub_reason, h.reason AS change_reason, h.sub_reason AS change_sub_reason
      FROM st_members m JOIN fx_member_history h USING (member_id) WHERE h.delete_flag = 'N'""",
    "st_survivor": """SELECT c.*, coalesce(g.survivor_id, c.member_id) AS survivor_id
      FROM (FROM st_without UNION FROM st_with) c
      LEFT JOIN fx_merged g ON c.member_id = g.victim_id AND g.delete_flag = 'N'""",
    "st_tier_history": f"""SELECT c.player_id, {pacific('enrolled_at')} AS enrolled_at, tier_from,
        tier_to, {pacific('changed_at')} AS changed_at, current_tier,
        {pacific('current_tier_at')} AS current_tier_at,
        CAST(i.player_id AS BIGINT) AS survivor_player_id, tier_reason, tier_sub_reason,
        change_reason, change_sub_reason
      FROM st_survivor c JOIN st_ids i ON i.member_id = c.survivor_id""",
    "st_lob": """SELECT *, CASE WHEN lob LIKE 'Gaming%' THEN 'Gaming'
        WHEN user_id LIKE 'SYS%' THEN 'Non-Gaming'
        WHEN lob IN ('Coffee', 'Entertainment', 'FB', 'Hotel', 'Spa') THEN 'Non-Gaming'
        ELSE 'Other' END AS lob_group FROM fx_activity""",
    "st_ranked": f"""SELECT *, {rank('tier_from')} AS tier_before, {rank('tier_to')} AS tier_after
      FROM fx_tier_history""",
    # visits
    "st_visits": """SELECT *, CASE WHEN site_group = 'LAS' THEN 'Vegas' ELSE 'Region' END AS site
      FROM fx_visits WHERE month >= DATE '2016-01-01'
        AND (segment <> 'Convention' OR segment IS NULL)""",
    "st_rolled": """SELECT guest_id, trip_start, trip_end,
        guest_id || '_' || trip_start || '_' || trip_end AS trip_id,
        count(department) AS departments, max(property) AS property,
        max(gaming_days) AS gaming_days, max(start_tier) AS start_tier
      FROM st_visits WHERE property <> 'EUROPE' AND trip_start < DATE '2024-12-31'
      GROUP BY guest_id, trip_start, trip_end""",
    "st_rolled_to_end": """SELECT guest_id, trip_start, trip_end,
        guest_id || '_' || trip_start || '_' || trip_end AS trip_id,
        max(property) AS property, max(start_tier) AS start_tier
      FROM st_visits WHERE property <> 'EUROPE' AND trip_start <= DATE '2024-12-31'
      GROUP BY guest_id, trip_start, trip_end""",
    "st_here": "SELECT * FROM st_rolled WHERE contains(property, 'MIDDLE EAST')",
    "st_returning": """SELECT DISTINCT a.guest_id FROM st_here a JOIN st_here b USING (guest_id)
      WHERE year(a.trip_start) = 2024 AND year(b.trip_start) = 2023""",
    "st_property_credits": """SELECT guest_id, year(ts) AS y, sum(credits) AS total,
        sum(CASE WHEN contains(site_name, 'MIDDLE EAST') THEN credits ELSE 0 END) AS here
      FROM fx_ledger JOIN fx_xref USING (player_id) GROUP BY ALL""",
    "st_dominant": """SELECT guest_id FROM st_property_credits WHERE y IN (2023, 2024)
      GROUP BY guest_id HAVING sum(here) > sum(total) * 0.5""",
    "st_any": "SELECT guest_id FROM st_property_credits WHERE y = 2024 AND here > 0",
    "st_cohort": """SELECT * FROM st_rolled WHERE guest_id IN (FROM st_returning)
      AND guest_id IN (FROM st_dominant)""",
    "st_new": """SELECT * FROM st_here WHERE year(trip_start) = 2024 AND guest_id NOT IN (
        SELECT guest_id FROM st_here WHERE year(trip_start) = 2023)""",
    "st_new_cohort": "SELECT * FROM st_new WHERE guest_id IN (FROM st_any)",
    # trips
    "st_credits_2023": credits_of_trips("st_rolled", 2023),
    "st_credits_2024": credits_of_trips("st_rolled", 2024),
    "st_demo_2023": described("st_credits_2023"),
    "st_demo_2024": described("st_credits_2024"),
    "st_promos_2023": promotions(2023),
    "st_promos_2024": promotions(2024),
    "st_fanout": f"""SELECT t.*, p.tier_before, p.tier_after, p.changed_at,
        CASE WHEN p.player_id IS NOT NULL THEN TIMESTAMP '2023-01-01' END AS prev_changed_at,
        {', '.join('p.' + r for r in REASONS.split(', '))},
        year(t.trip_start) AS calendar_year
      FROM st_demo_2023 t LEFT JOIN st_promos_2023 p ON t.player_id = p.player_id
        AND CAST(t.trip_start AS TIMESTAMP) BETWEEN TIMESTAMP '2023-01-01' AND p.changed_at
      WHERE age IS NOT NULL AND gender IS NOT NULL""",
    "st_disjoint": f"""SELECT t.*, p.tier_before, p.tier_after, p.changed_at, p.prev_changed_at,
        {', '.join('p.' + r for r in REASONS.split(', '))},
        year(t.trip_start) AS calendar_year
      FROM st_demo_2024 t LEFT JOIN (
        SELECT *, coalesce(lag(changed_at) OVER (PARTITION BY player_id
          ORDER BY changed_at, tier_before, tier_after, {REASONS}),
          TIMESTAMP '2024-01-01') AS prev_changed_at FROM st_promos_2024) p
        ON t.player_id = p.player_id
        AND CAST(t.trip_start AS TIMESTAMP) BETWEEN p.prev_changed_at AND p.changed_at
      WHERE age IS NOT NULL AND gender IS NOT NULL""",
    # history
    "st_periods": periods("st_fanout", 2023),
    "st_rollup": periods("st_disjoint", 2024),
    "st_labelled_hist": labelled("st_periods"),
    "st_natural_hist": history("st_labelled_hist", "st_periods")[0],
    "st_success": history("", "")[1].format(natural="st_natural_hist"),
    "st_unsuccess": history("", "st_periods")[2],
    "st_combined": COMBINED.format(success="st_success", unsuccess="st_unsuccess"),
    "st_hist_special": """SELECT DISTINCT guest_id FROM st_labelled_hist
      WHERE guest_id NOT IN (SELECT guest_id FROM st_natural_hist)""",
    "st_labelled": labelled("st_rollup"),
    "st_natural": f"""SELECT p.*, x.player_id FROM st_labelled p LEFT JOIN fx_xref x USING (guest_id)
      WHERE {EARNED} AND CAST(changed_at AS DATE) <> DATE '2024-02-01'
        AND x.player_id NOT IN (SELECT loyalty_id FROM fx_activity
          WHERE activity_type = 'Set Tier' AND year(created_at) = 2024)""",
    "st_special": """SELECT DISTINCT guest_id FROM st_labelled
      WHERE guest_id NOT IN (SELECT guest_id FROM st_natural)""",
    # trip models
    "st_numbered": f"""SELECT *, row_number() OVER (PARTITION BY guest_id ORDER BY trip_start,
          trip_end, player_id, changed_at NULLS LAST, tier_before, tier_after, {REASONS})
          AS trip_no,
        sum(credits) OVER (PARTITION BY guest_id ORDER BY trip_start
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_credits
      FROM st_disjoint""",
    "st_first": """SELECT n.guest_id, date_diff('day', trip_start, DATE '2024-12-31') AS days_left,
        credits, gaming_credits, non_gaming_credits, gender, age, location,
        CASE WHEN credits > 200000 THEN -1 WHEN credits > 75000 THEN 200000
          WHEN credits > 20000 THEN 75000 ELSE 20000 END AS target_credits,
        c.* EXCLUDE (guest_id)
      FROM st_numbered n JOIN st_combined c USING (guest_id) WHERE trip_no = 1
        AND n.guest_id NOT IN (FROM st_special) AND n.guest_id NOT IN (FROM st_hist_special)""",
    "st_second": f"""SELECT t.*, c.* EXCLUDE (guest_id), {ladder('top_tier')} AS target_credits
      FROM (SELECT guest_id, date_diff('day', max(trip_start), DATE '2024-12-31') AS days_left,
          sum(credits) AS credits, sum(gaming_credits) AS gaming_credits,
          sum(non_gaming_credits) AS non_gaming_credits, max(gender) AS gender, max(age) AS age,
          max(location) AS location FROM st_numbered WHERE trip_no <= 2 GROUP BY guest_id) t
      JOIN st_combined c USING (guest_id)
      WHERE {ladder('top_tier')} > 0 AND t.guest_id NOT IN (
        SELECT guest_id FROM st_numbered WHERE changed_at IS NOT NULL
        GROUP BY guest_id, changed_at HAVING max(trip_no) <= 2)""",
    "st_trip_labels": f"""SELECT *, {ladder('tier', 0)} AS target_credits FROM (
        SELECT *, coalesce(promo_tier, top_tier) AS tier,
          CASE WHEN changed_at IS NULL THEN -2 ELSE row_number() OVER (
            PARTITION BY guest_id, changed_at
            ORDER BY trip_start DESC, trip_end DESC, trip_no DESC) - 1 END AS label
        FROM (SELECT n.guest_id, trip_no, trip_start, trip_end, running_credits,
            date_diff('day', trip_start, DATE '2024-12-31') AS days_left, n.gender, n.age,
            c.* EXCLUDE (guest_id), p.promo_tier, p.changed_at, p.prev_changed_at
          FROM st_numbered n JOIN st_combined c USING (guest_id)
          LEFT JOIN (SELECT *, coalesce(lag(changed_at) OVER (PARTITION BY guest_id
              ORDER BY changed_at), TIMESTAMP '2024-01-01') AS prev_changed_at FROM st_natural) p
            ON n.guest_id = p.guest_id AND CAST(trip_start AS TIMESTAMP) >= p.prev_changed_at
            AND CAST(trip_start AS TIMESTAMP) <= p.changed_at
          WHERE n.guest_id NOT IN (FROM st_special)
            AND n.guest_id NOT IN (FROM st_hist_special)))
      WHERE label <> 0 AND hist_credits < {ladder('tier', 0)}""",
    # days
    "st_ledger_days": """SELECT guest_id, CAST(ts AS DATE) AS day, sum(credits) AS credits,
        date_diff('day', CAST(ts AS DATE), DATE '2024-12-31') AS days_left
      FROM fx_ledger JOIN fx_xref USING (player_id) WHERE year(ts) = 2024 GROUP BY ALL""",
    "st_population": """SELECT * FROM st_ledger_days
      WHERE guest_id IN (SELECT guest_id FROM st_combined)
        AND guest_id NOT IN (FROM st_special) AND guest_id NOT IN (FROM st_hist_special)""",
    "st_population_days": numbered_days("st_population"),
    "st_population_new": "SELECT * FROM st_ledger_days WHERE guest_id NOT IN (FROM st_special)",
    "st_population_new_days": numbered_days("st_population_new"),
    "st_intervals": intervals("st_natural", 2024),
    "st_rows": in_trips("st_population_days", "st_disjoint",
                        f"coalesce(t.tier_before, {number('t.tier')})"),
    "st_rows_hist": "SELECT r.*, c.* EXCLUDE (guest_id) FROM st_rows r "
                    "JOIN st_combined c USING (guest_id)",
    "st_day_features": "SELECT DISTINCT * FROM (" + labels(
        "st_rows_hist", "st_intervals", 2024) + ")",
    "st_rows_new": in_trips("st_population_new_days", "st_disjoint",
                            f"coalesce(t.tier_before, {number('t.tier')})"),
    "st_day_labels_new": labels("st_rows_new", "st_intervals", 2024),
    "st_day_features_new": "SELECT DISTINCT * FROM (" + shares("st_day_labels_new") + ")",
    "st_ledger_numbered": numbered_days("st_ledger_days"),
    # inference of a cohort: returning guests keep their history within the cohort's trips
    "ci_trips": """SELECT * FROM st_rolled_to_end WHERE guest_id IN (
        SELECT a.guest_id FROM st_rolled_to_end a JOIN st_rolled_to_end b USING (guest_id)
        WHERE contains(a.property, 'MIDDLE EAST') AND contains(b.property, 'MIDDLE EAST')
          AND year(a.trip_start) = 2024 AND year(b.trip_start) = 2023)
      AND guest_id IN (FROM st_dominant)""",
    "ci_credits_2023": credits_of_trips("ci_trips", 2023),
    "ci_demo_2023": described("ci_credits_2023"),
    "ci_fanout": f"""SELECT t.*, p.tier_before, p.tier_after, p.changed_at,
        {', '.join('p.' + r for r in REASONS.split(', '))},
        year(t.trip_start) AS calendar_year
      FROM ci_demo_2023 t LEFT JOIN st_promos_2023 p ON t.player_id = p.player_id
        AND CAST(t.trip_start AS TIMESTAMP) BETWEEN TIMESTAMP '2023-01-01' AND p.changed_at
      WHERE age IS NOT NULL AND gender IS NOT NULL""",
    "ci_periods": periods("ci_fanout", 2023),
    "ci_labelled": labelled("ci_periods"),
    "ci_natural": history("ci_labelled", "ci_periods")[0],
    "ci_success": history("", "")[1].format(natural="ci_natural"),
    "ci_unsuccess": history("", "ci_periods")[2],
    "ci_combined": COMBINED.format(success="ci_success", unsuccess="ci_unsuccess"),
    "ci_credits_2024": credits_of_trips("ci_trips", 2024),
    "ci_lodged": """SELECT t.*, d.lodging FROM ci_credits_2024 t
      JOIN fx_demo d USING (guest_id, trip_start, trip_end)""",
    "ci_days": in_trips("st_ledger_numbered", "ci_lodged", number("t.tier")),
    "ci_rows": f"""SELECT r.* EXCLUDE (lodging), {number('lodging')} AS lodging_code,
        {ladder('trip_tier')} AS target_credits, c.* EXCLUDE (guest_id)
      FROM ci_days r JOIN ci_combined c USING (guest_id) WHERE {ladder('trip_tier')} > 0""",
    "ni_credits_2024": credits_of_trips("st_new_cohort", 2024),
    "ni_lodged": """SELECT t.*, d.lodging FROM ni_credits_2024 t
      JOIN fx_demo d USING (guest_id, trip_start, trip_end)""",
    "ni_days": in_trips("st_ledger_numbered", "ni_lodged", number("t.tier")),
    "ni_rows": f"""SELECT r.* EXCLUDE (lodging), {number('lodging')} AS lodging_code,
        {ladder('trip_tier')} AS target_credits, CAST(NULL AS DATE) AS changed_on
      FROM ni_days r WHERE {ladder('trip_tier')} > 0""",
    # sequences and scores
    "st_steps": f"""SELECT *, {STEP} AS step,
        (row_number() OVER (PARTITION BY guest_id ORDER BY day) - 1) // 6 AS chunk
      FROM st_scored_rows""",
    "st_chunks": """SELECT guest_id, chunk, arg_max(label, day) AS label, count(*) AS length,
        string_agg(step, ';' ORDER BY day) AS steps FROM st_steps GROUP BY guest_id, chunk""",
    "st_overlap_rows": f"""SELECT *,
        concat_ws(',', CAST(round(credits * 100) AS BIGINT), day_no * 100, trip_length * 100,
          trip_day * 100) AS step FROM st_day_labels WHERE {NO_PROMOTION_DAY}""",
    "st_scaled": "SELECT *, " + ", ".join(
        f"(CAST({c} AS DOUBLE) - min(CAST({c} AS DOUBLE)) OVER ()) / (max(CAST({c} AS DOUBLE)) "
        f"OVER () - min(CAST({c} AS DOUBLE)) OVER ()) AS {c}_scaled" for c in EVENT_FEATURES)
        + " FROM st_running",
    "st_curve": """SELECT score AS threshold, pos, neg,
        sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
        row_number() OVER (ORDER BY score DESC) AS point,
        lead(pos) OVER (ORDER BY score DESC) AS next_pos,
        lead(neg) OVER (ORDER BY score DESC) AS next_neg,
        sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives
      FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
            FROM st_scores GROUP BY score)""",
    "st_sparse": """SELECT row_number() OVER (ORDER BY threshold DESC) AS point, threshold, tp, fp,
        CAST(tp AS DOUBLE) / CAST(nullif(positives, 0) AS DOUBLE) AS tpr,
        CAST(fp AS DOUBLE) / CAST(nullif(negatives, 0) AS DOUBLE) AS fpr
      FROM st_curve WHERE (tp = pos AND fp = neg) OR next_pos IS NULL
        OR next_pos <> pos OR next_neg <> neg""",
}


_ENCODED = ("days_left", "credits", "gaming_credits", "non_gaming_credits", "gender_index", "age",
            None, "local_share", "lodger_share", "target_credits", "top_tier", "gaming_share",
            "non_gaming_share", "hist_credits", "hist_first_trip_age", "hist_trips")


def _index(column):
    """Index of a category by falling frequency, then name."""
    return (f"(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS idx, "
            f"count(*) OVER () AS n FROM st_trainable GROUP BY {column})")


def _metrics(t):
    return f"""SELECT {t}::DOUBLE AS threshold,
        CAST(count(*) FILTER (score > {t} AND label = 1) AS DOUBLE)
          / nullif(count(*) FILTER (label = 1), 0) AS tpr,
        CAST(count(*) FILTER (score > {t} AND label = 0) AS DOUBLE)
          / nullif(count(*) FILTER (label = 0), 0) AS fpr,
        count(*) FILTER (score > {t}) / 364.0::DOUBLE AS alerts_per_day FROM st_scores"""


def _scaled_by(fit, apply):
    bounds = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}"
                       for c in EVENT_FEATURES)
    cells = ", ".join(f"(CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) AS {c}_scaled"
                      for c in EVENT_FEATURES)
    return (f"SELECT st_running.*, {cells} FROM st_running, "
            f"(SELECT {bounds} FROM st_running WHERE {fit}) WHERE {apply}")


_MEANS = " + ".join(
    f"({w}::DOUBLE * avg({c}_scaled) OVER last6)" for w, c in zip(WEIGHTS, EVENT_FEATURES))
_LABEL_JOIN = """SELECT f.*, s.trips AS success_trips,
    CASE WHEN s.guest_id IS NULL THEN 0 ELSE 1 END AS label
  FROM {features} f LEFT JOIN (
    SELECT guest_id, arg_min(trips, changed_at) AS trips FROM st_natural
    WHERE trips > {used} GROUP BY guest_id) s USING (guest_id)"""
CTES["st_trainable"] = ("SELECT * FROM (" + _LABEL_JOIN.format(features="st_first", used=1)
                        + ") WHERE location IS NOT NULL AND target_credits <> -1")
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, avg(CAST({c} AS DOUBLE)) AS mean,
      stddev_samp(CAST({c} AS DOUBLE)) AS stddev, min({c}) AS lowest, max({c}) AS highest
      FROM st_running""" for c in EVENT_FEATURES)
_LAST6 = "PARTITION BY guest_id ORDER BY day ROWS BETWEEN 5 PRECEDING AND CURRENT ROW"

BODIES: dict[str, str] = {
    "utc_to_pacific": f"SELECT *, {pacific('activity_at')} AS local_at FROM fx_activity",
    "lob_rollup": "FROM st_lob",
    "tier_ordinal": "FROM st_ranked",
    "target_ladder": f"""SELECT *, {number('start_tier')} AS trip_tier,
        {ladder(number('start_tier'))} AS target,
        {ladder(number('start_tier'), 0)} AS strict_target FROM st_rolled""",
    "promo_trip_buckets": """SELECT guest_id, count(*) AS success_trips,
        CASE WHEN count(*) IS NULL THEN 0 WHEN count(*) > 2 AND count(*) <= 5 THEN 1
          WHEN count(*) > 5 AND count(*) <= 11 THEN 2
          WHEN count(*) > 11 AND count(*) <= 26 THEN 3 ELSE 4 END AS bucket
      FROM st_rolled GROUP BY guest_id""",
    "ledger_build": f"""SELECT i.player_id, {pacific('a.activity_at')} AS ts,
        CAST(n.accrued_points / 10000.0 AS DECIMAL(18, 4)) AS credits, l.site_name, a.lob_group
      FROM st_lob a JOIN fx_items n USING (activity_id)
      JOIN st_ids i USING (member_id)
      JOIN fx_policies p USING (policy_id)
      LEFT JOIN fx_locations l ON a.location_id = l.location_id AND l.delete_flag = 'N'
      WHERE p.policy_name LIKE 'Tier Credits%' AND a.activity_status NOT IN ('Error')
        AND a.delete_flag = 'N' AND n.delete_flag = 'N' AND p.delete_flag = 'N'
        AND {pacific('a.activity_at')} BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'""",
    "tiers_without_history": "FROM st_without",
    "tiers_with_history": "FROM st_with",
    "survivor_lookup": """SELECT c.*,
        coalesce(g.survivor_id, c.member_id) AS survivor_id FROM st_with c
      LEFT JOIN fx_merged g ON c.member_id = g.victim_id AND g.delete_flag = 'N'""",
    "tier_history_build": "FROM st_tier_history",
    "freshness": """SELECT 'ledger' AS step, max(ts) AS latest, count(*) AS row_count
      FROM fx_ledger UNION ALL
      SELECT 'tier_history', max(changed_at), count(*) FROM fx_tier_history""",
    "ledger_sink_roundtrip": """SELECT *, year(ts) AS calendar_year FROM fx_ledger
      WHERE year(ts) = 2024""",
    "ledger_rewritten_year": """SELECT *, year(ts) AS calendar_year FROM fx_ledger
      WHERE year(ts) = 2023 OR (year(ts) = 2024 AND lob_group = 'Non-Gaming')""",
    "observed_write": "SELECT 'ledger' AS step, max(ts) AS latest, count(*) AS row_count FROM fx_ledger",
    "ledger_running": """SELECT *, sum(credits) OVER (PARTITION BY guest_id ORDER BY ts)
        AS running_credits FROM fx_ledger JOIN fx_xref USING (player_id)""",
    "member_xref": """SELECT player_id, guest_id, sum(credits) AS credits, count(*) AS rows
      FROM fx_ledger JOIN fx_xref USING (player_id) GROUP BY ALL""",
    "visit_base": "FROM st_visits",
    "trip_rollup": "FROM st_rolled",
    "property_trips": "FROM st_here",
    "returning_cohort": "FROM st_returning",
    "new_cohort": "FROM st_new",
    "dominant_players": "FROM st_dominant",
    "any_property_players": "FROM st_any",
    "cohort_trips": "FROM st_cohort",
    "new_cohort_trips": "FROM st_new_cohort",
    "in_house_on": "FROM st_here WHERE DATE '2024-01-26' BETWEEN trip_start AND trip_end",
    "distinct_guests": "SELECT count(DISTINCT guest_id) AS guests FROM st_rolled",
    "cohort_tier_changes": """SELECT guest_id, changed_at, tier_from, tier_to, tier_before,
        tier_after FROM st_ranked JOIN fx_xref USING (player_id)
      WHERE year(changed_at) = 2024 AND guest_id IN (SELECT guest_id FROM st_new_cohort)""",
    "latest_snapshot": """SELECT *, CAST(ts AS DATE) AS snapshot FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "newest_folder": "FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'",
    "table_roundtrip": "FROM st_rolled",
    "trip_credits": "FROM st_credits_2023",
    "trip_demo_join": "FROM st_demo_2023",
    "promotions_year": "FROM st_promos_2023",
    "trip_promo_fanout": "FROM st_fanout",
    "trip_promo_ranges": """SELECT guest_id, player_id, trip_id, trip_start, trip_end, credits, lodging, calendar_year,
        min(changed_at) AS first_promoted_at, max(changed_at) AS last_promoted_at, count(changed_at) AS later_promotions
      FROM st_fanout GROUP BY ALL""",
    "trip_promo_disjoint": "FROM st_disjoint",
    "customer_history": "FROM st_periods",
    "train_rollup": "FROM st_rollup",
    "reason_labels": "FROM st_labelled_hist",
    "set_tier": """SELECT loyalty_id AS player_id, created_at FROM fx_activity
      WHERE activity_type = 'Set Tier' AND year(created_at) = 2023""",
    "natural_promotions": "FROM st_natural",
    "natural_promotions_hist": "FROM st_natural_hist",
    "hist_success": "FROM st_success",
    "hist_unsuccess": "FROM st_unsuccess",
    "hist_combined": "FROM st_combined",
    "special_only_guests": "FROM st_hist_special",
    "trip_sequence": "FROM st_numbered",
    "first_trip_features": "FROM st_first",
    "second_trip_features": "FROM st_second",
    "first_trip_label": _LABEL_JOIN.format(features="st_first", used=1),
    "second_trip_label": _LABEL_JOIN.format(features="st_second", used=2),
    "trip_labels": "FROM st_trip_labels",
    "daily_credits": "FROM st_daily",
    "daily_running": "FROM st_running",
    "day_population": "FROM st_population",
    "day_in_trip": "FROM st_day_in_trip",
    "promo_intervals": "FROM st_day_intervals",
    "day_labels": "FROM st_day_labels",
    "day_features": "FROM st_day_features",
    "day_features_new": "FROM st_day_features_new",
    "lodging_running_share": shares("st_day_labels"),
    "drop_inconsistent": """FROM st_day_features WHERE guest_id NOT IN (
        SELECT guest_id FROM st_day_features WHERE running_credits > target_credits
          AND (day <> changed_on OR changed_on IS NULL))""",
    "train_rows": f"FROM st_day_labels WHERE {NO_PROMOTION_DAY}",
    "active_recent6": """SELECT *, row_number() OVER (PARTITION BY guest_id ORDER BY days_left)
        AS recency FROM st_running WHERE guest_id IN (
          SELECT guest_id FROM st_running WHERE day = DATE '2024-01-19') QUALIFY recency <= 6""",
    "active_by_date": "SELECT day, count(*) AS rows FROM st_running GROUP BY day",
    "active_by_lodging": """SELECT lodging_code, count(*) AS rows FROM st_day_labels
      GROUP BY lodging_code""",
    "inference_returning": "FROM ci_rows",
    "inference_new": shares("ni_rows"),
    "seq_trailing6": f"""SELECT guest_id, day, days_left, label,
        array_to_string(list(step) OVER ({_LAST6}), ';') AS steps,
        count(*) OVER ({_LAST6}) AS length FROM st_steps
      QUALIFY days_left BETWEEN 1 AND 365""",
    "seq_chunks6": "FROM st_chunks",
    "seq_padded": """SELECT * REPLACE (steps || repeat(';-100,-100,-100,-100', 6 - length)
        AS steps) FROM st_chunks""",
    "seq_trailing6_overlap": f"""SELECT guest_id, day, days_left, label,
        array_to_string(list(step) OVER w, ';') AS steps, count(*) OVER w AS length
      FROM st_overlap_rows
      WINDOW w AS (PARTITION BY guest_id ORDER BY {ROW_ORDER}
        ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
      QUALIFY days_left BETWEEN 1 AND 365 AND row_number() OVER (
        PARTITION BY guest_id, day ORDER BY trip_day, trip_length DESC, lodging_code DESC,
          trip_tier DESC, changed_on DESC NULLS FIRST) = 1""",
    "minmax_scale": "FROM st_scaled",
    "scaler_reload": "FROM st_scaled",
    "scaler_apply_other": _scaled_by("day < DATE '2024-01-16'", "day >= DATE '2024-01-16'"),
    "negative_downsample": f"""FROM st_scored_rows WHERE guest_id NOT IN (
        SELECT guest_id FROM st_scored_rows GROUP BY guest_id
        HAVING sum(label) = 0 AND {bucket('guest_id', '269')} < 700)""",
    "class_balance": f"""SELECT * FROM (
        SELECT *, count(*) OVER (PARTITION BY label) AS n,
          least(count(*) FILTER (label = 1) OVER (), count(*) FILTER (label = 0) OVER ()) AS small
        FROM st_trainable) WHERE {bucket('guest_id', 'balance')} * n < 1000 * small""",
    "category_index": """SELECT location, count(*) AS rows,
        row_number() OVER (ORDER BY count(*) DESC, location) - 1 AS idx
      FROM fx_demo WHERE location IS NOT NULL GROUP BY location""",
    "guest_split": f"""SELECT DISTINCT guest_id,
        CASE WHEN {bucket('guest_id', 'split')} < 800 THEN 'train' ELSE 'test' END AS side
      FROM st_running""",
    "feature_profile": _PROFILE,
    "location_onehot": f"""SELECT guest_id,
        CASE WHEN success_trips IS NULL THEN 0 WHEN success_trips BETWEEN 3 AND 5 THEN 1
          WHEN success_trips BETWEEN 6 AND 11 THEN 2 WHEN success_trips BETWEEN 12 AND 26 THEN 3
          ELSE 4 END AS label,
        concat_ws(',', {', '.join(
            "array_to_string([CASE WHEN i = l.idx THEN 10000 ELSE 0 END "
            "FOR i IN range(l.n - 1)], ',')" if c is None else
            "CAST(g.idx * 10000 AS BIGINT)" if c == "gender_index" else
            f"CAST(round(CAST(f.{c} AS DOUBLE) * 10000) AS BIGINT)" for c in _ENCODED)}) AS vector
      FROM st_trainable f JOIN {_index('location')} l USING (location)
      JOIN {_index('gender')} g USING (gender)""",
    "score_sequences": f"""SELECT guest_id, day, days_left, count(*) OVER last6 AS length,
        1.0::DOUBLE / (1.0::DOUBLE + exp(-({_MEANS} + {BIAS}::DOUBLE))) AS score
      FROM st_scaled WINDOW last6 AS ({_LAST6})""",
    "score_flag": "SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS flag FROM st_scores",
    "roc_points": """SELECT *, CAST(tp AS DOUBLE) / CAST(nullif(positives, 0) AS DOUBLE) AS tpr,
        CAST(fp AS DOUBLE) / CAST(nullif(negatives, 0) AS DOUBLE) AS fpr
      FROM (SELECT point, threshold, tp, fp, positives, negatives FROM st_curve
            UNION ALL SELECT 0, 'infinity'::DOUBLE, 0, 0, 1, 1)""",
    "roc_points_sparse": """SELECT * FROM st_sparse
      UNION ALL SELECT 0, 'infinity'::DOUBLE, 0, 0, 0.0::DOUBLE, 0.0::DOUBLE""",
    "roc_first_below_half": """FROM st_sparse WHERE point = (
        SELECT min(point) FROM st_sparse WHERE threshold < 0.5)""",
    "auc": """SELECT max(p) AS positives, max(n) AS negatives,
        CAST(sum(won) AS DOUBLE) / nullif(2.0::DOUBLE * max(p) * max(n), 0) AS auc
      FROM (SELECT sum(a.pos * CASE WHEN a.threshold > b.threshold THEN 2 * b.neg
              WHEN a.threshold = b.threshold THEN b.neg ELSE 0 END) AS won,
            max(a.positives) AS p, max(a.negatives) AS n FROM st_curve a, st_curve b)""",
    "threshold_metrics": " UNION ALL ".join(_metrics(t) for t in (0.15, 0.3, 0.35, 0.5)),
    "score_counts": """SELECT *, count(*) OVER (PARTITION BY guest_id) AS guest_scores
      FROM st_scores""",
    "fp_rows": "FROM st_fp",
    "fp_profile": "FROM st_fp_profile",
    "fp_winloss": """SELECT f.*, t.trip_start, t.trip_end, t.win_loss
      FROM st_fp_profile f JOIN (
        SELECT guest_id, trip_start, trip_end, sum(net_gaming_revenue) AS win_loss
        FROM fx_visits GROUP BY ALL) t
        ON f.guest_id = t.guest_id AND f.day >= t.trip_start AND f.day <= t.trip_end""",
    "fp_by_game": """SELECT game, count(*) AS guests FROM (
        SELECT guest_id, max(game_type) AS game FROM st_fp_profile GROUP BY guest_id)
      GROUP BY game""",
    "linked_accounts": """SELECT account_id, count(*) AS guests FROM (
        SELECT DISTINCT 'A' || (c_custkey // 3) AS account_id, c_custkey, c_acctbal
        FROM customer JOIN st_running ON c_custkey = guest_id) GROUP BY account_id""",
}


def scaled_rows(source, names, fitted=None):
    """Rows with every feature scaled by its range over all of them, or over the rows ``fitted``;
    a constant one is one half."""
    bounds = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}"
                       for c in names)
    cells = ", ".join(f"CASE WHEN hi_{c} = lo_{c} THEN 0.5 ELSE (CAST({c} AS DOUBLE) - lo_{c}) "
                      f"/ (hi_{c} - lo_{c}) END AS {c}_scaled" for c in names)
    return f"SELECT r.*, {cells} FROM {source} r, (SELECT {bounds} FROM {fitted or source})"


def mean_logit(names, over=""):
    return " + ".join(f"({w}::DOUBLE * avg({c}_scaled){over})"
                      for w, c in zip(model_weights(names), names)) + f" + {MODEL_BIAS}::DOUBLE"


def scored_active(source, scaled, names):
    """Yesterday's guests by the mean of their latest six rows."""
    return " UNION ALL ".join(f"""SELECT guest_id, DATE '{when}' - 1 AS day,
        min(days_left) AS days_left, count(*) AS length, DATE '{when}' AS as_of,
        1.0::DOUBLE / (1.0::DOUBLE + exp(-({mean_logit(names)}))) AS score
      FROM (SELECT * FROM {scaled} WHERE day < DATE '{when}' AND guest_id IN (
          SELECT guest_id FROM {source} WHERE day = DATE '{when}' - 1)
        QUALIFY row_number() OVER (PARTITION BY guest_id ORDER BY days_left, trip_day,
          trip_length DESC, lodging_code DESC NULLS LAST, trip_tier DESC NULLS LAST) <= 6)
      GROUP BY guest_id""" for when in AS_OF)


LAST_OF_DAY = """row_number() OVER (PARTITION BY guest_id, day ORDER BY trip_day, trip_length DESC,
    lodging_code DESC, trip_tier DESC, changed_on DESC NULLS FIRST) = 1"""
OF_GUEST = f"""PARTITION BY guest_id ORDER BY {ROW_ORDER} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW"""


def training_steps(scaled, names, share):
    step = ", ".join(f"CAST(CAST(round({c}_scaled * 1000000) AS BIGINT) AS VARCHAR)" for c in names)
    pad = ";" + ",".join("0" for _ in names)
    return f"""SELECT * REPLACE (steps || repeat('{pad}', CAST(6 - length AS BIGINT)) AS steps) FROM (
      SELECT guest_id, day, days_left, label, array_to_string(list(step) OVER w, ';') AS steps,
        count(*) OVER w AS length
      FROM (SELECT *, concat_ws(',', {step}) AS step FROM {scaled} WHERE {NO_PROMOTION_DAY}
          AND guest_id NOT IN (SELECT guest_id FROM {scaled} GROUP BY guest_id
            HAVING sum(label) = 0 AND {bucket('guest_id', '269')} < {share}))
      WINDOW w AS ({OF_GUEST}) QUALIFY days_left BETWEEN 1 AND 365 AND {LAST_OF_DAY})"""


def simulated(scaled, names):
    return f"""SELECT *, count(*) OVER (PARTITION BY guest_id) AS guest_scores FROM (
      SELECT guest_id, day, days_left, label, count(*) OVER w AS length,
        round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({mean_logit(names, ' OVER w')}))), 6) AS score
      FROM {scaled} WHERE {NO_PROMOTION_DAY}
      WINDOW w AS ({OF_GUEST}) QUALIFY days_left BETWEEN 1 AND 365 AND {LAST_OF_DAY})"""


CONSISTENT = """SELECT * FROM {rows} WHERE guest_id NOT IN (
    SELECT guest_id FROM {rows} WHERE running_credits > target_credits
      AND (day <> changed_on OR changed_on IS NULL))"""


def over(target, source, by, prefix):
    """The expression ``target`` and all below it that read ``source``, under names of their own,
    with ``by`` in its place."""
    def below(name):
        return {n for n in re.findall(NAMES, CTES[name]) if n in CTES and n != name}

    found: dict[str, bool] = {}

    def reads(name):
        if name not in found:
            found[name] = name == source or any([reads(n) for n in below(name)])
        return found[name]

    reads(target)
    new = {n: prefix + n.split("_", 1)[1] for n, yes in found.items() if yes and n != source} | {source: by}
    return {new[n]: re.sub(NAMES, lambda m: new.get(m[0], m[0]), CTES[n]) for n in new if n != source}


CTES |= {
    "st_model": CONSISTENT.format(rows="st_day_features"),
    "st_model_new": CONSISTENT.format(rows="st_day_features_new"),
    "ni_shared": shares("ni_rows"),
    # whole runs: a wider cohort, trained on its own trips
    "wi_dominant": CTES["st_dominant"].replace("* 0.5", "* 0.1"),
    "wi_cohort": "SELECT * FROM st_rolled WHERE guest_id IN (FROM st_returning) AND guest_id IN (FROM wi_dominant)",
}
CTES |= over("ci_rows", "st_dominant", "wi_dominant", "wi_")
CTES |= over("st_model", "st_rolled", "wi_cohort", "wr_")
CTES |= over("st_model_new", "st_rolled", "st_new_cohort", "wn_")
CTES |= {
    "wr_scaled": scaled_rows("wr_model", RETURNING_FEATURES),
    "wn_scaled": scaled_rows("wn_model_new", NEW_GUEST_FEATURES),
    "ci_scaled": scaled_rows("wi_rows", RETURNING_FEATURES, "wr_model"),
    "ni_scaled": scaled_rows("ni_shared", NEW_GUEST_FEATURES, "wn_model_new"),
    "ci_active": scored_active("wi_rows", "ci_scaled", RETURNING_FEATURES),
    "ni_active": scored_active("ni_shared", "ni_scaled", NEW_GUEST_FEATURES),
    "st_model_scaled": scaled_rows("st_model", RETURNING_FEATURES),
    "st_model_new_scaled": scaled_rows("st_model_new", NEW_GUEST_FEATURES),
    "st_simulated": simulated("st_model_scaled", RETURNING_FEATURES),
    "st_simulated_new": simulated("st_model_new_scaled", NEW_GUEST_FEATURES),
    "st_fp_model": f"""SELECT r.*, s.score, s.length, s.guest_scores
      FROM (SELECT * FROM st_model_new WHERE {NO_PROMOTION_DAY}) r
      JOIN st_simulated_new s ON r.guest_id = s.guest_id AND r.days_left = s.days_left
      WHERE r.guest_id NOT IN (SELECT guest_id FROM st_model_new WHERE label = 1 AND {NO_PROMOTION_DAY})
        AND r.guest_id IN (SELECT guest_id FROM st_simulated_new WHERE score > 0.4)""",
    "st_sim_curve": CTES["st_curve"].replace("st_scores", "st_simulated_new"),
    "st_sim_sparse": CTES["st_sparse"].replace("st_curve", "st_sim_curve"),
}
BODIES |= {
    "score_active_returning": "SELECT *, CASE WHEN score >= 0.4 THEN 1 ELSE 0 END AS flag FROM ci_active",
    "score_active_new": "SELECT *, CASE WHEN score >= 0.4 THEN 1 ELSE 0 END AS flag FROM ni_active",
    "scored_run_log": " UNION ALL ".join(
        f"SELECT 'scores' AS step, CAST(max(day) AS TIMESTAMP) AS latest, count(*) AS row_count "
        f"FROM {source} WHERE as_of = DATE '{when}'"
        for source in ("ci_active", "ni_active") for when in AS_OF),
    "cohort_sequences_returning": training_steps("wr_scaled", RETURNING_FEATURES, 700),
    "cohort_sequences_new": training_steps("wn_scaled", NEW_GUEST_FEATURES, 500),
    "train_sequences_returning": training_steps("st_model_scaled", RETURNING_FEATURES, 700),
    "train_sequences_new": training_steps("st_model_new_scaled", NEW_GUEST_FEATURES, 500),
    "train_score": f"""SELECT s.* REPLACE (steps || repeat(';0,0,0,0', CAST(6 - length AS BIGINT)) AS steps),
        CASE WHEN label = 1 THEN 40 ELSE 1 END AS weight, 1 AS probability,
        CASE WHEN {bucket('guest_id', 'split')} < 800 THEN 'train' ELSE 'test' END AS side
      FROM (SELECT guest_id, day, days_left, label, array_to_string(list(step) OVER ({_LAST6}), ';') AS steps,
          count(*) OVER ({_LAST6}) AS length
        FROM (SELECT c.*, s.label, concat_ws(',', {', '.join(
            f"CAST(CAST(round({c}_scaled * 1000000) AS BIGINT) AS VARCHAR)" for c in EVENT_FEATURES)}) AS step
          FROM st_scaled c JOIN st_scores s USING (guest_id, day))) s""",
    "train_optimality": "SELECT i AS coefficient, 1 AS optimal FROM range(-1, 24) t(i)",
    "fp_model_rows": "FROM st_fp_model",
    "fp_model_by_lodging": "SELECT lodging_code, count(*) AS rows FROM st_fp_model GROUP BY lodging_code",
    "simulate_scores": "FROM st_simulated",
    "simulate_scores_new": "FROM st_simulated_new",
    "simulate_roc": BODIES["roc_points_sparse"].replace("st_sparse", "st_sim_sparse"),
    "simulate_auc": BODIES["auc"].replace("st_curve", "st_sim_curve"),
    "simulate_thresholds": " UNION ALL ".join(
        _metrics(t).replace("st_scores", "st_simulated_new") for t in (0.3, 0.35, 0.4)),
}


def with_ctes(body: str) -> str:
    """The body behind every expression it needs, in order of dependence."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(NAMES, text):
            if name in CTES and name not in ordered:
                need(CTES[name])
                ordered.append(name)

    need(body)
    head = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered)
    return f"WITH {head}\n{body}" if head else body


def statements() -> dict[str, str]:
    return {name: with_ctes(shape_sql(body, SPECS[name])) for name, body in BODIES.items()}
