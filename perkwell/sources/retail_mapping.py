"""Loyalty tables derived from an order-and-events retail star schema.

One SELECT text per loyalty table, portable between Spark SQL and DuckDB: the
few spellings that differ (date intervals, timestamp literals) come from a
``Dialect``. Spark reads them through ``RetailLoyalty``; the SQL checks put the
same texts in front of their own queries as common table expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(2024, 1, 20, 10, 30)
# Layout of the source files; stating it spares a footer read per table.
SOURCES = {
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


@dataclass(frozen=True)
class Dialect:
    timestamp: str
    days: str
    hours: str
    one_to_three: str

    def ts(self, text: str) -> str:
        return f"{self.timestamp} '{text}'"

    def add_days(self, ts: str, days: str) -> str:
        return f"({ts} + {self.days.format(n=f'CAST({days} AS INT)')})"

    def add_hours(self, ts: str, hours: str) -> str:
        return f"({ts} + {self.hours.format(n=f'CAST({hours} AS INT)')})"


SPARK = Dialect("TIMESTAMP_NTZ", "make_dt_interval({n})", "make_dt_interval(0, {n})", "explode(array(1L, 2L, 3L))")
DUCKDB = Dialect("TIMESTAMP", "to_days({n})", "to_hours({n})", "unnest([1, 2, 3])")


def loyalty_selects(d: Dialect) -> dict[str, str]:
    """SELECT text per table; ``{name}`` marks a source table."""
    day0 = d.ts("2024-01-20 00:00:00")
    no_time = "CAST(NULL AS TIMESTAMP)" if d is DUCKDB else "CAST(NULL AS TIMESTAMP_NTZ)"
    expiry = (
        f"CASE WHEN c_custkey % 97 <> 0 THEN "
        f"{d.add_hours(d.add_days(day0, '(c_custkey % 121) - 60'), 'c_custkey % 24')} END"
    )
    n_parts = "(SELECT count(*) FROM {part})"
    n_vouchers = "(SELECT count(*) FROM {supplier})"
    n_orders = "(SELECT count(*) FROM {orders})"
    n_events = "(SELECT count(*) FROM {events})"
    asking_customer = "CASE WHEN o_orderkey % 29 = 0 THEN CAST(-1 AS BIGINT) ELSE o_custkey END AS customer_id"
    asked_voucher = f"CAST(1 + o_orderkey % ({n_vouchers} + 2) AS BIGINT)"
    order_total = "CAST(o_totalprice AS DECIMAL(10,2))"
    order_discount = (
        "CAST(CASE WHEN o_orderkey % 4 = 0 "
        f"THEN {order_total} * CAST(0.10 AS DECIMAL(3,2)) ELSE 0 END AS DECIMAL(10,2))"
    )
    ledger_type = (
        "CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'BONUS' "
        "WHEN 'click' THEN 'REDEMPTION' WHEN 'view' THEN 'ADJUSTMENT' ELSE 'EXPIRY' END"
    )
    ledger_expiry = (
        f"CASE WHEN event_type IN ('purchase', 'signup') THEN {d.add_days('ts', '(event_id % 40) - 10')} END"
    )
    item_type = (
        "CASE WHEN p_partkey % 8 = 0 THEN 'SET_MEAL' WHEN p_partkey % 8 = 1 THEN 'SEASONAL' "
        "WHEN p_partkey % 8 <= 4 THEN 'INGREDIENT' ELSE 'A_LA_CARTE' END"
    )
    points = "CAST(floor(value) AS BIGINT)"
    old_tier = "CASE WHEN event_id % 11 <> 0 THEN CAST(1 + event_id % 6 AS BIGINT) END"
    new_tier = "CAST(1 + (event_id * 3) % 5 AS BIGINT)"
    return {
        "membership_tiers": f"""
            SELECT CAST(r_regionkey + 1 AS BIGINT) AS tier_id,
                   CASE r_regionkey WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Gold'
                        WHEN 3 THEN 'Platinum' ELSE 'Diamond' END AS tier_name,
                   CAST(CASE r_regionkey WHEN 0 THEN 0 WHEN 1 THEN 500 WHEN 2 THEN 1500
                        WHEN 3 THEN 3000 ELSE 5000 END AS BIGINT) AS points_required,
                   CAST(5 * (r_regionkey + 1) AS DECIMAL(5,2)) AS discount_percentage,
                   CAST(10 + 5 * r_regionkey AS DECIMAL(10,2)) AS renewal_fee,
                   CAST(50 * (r_regionkey + 1) AS BIGINT) AS birthday_bonus_points,
                   CAST(12 AS BIGINT) AS points_expiry_months,
                   CAST(CASE r_regionkey WHEN 0 THEN 1.0 WHEN 1 THEN 1.2 WHEN 2 THEN 1.5
                        WHEN 3 THEN 2.0 ELSE 2.5 END AS DECIMAL(5,2)) AS base_earn_rate,
                   {no_time} AS created_date
            FROM {{region}}""",
        "customers": f"""
            SELECT c_custkey AS customer_id, c_name AS name,
                   concat('c', c_custkey, '@example.com') AS email,
                   concat('555-', c_custkey) AS phone,
                   CAST(1 + c_custkey % 5 AS BIGINT) AS tier_id,
                   CAST(floor(greatest(c_acctbal, 0)) AS BIGINT) AS points_balance,
                   {no_time} AS last_points_earned_date,
                   {expiry} AS points_expiry_date,
                   {expiry} AS membership_expiry_date,
                   CASE WHEN c_custkey % 10 = 9 THEN 'N' ELSE 'Y' END AS is_member,
                   CASE c_custkey % 13 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'PENDING' ELSE 'ACTIVE' END
                       AS membership_status,
                   {no_time} AS last_visit_date,
                   {d.ts("2020-01-01 00:00:00")} AS join_date,
                   {d.add_days(d.ts("1960-01-01 00:00:00"), "(c_custkey * 37) % 14600")} AS birth_date,
                   CASE WHEN c_custkey % 3 <> 0 THEN {d.add_days(expiry, "-365")} END AS last_renewal_date,
                   CAST(c_custkey % 4 AS BIGINT) AS renewal_count
            FROM {{customer}}""",
        "menu_items": f"""
            SELECT p_partkey AS item_id,
                   {item_type} AS item_type,
                   p_name AS name, p_type AS description,
                   CAST(CASE WHEN {item_type} = 'INGREDIENT' THEN p_retailprice * 0.2
                        ELSE p_retailprice END AS DECIMAL(10,2)) AS base_price,
                   CASE WHEN p_partkey % 11 = 0 THEN 'N' ELSE 'Y' END AS is_active,
                   CASE WHEN {item_type} = 'SEASONAL' THEN {d.add_days(day0, "-100 - p_partkey % 90")} END AS valid_from,
                   CASE WHEN {item_type} = 'SEASONAL' THEN {d.add_days(day0, "p_partkey % 61 - 20")} END AS valid_to,
                   CAST(p_size * 10 AS BIGINT) AS current_stock,
                   CASE WHEN p_partkey % 23 <> 1 THEN CAST(p_size * 20 AS BIGINT) END AS initial_stock
            FROM {{part}}""",
        "set_meal_components": f"""
            SELECT p_partkey AS set_meal_id, p_partkey + k + 1 AS component_id,
                   CAST(1 + k % 2 AS BIGINT) AS quantity
            FROM (SELECT p_partkey, {d.one_to_three} AS k FROM {{part}} WHERE {item_type} = 'SET_MEAL') AS slot
            WHERE k <= CAST(floor(p_partkey / 8) AS BIGINT) % 4""",
        "promotions": f"""
            SELECT s_suppkey + 1 AS promotion_id, 'VOUCHER' AS promotion_type,
                   concat(CASE WHEN s_suppkey % 7 = 0 THEN 'BDAY ' ELSE 'Voucher ' END, s_name) AS name,
                   {d.add_days(day0, "-10")} AS valid_from,
                   {d.add_days(day0, "s_suppkey % 40 - 5")} AS valid_to,
                   CAST(CASE s_suppkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 5 ELSE 150 END
                       AS DECIMAL(10,2)) AS discount_value,
                   CASE WHEN s_suppkey % 9 <> 0 THEN concat('DISC', s_suppkey % 41) END AS voucher_code,
                   CASE WHEN s_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS is_auto_assign,
                   CASE WHEN s_suppkey % 3 = 0 THEN CAST(100 * (1 + s_suppkey % 5) AS BIGINT) END
                       AS points_required,
                   CASE WHEN s_suppkey % 5 = 0 THEN CAST(50000 AS DECIMAL(10,2)) END AS min_spend,
                   CAST(NULL AS BIGINT) AS set_meal_id,
                   CASE WHEN s_suppkey % 6 <> 0 THEN CAST(1 + s_suppkey % 5 AS BIGINT) END AS applicable_tier_id
            FROM {{supplier}}
            UNION ALL
            SELECT 1000000000 + p_partkey, 'SEASONAL', concat('Redeem ', p_name),
                   {d.add_days(day0, "-(p_partkey % 30)")}, {d.add_days(day0, "p_partkey % 45")},
                   CAST(NULL AS DECIMAL(10,2)), CAST(NULL AS STRING), 'N',
                   CAST(100 * (p_partkey % 50) AS BIGINT),
                   CASE WHEN p_partkey % 3 = 0 THEN CAST(950 AS DECIMAL(10,2)) END,
                   p_partkey, CASE WHEN p_partkey % 5 < 2 THEN CAST(1 + p_partkey % 5 * 3 AS BIGINT) END
            FROM {{part}} WHERE {item_type} = 'SEASONAL'
            UNION ALL
            SELECT 2000000000 + p_partkey, 'SET_MEAL', concat('Meal ', p_name),
                   {d.add_days(day0, "-5")}, {d.add_days(day0, "20")},
                   CAST(15 AS DECIMAL(10,2)), CAST(NULL AS STRING), 'N',
                   CAST(NULL AS BIGINT), CAST(NULL AS DECIMAL(10,2)), p_partkey, CAST(NULL AS BIGINT)
            FROM {{part}} WHERE {item_type} = 'SET_MEAL' AND p_size > 25""",
        "orders": f"""
            SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                   {d.add_days("o_orderdate", "8340")} AS order_date,
                   {order_total} AS total_amount, {order_discount} AS discount_amount,
                   CAST({order_total} - {order_discount} AS DECIMAL(10,2)) AS final_amount,
                   CASE o_orderkey % 4 WHEN 0 THEN 'CASH' WHEN 1 THEN 'CARD' WHEN 2 THEN 'ONLINE' END
                       AS payment_method,
                   CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CANCELLED' ELSE 'REFUNDED' END
                       AS status
            FROM {{orders}}""",
        "order_items": """
            SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS item_id,
                   CAST(l_quantity AS BIGINT) AS quantity,
                   CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
                   CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2))
                       AS DECIMAL(10,2)) AS discount_applied
            FROM {lineitem}""",
        "redemptions": f"""
            SELECT o_orderkey AS redemption_id, o_custkey AS customer_id,
                   CASE WHEN seasonal IS NULL THEN CAST(1 + o_orderkey % {n_vouchers} AS BIGINT)
                        ELSE 1000000000 + seasonal END AS promotion_id,
                   o_orderkey AS order_id, CAST(100 * (o_orderkey % 9) AS BIGINT) AS points_used,
                   {d.add_days("o_orderdate", "8340")} AS redemption_date, 'COMPLETED' AS redemption_status,
                   seasonal AS item_id, CAST(NULL AS DECIMAL(10,2)) AS discount_value
            FROM {{orders}} LEFT JOIN (
                SELECT l_orderkey, min(CASE WHEN l_partkey % 8 = 1 THEN l_partkey END) AS seasonal
                FROM {{lineitem}} GROUP BY l_orderkey) AS in_order ON o_orderkey = l_orderkey
            WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
        "customer_promotions": f"""
            SELECT user_id AS customer_id, promotion_id, min(ts) AS date_acquired,
                   CASE WHEN count(CASE WHEN event_type = 'purchase' THEN 1 END) > 0 THEN 'Y' ELSE 'N' END AS is_used,
                   max(CASE WHEN event_type = 'purchase' THEN ts END) AS used_date,
                   CASE promotion_id % 4 WHEN 0 THEN 'AUTO_TIER' WHEN 1 THEN 'POINT_REDEEM'
                        WHEN 2 THEN 'MANUAL' ELSE 'BIRTHDAY' END AS acquisition_method
            FROM (SELECT user_id, ts, event_type, CAST(1 + event_id % {n_vouchers} AS BIGINT) AS promotion_id
                  FROM {{events}}) AS held
            GROUP BY user_id, promotion_id""",
        "point_transactions": f"""
            SELECT event_id AS transaction_id, user_id AS customer_id,
                   CASE WHEN event_type = 'purchase' THEN CAST(event_id % {n_orders} AS BIGINT) END AS order_id,
                   CASE WHEN event_type = 'click' THEN CAST(1 + event_id % ({n_vouchers} + 3) AS BIGINT) END
                       AS promotion_id,
                   CASE WHEN event_type IN ('click', 'error') THEN -{points} ELSE {points} END AS points_amount,
                   {ledger_type} AS transaction_type, ts AS transaction_date,
                   CASE WHEN event_type = 'error'
                        THEN concat('Points expired from transaction ', CAST((event_id * 7) % {n_events} AS BIGINT))
                        ELSE concat('Entry of ', event_type) END AS description,
                   {ledger_expiry} AS expiry_date
            FROM {{events}}""",
        "membership_history": f"""
            SELECT event_id AS history_id, user_id AS customer_id, {old_tier} AS old_tier_id,
                   {new_tier} AS new_tier_id, ts AS change_date,
                   CASE WHEN {old_tier} IS NULL THEN 'SIGNUP' WHEN {new_tier} > {old_tier} THEN 'UPGRADE'
                        WHEN {new_tier} < {old_tier} THEN 'DOWNGRADE' ELSE 'ADMIN' END AS change_reason,
                   'SYSTEM' AS changed_by
            FROM {{events}} WHERE event_type IN ('signup', 'view')""",
        "customer_activity": """
            SELECT event_id AS activity_id, user_id AS customer_id,
                   CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'purchase' THEN 'ORDER'
                        WHEN 'click' THEN 'VOUCHER_REDEMPTION' WHEN 'view' THEN 'TIER_CHANGE'
                        ELSE 'EXPIRATION' END AS activity_type,
                   ts AS activity_date, CAST(NULL AS STRING) AS ip_address,
                   concat('Event ', event_id) AS details
            FROM {events}""",
        # Request tables: one row per call of the former one-at-a-time functions.
        "seasonal_checks": f"""
            SELECT o_orderkey AS request_id, {asking_customer},
                   CAST(8 * (o_orderkey % CAST(floor({n_parts} / 8) AS BIGINT)) + 1 AS BIGINT) AS item_id,
                   CAST(900 + o_orderkey % 200 AS DECIMAL(10,2)) AS item_price
            FROM {{orders}}""",
        "demand_requests": """
            SELECT p_partkey AS item_id, CAST(p_partkey % 45 AS BIGINT) AS days_remaining FROM {part}""",
        "voucher_checks": f"""
            SELECT o_orderkey AS request_id, {asked_voucher} AS promotion_id, {order_total} AS order_amount,
                   {asking_customer}
            FROM {{orders}}""",
        "meal_price_requests": f"""
            SELECT o_orderkey AS request_id,
                   CAST(8 * (o_orderkey % CAST(floor({n_parts} / 8) + 1 AS BIGINT)) AS BIGINT) AS item_id,
                   {asking_customer}, o_orderkey % 3 <> 0 AS apply_tier_discount
            FROM {{orders}}""",
        "seasonal_redeem_requests": f"""
            SELECT o_orderkey AS request_id, {asking_customer},
                   CASE WHEN seasonal IS NULL OR o_orderkey % 37 = 0
                        THEN CAST(o_orderkey % {n_parts} AS BIGINT) ELSE seasonal END AS item_id,
                   CASE WHEN o_orderkey % 31 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS order_id
            FROM {{orders}} LEFT JOIN (
                SELECT l_orderkey, min(CASE WHEN l_partkey % 8 = 1 THEN l_partkey END) AS seasonal
                FROM {{lineitem}} GROUP BY l_orderkey) AS in_order ON o_orderkey = l_orderkey""",
        "voucher_redeem_requests": f"""
            SELECT o_orderkey AS request_id, {asking_customer}, {asked_voucher} AS promotion_id,
                   CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS order_id
            FROM {{orders}}""",
        # Four customers at a time redeem on one order.
        "shared_redeem_requests": f"""
            SELECT o_orderkey AS request_id, {asking_customer}, {asked_voucher} AS promotion_id,
                   CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey - o_orderkey % 4 END AS order_id
            FROM {{orders}}""",
        "alacarte_requests": f"""
            SELECT o_orderkey AS request_id, {asking_customer},
                   CASE WHEN o_orderkey % 101 = 0 THEN concat(o_orderkey, ',abc')
                        ELSE concat((o_orderkey * 7) % {n_parts}, ', ', (o_orderkey * 11) % {n_parts}, ',,',
                                    (o_orderkey * 13) % ({n_parts} + 50)) END AS item_ids,
                   CASE WHEN o_orderkey % 43 = 0 THEN 'BITCOIN' WHEN o_orderkey % 41 <> 0 THEN 'CARD' END AS payment_method,
                   CASE WHEN o_orderkey % 2 = 0 THEN {asked_voucher} END AS promotion_id
            FROM {{orders}}""",
        "setmeal_requests": f"""
            SELECT o_orderkey AS request_id, {asking_customer},
                   CAST(8 * (o_orderkey % CAST(floor({n_parts} / 8) AS BIGINT)) + CASE WHEN o_orderkey % 19 = 0
                        THEN 1 ELSE 0 END AS BIGINT) AS item_id,
                   CASE WHEN o_orderkey % 47 = 0 THEN 'CHEQUE' WHEN o_orderkey % 41 <> 0 THEN 'ONLINE' END AS payment_method,
                   CASE WHEN o_orderkey % 2 = 1 THEN {asked_voucher} END AS promotion_id
            FROM {{orders}}""",
        # Change sets: what a statement on the ledger or on the order lines touched.
        "ledger_changes": f"""
            SELECT event_id AS change_id,
                   CASE event_id % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'U' ELSE 'D' END AS op,
                   CASE WHEN event_id % 3 <> 2 THEN user_id END AS new_customer_id,
                   CASE WHEN event_id % 3 <> 2 THEN {points} END AS new_points_amount,
                   CASE WHEN event_id % 3 <> 2 THEN {ledger_type} END AS new_transaction_type,
                   CASE WHEN event_id % 3 <> 2 THEN {ledger_expiry} END AS new_expiry_date,
                   CASE WHEN event_id % 3 <> 0 THEN user_id + event_id % 2 END AS old_customer_id,
                   CASE WHEN event_id % 3 <> 0 THEN CAST(floor(value / 2) AS BIGINT) END AS old_points_amount,
                   CASE WHEN event_id % 3 <> 0 THEN {ledger_type} END AS old_transaction_type,
                   CASE WHEN event_id % 3 <> 0 THEN {ledger_expiry} END AS old_expiry_date
            FROM {{events}}""",
        "order_item_changes": """
            SELECT CASE l_linestatus WHEN 'O' THEN 'I' ELSE 'D' END AS op,
                   CASE WHEN l_linestatus = 'O' THEN l_orderkey END AS new_order_id,
                   CASE WHEN l_linestatus <> 'O' THEN l_orderkey END AS old_order_id
            FROM {lineitem} WHERE l_returnflag = 'R'""",
        # Every line is added; then returned ones are taken back and accepted ones get one piece more.
        "line_changes": """
            SELECT 'I' AS op, CAST(NULL AS BIGINT) AS old_order_id, CAST(NULL AS DECIMAL(10,2)) AS old_price,
                   CAST(NULL AS BIGINT) AS old_quantity, CAST(NULL AS DECIMAL(10,2)) AS old_discount_applied,
                   l_orderkey AS new_order_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS new_price,
                   CAST(l_quantity AS BIGINT) AS new_quantity,
                   CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2))
                       AS new_discount_applied
            FROM {lineitem}
            UNION ALL
            SELECT CASE l_returnflag WHEN 'R' THEN 'D' ELSE 'U' END, l_orderkey, CAST(l_extendedprice AS DECIMAL(10,2)),
                   CAST(l_quantity AS BIGINT),
                   CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)),
                   CASE WHEN l_returnflag = 'A' THEN l_orderkey END,
                   CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(10,2)) END,
                   CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) + 1 END,
                   CASE WHEN l_returnflag = 'A'
                        THEN CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) END
            FROM {lineitem} WHERE l_returnflag IN ('A', 'R')""",
        # Rows as they arrive before cleaning, for the data checks.
        "raw_customers": """
            SELECT c_custkey AS customer_id, CAST(floor(c_acctbal) AS BIGINT) AS points_balance,
                   CASE WHEN c_mktsegment = 'MACHINERY' THEN '?' ELSE 'Y' END AS is_member,
                   'ACTIVE' AS membership_status, c_name AS name,
                   CASE WHEN c_custkey % 50 = 0 THEN repeat('x', 101) ELSE '' END AS email,
                   concat('555-', c_custkey, CASE WHEN c_custkey % 60 = 0 THEN '-555-555-555' ELSE '' END) AS phone
            FROM {customer}""",
        "raw_point_transactions": f"""
            SELECT event_id AS transaction_id, {points} AS points_amount,
                   CASE WHEN event_type = 'view' THEN 'GIFT' ELSE {ledger_type} END AS transaction_type,
                   event_type AS description
            FROM {{events}}""",
    }


_PLACEHOLDER = re.compile(r"\{(\w+)\}")
_COUNT = re.compile(r"\(SELECT count\(\*\) FROM \{(\w+)\}\)")


class RetailLoyalty:
    """Loyalty tables over the parquet files of one directory, built on first use."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}
        self._counts: dict[str, int] = {}

    @cached_property
    def _selects(self) -> dict[str, str]:
        return loyalty_selects(SPARK)

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.schema(SOURCES[name]).parquet(f"{self.directory}/{name}.parquet")
        return self._sources[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._tables:
            text = self._counted(self._selects[name])
            sources = {src: self.source(src) for src in set(_PLACEHOLDER.findall(text))}
            self._tables[name] = self.spark.sql(text, **sources)
        return self._tables[name]

    def _counted(self, text: str) -> str:
        """Put source row counts, read once from the file footers, into the text."""
        def count(match: re.Match) -> str:
            name = match.group(1)
            if name not in self._counts:
                self._counts[name] = self.source(name).count()
            return str(self._counts[name])

        return _COUNT.sub(count, text)

    def stream(self, table: str, source: str) -> DataFrame:
        """A loyalty table over the files of ``source`` as a stream; its other inputs stay batch."""
        files = (
            self.spark.readStream.schema(SOURCES[source]).option("maxFilesPerTrigger", 1)
            .parquet(f"{self.directory}/{source}.parquet*")  # a pattern fits a file as well as a folder
        )
        text = self._counted(self._selects[table])
        others = {src: self.source(src) for src in set(_PLACEHOLDER.findall(text)) if src != source}
        return self.spark.sql(text, **{source: files}, **others)


def duckdb_prelude(query: str) -> str:
    """Put the loyalty tables a DuckDB query names (as ``ly_<table>``) in front of it."""
    selects = loyalty_selects(DUCKDB)
    used = [name for name in selects if re.search(rf"\bly_{name}\b", query)]
    ctes = [f"ly_{name} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), selects[name])})" for name in used]
    body = query.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ", ".join(ctes) + ", " + body[len("WITH RECURSIVE"):]
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[len("WITH "):]
    return "WITH " + ", ".join(ctes) + " " + body
