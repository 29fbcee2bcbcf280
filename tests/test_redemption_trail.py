"""The balance found by requests that lack points."""

from datetime import datetime

from perkwell.operators import vouchers


def test_only_customers_short_of_points_are_followed(spark, monkeypatch):
    met = []
    monkeypatch.setattr(vouchers, "found_at_turn", lambda rows, *a, was=vouchers.found_at_turn: met.append(rows.count()) or was(rows, *a))
    promotions = spark.createDataFrame(
        [(1, 5.0, None, 100, None), (2, 5.0, None, None, None)], "promotion_id long, discount_value double, min_spend double, points_required long, applicable_tier_id long",
    ).selectExpr(
        "promotion_id", "CAST(discount_value AS DECIMAL(10,2)) AS discount_value", "CAST(min_spend AS DECIMAL(10,2)) AS min_spend", "points_required",
        "applicable_tier_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS valid_from", "TIMESTAMP_NTZ '2024-12-31 00:00:00' AS valid_to",
    )
    customers = spark.range(1, 41).selectExpr("id AS customer_id", "CASE WHEN id = 1 THEN 250L ELSE 9000L END AS points_balance", "1L AS tier_id")
    orders = spark.range(0).selectExpr("id AS order_id", "id AS customer_id", "CAST(0 AS DECIMAL(10,2)) AS total_amount", "CAST(0 AS DECIMAL(10,2)) AS discount_amount")
    # Four requests of each customer, the second for a voucher without points.
    requests = spark.range(160).selectExpr(
        "id AS request_id", "1 + id % 40 AS customer_id", "IF(id >= 40 AND id < 80, 2L, 1L) AS promotion_id", "CAST(NULL AS LONG) AS order_id")
    rows = vouchers.redemption_trail(requests, promotions, customers, orders, datetime(2024, 1, 20)).collect()
    assert [r.details for r in rows if r.request_id == 120] == [
        "Insufficient points for redemption. Needed 100, found 50",
        "Error during redemption for customer ID 1: ORA-20002: Insufficient points for redemption",
    ]
    assert sum("redeemed" in r.details for r in rows) == 159 and met == [3]
