"""À la carte ordering with voucher redemption: orders, then vouchers, then their effects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from perkwell.functions.columns import MONEY
from perkwell.operators.maintenance import mark_promo_used
from perkwell.operators.meals import create_alacarte_orders
from perkwell.operators.vouchers import redeem_vouchers
from perkwell.plans.points_cascade import inserts_as_changes, points_cascade
from perkwell.sources.checkpoints import cut


def place_alacarte_orders(
    requests: DataFrame, customers: DataFrame, items: DataFrame, promotions: DataFrame, holdings: DataFrame,
    as_of: datetime,
) -> dict[str, DataFrame]:
    """Create the orders and redeem their vouchers, all requests at once.

    A voucher worth more than 0 is redeemed against the new order. When that fails
    the order stays and its discount falls back to 0.
    """
    made = create_alacarte_orders(requests, customers, items, promotions, as_of)
    orders = cut(made["orders"])
    headers = orders.select(
        F.col("request_id").alias("order_id"), "customer_id", "total_amount",
        F.lit(0).cast(MONEY).alias("discount_amount"),
    )
    asked = orders.where("discount_amount > 0").select(
        "request_id", "customer_id", "promotion_id", F.col("request_id").alias("order_id")
    )
    redeemed = redeem_vouchers(asked, promotions, customers, headers, as_of)
    failed = redeemed["outcomes"].where("status <> 'REDEEMED'").select("request_id", F.lit(True).alias("_failed"))
    discount = F.when(F.col("_failed"), F.lit(0).cast(MONEY)).otherwise(F.col("discount_amount"))
    final = (
        orders.join(failed, "request_id", "left")
        .withColumns({
            "discount_amount": discount,
            "final_amount": F.greatest(
                (F.col("total_amount") - discount).cast(MONEY), F.lit(0).cast(MONEY)
            ),
        })
        .drop("_failed")
    )
    return {
        **made, "orders": final, "voucher_outcomes": redeemed["outcomes"], "redemptions": redeemed["redemptions"],
        "point_transactions": redeemed["point_transactions"],
        "customer_promotions": mark_promo_used(redeemed["redemptions"], holdings, as_of),
        "activity": made["activity"].unionByName(redeemed["activity"]),
    }


def place_and_settle(
    requests: DataFrame, customers: DataFrame, items: DataFrame, promotions: DataFrame, holdings: DataFrame, ledger: DataFrame,
    tiers: DataFrame, as_of: datetime,
) -> dict[str, DataFrame]:
    """Orders, their vouchers, and what the points spent on these set off: balances, expiry dates, tiers, history, new vouchers.

    The jobs hand each other change sets. The ledger entries of the redemptions are written once; the upkeep
    reads them as inserts. ``ledger`` is the ledger before the orders.
    """
    placed = place_alacarte_orders(requests, customers, items, promotions, holdings, as_of)
    entries = cut(placed["point_transactions"])
    after = ledger.unionByName(entries, allowMissingColumns=True)
    settled = points_cascade(inserts_as_changes(entries), after, customers, tiers, promotions, holdings, as_of)
    return {
        **placed, "point_transactions": entries, "customers": settled["customers"],
        "membership_history": settled["membership_history"], "new_promotions": settled["customer_promotions"],
    }
