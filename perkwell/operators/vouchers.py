"""Voucher reports, values and jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.functions.columns import MONEY, cents, joined_text, live_at, moment, strict_least
from perkwell.functions.joins import dealt_join
from perkwell.operators.audit import activity_rows
from perkwell.operators.audit_trail import CHECK_VIOLATED, NO_DATA, NO_PARENT, Rung, event, ladder_events, trail
from perkwell.operators.integrity import assign_keys
from perkwell.operators.ordering import PLACE, place_in_order
from perkwell.operators.shared_budgets import Budget, found_at_turn, serve_in_order
from perkwell.sources.checkpoints import cut, written

VOUCHER_TYPES = ("AUTO", "BIRTHDAY", "ALL")
# Code letters, one per hex digit of a digest.
CODE_LETTERS = "ABCDEFGHJKLMNPQR"
# Why a redemption may be refused.
REFUSALS = (
    "VOUCHER_NOT_FOUND", "ORDER_NOT_FOUND", "CUSTOMER_NOT_FOUND", "ORDER_NOT_OWNED", "MIN_SPEND_NOT_MET", "INSUFFICIENT_POINTS",
    "INVALID_POINTS", "DISCOUNT_ABOVE_TOTAL", "NOT_LIVE", "TIER_MISMATCH", "NOT_HELD", "ALREADY_USED",
)
# Offers of a chunk, as a power of two: the bits of a long.
CHUNK_BITS = 6
# Pairs of a customer and an offer that are unfolded in one task, about.
PAIRS_TOGETHER = 5_000_000
# Beyond so many tasks of a tier, no more offers are repeated over tasks than so many a customer: else the copies
# would grow with the pairs times the offers.
TASKS_ANYWAY = 64
OFFERS_REPEATED = 16
# Customers that meet a chunk together, about.
PEOPLE_TOGETHER = 256
# Not the text of any tier id.
ANY_TIER = "*"
# Up to this value a discount is a percentage, above it an amount of money.
PERCENT_LIMIT = 100


def _is_birthday() -> Column:
    return F.col("name").startswith("BDAY")


def _is_assignable() -> Column:
    return (F.col("is_auto_assign") == "Y") | _is_birthday()


def assignable_vouchers(promotions: DataFrame, tiers: DataFrame, as_of: datetime) -> DataFrame:
    """Live vouchers that are assigned automatically or on birthdays."""
    kind = (
        F.when(_is_birthday(), "BIRTHDAY").when(F.col("is_auto_assign") == "Y", "AUTO_ASSIGN").otherwise("MANUAL")
    )
    tier = tiers.select(
        F.col("tier_id").alias("applicable_tier_id"), F.col("tier_name").alias("applicable_tier"),
        "birthday_bonus_points",
    )
    return (
        promotions.where(_is_assignable() & live_at(as_of))
        .join(tier, "applicable_tier_id", "left")
        .select(
            "promotion_id", "name", "voucher_code", kind.alias("assignment_type"), "valid_from", "valid_to",
            "applicable_tier", "birthday_bonus_points",
        )
        .orderBy("assignment_type", "name", "promotion_id")
    )


def voucher_assignment_status(promotions: DataFrame, holdings: DataFrame) -> DataFrame:
    """How often each assignable voucher was given and used, and when."""
    held = holdings.groupBy("promotion_id").agg(
        F.count("customer_id").alias("assigned_count"),
        F.count(F.when(F.col("is_used") == "Y", 1)).alias("redeemed_count"),
        F.min("date_acquired").alias("first_assignment"),
        F.max("date_acquired").alias("last_assignment"),
    )
    return (
        promotions.where(_is_assignable())
        .select(
            "promotion_id", "name", "voucher_code",
            F.when(_is_birthday(), "BIRTHDAY").otherwise("AUTO_ASSIGN").alias("voucher_type"),
        )
        .join(held, "promotion_id", "left")
        .fillna(0, ["assigned_count", "redeemed_count"])
        .orderBy("name", "promotion_id")
    )


def active_promo_assigned_count(promotions: DataFrame, holdings: DataFrame, as_of: datetime) -> DataFrame:
    """Holders per live automatic promotion, zero included."""
    held = holdings.groupBy("promotion_id").agg(F.count("customer_id").alias("assigned_count"))
    return (
        promotions.where((F.col("is_auto_assign") == "Y") & live_at(as_of))
        .select("promotion_id", "name")
        .join(held, "promotion_id", "left")
        .fillna(0, "assigned_count")
    )


def used_promotions(holdings: DataFrame) -> DataFrame:
    return holdings.where(F.col("is_used") == "Y")


def holdings_by_tier_count(holdings: DataFrame, customers: DataFrame) -> DataFrame:
    """Number of vouchers held per customer tier."""
    per_customer = holdings.groupBy("customer_id").agg(F.count("*").alias("held"))
    return (
        per_customer.join(customers.select("customer_id", "tier_id"), "customer_id")
        .groupBy("tier_id").agg(F.sum("held").alias("holdings"))
    )


def _code(prefix: str, letters: int, seed: str, row_id: str, attempt: int) -> Column:
    digests = [
        F.md5(F.concat_ws("|", F.lit(seed), F.col(row_id), F.lit(attempt), F.lit(part)).cast("binary"))
        for part in range(-(-letters // 32))
    ]
    text = F.translate(F.concat(*digests), "0123456789abcdef", CODE_LETTERS)
    return F.concat(F.lit(prefix), F.substring(text, 1, letters))


def _handed_out(waiting: DataFrame, used: DataFrame, prefix: str, letters: int, row_id: str) -> DataFrame:
    """Free codes in order, one per id in order. The list is at most twice as long as used codes and ids together."""
    digit = [
        F.substring(F.lit(CODE_LETTERS), ((F.col("id") / len(CODE_LETTERS)**k).cast("long") % len(CODE_LETTERS) + 1).cast("int"), F.lit(1))
        for k in range(letters)
    ]
    every = waiting.sparkSession.range(len(CODE_LETTERS) ** letters).select(
        F.concat(F.lit(prefix), *reversed(digit)).alias("voucher_code")
    )
    free = assign_keys(every.join(used, "voucher_code", "left_anti"), ["voucher_code"], "_rank", 0)
    return assign_keys(waiting, [row_id], "_rank", 0).join(free, "_rank").select(row_id, "voucher_code")


def voucher_codes(
    ids: DataFrame, used_codes: DataFrame, prefix: str | None = None, length: int = 12, seed: str = "",
    row_id: str = "id",
) -> DataFrame:
    """One code per id: the upper-case prefix plus letters, at least one of them.

    Codes are a seeded hash of the id, so a rerun gives the same ones. An id whose
    code is in ``used_codes`` or was drawn by a lower id draws again. Where more than
    half of the possible codes would be used, drawing would take long; the free codes
    are then listed and handed out in order instead. It is an error only if there are
    fewer free codes than ids.
    """
    prefix = (prefix or "").upper()
    letters = max(1, length - len(prefix))
    taken = used_codes.select("voucher_code").where(F.col("voucher_code").isNotNull())
    done = None
    waiting = cut(ids.select(row_id))
    possible = len(CODE_LETTERS) ** letters
    fitting = F.col("voucher_code").startswith(prefix) & (F.translate(
        F.substring("voucher_code", len(prefix) + 1, letters + 1), CODE_LETTERS, "0" * len(CODE_LETTERS)
    ) == "0" * letters)
    used = cut(taken.where(fitting).distinct())
    wanted = waiting.count()
    free = possible - used.count()
    if wanted > free:
        raise ValueError("code space is used up; ask for longer codes")
    if 2 * (possible - free + wanted) > possible:
        return _handed_out(waiting, used, prefix, letters, row_id)
    attempt = 0
    while True:
        drawn = waiting.withColumn("voucher_code", _code(prefix, letters, seed, row_id, attempt))
        firsts = drawn.groupBy("voucher_code").agg(F.min(row_id).alias(row_id)).select(row_id, "voucher_code")
        fresh = cut(firsts.join(taken, "voucher_code", "left_anti"))
        done = fresh if done is None else done.unionByName(fresh)
        waiting = cut(waiting.join(fresh, row_id, "left_anti"))
        if waiting.isEmpty():
            return done.select(row_id, "voucher_code")
        taken = taken.unionByName(fresh.select("voucher_code"))
        attempt += 1


def voucher_generation_log(codes: DataFrame, prefix: str | None, length: int, as_of: datetime) -> DataFrame:
    """Audit rows for generated codes."""
    text = joined_text(
        'Generated voucher code "', F.col("voucher_code"), f'" with prefix "{prefix or ""}" and length {length}'
    )
    return activity_rows(codes.select(text.alias("details")), "VOUCHER_GENERATION", as_of)


def discount_on(amount: Column, value: Column) -> Column:
    """A voucher's worth on an amount: a percentage up to the limit, else money, never above the amount."""
    percent = F.round(strict_least(amount * value * F.lit("0.01").cast("decimal(3,2)"), amount), 2)
    return F.when(value <= PERCENT_LIMIT, percent.cast(MONEY)).otherwise(strict_least(value, amount).cast(MONEY))


def _valued(requests: DataFrame, promotions: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Requests of (promotion_id, order_amount, customer_id) with ``voucher_value`` and what the trail needs."""
    live = promotions.where((F.col("promotion_type") == "VOUCHER") & live_at(as_of)).select(
        "promotion_id", F.col("discount_value").alias("_value"), F.col("min_spend").alias("_min_spend"),
        F.col("applicable_tier_id").alias("_tier"), F.lit(True).alias("_live"),
    )
    tier_of = customers.select("customer_id", F.col("tier_id").alias("_customer_tier"), F.lit(True).alias("_known"))
    amount = F.col("order_amount")
    status = (
        F.when(F.col("_live").isNull(), "NOT_FOUND")
        .when(F.col("_min_spend").isNotNull() & (amount < F.col("_min_spend")), "MIN_SPEND")
        .when(F.col("_tier").isNotNull() & F.col("_customer_tier").isNull(), "NO_TIER")
        .when(F.col("_tier").isNotNull() & (F.col("_customer_tier") != F.col("_tier")), "TIER")
        .otherwise("VALUED")
    )
    value = F.when(F.col("_status") == "VALUED", discount_on(amount, F.col("_value"))).otherwise(F.lit(0).cast(MONEY))
    return (
        requests.join(live, "promotion_id", "left").join(tier_of, "customer_id", "left").withColumn("_status", status)
        .select(*requests.columns, value.alias("voucher_value"), "_status", "_value", "_known")
    )


def voucher_value(requests: DataFrame, promotions: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Add ``voucher_value`` to requests of (promotion_id, order_amount, customer_id)."""
    return _valued(requests, promotions, customers, as_of).select(*requests.columns, "voucher_value")


def value_events() -> list[Column]:
    """Audit events of working out a voucher's value; needs the columns of ``_valued``."""
    def step(template: str, when: Column) -> Column:
        return event("VOUCHER_REDEMPTION", "Voucher ID {promotion_id} " + template + " for customer {customer_id}", when)

    status, percent = F.col("_status"), F.col("_value") <= PERCENT_LIMIT
    return [
        event("VOUCHER_REDEMPTION", "Voucher ID {promotion_id} applied for order amount {order_amount}", status != "NOT_FOUND"),
        step("not found or expired", status == "NOT_FOUND"),
        step("not applied due to minimum spend not met", status == "MIN_SPEND"),
        step("not applied due to missing tier", status == "NO_TIER"),
        step("not applied due to tier mismatch", status == "TIER"),
        step("applied with a discount of {_value}%", (status == "VALUED") & percent),
        step("applied with a fixed discount of {_value}", (status == "VALUED") & ~percent),
    ]


def voucher_value_trail(requests: DataFrame, promotions: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """The audit rows of working out values for requests of (request_id, promotion_id, order_amount, customer_id)."""
    valued = _valued(requests, promotions, customers, as_of).where(F.col("_known") | F.col("customer_id").isNull())
    return trail(valued, F.array(*value_events()), as_of)


def with_value_events(requests: DataFrame, promotions: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """``requests`` with ``voucher_value`` and their ``_value_events``."""
    valued = _valued(requests, promotions, customers, as_of)
    return valued.select(*requests.columns, "voucher_value", F.array(*value_events()).alias("_value_events")
    )


def live_offers(promotions: DataFrame, as_of: datetime) -> DataFrame:
    """Live automatic promotions as (tier_id, promotion_id); an open one has no tier."""
    offered = promotions.where((F.col("is_auto_assign") == "Y") & live_at(as_of))
    return offered.select(F.col("applicable_tier_id").alias("tier_id"), "promotion_id")


def offers_not_held(people: DataFrame, tiers: DataFrame, offers: DataFrame, holdings: DataFrame) -> DataFrame:
    """``people`` (customer_id, tier_id, ...) with every offer of their tier, or of any tier, they do not hold yet.

    Offers without a tier are for members of every tier in ``tiers``. Offers are numbered, and 64 of them make a
    chunk with one bit each. What a customer holds becomes a bitmap per chunk. A customer meets the chunks of the own
    tier and the open ones, and only what the bitmap leaves of a chunk is unfolded. So an offer held never becomes a
    row, and what is joined is a 64th of all pairs, however many offers there are.

    The result itself has about as many rows as people times offers. People are therefore dealt over tasks by the
    pairs they will give, not by the few bytes they take. Each task has all offers of its tier, so there are no more
    tasks than keep these copies in proportion to people and offers. People meet a chunk by hundreds: the same few offers then follow
    each other in the result, which a columnar file writes in a small part of the bytes.
    """
    wanted = offers.select(F.coalesce(F.col("tier_id").cast("string"), F.lit(ANY_TIER)).alias("_for"), "promotion_id").distinct()
    numbered = place_in_order(wanted, ["_for", "promotion_id"]).select(
        "_for", "promotion_id", F.shiftright(PLACE, CHUNK_BITS).alias("_chunk"),
        F.col(PLACE).bitwiseAND(2**CHUNK_BITS - 1).cast("int").alias("_bit"),
    )
    # At most 64 offers in a row; those of a tier stand together, so their bits follow each other.
    chunks = numbered.groupBy("_for", "_chunk").agg(
        F.min("_bit").alias("_first"), F.array_sort(F.collect_list(F.struct("_bit", "promotion_id"))).alias("_offers")
    ).withColumn("_offers", F.col("_offers.promotion_id"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    bitmaps = (
        holdings.select("customer_id", "promotion_id").join(numbered.select("promotion_id", "_chunk", "_bit").distinct(), "promotion_id")
        .groupBy("customer_id", "_chunk").agg(F.bit_or(one).alias("_bits"))
        .groupBy("customer_id").agg(F.map_from_entries(F.collect_list(F.struct("_chunk", "_bits"))).alias("_held"))
    )
    known = tiers.select("tier_id", F.lit(ANY_TIER).alias("_any")).distinct()
    asking = cut(people.join(known, "tier_id", "left").join(bitmaps, "customer_id", "left").select(
        *people.columns, "_held", F.explode(F.array_compact(F.array(F.col("tier_id").cast("string"), F.col("_any")))).alias("_for")
    ))
    people_of, offered = F.col("_people"), F.col("_offered")
    parts = F.ceil(F.least(people_of * offered / PAIRS_TOGETHER, people_of * OFFERS_REPEATED / offered + TASKS_ANYWAY))
    shares = written(
        asking.groupBy("_for").agg(F.count("*").alias("_people"))
        .join(numbered.groupBy("_for").agg(F.count("*").alias("_offered")), "_for")
        .select("_for", parts.alias("_parts"), F.ceil(people_of / parts / PEOPLE_TOGETHER).alias("_batches"))
    )
    met = dealt_join(asking, chunks, "_for", shares).withColumn("_one", F.explode("_rows"))
    bits = F.coalesce(F.col("_one._held")[F.col("_chunk")], F.lit(0).cast("long"))
    free = F.filter("_offers", lambda _, k: F.call_function("shiftright", F.col("_bits"), F.col("_first") + k).bitwiseAND(1) == 0)
    # A column of its own: unfolding a plain column is compiled, unfolding a filter is not.
    fresh = met.withColumn("_bits", bits).withColumn("_fresh", F.when(F.col("_bits") == 0, F.col("_offers")).otherwise(free))
    return fresh.select(*[F.col("_one")[c].alias(c) for c in people.columns], F.explode("_fresh").alias("promotion_id"))


def bulk_assign_vouchers(
    customers: DataFrame, tiers: DataFrame, promotions: DataFrame, holdings: DataFrame, as_of: datetime,
    voucher_type: str = "ALL", tier_id: int | None = None,
) -> dict[str, DataFrame]:
    """Give members every live automatic promotion open to their tier that they do not hold yet.

    The ``BIRTHDAY`` type assigns nothing.
    """
    members = customers.where(F.col("is_member") == "Y").select("customer_id", "tier_id")
    if tier_id is not None:
        members = members.where(F.col("tier_id") == tier_id)
    if voucher_type not in ("AUTO", "ALL"):
        members = members.where(F.lit(False))
    fresh = offers_not_held(members, tiers, live_offers(promotions, as_of), holdings)
    new = fresh.select(
        "customer_id", "promotion_id", moment(as_of).alias("date_acquired"), F.lit("N").alias("is_used"),
        F.lit("AUTO_TIER").alias("acquisition_method"),
    )
    report = new.agg(joined_text("Total new assignments: ", F.count("*")).alias("details"))
    return {"customer_promotions": new, "activity": activity_rows(report, "VOUCHER_ASSIGNMENT", as_of)}


def _checked_redemptions(
    requests: DataFrame, promotions: DataFrame, customers: DataFrame, orders: DataFrame,
    holdings: DataFrame | None, as_of: datetime, value_mode: str, strict: bool, owned_only: bool,
) -> DataFrame:
    """Requests with the facts they need, the first check they fail before and after points and room are looked at (NULL if none)."""
    promo = promotions.select(
        "promotion_id", F.lit(True).alias("_promo"), F.col("discount_value").alias("_value"),
        F.col("min_spend").alias("_min_spend"), F.col("points_required").alias("_points"),
        live_at(as_of).alias("_live"), F.col("applicable_tier_id").alias("_tier"),
    )
    order = orders.select(
        "order_id", F.col("customer_id").alias("_owner"), F.col("total_amount").alias("_total"),
        F.coalesce("discount_amount", F.lit(0).cast(MONEY)).alias("_discount"),
    )
    person = customers.select(
        "customer_id", F.lit(True).alias("_known"), F.col("points_balance").alias("_balance"),
        F.col("tier_id").alias("_customer_tier"),
    )
    with_order = F.col("order_id").isNotNull()
    rows = (
        requests.join(promo, "promotion_id", "left").join(order, "order_id", "left")
        .join(person, "customer_id", "left")
    )
    if value_mode == "percent":
        rows = rows.withColumn("_value", discount_on(F.col("_total"), F.col("_value")))
    failure = (
        F.when(F.col("_promo").isNull(), "VOUCHER_NOT_FOUND")
        .when(with_order & F.col("_owner").isNull(), "ORDER_NOT_FOUND")
        .when(F.col("_known").isNull(), "CUSTOMER_NOT_FOUND")
        .when(F.lit(owned_only) & with_order & (F.col("_owner") != F.col("customer_id")), "ORDER_NOT_OWNED")
        .when(with_order & (F.col("_total") < F.col("_min_spend")), "MIN_SPEND_NOT_MET")
        .when(F.col("_balance") < F.col("_points"), "INSUFFICIENT_POINTS")
        .when(F.col("_points") < 0, "INVALID_POINTS")
    )
    late = F.lit(None).cast("string")
    if strict:
        held = holdings.select("customer_id", "promotion_id", F.col("is_used").alias("_used"))
        rows = rows.join(held, ["customer_id", "promotion_id"], "left")
        late = (
            F.when(~F.col("_live"), "NOT_LIVE")
            .when(F.col("_customer_tier") != F.col("_tier"), "TIER_MISMATCH")
            .when(F.col("_used").isNull(), "NOT_HELD")
            .when(F.col("_used") == "Y", "ALREADY_USED")
        )
    return rows.select(
        *requests.columns, failure.alias("_failure"), late.alias("_late"), F.coalesce("_points", F.lit(0)).alias("points_used"),
        F.col("_points").isNotNull().alias("_with_points"), F.col("_known"), F.col("_min_spend"),
        F.coalesce("_balance", F.lit(0)).alias("_balance"), F.col("_value"), F.col("_total"), F.col("_discount"),
        cents(F.coalesce("_value", F.lit(0).cast(MONEY))).cast("long").alias("_value_cents"),
        cents(F.coalesce(F.col("_total") - F.col("_discount"), F.lit(0).cast(MONEY))).cast("long")
        .alias("_room_cents"),
    )


def _decide(passed: DataFrame, once: bool) -> DataFrame:
    """Serve the requests in order: points first, then the room of the order, then the one use of a held voucher.

    A request for more than the whole room of its order has none at any turn, and one for no points on a balance not below 0
    always has them, so neither takes part in the budget. With ``once`` the room is looked at before the use.
    """
    drawing = F.coalesce(F.col("order_id").isNotNull() & (F.col("_value_cents") > 0), F.lit(False))
    too_much = F.lit(not once) & drawing & (F.col("_room_cents") < F.col("_value_cents"))
    asked = passed.withColumns({
        "_points_key": F.when((F.col("points_used") != 0) | (F.col("_balance") < 0), F.col("customer_id")),
        "_room_key": F.when(drawing & ~too_much, F.col("order_id")),
    })
    asked = asked.withColumns({
        "_late_reason": F.when(too_much, "DISCOUNT_ABOVE_TOTAL").otherwise(F.col("_late")),
        "_use_key": F.when(F.lit(once), F.concat_ws(":", "customer_id", "promotion_id")), "_use": F.lit(1),
    })
    budgets = [
        Budget("_points_key", "points_used", "_balance", "INSUFFICIENT_POINTS"),
        Budget("_room_key", "_value_cents", "_room_cents", "DISCOUNT_ABOVE_TOTAL"),
    ]
    if once:
        budgets.append(Budget("_use_key", "_use", "_use", "ALREADY_USED"))
    served = serve_in_order(asked, ["request_id"], budgets, late="_late_reason")
    return served.select(*passed.columns, F.col("reason").alias("_reason"))


def _redeemed(
    requests: DataFrame, promotions: DataFrame, customers: DataFrame, orders: DataFrame, holdings: DataFrame | None,
    as_of: datetime, value_mode: str, strict: bool, owned_only: bool,
) -> DataFrame:
    """All requests with ``status``, ``accepted`` and what the rows to write need, written once."""
    if strict and holdings is None:
        raise ValueError("strict redemption needs the holdings")
    checked = cut(_checked_redemptions(
        requests, promotions, customers, orders, holdings, as_of, value_mode, strict, owned_only
    ))
    decided = _decide(checked.where(F.col("_failure").isNull()), strict)
    failed = checked.where(F.col("_failure").isNotNull()).withColumn("_reason", F.col("_failure"))
    return cut(decided.unionByName(failed).withColumns({
        "accepted": F.col("_reason").isNull(), "status": F.coalesce("_reason", F.lit("REDEEMED")),
    }))


def redeem_vouchers(
    requests: DataFrame, promotions: DataFrame, customers: DataFrame, orders: DataFrame, as_of: datetime,
    holdings: DataFrame | None = None, value_mode: str = "money", strict: bool = False, owned_only: bool = False,
) -> dict[str, DataFrame]:
    """Redeem vouchers for requests of (request_id, customer_id, promotion_id, order_id or NULL).

    Requests are served in the order of ``request_id``, each on the balance and the order room the earlier ones
    left. Several customers may redeem on one order, whoever placed it; ``owned_only`` refuses requests for
    the orders of others. Points are looked at before the order's room. The discount is taken as money even for
    percent vouchers; ``value_mode="percent"`` computes the percentage instead. ``strict`` also checks validity,
    tier, holding and earlier use, in the batch too. ``outcomes`` has one row per request; the other results
    are the rows to write.
    """
    results = _redeemed(requests, promotions, customers, orders, holdings, as_of, value_mode, strict, owned_only)
    done = results.where("accepted")
    now = moment(as_of)
    outcomes = results.select(
        "request_id", "customer_id", "promotion_id", "order_id", "status",
        F.when(F.col("accepted"), F.col("points_used")).alias("points_used"),
    )
    redemptions = done.select(
        "customer_id", "promotion_id", "order_id", "points_used", now.alias("redemption_date"),
        F.lit("COMPLETED").alias("redemption_status"),
    )
    ledger = done.where("_with_points").select(
        "customer_id", (-F.col("points_used")).alias("points_amount"), F.lit("REDEMPTION").alias("transaction_type"),
        now.alias("transaction_date"), F.lit("Voucher redemption").alias("description"),
    )
    totals = (
        done.where(F.col("order_id").isNotNull() & F.col("_value").isNotNull())
        .groupBy("order_id").agg(
            (F.max("_discount") + F.sum("_value")).cast(MONEY).alias("discount_amount"), F.max("_total").alias("_total")
        )
        .select("order_id", "discount_amount", (F.col("_total") - F.col("discount_amount")).cast(MONEY)
                .alias("final_amount"))
    )
    text = F.when(
        F.col("accepted"),
        joined_text("Customer ID ", F.col("customer_id"), " redeemed voucher ID ", F.col("promotion_id")),
    ).otherwise(joined_text("Error during redemption for customer ID ", F.col("customer_id"), ": ", F.col("status")))
    audit = activity_rows(results.select("customer_id", text.alias("details")), "VOUCHER_REDEMPTION", as_of,
                          customer="customer_id")
    return {
        "outcomes": outcomes, "redemptions": redemptions, "point_transactions": ledger, "orders": totals,
        "activity": audit,
    }


def redemption_trail(
    requests: DataFrame, promotions: DataFrame, customers: DataFrame, orders: DataFrame, as_of: datetime,
    holdings: DataFrame | None = None, value_mode: str = "money", strict: bool = False, owned_only: bool = False,
) -> DataFrame:
    """Every audit row of ``redeem_vouchers``, step by step, with the balance that was found when the request had its turn."""
    results = _redeemed(requests, promotions, customers, orders, holdings, as_of, value_mode, strict, owned_only)
    spent = Budget("customer_id", "points_used", "_balance", "INSUFFICIENT_POINTS")
    # Only who was short of points is told the balance, and only who drew points had changed it.
    known = results.where(F.col("_known"))
    lacking = F.col("status") == "INSUFFICIENT_POINTS"
    short = written(known.where(lacking).select("customer_id", F.lit(True).alias("_short")).distinct())
    marked = known.join(short, "customer_id", "left")
    told = F.coalesce(F.col("_short"), F.lit(False)) & (lacking | (F.col("accepted") & (F.col("points_used") != 0)))
    found = found_at_turn(marked.where(told), ["request_id"], spent, F.col("accepted"), "_found").unionByName(
        marked.where(~told).withColumn("_found", F.lit(None).cast("long"))
    )
    # What the caller is told.
    error = (
        F.when(F.col("status") == "MIN_SPEND_NOT_MET", "ORA-20001: Order does not meet minimum spend requirement")
        .when(F.col("status") == "INSUFFICIENT_POINTS", "ORA-20002: Insufficient points for redemption")
        .when((F.col("status") == "VOUCHER_NOT_FOUND") | ((F.col("status") == "ORDER_NOT_FOUND") & F.col("_min_spend").isNotNull()), NO_DATA)
        .when(F.col("status") == "ORDER_NOT_FOUND", NO_PARENT)
        .when(F.col("status").isin("DISCOUNT_ABOVE_TOTAL", "INVALID_POINTS"), CHECK_VIOLATED)
        .otherwise(F.col("status"))
    )

    def step(template: str) -> list[Column]:
        return [event("VOUCHER_REDEMPTION", template)]

    rungs = [
        Rung(["MIN_SPEND_NOT_MET"], failed=step("Order ID {order_id} does not meet the minimum spend requirement")),
        Rung(["INSUFFICIENT_POINTS"], failed=step("Insufficient points for redemption. Needed {points_used}, found {_found}")),
        Rung([s for s in REFUSALS if s not in ("MIN_SPEND_NOT_MET", "INSUFFICIENT_POINTS")]),
    ]
    events = ladder_events(
        rungs, F.col("status"), step("Customer ID {customer_id} redeemed voucher ID {promotion_id}"),
        event("VOUCHER_REDEMPTION", "Error during redemption for customer ID {customer_id}: {_error}"),
    )
    return trail(found.withColumn("_error", error), events, as_of)
