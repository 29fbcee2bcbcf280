"""The same results in DuckDB SQL, written independently of the operators.

Texts use ``ly_<table>`` for the loyalty tables, ``$now`` for the as-of time and
``$day0`` for its midnight.
"""

from __future__ import annotations

from perkwell.schemas import PRIMARY_KEYS, REFERENCES, RULES, SCHEMAS, TABLES, UNIQUE_COLUMNS
from perkwell.sources.retail_mapping import duckdb_prelude

NOW = "TIMESTAMP '2024-01-20 10:30:00'"
DAY0 = "TIMESTAMP '2024-01-20 00:00:00'"


def _ratio(num: str, den: str, scale: int) -> str:
    """Exact half-up quotient of whole numbers with a positive divisor."""
    n, d, p = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**scale
    return (
        f"CAST((CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * ((2 * abs({n}) * {p} + {d}) // (2 * {d})) AS DOUBLE) / {p}"
    )


def _days(later: str, earlier: str, rounding: str = "floor") -> str:
    return f"CAST({rounding}((epoch_us({later}) - epoch_us({earlier})) / 86400000000) AS BIGINT)"


def _number(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    cut = f"CASE WHEN contains({text}, '.') THEN regexp_replace({text}, '\\.?0+$', '') ELSE {text} END"
    return f"regexp_replace({cut}, '^(-?)0\\.', '\\1.')"


def _cents(value: str) -> str:
    return f"CAST({value} * 100 AS HUGEINT)"


def _plus_months(ts: str, months: int) -> str:
    moved = f"({ts} + INTERVAL {months} MONTH)"
    return (
        f"CASE WHEN CAST({ts} AS DATE) = last_day({ts}) THEN {moved} + "
        f"to_days(CAST(date_diff('day', CAST({moved} AS DATE), last_day({moved})) AS INTEGER)) ELSE {moved} END"
    )


_LIVE = "$now BETWEEN p.valid_from AND p.valid_to"
_NEXT_TIER = "LEFT JOIN ly_membership_tiers n ON n.tier_id = c.tier_id + 1"

# One voucher's value on an amount; needs aliases p (live voucher), c (customer) and the amount text.
def _voucher_value(amount: str) -> str:
    return f"""CAST(CASE WHEN p.promotion_id IS NULL THEN 0
        WHEN p.min_spend IS NOT NULL AND {amount} < p.min_spend THEN 0
        WHEN p.applicable_tier_id IS NOT NULL AND (c.tier_id IS NULL OR c.tier_id <> p.applicable_tier_id) THEN 0
        WHEN p.discount_value <= 100
        THEN round(least({amount} * p.discount_value * CAST(0.01 AS DECIMAL(3,2)), {amount}), 2)
        ELSE least(p.discount_value, {amount}) END AS DECIMAL(10,2))"""


_VOUCHER_JOIN = (
    "LEFT JOIN (SELECT * FROM ly_promotions p WHERE p.promotion_type = 'VOUCHER' AND " + _LIVE + ") p"
    " ON p.promotion_id = r.promotion_id LEFT JOIN ly_customers c ON c.customer_id = r.customer_id"
)

_FIRST_SEASONAL = (
    "(SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY p.set_meal_id ORDER BY p.promotion_id) AS nr"
    " FROM ly_promotions p WHERE p.promotion_type = 'SEASONAL' AND " + _LIVE + ") WHERE nr = 1)"
)

_COMPONENT_COST = """(SELECT k.set_meal_id, sum(m.base_price * k.quantity) AS cost, count(*) AS comps,
    count(CASE WHEN m.is_active = 'Y' THEN 1 END) AS active
    FROM ly_set_meal_components k JOIN ly_menu_items m ON m.item_id = k.component_id GROUP BY k.set_meal_id)"""

_VALIDITY = """CASE WHEN m.item_type IS DISTINCT FROM 'SET_MEAL' OR m.is_active IS DISTINCT FROM 'Y'
    THEN 'INVALID_SETMEAL' WHEN (SELECT count(*) FROM ly_set_meal_components k WHERE k.set_meal_id = m.item_id) = 0
    THEN 'NO_COMPONENTS' WHEN (SELECT count(*) FROM ly_set_meal_components k JOIN ly_menu_items x
        ON x.item_id = k.component_id WHERE k.set_meal_id = m.item_id AND x.is_active = 'Y')
        < (SELECT count(*) FROM ly_set_meal_components k WHERE k.set_meal_id = m.item_id)
    THEN 'INACTIVE_COMPONENTS' ELSE 'VALID' END"""

_SEASONAL_OUTCOME = f"""
    SELECT r.*, CASE WHEN c.customer_id IS NULL THEN 'INVALID_CUSTOMER'
            WHEN m.item_id IS NULL THEN 'INVALID_ITEM'
            WHEN NOT EXISTS (SELECT 1 FROM ly_orders o WHERE o.order_id = r.order_id
                AND o.customer_id = r.customer_id) THEN 'INVALID_ORDER'
            WHEN NOT EXISTS (SELECT 1 FROM ly_order_items l WHERE l.order_id = r.order_id
                AND l.item_id = r.item_id) THEN 'ITEM_NOT_IN_ORDER'
            WHEN p.promotion_id IS NULL THEN 'NO_PROMOTION'
            WHEN c.points_balance < p.points_required THEN 'INSUFFICIENT_POINTS' ELSE 'REDEEMED' END AS status,
        p.promotion_id AS promo, p.points_required AS points, m.base_price AS price
    FROM ly_seasonal_redeem_requests r LEFT JOIN ly_customers c ON c.customer_id = r.customer_id
    LEFT JOIN ly_menu_items m ON m.item_id = r.item_id AND m.item_type = 'SEASONAL'
    LEFT JOIN {_FIRST_SEASONAL} p ON p.set_meal_id = r.item_id"""

_EXPIRY_STEPS = """
    due AS (
        SELECT t.*, c.points_balance, row_number() OVER (PARTITION BY t.customer_id
            ORDER BY t.expiry_date, t.transaction_date, t.transaction_id) AS nr
        FROM ly_point_transactions t JOIN ly_customers c ON c.customer_id = t.customer_id
        WHERE t.expiry_date <= $day0 AND t.points_amount > 0 AND t.transaction_type IN ('PURCHASE', 'BONUS')
          AND c.points_balance >= t.points_amount
          AND t.transaction_id NOT IN (SELECT CAST(regexp_extract(description, 'from transaction (\\d+)', 1) AS BIGINT)
              FROM ly_point_transactions WHERE transaction_type = 'EXPIRY')),
    walk AS (
        SELECT customer_id, CAST(0 AS BIGINT) AS nr, max(points_balance) AS rest, false AS hit,
            CAST(NULL AS BIGINT) AS transaction_id, CAST(0 AS BIGINT) AS points
        FROM due GROUP BY customer_id
        UNION ALL
        SELECT d.customer_id, d.nr, CASE WHEN w.rest >= d.points_amount THEN w.rest - d.points_amount ELSE w.rest END,
            w.rest >= d.points_amount, d.transaction_id, d.points_amount
        FROM walk w JOIN due d ON d.customer_id = w.customer_id AND d.nr = w.nr + 1)"""

_REACHED = "(SELECT max(t.tier_id) FROM ly_membership_tiers t WHERE t.points_required <= c.points_balance)"
_TIER_UPDATES = """(SELECT * FROM (SELECT c.customer_id, c.tier_id AS old_tier_id,
    (SELECT arg_max(t.tier_id, t.points_required) FROM ly_membership_tiers t
        WHERE t.points_required <= c.points_balance) AS new_tier_id FROM ly_customers c)
    WHERE new_tier_id <> old_tier_id)"""
_CHANGE_REASON = """CASE WHEN u.old_tier_id IS NULL THEN 'SIGNUP' WHEN u.new_tier_id > u.old_tier_id THEN 'UPGRADE'
    WHEN u.new_tier_id < u.old_tier_id THEN 'DOWNGRADE' ELSE 'ADMIN' END"""
_POINTS_CHANGE = """(SELECT CASE WHEN op = 'D' THEN old_customer_id ELSE new_customer_id END AS customer_id,
    CAST(sum(CASE op WHEN 'I' THEN new_points_amount WHEN 'U' THEN new_points_amount - coalesce(old_points_amount, 0)
        ELSE -old_points_amount END) AS BIGINT) AS change FROM ly_ledger_changes GROUP BY 1)"""
_REDATED = """(SELECT DISTINCT CASE WHEN op = 'D' THEN old_customer_id ELSE new_customer_id END AS customer_id
    FROM ly_ledger_changes
    WHERE (op IN ('I', 'U') AND new_points_amount > 0 AND new_transaction_type IN ('PURCHASE', 'BONUS')
           AND new_expiry_date IS NOT NULL)
       OR (op IN ('U', 'D') AND old_points_amount > 0 AND old_transaction_type IN ('PURCHASE', 'BONUS')
           AND old_expiry_date IS NOT NULL))"""
_NEXT_EXPIRY = """(SELECT min(t.expiry_date) FROM ly_point_transactions t WHERE t.customer_id = c.customer_id
    AND t.expiry_date > $now AND t.transaction_type IN ('PURCHASE', 'BONUS') AND t.points_amount > 0)"""
_CASCADE = f"""cascade AS (
    SELECT c.customer_id, c.tier_id, c.points_balance AS old_balance, c.points_balance + g.change AS points_balance,
        CASE WHEN d.customer_id IS NOT NULL THEN {_NEXT_EXPIRY} ELSE c.points_expiry_date END AS points_expiry_date,
        (SELECT arg_max(t.tier_id, t.points_required) FROM ly_membership_tiers t
            WHERE t.points_required <= c.points_balance + g.change) AS reached
    FROM ly_customers c JOIN {_POINTS_CHANGE} g ON g.customer_id = c.customer_id
    LEFT JOIN {_REDATED} d ON d.customer_id = c.customer_id)"""

_ALACARTE_PARTS = """
    parts AS (
        SELECT r.request_id, r.customer_id, r.promotion_id, r.payment_method, trim(part) AS part,
               c.is_member IS NOT DISTINCT FROM 'Y' AS member,
               coalesce(payment_method IN ('CASH', 'CARD', 'ONLINE'), true) AS payable
        FROM (SELECT *, unnest(string_split(item_ids, ',')) AS part FROM ly_alacarte_requests) r
        LEFT JOIN ly_customers c ON c.customer_id = r.customer_id),
    judged AS (
        SELECT request_id, customer_id, promotion_id, payment_method, member, payable,
            bool_or(part <> '' AND TRY_CAST(part AS DECIMAL(38,9)) IS NULL) AS bad,
            count(m.item_id) AS items, sum(m.base_price) AS total
        FROM parts LEFT JOIN ly_menu_items m ON m.item_id = TRY_CAST(part AS BIGINT)
            AND m.item_type = 'A_LA_CARTE' AND m.is_active = 'Y'
        GROUP BY request_id, customer_id, promotion_id, payment_method, member, payable)"""
_ALACARTE_ORDERS = f"""(SELECT r.request_id, r.customer_id, r.promotion_id, r.payment_method, r.items,
        CAST(r.total AS DECIMAL(10,2)) AS total,
        CASE WHEN r.promotion_id IS NULL THEN 0 ELSE {_voucher_value("CAST(r.total AS DECIMAL(10,2))")} END AS discount
    FROM (SELECT * FROM judged WHERE member AND payable AND NOT bad AND items > 0) r {_VOUCHER_JOIN})"""

_SETMEAL_JUDGED = """(SELECT r.*, m.item_id AS on_menu,
    CASE WHEN m.item_type = 'SET_MEAL' AND m.is_active = 'Y' THEN m.base_price END AS total,
    CASE WHEN c.customer_id IS NULL THEN 'CUSTOMER_NOT_FOUND' WHEN c.is_member <> 'Y' THEN 'NOT_A_MEMBER'
         WHEN m.item_type = 'SET_MEAL' AND m.is_active = 'Y' THEN CASE WHEN r.payment_method NOT IN ('CASH', 'CARD', 'ONLINE')
             THEN 'PAYMENT_METHOD_REFUSED' ELSE 'CREATED' END ELSE 'SET_MEAL_NOT_AVAILABLE' END AS status
    FROM ly_setmeal_requests r LEFT JOIN ly_customers c ON c.customer_id = r.customer_id
    LEFT JOIN ly_menu_items m ON m.item_id = r.item_id)"""


def _redeem_walk(requests: str, orders: str) -> str:
    """Voucher redemption as a walk over each customer's requests; the order room is a limit of its own."""
    return f"""
    facts AS (
        SELECT r.request_id, r.customer_id, r.promotion_id, r.order_id, p.points_required,
            coalesce(p.points_required, 0) AS points, c.points_balance,
            CASE WHEN p.promotion_id IS NULL THEN 'VOUCHER_NOT_FOUND'
                WHEN r.order_id IS NOT NULL AND o.order_id IS NULL THEN 'ORDER_NOT_FOUND'
                WHEN c.customer_id IS NULL THEN 'CUSTOMER_NOT_FOUND'
                WHEN r.order_id IS NOT NULL AND o.customer_id <> r.customer_id THEN 'ORDER_NOT_OWNED'
                WHEN r.order_id IS NOT NULL AND o.total_amount < p.min_spend THEN 'MIN_SPEND_NOT_MET'
                WHEN c.points_balance < p.points_required THEN 'INSUFFICIENT_POINTS' END AS failure,
            r.order_id IS NOT NULL AND coalesce(o.discount_amount + p.discount_value > o.total_amount, false) AS too_much
        FROM {requests} r LEFT JOIN ly_promotions p ON p.promotion_id = r.promotion_id
        LEFT JOIN {orders} o ON o.order_id = r.order_id LEFT JOIN ly_customers c ON c.customer_id = r.customer_id),
    queue AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY request_id) AS nr
              FROM facts WHERE failure IS NULL),
    walk AS (
        SELECT customer_id, CAST(0 AS BIGINT) AS nr, max(points_balance) AS rest, CAST(NULL AS BIGINT) AS request_id,
            false AS hit, CAST(NULL AS VARCHAR) AS refused FROM queue GROUP BY customer_id
        UNION ALL
        SELECT q.customer_id, q.nr, CASE WHEN w.rest >= q.points AND NOT q.too_much THEN w.rest - q.points ELSE w.rest END,
            q.request_id, w.rest >= q.points AND NOT q.too_much,
            CASE WHEN w.rest < q.points THEN 'INSUFFICIENT_POINTS' WHEN q.too_much THEN 'DISCOUNT_ABOVE_TOTAL' END
        FROM walk w JOIN queue q ON q.customer_id = w.customer_id AND q.nr = w.nr + 1)"""


# À la carte orders with their vouchers, which of these were paid for, and what that did to the customers.
_FLOW = f"""
    made AS (SELECT * FROM {_ALACARTE_ORDERS}),
    asked AS (SELECT request_id, customer_id, promotion_id, request_id AS order_id FROM made WHERE discount > 0),
    heads AS (SELECT request_id AS order_id, customer_id, total AS total_amount, CAST(0 AS DECIMAL(10,2)) AS discount_amount FROM made),
    {_redeem_walk("asked", "heads")},
    paid AS (SELECT w.customer_id, f.promotion_id, f.points_required AS points FROM walk w JOIN facts f ON f.request_id = w.request_id
        WHERE w.hit)"""
_SETTLED = """
    settled AS (
        SELECT c.customer_id, c.tier_id, c.points_balance AS old_balance, c.points_balance - CAST(s.points AS BIGINT) AS points_balance,
            c.points_expiry_date, (SELECT arg_max(t.tier_id, t.points_required) FROM ly_membership_tiers t
                WHERE t.points_required <= c.points_balance - s.points) AS reached
        FROM ly_customers c JOIN (SELECT customer_id, sum(points) AS points FROM paid WHERE points IS NOT NULL GROUP BY customer_id) s
            ON s.customer_id = c.customer_id)"""


# Redemption on orders that several customers share: a request is judged once all earlier ones of its customer and of its order are.
_SHARED_WAVES = """
    asked AS (
        SELECT r.request_id, r.customer_id, r.promotion_id, r.order_id, p.points_required, p.discount_value AS value,
            coalesce(p.points_required, 0) AS points, c.points_balance, o.total_amount - o.discount_amount AS room,
            CASE WHEN p.promotion_id IS NULL THEN 'VOUCHER_NOT_FOUND'
                WHEN r.order_id IS NOT NULL AND o.order_id IS NULL THEN 'ORDER_NOT_FOUND'
                WHEN c.customer_id IS NULL THEN 'CUSTOMER_NOT_FOUND'
                WHEN r.order_id IS NOT NULL AND o.total_amount < p.min_spend THEN 'MIN_SPEND_NOT_MET'
                WHEN c.points_balance < p.points_required THEN 'INSUFFICIENT_POINTS' END AS failure
        FROM ly_shared_redeem_requests r LEFT JOIN ly_promotions p ON p.promotion_id = r.promotion_id
        LEFT JOIN ly_orders o ON o.order_id = r.order_id LEFT JOIN ly_customers c ON c.customer_id = r.customer_id),
    waves AS (
        SELECT 0 AS wave, request_id, customer_id, order_id, points, points_balance, coalesce(value, 0) AS value, room,
            CAST(NULL AS VARCHAR) AS status
        FROM asked WHERE failure IS NULL
        UNION ALL
        SELECT wave + 1, request_id, customer_id, order_id, points, points_balance, value, room,
            CASE WHEN status IS NOT NULL THEN status WHEN before_me > 0 THEN NULL
                WHEN points_balance - spent < points THEN 'INSUFFICIENT_POINTS'
                WHEN order_id IS NOT NULL AND room - taken < value THEN 'DISCOUNT_ABOVE_TOTAL' ELSE 'REDEEMED' END
        FROM (SELECT *, coalesce(sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY request_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                + CASE WHEN order_id IS NULL THEN 0 ELSE coalesce(sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END) OVER (
                    PARTITION BY order_id ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS before_me,
                coalesce(sum(CASE WHEN status = 'REDEEMED' THEN points ELSE 0 END) OVER (PARTITION BY customer_id
                    ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
                coalesce(sum(CASE WHEN status = 'REDEEMED' THEN value ELSE 0 END) OVER (PARTITION BY order_id
                    ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
                sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END) OVER () AS waiting
            FROM waves) WHERE waiting > 0),
    ended AS (SELECT * FROM waves WHERE wave = (SELECT max(wave) FROM waves))"""


# The audit trail, typed out step by step.
_AUDIT_TRAIL = f"""
    {_SHARED_WAVES},
    seasonal AS (
        SELECT o.request_id, o.customer_id, o.item_id AS i, o.order_id AS d, o.status AS s, o.points AS need, c.points_balance AS had,
            array_position(['INVALID_ITEM', 'INVALID_ORDER', 'ITEM_NOT_IN_ORDER', 'NO_PROMOTION', 'INSUFFICIENT_POINTS', 'REDEEMED'],
                o.status) AS n
        FROM ({_SEASONAL_OUTCOME}) o JOIN ly_customers c ON c.customer_id = o.customer_id),
    seasonal_steps AS (
        SELECT request_id, customer_id, 1 AS step, 'Customer ' || customer_id || ' validated for seasonal item redemption' AS details FROM seasonal
        UNION ALL SELECT request_id, customer_id, 2, CASE WHEN n > 1 THEN 'Seasonal menu item ' || i || ' validated for customer ' || customer_id
            ELSE 'Failed redemption attempt - Invalid seasonal menu item ID: ' || i END FROM seasonal
        UNION ALL SELECT request_id, customer_id, 3, CASE WHEN n > 2 THEN 'Order ' || d || ' validated for seasonal item redemption'
            WHEN n = 2 THEN 'Failed redemption attempt - Invalid order ID for customer: ' || d
            ELSE 'Error redeeming seasonal item: ORA-20054: Invalid seasonal menu item ID' END FROM seasonal
        UNION ALL SELECT request_id, customer_id, 4, CASE WHEN n > 3 THEN 'Setmeal ' || i || ' confirmed in order ' || d
            WHEN n = 3 THEN 'Failed redemption attempt - Order does not contain specified setmeal: ' || i
            ELSE 'Error redeeming seasonal item: ORA-20055: Invalid order ID for customer' END FROM seasonal WHERE n > 1
        UNION ALL SELECT request_id, customer_id, 5, CASE WHEN n > 4 THEN 'Valid seasonal promotion found for setmeal ' || i
            WHEN n = 4 THEN 'Failed redemption attempt - No valid seasonal promotion found for setmeal: ' || i
            ELSE 'Error redeeming seasonal item: ORA-20051: Order does not contain the specified setmeal' END FROM seasonal WHERE n > 2
        UNION ALL SELECT request_id, customer_id, 6, CASE WHEN n > 5 THEN 'Customer ' || customer_id
                || ' has sufficient points for redemption (Points balance: ' || had || ')'
            WHEN n = 5 THEN 'Failed redemption attempt - Insufficient points (Balance: ' || had || ', Required: ' || need || ')'
            ELSE 'Error redeeming seasonal item: ORA-20050: No valid seasonal promotion found for this setmeal' END FROM seasonal WHERE n > 3
        UNION ALL SELECT request_id, customer_id, 7, CASE WHEN n > 5 THEN 'Successfully redeemed seasonal item ' || i || ' using '
                || coalesce(CAST(need AS VARCHAR), '') || ' points'
            ELSE 'Error redeeming seasonal item: ORA-20052: Insufficient points balance' END FROM seasonal WHERE n > 4),
    offered AS (
        SELECT r.request_id, c.customer_id, r.promotion_id AS v, r.order_amount AS amount, c.tier_id, p.applicable_tier_id AS tier,
            p.min_spend, p.discount_value AS off, p.promotion_id IS NOT NULL AS live, 'value' AS job, 1 AS base
        FROM ly_voucher_checks r JOIN ly_customers c ON c.customer_id = r.customer_id
        LEFT JOIN (SELECT * FROM ly_promotions p WHERE p.promotion_type = 'VOUCHER' AND {_LIVE}) p ON p.promotion_id = r.promotion_id
        UNION ALL
        SELECT r.request_id, c.customer_id, r.promotion_id, m.base_price, c.tier_id, p.applicable_tier_id, p.min_spend, p.discount_value,
            p.promotion_id IS NOT NULL, 'set meal', 100
        FROM ly_setmeal_requests r JOIN ly_customers c ON c.customer_id = r.customer_id AND c.is_member = 'Y'
        JOIN ly_menu_items m ON m.item_id = r.item_id AND m.item_type = 'SET_MEAL' AND m.is_active = 'Y'
        LEFT JOIN (SELECT * FROM ly_promotions p WHERE p.promotion_type = 'VOUCHER' AND {_LIVE}) p ON p.promotion_id = r.promotion_id
        WHERE r.promotion_id IS NOT NULL),
    value_steps AS (
        SELECT job, request_id, customer_id, base AS place, 'Voucher ID ' || v || CASE
            WHEN live THEN ' applied for order amount ' || {_number("amount")}
            ELSE ' not found or expired for customer ' || customer_id END AS details FROM offered
        UNION ALL SELECT job, request_id, customer_id, base + 1, 'Voucher ID ' || v || CASE
            WHEN amount < min_spend THEN ' not applied due to minimum spend not met'
            WHEN tier IS NOT NULL AND tier_id IS NULL THEN ' not applied due to missing tier'
            WHEN tier <> tier_id THEN ' not applied due to tier mismatch'
            WHEN off <= 100 THEN ' applied with a discount of ' || {_number("off")} || '%'
            ELSE ' applied with a fixed discount of ' || {_number("off")} END || ' for customer ' || customer_id FROM offered WHERE live),
    turns AS (
        SELECT f.*, e.status AS decided, c.points_balance AS had, p.min_spend,
            coalesce(sum(CASE WHEN e.status = 'REDEEMED' THEN f.points ELSE 0 END) OVER (PARTITION BY f.customer_id ORDER BY f.request_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
        FROM asked f JOIN ly_customers c ON c.customer_id = f.customer_id LEFT JOIN ended e ON e.request_id = f.request_id
        LEFT JOIN ly_promotions p ON p.promotion_id = f.promotion_id),
    redemption_steps AS (
        SELECT request_id, customer_id, 1 AS place, CASE coalesce(failure, decided)
            WHEN 'MIN_SPEND_NOT_MET' THEN 'Order ID ' || order_id || ' does not meet the minimum spend requirement'
            WHEN 'INSUFFICIENT_POINTS' THEN 'Insufficient points for redemption. Needed ' || points || ', found ' || (had - gone) END AS details
        FROM turns WHERE coalesce(failure, decided) IN ('MIN_SPEND_NOT_MET', 'INSUFFICIENT_POINTS')
        UNION ALL SELECT request_id, customer_id, 2, CASE coalesce(failure, decided)
            WHEN 'REDEEMED' THEN 'Customer ID ' || customer_id || ' redeemed voucher ID ' || promotion_id
            ELSE 'Error during redemption for customer ID ' || customer_id || ': ' || CASE coalesce(failure, decided)
                WHEN 'MIN_SPEND_NOT_MET' THEN 'ORA-20001: Order does not meet minimum spend requirement'
                WHEN 'INSUFFICIENT_POINTS' THEN 'ORA-20002: Insufficient points for redemption'
                WHEN 'VOUCHER_NOT_FOUND' THEN 'ORA-01403: no data found'
                WHEN 'ORDER_NOT_FOUND' THEN CASE WHEN min_spend IS NOT NULL THEN 'ORA-01403: no data found'
                    ELSE 'ORA-02291: integrity constraint violated - parent key not found' END
                ELSE 'ORA-02290: check constraint violated' END END
        FROM turns),
    meals AS (
        SELECT r.request_id, c.customer_id, r.item_id AS i, r.promotion_id, c.is_member = 'Y' AS member,
            m.item_id IS NOT NULL AS listed, m.item_type = 'SET_MEAL' AND m.is_active = 'Y' AS on_sale, m.base_price,
            coalesce(r.payment_method IN ('CASH', 'CARD', 'ONLINE'), true) AS payable,
            EXISTS (SELECT 1 FROM ly_promotions p WHERE p.promotion_type = 'SET_MEAL' AND {_LIVE} AND p.set_meal_id = r.item_id) AS promoted
        FROM ly_setmeal_requests r JOIN ly_customers c ON c.customer_id = r.customer_id
        LEFT JOIN ly_menu_items m ON m.item_id = r.item_id),
    makers AS (SELECT i, min(request_id) AS maker FROM meals WHERE member AND listed AND NOT promoted GROUP BY i),
    meal_steps AS (
        SELECT request_id, customer_id, 1 AS place, 'ORDER' AS kind, 'Customer ' || customer_id || ' validated for set meal order' AS details
        FROM meals WHERE member
        UNION ALL SELECT m.request_id, m.customer_id, 2, 'VOUCHER_ASSIGNMENT', 'Auto-created promotion for set meal ' || m.i
        FROM meals m JOIN makers k ON k.i = m.i AND k.maker = m.request_id
        UNION ALL SELECT request_id, customer_id, 3, 'ORDER', 'Set meal ' || i || ' validated for customer ' || customer_id
        FROM meals WHERE member AND on_sale
        UNION ALL SELECT request_id, customer_id, place, 'VOUCHER_REDEMPTION', details FROM value_steps WHERE job = 'set meal'
        UNION ALL SELECT m.request_id, m.customer_id, 200, 'ORDER', CASE
            WHEN NOT member THEN 'Failed to create set meal order: ORA-20010: Customer is not a member'
            WHEN NOT listed AND NOT promoted THEN 'Failed to create set meal order: ORA-02291: integrity constraint violated - parent key not found'
            WHEN NOT coalesce(on_sale, false) THEN 'Failed to create set meal order: ORA-20020: Set meal not available'
            WHEN NOT payable THEN 'Failed to create set meal order: ORA-02290: check constraint violated'
            ELSE 'Created SET_MEAL order #' || m.request_id || ' with item ' || i || ' base price=' || {_number("m.base_price")}
                || ' promo discount=0 final price=' || {_number("m.base_price - m.off")} END
        FROM (SELECT m.*, CAST(CASE WHEN m.promotion_id IS NULL OR NOT coalesce(m.on_sale, false) THEN 0
                ELSE {_voucher_value("CAST(m.base_price AS DECIMAL(10,2))")} END AS DECIMAL(10,2)) AS off
            FROM meals m {_VOUCHER_JOIN.replace("r.promotion_id", "m.promotion_id").replace("r.customer_id", "m.customer_id")}) m)"""


def _key_text(table: str, alias: str = "") -> str:
    prefix = f"{alias}." if alias else ""
    return "concat_ws('|', " + ", ".join(f"CAST({prefix}{c} AS VARCHAR)" for c in PRIMARY_KEYS[table]) + ")"


# The constraints, typed out from the table definitions and not taken from the rules the operators use.
_CHECKS = """
membership_tiers | points_required | points_required >= 0
membership_tiers | discount_percentage | discount_percentage >= 0 AND discount_percentage <= 100
membership_tiers | tier_name_length | length(tier_name) <= 20
customers | points_balance | points_balance >= 0
customers | is_member | is_member = 'Y' OR is_member = 'N'
customers | membership_status | membership_status = 'ACTIVE' OR membership_status = 'CANCELLED' OR membership_status = 'PENDING'
customers | name_length | length(name) <= 100
customers | email_length | length(email) <= 100
customers | phone_length | length(phone) <= 15
customers | membership_status_length | length(membership_status) <= 20
menu_items | item_type | item_type = 'A_LA_CARTE' OR item_type = 'SET_MEAL' OR item_type = 'INGREDIENT' OR item_type = 'SEASONAL'
menu_items | base_price | base_price >= 0
menu_items | is_active | is_active = 'Y' OR is_active = 'N'
menu_items | menu_dates | valid_to IS NULL OR valid_to >= valid_from
menu_items | item_type_length | length(item_type) <= 20
menu_items | name_length | length(name) <= 100
menu_items | description_length | length(description) <= 200
promotions | promotion_type | promotion_type = 'VOUCHER' OR promotion_type = 'SEASONAL' OR promotion_type = 'SET_MEAL'
promotions | is_auto_assign | is_auto_assign = 'Y' OR is_auto_assign = 'N'
promotions | subtype_attributes | (promotion_type = 'VOUCHER' AND discount_value IS NOT NULL) OR (promotion_type = 'SEASONAL' AND points_required IS NOT NULL) OR (promotion_type = 'SET_MEAL' AND set_meal_id IS NOT NULL)
promotions | valid_dates | valid_to >= valid_from
promotions | promotion_type_length | length(promotion_type) <= 20
promotions | name_length | length(name) <= 100
promotions | voucher_code_length | length(voucher_code) <= 50
orders | total_amount | total_amount >= 0
orders | discount_amount | discount_amount >= 0
orders | final_amount | final_amount >= 0
orders | payment_method | payment_method = 'CASH' OR payment_method = 'CARD' OR payment_method = 'ONLINE'
orders | status | status = 'COMPLETED' OR status = 'CANCELLED' OR status = 'REFUNDED'
orders | order_amounts | final_amount = total_amount - discount_amount
orders | payment_method_length | length(payment_method) <= 50
orders | status_length | length(status) <= 20
point_transactions | transaction_type | transaction_type = 'PURCHASE' OR transaction_type = 'REDEMPTION' OR transaction_type = 'BONUS' OR transaction_type = 'ADJUSTMENT' OR transaction_type = 'EXPIRY'
point_transactions | points_sign | (transaction_type IN ('REDEMPTION', 'EXPIRY') AND points_amount <= 0) OR (transaction_type NOT IN ('REDEMPTION', 'EXPIRY') AND points_amount >= 0)
point_transactions | transaction_type_length | length(transaction_type) <= 20
point_transactions | description_length | length(description) <= 200
membership_history | change_reason | change_reason = 'SIGNUP' OR change_reason = 'RENEWAL' OR change_reason = 'UPGRADE' OR change_reason = 'DOWNGRADE' OR change_reason = 'ADMIN' OR change_reason = 'AUTO'
membership_history | change_reason_length | length(change_reason) <= 100
membership_history | changed_by_length | length(changed_by) <= 30
customer_promotions | is_used | is_used = 'Y' OR is_used = 'N'
customer_promotions | acquisition_method | acquisition_method = 'AUTO_TIER' OR acquisition_method = 'TIER_UPGRADE' OR acquisition_method = 'POINT_REDEEM' OR acquisition_method = 'MANUAL' OR acquisition_method = 'BIRTHDAY'
customer_promotions | used_date | is_used = 'N' OR used_date IS NOT NULL
customer_promotions | acquisition_method_length | length(acquisition_method) <= 20
redemptions | points_used | points_used >= 0
redemptions | redemption_status | redemption_status = 'COMPLETED' OR redemption_status = 'CANCELLED'
redemptions | redemption_status_length | length(redemption_status) <= 20
set_meal_components | quantity | quantity > 0
set_meal_components | no_self_component | set_meal_id != component_id
order_items | quantity | quantity > 0
order_items | price | price >= 0
order_items | discount_applied | discount_applied >= 0
customer_activity | activity_type | activity_type IN ('LOGIN', 'ORDER', 'SEASONAL_REDEMPTION', 'SEASONAL_EXPIRATION', 'VOUCHER_REDEMPTION', 'VOUCHER_GENERATION', 'TIER_CHANGE', 'RENEWAL', 'EXPIRATION', 'VOUCHER_ASSIGNMENT', 'BIRTHDAY')
customer_activity | activity_type_length | length(activity_type) <= 30
customer_activity | ip_address_length | length(ip_address) <= 45
customer_activity | details_length | length(details) <= 4000
"""
_FOREIGN_KEYS = """
customers tier_id membership_tiers tier_id
promotions set_meal_id menu_items item_id
promotions applicable_tier_id membership_tiers tier_id
orders customer_id customers customer_id
point_transactions customer_id customers customer_id
point_transactions order_id orders order_id
point_transactions promotion_id promotions promotion_id
membership_history customer_id customers customer_id
membership_history old_tier_id membership_tiers tier_id
membership_history new_tier_id membership_tiers tier_id
customer_promotions customer_id customers customer_id
customer_promotions promotion_id promotions promotion_id
redemptions customer_id customers customer_id
redemptions promotion_id promotions promotion_id
redemptions order_id orders order_id
redemptions item_id menu_items item_id
set_meal_components set_meal_id menu_items item_id
set_meal_components component_id menu_items item_id
order_items order_id orders order_id
order_items item_id menu_items item_id
customer_activity customer_id customers customer_id
"""
# Each table's keys, unique columns and required columns.
_KEYS = """
membership_tiers | tier_id | tier_name | tier_id tier_name points_required discount_percentage
customers | customer_id | email phone | customer_id name email phone tier_id
menu_items | item_id | | item_id item_type name base_price
promotions | promotion_id | voucher_code | promotion_id promotion_type name valid_from valid_to
orders | order_id | | order_id customer_id total_amount final_amount
point_transactions | transaction_id | | transaction_id customer_id points_amount transaction_type transaction_date
membership_history | history_id | | history_id customer_id new_tier_id
customer_promotions | customer_id promotion_id | | customer_id promotion_id
redemptions | redemption_id | | redemption_id customer_id promotion_id points_used
set_meal_components | set_meal_id component_id | | set_meal_id component_id quantity
order_items | order_item_id | | order_item_id order_id item_id price
customer_activity | activity_id | | activity_id
"""


def _typed(lines: str, sep: str | None) -> list[list[str]]:
    return [[part.strip() for part in line.split(sep)] for line in lines.strip().splitlines()]


def _row_key(table: str) -> str:
    keys = next(row[1] for row in _typed(_KEYS, "|") if row[0] == table).split()
    return "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in keys) + ")"


def _check_sql() -> str:
    raw = {"customers": "raw_customers", "point_transactions": "raw_point_transactions"}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule_name, {_row_key(table)} AS row_key "
        f"FROM ly_{raw.get(table, table)} WHERE NOT coalesce({test}, true)" for table, rule, test in _typed(_CHECKS, "|")
    )


def _fk_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{child}' AS table_name, '{column}' AS column_name, {_row_key(child)} AS row_key, {column} AS missing_key "
        f"FROM ly_{child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM ly_{parent})"
        for child, column, parent, key in _typed(_FOREIGN_KEYS, None)
    )


def _unique_sql() -> str:
    parts = []
    for table, primary, unique, required in _typed(_KEYS, "|"):
        for key in [primary.split(), *[[c] for c in unique.split()]]:
            text = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in key) + ")"
            parts.append(
                f"SELECT '{table}' AS table_name, '{','.join(key)}' AS key_name, {text} AS key_value, CAST(count(*) AS BIGINT) AS row_count "
                f"FROM ly_{table} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in key)} GROUP BY {', '.join(key)} HAVING count(*) > 1"
            )
        for column in required.split():
            parts.append(f"SELECT '{table}', '{column}', 'NULL', CAST(count(*) AS BIGINT) FROM ly_{table} WHERE {column} IS NULL HAVING count(*) > 0")
    return " UNION ALL ".join(parts)


_DOOMED = """
    gone_items AS (SELECT item_id FROM ly_menu_items WHERE item_type = 'SEASONAL' AND valid_to < $now),
    gone_promotions AS (SELECT promotion_id FROM ly_promotions
        WHERE set_meal_id IN (SELECT item_id FROM gone_items))"""
_GONE_REDEMPTION = (
    "(promotion_id IN (SELECT promotion_id FROM gone_promotions) OR item_id IN (SELECT item_id FROM gone_items))"
)

SQL: dict[str, str] = {
    "seasonal_item_performance": f"""
        SELECT m.item_id, m.name, m.description AS season, CAST(count(l.order_item_id) AS BIGINT) AS total_sold,
            CAST(coalesce(sum(l.price) FILTER (WHERE o.discount_amount = 0), 0) AS DOUBLE) AS revenue,
            CAST(count(r.redemption_id) AS BIGINT) AS points_redemptions,
            CASE WHEN m.initial_stock IS NOT NULL THEN
                {_ratio("count(l.order_item_id) * 100", "greatest(1, m.initial_stock)", 2)} END AS sell_through_rate,
            {_ratio("sum(l.quantity)", "count(l.quantity)", 1)} AS avg_order_size,
            {_ratio("(count(*) FILTER (WHERE r.redemption_id IS NOT NULL AND p.min_spend <= o.total_amount)) * 100",
                    "greatest(1, count(r.redemption_id))", 2)} AS min_spend_met
        FROM ly_menu_items m JOIN ly_order_items l ON l.item_id = m.item_id JOIN ly_orders o ON o.order_id = l.order_id
        LEFT JOIN ly_redemptions r ON r.order_id = o.order_id
        LEFT JOIN ly_promotions p ON p.promotion_id = r.promotion_id AND p.set_meal_id = m.item_id
        WHERE m.item_type = 'SEASONAL' GROUP BY m.item_id, m.name, m.description, m.initial_stock""",
    "seasonal_inventory_status": f"""
        SELECT m.item_id, m.name, m.current_stock, {_days("m.valid_to", "$now", "ceil")} AS days_left_in_season,
            CASE WHEN p.promotion_id IS NOT NULL THEN 'Y' ELSE 'N' END AS redemption_allowed,
            CAST(coalesce(p.min_spend, 0) AS DOUBLE) AS min_spend_required,
            CAST(coalesce(p.points_required, 0) AS BIGINT) AS points_cost
        FROM ly_menu_items m LEFT JOIN ly_promotions p ON p.set_meal_id = m.item_id AND {_LIVE}
        WHERE m.item_type = 'SEASONAL'""",
    "upcoming_renewals": f"""
        SELECT c.customer_id, c.name, c.email, t.tier_name, c.membership_expiry_date,
            {_days("c.membership_expiry_date", "$now")} AS days_until_expiry,
            CAST(t.renewal_fee AS DOUBLE) AS renewal_fee,
            CASE WHEN c.membership_expiry_date <= $now THEN 'EXPIRED'
                 WHEN c.membership_expiry_date <= $now + INTERVAL 7 DAY THEN 'URGENT'
                 WHEN c.membership_expiry_date <= $now + INTERVAL 30 DAY THEN 'UPCOMING'
                 ELSE 'ACTIVE' END AS renewal_status
        FROM ly_customers c JOIN ly_membership_tiers t ON t.tier_id = c.tier_id WHERE c.is_member = 'Y'""",
    "tier_comparison": f"""
        SELECT c.customer_id, c.name, t.tier_name AS current_tier, c.points_balance, n.tier_name AS next_tier,
            n.points_required - c.points_balance AS points_needed,
            CAST(n.discount_percentage - t.discount_percentage AS DOUBLE) AS additional_discount,
            CAST(n.renewal_fee - t.renewal_fee AS DOUBLE) AS fee_change,
            CASE WHEN n.tier_id IS NULL THEN 'MAX_TIER' WHEN c.points_balance >= n.points_required THEN 'ELIGIBLE_NOW'
                 ELSE 'NEEDS_MORE_POINTS' END AS upgrade_status
        FROM ly_customers c JOIN ly_membership_tiers t ON t.tier_id = c.tier_id {_NEXT_TIER}""",
    "assignable_vouchers": f"""
        SELECT p.promotion_id, p.name, p.voucher_code,
            CASE WHEN p.name LIKE 'BDAY%' THEN 'BIRTHDAY' WHEN p.is_auto_assign = 'Y' THEN 'AUTO_ASSIGN'
                 ELSE 'MANUAL' END AS assignment_type, p.valid_from, p.valid_to, t.tier_name AS applicable_tier,
            t.birthday_bonus_points
        FROM ly_promotions p LEFT JOIN ly_membership_tiers t ON t.tier_id = p.applicable_tier_id
        WHERE (p.is_auto_assign = 'Y' OR p.name LIKE 'BDAY%') AND {_LIVE}""",
    "voucher_assignment_status": """
        SELECT p.promotion_id, p.name, p.voucher_code,
            CASE WHEN p.name LIKE 'BDAY%' THEN 'BIRTHDAY' ELSE 'AUTO_ASSIGN' END AS voucher_type,
            CAST(count(h.customer_id) AS BIGINT) AS assigned_count,
            CAST(count(*) FILTER (WHERE h.is_used = 'Y') AS BIGINT) AS redeemed_count,
            min(h.date_acquired) AS first_assignment, max(h.date_acquired) AS last_assignment
        FROM ly_promotions p LEFT JOIN ly_customer_promotions h ON h.promotion_id = p.promotion_id
        WHERE p.is_auto_assign = 'Y' OR p.name LIKE 'BDAY%' GROUP BY p.promotion_id, p.name, p.voucher_code""",
    "setmeal_profitability": f"""
        SELECT m.item_id, m.name, CAST(m.base_price AS DOUBLE) AS selling_price, CAST(k.cost AS DOUBLE) AS component_cost,
            CAST(m.base_price - k.cost AS DOUBLE) AS gross_profit,
            {_ratio("(" + _cents("m.base_price") + " - " + _cents("k.cost") + ") * 100", _cents("m.base_price"), 2)}
                AS base_margin_pct,
            {_ratio("(" + _cents("m.base_price") + " * 85 - " + _cents("k.cost") + " * 100) * 100",
                    _cents("m.base_price") + " * 85", 2)} AS discounted_margin_pct,
            {_VALIDITY} AS validation_status,
            CAST((SELECT count(*) FROM ly_order_items l JOIN ly_orders o ON o.order_id = l.order_id
                WHERE l.item_id = m.item_id AND o.order_date > $now - INTERVAL 3 MONTH) AS BIGINT)
                AS sales_last_3_months
        FROM ly_menu_items m JOIN {_COMPONENT_COST} k ON k.set_meal_id = m.item_id WHERE m.item_type = 'SET_MEAL'""",
    "order_type_comparison": f"""
        SELECT CASE WHEN m.item_type = 'SET_MEAL' THEN 'Setmeal' ELSE 'À La Carte' END AS order_type,
            t.tier_name AS customer_tier, CAST(count(DISTINCT l.order_id) AS BIGINT) AS order_count,
            CAST(sum(l.price * l.quantity) AS DOUBLE) AS total_revenue,
            {_ratio("sum(CAST(l.price * 100 AS BIGINT) * l.quantity)", "count(*) * 100", 2)} AS avg_order_value,
            {_ratio("sum(CAST(l.price * 100 AS BIGINT) * l.quantity)", "count(DISTINCT o.customer_id) * 100", 2)}
                AS revenue_per_customer,
            {_ratio("count(DISTINCT l.order_id)", "count(DISTINCT o.customer_id)", 2)} AS orders_per_customer
        FROM ly_order_items l JOIN ly_menu_items m ON m.item_id = l.item_id JOIN ly_orders o ON o.order_id = l.order_id
        JOIN ly_customers c ON c.customer_id = o.customer_id JOIN ly_membership_tiers t ON t.tier_id = c.tier_id
        GROUP BY 1, 2""",
    "order_totals_reconciliation": """
        SELECT o.order_id, CAST(o.total_amount AS DOUBLE) AS total_amount,
            CAST(o.discount_amount AS DOUBLE) AS discount_amount, CAST(o.final_amount AS DOUBLE) AS final_amount,
            (SELECT CAST(sum(l.price * l.quantity) AS DOUBLE) FROM ly_order_items l WHERE l.order_id = o.order_id)
                AS calc_total,
            (SELECT CAST(sum(l.discount_applied * l.quantity) AS DOUBLE) FROM ly_order_items l
                WHERE l.order_id = o.order_id) AS calc_discount
        FROM ly_orders o WHERE o.order_id IN (SELECT max(order_id) FROM ly_orders GROUP BY customer_id)""",
    "points_ledger_reconciliation": """
        SELECT c.customer_id, c.points_balance, (SELECT CAST(sum(t.points_amount) AS BIGINT)
            FROM ly_point_transactions t WHERE t.customer_id = c.customer_id) AS ledger_points
        FROM ly_customers c""",
    "tier_change_history": """
        SELECT h.history_id, h.customer_id, c.name, a.tier_name AS old_tier, b.tier_name AS new_tier, h.change_date,
            h.change_reason
        FROM ly_membership_history h JOIN ly_customers c ON c.customer_id = h.customer_id
        JOIN ly_membership_tiers a ON a.tier_id = h.old_tier_id
        JOIN ly_membership_tiers b ON b.tier_id = h.new_tier_id""",
    "customer_status": f"""
        SELECT c.customer_id, c.name, c.points_balance, t.tier_name AS current_tier,
            t.points_required AS current_tier_requirement, n.tier_name AS next_tier,
            n.points_required AS next_tier_requirement, n.points_required - c.points_balance AS points_needed
        FROM ly_customers c JOIN ly_membership_tiers t ON t.tier_id = c.tier_id {_NEXT_TIER}""",
    "customer_tiers": """
        SELECT c.customer_id, c.name, c.points_balance, t.tier_name AS current_tier
        FROM ly_customers c JOIN ly_membership_tiers t ON t.tier_id = c.tier_id""",
    "ledger_by_type": """
        SELECT transaction_id, customer_id, points_amount, transaction_type, transaction_date, description
        FROM ly_point_transactions WHERE transaction_type = 'REDEMPTION'""",
    "ledger_description_search": """
        SELECT transaction_id, customer_id, points_amount, description, expiry_date
        FROM ly_point_transactions WHERE description LIKE '%expired from%'""",
    "active_promo_assigned_count": f"""
        SELECT p.promotion_id, p.name, CAST(count(h.customer_id) AS BIGINT) AS assigned_count
        FROM ly_promotions p LEFT JOIN ly_customer_promotions h ON h.promotion_id = p.promotion_id
        WHERE p.is_auto_assign = 'Y' AND {_LIVE} GROUP BY p.promotion_id, p.name""",
    "activity_by_type": """
        SELECT activity_id, customer_id, activity_type, activity_date, details
        FROM ly_customer_activity WHERE activity_type = 'VOUCHER_REDEMPTION'""",
    "recent_activity_by_type": """
        SELECT activity_id, customer_id, activity_type, activity_date, details
        FROM ly_customer_activity WHERE activity_type = 'LOGIN' AND activity_date >= $now - INTERVAL 5 MINUTE""",
    "promotions_of_named_item": """
        SELECT p.promotion_id, p.promotion_type, p.name, p.valid_from, p.valid_to,
            CAST(p.discount_value AS DOUBLE) AS discount_value, p.set_meal_id
        FROM ly_promotions p WHERE p.set_meal_id IN (SELECT item_id FROM ly_menu_items WHERE item_type = 'SEASONAL'
            AND name IN (SELECT name FROM ly_menu_items WHERE item_type = 'SEASONAL' AND is_active = 'N'))""",
    "tier_requirements": """
        SELECT tier_id, tier_name, points_required FROM ly_membership_tiers""",
    "used_promotions": "SELECT * FROM ly_customer_promotions WHERE is_used = 'Y'",
    "expired_item_status": """
        SELECT item_id, item_type, name, CAST(base_price AS DOUBLE) AS base_price, valid_to, is_active
        FROM ly_menu_items WHERE item_type = 'SEASONAL'
          AND name IN (SELECT name FROM ly_menu_items WHERE item_type = 'SEASONAL' AND valid_to < $now)""",
    "holdings_by_tier_count": """
        SELECT c.tier_id, CAST(count(*) AS BIGINT) AS holdings FROM ly_customer_promotions h
        JOIN ly_customers c ON c.customer_id = h.customer_id GROUP BY c.tier_id""",
    "seasonal_redemption_eligibility": f"""
        SELECT r.request_id, r.customer_id, r.item_id, CAST(r.item_price AS DOUBLE) AS item_price,
            CASE WHEN p.promotion_id IS NULL THEN 'NO_PROMOTION' WHEN c.customer_id IS NULL THEN 'INVALID CUSTOMER'
                WHEN c.points_balance < coalesce(p.points_required, 0) THEN 'INSUFFICIENT_POINTS'
                WHEN p.min_spend IS NOT NULL AND r.item_price < p.min_spend THEN 'MIN_SPEND_NOT_MET'
                WHEN p.applicable_tier_id IS NOT NULL AND c.tier_id < p.applicable_tier_id THEN 'TIER_RESTRICTED'
                ELSE 'ELIGIBLE' END AS eligibility
        FROM ly_seasonal_checks r LEFT JOIN {_FIRST_SEASONAL} p ON p.set_meal_id = r.item_id
        LEFT JOIN ly_customers c ON c.customer_id = r.customer_id""",
    "predict_seasonal_demand": """
        SELECT r.item_id, r.days_remaining, CAST(CASE WHEN s.total IS NULL THEN 0
            ELSE (s.total * r.days_remaining * 12 + s.lines * 10 - 1) // (s.lines * 10) END AS BIGINT)
            AS predicted_demand
        FROM ly_demand_requests r LEFT JOIN (
            SELECT l.item_id, sum(l.quantity) AS total, count(*) AS lines FROM ly_order_items l
            JOIN ly_orders o ON o.order_id = l.order_id
            WHERE o.order_date BETWEEN $now - INTERVAL 30 DAY AND $now GROUP BY l.item_id) s ON s.item_id = r.item_id""",
    "upgrade_value": f"""
        SELECT r.customer_id, CASE WHEN n.tier_id IS NULL THEN 'At highest tier or invalid customer'
            ELSE 'Upgrade to ' || n.tier_name || ' | Discount Increase: +'
                || {_number("(n.discount_percentage - t.discount_percentage)")} || '% | Points Needed: '
                || {_number("(n.points_required - c.points_balance)")} || ' | Renewal Fee Change: '
                || CASE WHEN n.renewal_fee > t.renewal_fee
                        THEN '+$' || {_number("(n.renewal_fee - t.renewal_fee)")}
                        WHEN n.renewal_fee < t.renewal_fee
                        THEN '-$' || {_number("(t.renewal_fee - n.renewal_fee)")}
                        ELSE 'No change' END END AS upgrade_value
        FROM (SELECT DISTINCT customer_id FROM ly_voucher_checks) r
        LEFT JOIN ly_customers c ON c.customer_id = r.customer_id
        LEFT JOIN ly_membership_tiers t ON t.tier_id = c.tier_id {_NEXT_TIER}""",
    "membership_health": f"""
        SELECT customer_id, CASE WHEN tier_name IS NULL THEN 'Customer not found'
            WHEN membership_status <> 'ACTIVE' THEN tier_name || ' membership: ' || membership_status
                || ' (last renewed: ' || coalesce(upper(strftime(last_renewal_date, '%d-%b-%Y')), '') || ')'
            WHEN days <= 0 THEN tier_name || ' membership: EXPIRED ' || abs(days) || ' days ago'
            WHEN days <= 7 THEN tier_name || ' membership: CRITICAL - renew in ' || days || ' days'
            WHEN days <= 30 THEN tier_name || ' membership: Renewal due in ' || days || ' days'
            ELSE tier_name || ' membership: Active (expires in ' || coalesce(CAST(days AS VARCHAR), '') || ' days)'
            END AS membership_health
        FROM (SELECT r.customer_id, t.tier_name, c.membership_status, c.last_renewal_date,
                {_days("c.membership_expiry_date", "$now")} AS days
              FROM (SELECT DISTINCT customer_id FROM ly_voucher_checks) r
              LEFT JOIN ly_customers c ON c.customer_id = r.customer_id
              LEFT JOIN ly_membership_tiers t ON t.tier_id = c.tier_id)""",
    "voucher_codes": """
        SELECT customer_id AS id, 'PRM' || substr(translate(md5('spring|' || customer_id || '|0|0'),
            '0123456789abcdef', 'ABCDEFGHJKLMNPQR'), 1, 11) AS voucher_code FROM ly_customers""",
    "voucher_value": f"""
        SELECT r.request_id, r.promotion_id, CAST(r.order_amount AS DOUBLE) AS order_amount, r.customer_id,
            CAST({_voucher_value("r.order_amount")} AS DOUBLE) AS voucher_value
        FROM ly_voucher_checks r {_VOUCHER_JOIN}""",
    "validate_setmeal": f"SELECT m.item_id, {_VALIDITY} AS validation_status FROM ly_menu_items m",
    "setmeal_price": f"""
        SELECT r.request_id, r.item_id, r.customer_id, CAST(round(greatest(
            k.cost * (100 - least(15 + CASE WHEN r.apply_tier_discount THEN coalesce(t.discount_percentage, 0) ELSE 0 END,
                50)) * CAST(0.01 AS DECIMAL(3,2)), k.cost * CAST(0.7 AS DECIMAL(2,1))), 2) AS DOUBLE) AS setmeal_price
        FROM ly_meal_price_requests r LEFT JOIN {_COMPONENT_COST} k ON k.set_meal_id = r.item_id
        LEFT JOIN ly_customers c ON c.customer_id = r.customer_id
        LEFT JOIN ly_membership_tiers t ON t.tier_id = c.tier_id""",
    "redeem_seasonal": f"""
        SELECT request_id, customer_id, item_id, order_id, status,
            CAST(CASE status WHEN 'INVALID_CUSTOMER' THEN -20053 WHEN 'INVALID_ITEM' THEN -20054
                WHEN 'INVALID_ORDER' THEN -20055 WHEN 'ITEM_NOT_IN_ORDER' THEN -20051 WHEN 'NO_PROMOTION' THEN -20050
                WHEN 'INSUFFICIENT_POINTS' THEN -20052 END AS INTEGER) AS error_code,
            CASE WHEN status = 'REDEEMED' THEN promo END AS promotion_id,
            CASE WHEN status = 'REDEEMED' THEN points END AS points_used,
            CAST(CASE WHEN status = 'REDEEMED' THEN price END AS DOUBLE) AS discount_value
        FROM ({_SEASONAL_OUTCOME})""",
    "redeem_seasonal_redemptions": f"""
        SELECT customer_id, promo AS promotion_id, order_id, points AS points_used, $now AS redemption_date,
            'COMPLETED' AS redemption_status, item_id, CAST(price AS DOUBLE) AS discount_value
        FROM ({_SEASONAL_OUTCOME}) WHERE status = 'REDEEMED'""",
    "redeem_seasonal_ledger": f"""
        SELECT customer_id, order_id, promo AS promotion_id, -points AS points_amount, 'REDEMPTION' AS transaction_type,
            'Seasonal item redemption for setmeal ' || item_id AS description, $now AS transaction_date,
            {_plus_months("$now", 12)} AS expiry_date
        FROM ({_SEASONAL_OUTCOME}) WHERE status = 'REDEEMED'""",
    "redeem_seasonal_lines": f"""
        SELECT l.order_item_id, l.order_id, l.item_id, l.quantity, CAST(l.price AS DOUBLE) AS price,
            CAST(m.base_price AS DOUBLE) AS discount_applied
        FROM ly_order_items l JOIN ly_menu_items m ON m.item_id = l.item_id
        WHERE (l.order_id, l.item_id) IN (SELECT (order_id, item_id) FROM ({_SEASONAL_OUTCOME})
            WHERE status = 'REDEEMED')""",
    "expire_seasonal_items": """
        SELECT item_id, item_type, name, description, CAST(base_price AS DOUBLE) AS base_price, 'N' AS is_active,
            valid_from, valid_to, current_stock, initial_stock
        FROM ly_menu_items WHERE item_type = 'SEASONAL' AND valid_to < $now AND is_active = 'Y'""",
    "expired_item_promotions": """
        SELECT promotion_id, promotion_type, name, valid_from, valid_to, CAST(discount_value AS DOUBLE) AS discount_value,
            voucher_code, is_auto_assign, points_required, CAST(min_spend AS DOUBLE) AS min_spend, set_meal_id,
            applicable_tier_id
        FROM ly_promotions WHERE set_meal_id IN (SELECT item_id FROM ly_menu_items
            WHERE item_type = 'SEASONAL' AND valid_to < $now)""",
    "renew_memberships": f"""
        SELECT customer_id, {_plus_months("greatest(membership_expiry_date, $now)", 12)} AS membership_expiry_date,
            'ACTIVE' AS membership_status, $now AS last_renewal_date, renewal_count + 1 AS renewal_count
        FROM ly_customers WHERE is_member = 'Y' AND membership_expiry_date <= $now + INTERVAL 30 DAY""",
    "expire_points": f"""
        WITH RECURSIVE {_EXPIRY_STEPS}
        SELECT customer_id, -points AS points_amount, 'EXPIRY' AS transaction_type,
            'Points expired from transaction ' || transaction_id AS description, $now AS transaction_date
        FROM walk WHERE hit""",
    "expire_points_marked": f"""
        WITH RECURSIVE {_EXPIRY_STEPS}
        SELECT t.transaction_id, t.customer_id, CAST(NULL AS TIMESTAMP) AS expiry_date,
            coalesce(t.description, '') || ' - EXPIRED' AS description
        FROM walk w JOIN ly_point_transactions t ON t.transaction_id = w.transaction_id WHERE w.hit""",
    "expire_points_totals": f"""
        WITH RECURSIVE {_EXPIRY_STEPS}
        SELECT CAST(coalesce(sum(points), 0) AS BIGINT) AS points_expired, CAST(count(*) AS BIGINT) AS entries_expired,
            CAST(count(DISTINCT customer_id) AS BIGINT) AS customers_affected FROM walk WHERE hit""",
    "expire_points_balances": f"""
        WITH RECURSIVE {_EXPIRY_STEPS}
        SELECT customer_id, min(rest) AS points_balance, CAST(sum(points) AS BIGINT) AS points_expired,
            CAST(count(*) AS BIGINT) AS entries_expired
        FROM walk WHERE hit GROUP BY customer_id""",
    "downgrade_tiers": f"""
        SELECT * FROM (SELECT c.customer_id, c.tier_id AS old_tier_id, {_REACHED} AS new_tier_id FROM ly_customers c
            WHERE c.customer_id IN (SELECT customer_id FROM ly_point_transactions WHERE transaction_type = 'EXPIRY'
                AND CAST(transaction_date AS DATE) = CAST($now AS DATE)))
        WHERE new_tier_id < old_tier_id""",
    "expiry_run_downgrades": f"""
        WITH RECURSIVE {_EXPIRY_STEPS},
        lowered AS (SELECT customer_id, min(rest) AS rest FROM walk WHERE hit GROUP BY customer_id),
        people AS (SELECT c.customer_id, c.tier_id, coalesce(l.rest, c.points_balance) AS points
            FROM ly_customers c LEFT JOIN lowered l ON l.customer_id = c.customer_id
            WHERE l.customer_id IS NOT NULL OR c.customer_id IN (SELECT customer_id FROM ly_point_transactions
                WHERE transaction_type = 'EXPIRY' AND CAST(transaction_date AS DATE) = CAST($now AS DATE)))
        SELECT * FROM (SELECT c.customer_id, c.tier_id AS old_tier_id, (SELECT max(t.tier_id)
            FROM ly_membership_tiers t WHERE t.points_required <= c.points) AS new_tier_id FROM people c)
        WHERE new_tier_id < old_tier_id""",
    "bulk_assign_vouchers": f"""
        SELECT c.customer_id, p.promotion_id, $now AS date_acquired, 'N' AS is_used,
            'AUTO_TIER' AS acquisition_method
        FROM ly_customers c JOIN ly_promotions p ON p.is_auto_assign = 'Y' AND {_LIVE}
            AND (p.applicable_tier_id IS NULL OR p.applicable_tier_id = c.tier_id)
        WHERE c.is_member = 'Y' AND NOT EXISTS (SELECT 1 FROM ly_customer_promotions h
            WHERE h.customer_id = c.customer_id AND h.promotion_id = p.promotion_id)""",
    "redeem_vouchers": f"""
        WITH RECURSIVE {_redeem_walk("ly_voucher_redeem_requests", "ly_orders")}
        SELECT f.request_id, f.customer_id, f.promotion_id, f.order_id,
            coalesce(f.failure, w.refused, 'REDEEMED') AS status, CASE WHEN w.hit THEN f.points END AS points_used
        FROM facts f LEFT JOIN walk w ON w.request_id = f.request_id""",
    "redeem_vouchers_orders": f"""
        WITH RECURSIVE {_redeem_walk("ly_voucher_redeem_requests", "ly_orders")}
        SELECT o.order_id, CAST(o.discount_amount + p.discount_value AS DOUBLE) AS discount_amount,
            CAST(o.total_amount - (o.discount_amount + p.discount_value) AS DOUBLE) AS final_amount
        FROM walk w JOIN ly_voucher_redeem_requests r ON r.request_id = w.request_id
        JOIN ly_orders o ON o.order_id = r.order_id JOIN ly_promotions p ON p.promotion_id = r.promotion_id
        WHERE w.hit AND p.discount_value IS NOT NULL""",
    "redeem_vouchers_shared": f"""
        WITH RECURSIVE {_SHARED_WAVES}
        SELECT f.request_id, f.customer_id, f.promotion_id, f.order_id, coalesce(f.failure, e.status) AS status,
            CASE WHEN e.status = 'REDEEMED' THEN f.points END AS points_used
        FROM asked f LEFT JOIN ended e ON e.request_id = f.request_id""",
    "redeem_vouchers_shared_orders": f"""
        WITH RECURSIVE {_SHARED_WAVES}
        SELECT o.order_id, CAST(o.discount_amount + s.off AS DOUBLE) AS discount_amount,
            CAST(o.total_amount - (o.discount_amount + s.off) AS DOUBLE) AS final_amount
        FROM ly_orders o JOIN (SELECT f.order_id, sum(f.value) AS off FROM ended e JOIN asked f ON f.request_id = e.request_id
            WHERE e.status = 'REDEEMED' AND f.value IS NOT NULL GROUP BY f.order_id) s ON s.order_id = o.order_id""",
    "redeem_vouchers_shared_ledger": f"""
        WITH RECURSIVE {_SHARED_WAVES}
        SELECT f.customer_id, -f.points_required AS points_amount, 'REDEMPTION' AS transaction_type, $now AS transaction_date,
            'Voucher redemption' AS description
        FROM ended e JOIN asked f ON f.request_id = e.request_id WHERE e.status = 'REDEEMED' AND f.points_required IS NOT NULL""",
    "create_alacarte_orders": f"""
        WITH {_ALACARTE_PARTS}
        SELECT request_id, customer_id, $now AS order_date, CAST(total AS DOUBLE) AS total_amount,
            CAST(discount AS DOUBLE) AS discount_amount, CAST(greatest(total - discount, 0) AS DOUBLE) AS final_amount,
            payment_method, 'COMPLETED' AS status, CAST(items AS BIGINT) AS items
        FROM {_ALACARTE_ORDERS}""",
    "create_alacarte_lines": f"""
        WITH {_ALACARTE_PARTS}
        SELECT p.request_id, m.item_id, CAST(1 AS BIGINT) AS quantity, CAST(m.base_price AS DOUBLE) AS price,
            CAST(0 AS DOUBLE) AS discount_applied
        FROM parts p JOIN judged j ON j.request_id = p.request_id
        JOIN ly_menu_items m ON m.item_id = TRY_CAST(p.part AS BIGINT) AND m.item_type = 'A_LA_CARTE'
            AND m.is_active = 'Y'
        WHERE j.member AND j.payable AND NOT j.bad""",
    "create_alacarte_skipped": f"""
        WITH {_ALACARTE_PARTS}
        SELECT p.request_id, p.part AS item_text FROM parts p JOIN judged j ON j.request_id = p.request_id
        WHERE j.member AND j.payable AND NOT j.bad AND p.part <> '' AND NOT EXISTS (
            SELECT 1 FROM ly_menu_items m WHERE m.item_id = TRY_CAST(p.part AS BIGINT) AND m.item_type = 'A_LA_CARTE'
                AND m.is_active = 'Y')""",
    "create_setmeal_lines": f"""
        SELECT r.request_id, r.item_id, CAST(1 AS BIGINT) AS quantity, CAST(r.total AS DOUBLE) AS price,
            CAST(0 AS DOUBLE) AS discount_applied
        FROM {_SETMEAL_JUDGED} r WHERE r.status = 'CREATED'""",
    "create_setmeal_rejects": f"""
        SELECT r.request_id, r.customer_id, r.item_id, r.status, CAST(CASE r.status WHEN 'CUSTOMER_NOT_FOUND' THEN -20011
            WHEN 'NOT_A_MEMBER' THEN -20010 WHEN 'SET_MEAL_NOT_AVAILABLE' THEN -20020 ELSE -2290 END AS INTEGER) AS error_code
        FROM {_SETMEAL_JUDGED} r WHERE r.status <> 'CREATED'""",
    "create_alacarte_rejects": f"""
        WITH {_ALACARTE_PARTS}
        SELECT request_id, customer_id, CASE WHEN NOT member THEN 'NOT_A_MEMBER' WHEN NOT payable
                THEN 'PAYMENT_METHOD_REFUSED' WHEN bad THEN 'BAD_ITEM_LIST' ELSE 'NO_VALID_ITEMS' END AS status,
            CAST(CASE WHEN NOT member THEN -20010 WHEN NOT payable THEN -2290 WHEN bad THEN NULL ELSE -20011 END
                AS INTEGER) AS error_code
        FROM judged WHERE NOT member OR NOT payable OR bad OR items = 0""",
    "create_setmeal_orders": f"""
        SELECT r.request_id, r.customer_id, r.item_id, $now AS order_date, CAST(r.total AS DOUBLE) AS total_amount,
            CAST(least(v, r.total) AS DOUBLE) AS discount_amount,
            CAST(greatest(r.total - least(v, r.total), 0) AS DOUBLE) AS final_amount, r.payment_method,
            'COMPLETED' AS status
        FROM (SELECT r.*, CASE WHEN r.promotion_id IS NULL THEN 0 ELSE {_voucher_value("r.total")} END AS v
              FROM {_SETMEAL_JUDGED} r {_VOUCHER_JOIN} WHERE r.status = 'CREATED') r""",
    "create_setmeal_promotions": f"""
        SELECT DISTINCT 'SET_MEAL' AS promotion_type, 'Auto Promo for Set Meal ' || r.item_id AS name,
            $now AS valid_from, $now + INTERVAL 30 DAY AS valid_to, CAST(5 AS DOUBLE) AS discount_value,
            r.item_id AS set_meal_id
        FROM {_SETMEAL_JUDGED} r WHERE r.status IN ('CREATED', 'SET_MEAL_NOT_AVAILABLE', 'PAYMENT_METHOD_REFUSED') AND r.on_menu IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM ly_promotions p WHERE p.promotion_type = 'SET_MEAL'
              AND p.set_meal_id = r.item_id AND {_LIVE})""",
    "audit_activity": f"""
        SELECT CAST(NULL AS BIGINT) AS customer_id, 'SEASONAL_EXPIRATION' AS activity_type, $now AS activity_date,
            CAST(NULL AS VARCHAR) AS ip_address, 'Deactivated ' || count(*) || ' expired seasonal items' AS details
        FROM ly_menu_items WHERE item_type = 'SEASONAL' AND valid_to < $now AND is_active = 'Y'
        UNION ALL
        SELECT NULL, 'SEASONAL_EXPIRATION', $now, NULL, 'Removed ' || count(*) || ' associated seasonal promotions'
        FROM ly_promotions WHERE set_meal_id IN (SELECT item_id FROM ly_menu_items
            WHERE item_type = 'SEASONAL' AND valid_to < $now)
        UNION ALL
        SELECT NULL, 'RENEWAL', $now, NULL, 'Renewed ' || count(*) || ' memberships, failed 0'
        FROM ly_customers WHERE is_member = 'Y' AND membership_expiry_date <= $now
        UNION ALL
        SELECT customer_id, 'SEASONAL_REDEMPTION', $now, NULL, CASE WHEN status = 'REDEEMED'
            THEN 'Successfully redeemed seasonal item ' || item_id || ' using ' || points || ' points'
            ELSE 'Failed redemption attempt - ' || status || ' for item ' || item_id END
        FROM ({_SEASONAL_OUTCOME}) WHERE status <> 'INVALID_CUSTOMER'""",
    "audit_trail": f"""
        WITH RECURSIVE {_AUDIT_TRAIL}, every AS (
            SELECT 'seasonal' AS job, request_id, customer_id, step AS place, 'SEASONAL_REDEMPTION' AS kind, details FROM seasonal_steps
            UNION ALL SELECT 'value', request_id, customer_id, place, 'VOUCHER_REDEMPTION', details FROM value_steps WHERE job = 'value'
            UNION ALL SELECT 'redemption', request_id, customer_id, place, 'VOUCHER_REDEMPTION', details FROM redemption_steps
            UNION ALL SELECT 'set meal', request_id, customer_id, place, kind, details FROM meal_steps)
        SELECT job, request_id, customer_id, kind AS activity_type, $now AS activity_date, CAST(NULL AS VARCHAR) AS ip_address, details,
            CAST(row_number() OVER (PARTITION BY job, request_id ORDER BY place) AS INTEGER) AS step
        FROM every""",
    "realign_tiers": f"""
        SELECT * FROM (SELECT c.customer_id, c.tier_id AS old_tier_id, {_REACHED} AS new_tier_id, $now AS change_date,
            'ADMIN' AS change_reason FROM ly_customers c) WHERE new_tier_id <> old_tier_id""",
    "realign_tiers_customers": f"""
        SELECT customer_id, reached AS tier_id FROM (SELECT c.customer_id, c.tier_id, {_REACHED} AS reached FROM ly_customers c)
        WHERE reached <> tier_id""",
    "append_from_select": """
        SELECT * FROM ly_point_transactions UNION ALL
        SELECT NULL, customer_id, NULL, NULL, 100, 'PURCHASE', $now - INTERVAL 60 DAY, 'Added purchase',
            $now - INTERVAL 1 DAY FROM ly_customers WHERE membership_status = 'PENDING'""",
    "bulk_update": """
        SELECT promotion_id, promotion_type, name, valid_from,
            CASE WHEN promotion_type = 'VOUCHER' THEN valid_to + INTERVAL 30 DAY ELSE valid_to END AS valid_to,
            CAST(discount_value AS DOUBLE) AS discount_value, voucher_code,
            CASE WHEN promotion_type = 'VOUCHER' THEN 'Y' ELSE is_auto_assign END AS is_auto_assign, points_required,
            CAST(min_spend AS DOUBLE) AS min_spend, set_meal_id,
            CASE WHEN promotion_type <> 'VOUCHER' THEN applicable_tier_id END AS applicable_tier_id
        FROM ly_promotions""",
    "bulk_delete": """
        SELECT * FROM ly_customer_promotions WHERE acquisition_method <> 'MANUAL'
          AND promotion_id NOT IN (SELECT promotion_id FROM ly_promotions WHERE is_auto_assign = 'Y')""",
    "sync_points_balance": f"""
        SELECT c.customer_id, c.points_balance AS old_balance, c.points_balance + g.change AS points_balance
        FROM ly_customers c JOIN {_POINTS_CHANGE} g ON g.customer_id = c.customer_id""",
    "recalc_points_expiry": f"""
        SELECT c.customer_id, {_NEXT_EXPIRY} AS points_expiry_date FROM ly_customers c
        WHERE c.customer_id IN (SELECT customer_id FROM {_REDATED})""",
    "recalc_tier": f"SELECT * FROM {_TIER_UPDATES}",
    "log_tier_changes": f"""
        SELECT u.customer_id, u.old_tier_id, u.new_tier_id, $now AS change_date, {_CHANGE_REASON} AS change_reason,
            'SYSTEM' AS changed_by FROM {_TIER_UPDATES} u""",
    "assign_on_tier_change": f"""
        SELECT u.customer_id, p.promotion_id, $now AS date_acquired, 'N' AS is_used,
            CASE WHEN u.old_tier_id IS NULL THEN 'AUTO_TIER' ELSE 'TIER_UPGRADE' END AS acquisition_method
        FROM {_TIER_UPDATES} u JOIN ly_promotions p ON p.is_auto_assign = 'Y' AND {_LIVE}
            AND (p.applicable_tier_id IS NULL OR p.applicable_tier_id = u.new_tier_id)
        WHERE NOT EXISTS (SELECT 1 FROM ly_customer_promotions h
            WHERE h.customer_id = u.customer_id AND h.promotion_id = p.promotion_id)""",
    "sync_order_totals": """
        SELECT o.order_id, CAST(coalesce(sum(l.price * l.quantity), 0) AS DOUBLE) AS total_amount,
            CAST(coalesce(sum(l.discount_applied * l.quantity), 0) AS DOUBLE) AS discount_amount,
            CAST(coalesce(sum((l.price - l.discount_applied) * l.quantity), 0) AS DOUBLE) AS final_amount
        FROM ly_orders o LEFT JOIN ly_order_items l ON l.order_id = o.order_id
        WHERE o.order_id IN (SELECT CASE WHEN op = 'D' THEN old_order_id ELSE new_order_id END
            FROM ly_order_item_changes)
        GROUP BY o.order_id""",
    "mark_promo_used": """
        SELECT h.customer_id, h.promotion_id, h.date_acquired, 'Y' AS is_used, $now AS used_date, h.acquisition_method
        FROM ly_customer_promotions h WHERE EXISTS (SELECT 1 FROM ly_redemptions r
            WHERE r.customer_id = h.customer_id AND r.promotion_id = h.promotion_id)""",
    "birthday_bonus": """
        SELECT c.customer_id, t.birthday_bonus_points AS points_amount, 'BONUS' AS transaction_type,
            'Birthday reward points' AS description, $now AS transaction_date, $now + INTERVAL 12 MONTH AS expiry_date
        FROM ly_customers c JOIN ly_membership_tiers t ON t.tier_id = c.tier_id
        WHERE month(c.birth_date) = month($now) AND day(c.birth_date) = day($now) AND t.birthday_bonus_points > 0""",
    "birthday_bonus_audit": """
        SELECT c.customer_id, 'BIRTHDAY' AS activity_type, $now AS activity_date, CAST(NULL AS VARCHAR) AS ip_address,
            'Received ' || t.birthday_bonus_points || ' birthday points' AS details
        FROM ly_customers c JOIN ly_membership_tiers t ON t.tier_id = c.tier_id
        WHERE month(c.birth_date) = month($now) AND day(c.birth_date) = day($now) AND t.birthday_bonus_points > 0""",
    "points_cascade_customers": f"""
        WITH {_CASCADE}
        SELECT customer_id, old_balance, points_balance, points_expiry_date, coalesce(reached, tier_id) AS tier_id
        FROM cascade""",
    "ledger_change_stream": f"""
        WITH {_CASCADE}
        SELECT customer_id, old_balance, points_balance, points_expiry_date, coalesce(reached, tier_id) AS tier_id
        FROM cascade""",
    "ledger_change_stream_history": f"""
        WITH {_CASCADE}, u AS (SELECT customer_id, tier_id AS old_tier_id, reached AS new_tier_id FROM cascade
            WHERE reached <> tier_id)
        SELECT u.customer_id, u.old_tier_id, u.new_tier_id, $now AS change_date, {_CHANGE_REASON} AS change_reason,
            'SYSTEM' AS changed_by FROM u""",
    "expiry_from_counts": f"""
        SELECT c.customer_id, {_NEXT_EXPIRY} AS points_expiry_date FROM ly_customers c
        WHERE c.customer_id IN (SELECT customer_id FROM {_REDATED})""",
    "line_change_stream": """
        SELECT o.order_id, CAST(sum(q * price) AS DOUBLE) AS total_amount, CAST(sum(q * off) AS DOUBLE) AS discount_amount,
            CAST(sum(q * (price - off)) AS DOUBLE) AS final_amount
        FROM ly_orders o JOIN (SELECT l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
                CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS off,
                CAST(l_quantity AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END
                    + CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS q
            FROM lineitem) l ON l.order_id = o.order_id GROUP BY o.order_id""",
    "points_cascade_history": f"""
        WITH {_CASCADE}, u AS (SELECT customer_id, tier_id AS old_tier_id, reached AS new_tier_id FROM cascade
            WHERE reached <> tier_id)
        SELECT u.customer_id, u.old_tier_id, u.new_tier_id, $now AS change_date, {_CHANGE_REASON} AS change_reason,
            'SYSTEM' AS changed_by FROM u""",
    "points_cascade_vouchers": f"""
        WITH {_CASCADE}
        SELECT u.customer_id, p.promotion_id, $now AS date_acquired, 'N' AS is_used,
            'TIER_UPGRADE' AS acquisition_method
        FROM cascade u JOIN ly_promotions p ON p.is_auto_assign = 'Y' AND {_LIVE}
            AND (p.applicable_tier_id IS NULL OR p.applicable_tier_id = u.reached)
        WHERE u.reached <> u.tier_id AND NOT EXISTS (SELECT 1 FROM ly_customer_promotions h
            WHERE h.customer_id = u.customer_id AND h.promotion_id = p.promotion_id)""",
    "alacarte_order_flow": f"""
        WITH RECURSIVE {_ALACARTE_PARTS}, made AS (SELECT * FROM {_ALACARTE_ORDERS}),
        asked AS (SELECT request_id, customer_id, promotion_id, request_id AS order_id FROM made WHERE discount > 0),
        heads AS (SELECT request_id AS order_id, customer_id, total AS total_amount, CAST(0 AS DECIMAL(10,2))
            AS discount_amount FROM made), {_redeem_walk("asked", "heads")},
        ended AS (SELECT m.*, CASE WHEN m.discount > 0 AND NOT coalesce(w.hit, false) THEN 0 ELSE m.discount END AS off
            FROM made m LEFT JOIN walk w ON w.request_id = m.request_id)
        SELECT request_id, customer_id, $now AS order_date, CAST(total AS DOUBLE) AS total_amount,
            CAST(off AS DOUBLE) AS discount_amount, CAST(greatest(total - off, 0) AS DOUBLE) AS final_amount,
            payment_method, 'COMPLETED' AS status, CAST(items AS BIGINT) AS items
        FROM ended""",
    "alacarte_flow_ledger": f"""
        WITH RECURSIVE {_ALACARTE_PARTS}, {_FLOW}
        SELECT customer_id, -points AS points_amount, 'REDEMPTION' AS transaction_type, $now AS transaction_date,
            'Voucher redemption' AS description FROM paid WHERE points IS NOT NULL""",
    "alacarte_flow_customers": f"""
        WITH RECURSIVE {_ALACARTE_PARTS}, {_FLOW}, {_SETTLED}
        SELECT customer_id, old_balance, points_balance, points_expiry_date, coalesce(reached, tier_id) AS tier_id FROM settled""",
    "alacarte_flow_history": f"""
        WITH RECURSIVE {_ALACARTE_PARTS}, {_FLOW}, {_SETTLED},
        u AS (SELECT customer_id, tier_id AS old_tier_id, reached AS new_tier_id FROM settled WHERE reached <> tier_id)
        SELECT u.customer_id, u.old_tier_id, u.new_tier_id, $now AS change_date, {_CHANGE_REASON} AS change_reason,
            'SYSTEM' AS changed_by FROM u""",
    "alacarte_flow_holdings": f"""
        WITH RECURSIVE {_ALACARTE_PARTS}, {_FLOW}
        SELECT h.customer_id, h.promotion_id, h.date_acquired, 'Y' AS is_used, $now AS used_date, h.acquisition_method
        FROM ly_customer_promotions h WHERE (h.customer_id, h.promotion_id) IN (SELECT (customer_id, promotion_id) FROM paid)""",
    "ledger_stream": """
        SELECT c.customer_id, c.points_balance AS old_balance,
            c.points_balance + CAST(sum(t.points_amount) AS BIGINT) AS points_balance
        FROM ly_customers c JOIN ly_point_transactions t ON t.customer_id = c.customer_id
        GROUP BY c.customer_id, c.points_balance""",
    "order_totals_stream": """
        SELECT o.order_id, CAST(sum(l.price * l.quantity) AS DOUBLE) AS total_amount,
            CAST(sum(l.discount_applied * l.quantity) AS DOUBLE) AS discount_amount,
            CAST(sum((l.price - l.discount_applied) * l.quantity) AS DOUBLE) AS final_amount
        FROM ly_orders o JOIN ly_order_items l ON l.order_id = o.order_id GROUP BY o.order_id""",
    "check_violations": _check_sql(),
    "fk_violations": _fk_sql(),
    "unique_violations": _unique_sql(),
    "cascade_delete": f"""
        WITH {_DOOMED}
        SELECT 'menu_items' AS table_name, CAST(item_id AS VARCHAR) AS row_key FROM gone_items
        UNION ALL SELECT 'promotions', CAST(promotion_id AS VARCHAR) FROM gone_promotions
        UNION ALL SELECT 'order_items', CAST(order_item_id AS VARCHAR) FROM ly_order_items
            WHERE item_id IN (SELECT item_id FROM gone_items)
        UNION ALL SELECT 'redemptions', CAST(redemption_id AS VARCHAR) FROM ly_redemptions WHERE {_GONE_REDEMPTION}
        UNION ALL SELECT 'point_transactions', CAST(transaction_id AS VARCHAR) FROM ly_point_transactions
            WHERE promotion_id IN (SELECT promotion_id FROM gone_promotions)
        UNION ALL SELECT 'customer_promotions', {_key_text("customer_promotions")} FROM ly_customer_promotions
            WHERE promotion_id IN (SELECT promotion_id FROM gone_promotions)
        UNION ALL SELECT 'set_meal_components', {_key_text("set_meal_components")} FROM ly_set_meal_components
            WHERE set_meal_id IN (SELECT item_id FROM gone_items) OR component_id IN (SELECT item_id FROM gone_items)""",
    "cascade_kept_redemptions": f"""
        WITH {_DOOMED}
        SELECT redemption_id, customer_id, promotion_id, order_id, points_used, redemption_date, redemption_status,
            item_id, CAST(discount_value AS DOUBLE) AS discount_value
        FROM ly_redemptions WHERE NOT coalesce({_GONE_REDEMPTION}, false)""",
    "apply_defaults": """
        SELECT customer_id, tier_id, CAST(0 AS BIGINT) AS points_balance, 'N' AS is_member,
            'ACTIVE' AS membership_status, $now AS join_date, renewal_count, CAST(NULL AS TIMESTAMP) AS last_visit_date
        FROM ly_customers""",
    "assign_keys": """
        SELECT 1000 + row_number() OVER (ORDER BY date_acquired, customer_id, promotion_id) AS holding_id, customer_id,
            promotion_id, date_acquired FROM ly_customer_promotions""",
    "evolve_redemptions": """
        SELECT redemption_id, customer_id, promotion_id, order_id, points_used, redemption_date, redemption_status,
            item_id, CAST(v AS DOUBLE) AS discount_value
        FROM (SELECT *, CAST(NULL AS DOUBLE) AS v FROM ly_redemptions
              UNION ALL SELECT *, points_used / 100 FROM ly_redemptions)""",
}
SQL["tier_changes_today"] = SQL["tier_change_history"] + " WHERE h.change_date >= $day0"


def check_sql() -> dict[str, str]:
    return {
        name: duckdb_prelude(text.replace("$now", NOW).replace("$day0", DAY0)) for name, text in SQL.items()
    }
