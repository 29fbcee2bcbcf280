"""The twelve loyalty tables: columns, keys, references, defaults and rules."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType

# Table layouts. Dates and times carry no zone.
_COLUMNS = {
    "membership_tiers": """
        tier_id BIGINT NOT NULL, tier_name STRING NOT NULL, points_required BIGINT NOT NULL,
        discount_percentage DECIMAL(5,2) NOT NULL, renewal_fee DECIMAL(10,2), birthday_bonus_points BIGINT,
        points_expiry_months BIGINT, base_earn_rate DECIMAL(5,2), created_date TIMESTAMP_NTZ""",
    "customers": """
        customer_id BIGINT NOT NULL, name STRING NOT NULL, email STRING NOT NULL, phone STRING NOT NULL,
        tier_id BIGINT NOT NULL, points_balance BIGINT, last_points_earned_date TIMESTAMP_NTZ,
        points_expiry_date TIMESTAMP_NTZ, membership_expiry_date TIMESTAMP_NTZ, is_member STRING,
        membership_status STRING, last_visit_date TIMESTAMP_NTZ, join_date TIMESTAMP_NTZ,
        birth_date TIMESTAMP_NTZ, last_renewal_date TIMESTAMP_NTZ, renewal_count BIGINT""",
    "menu_items": """
        item_id BIGINT NOT NULL, item_type STRING NOT NULL, name STRING NOT NULL, description STRING,
        base_price DECIMAL(10,2) NOT NULL, is_active STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ,
        current_stock BIGINT, initial_stock BIGINT""",
    "promotions": """
        promotion_id BIGINT NOT NULL, promotion_type STRING NOT NULL, name STRING NOT NULL,
        valid_from TIMESTAMP_NTZ NOT NULL, valid_to TIMESTAMP_NTZ NOT NULL, discount_value DECIMAL(10,2),
        voucher_code STRING, is_auto_assign STRING, points_required BIGINT, min_spend DECIMAL(10,2),
        set_meal_id BIGINT, applicable_tier_id BIGINT""",
    "orders": """
        order_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, order_date TIMESTAMP_NTZ,
        total_amount DECIMAL(10,2) NOT NULL, discount_amount DECIMAL(10,2), final_amount DECIMAL(10,2) NOT NULL,
        payment_method STRING, status STRING""",
    "point_transactions": """
        transaction_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, order_id BIGINT, promotion_id BIGINT,
        points_amount BIGINT NOT NULL, transaction_type STRING NOT NULL, transaction_date TIMESTAMP_NTZ NOT NULL,
        description STRING, expiry_date TIMESTAMP_NTZ""",
    "membership_history": """
        history_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, old_tier_id BIGINT, new_tier_id BIGINT NOT NULL,
        change_date TIMESTAMP_NTZ, change_reason STRING, changed_by STRING""",
    "customer_promotions": """
        customer_id BIGINT NOT NULL, promotion_id BIGINT NOT NULL, date_acquired TIMESTAMP_NTZ, is_used STRING,
        used_date TIMESTAMP_NTZ, acquisition_method STRING""",
    "redemptions": """
        redemption_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, promotion_id BIGINT NOT NULL, order_id BIGINT,
        points_used BIGINT NOT NULL, redemption_date TIMESTAMP_NTZ, redemption_status STRING, item_id BIGINT,
        discount_value DECIMAL(10,2)""",
    "set_meal_components": """
        set_meal_id BIGINT NOT NULL, component_id BIGINT NOT NULL, quantity BIGINT NOT NULL""",
    "order_items": """
        order_item_id BIGINT NOT NULL, order_id BIGINT NOT NULL, item_id BIGINT NOT NULL, quantity BIGINT,
        price DECIMAL(10,2) NOT NULL, discount_applied DECIMAL(10,2)""",
    "customer_activity": """
        activity_id BIGINT NOT NULL, customer_id BIGINT, activity_type STRING, activity_date TIMESTAMP_NTZ,
        ip_address STRING, details STRING""",
}

_TYPES = {"BIGINT": LongType(), "STRING": StringType(), "TIMESTAMP_NTZ": TimestampNTZType()}
_COLUMN = re.compile(r"(\w+) (?:(BIGINT|STRING|TIMESTAMP_NTZ)|DECIMAL\((\d+),(\d+)\))( NOT NULL)?")


def _struct(columns: str) -> StructType:
    return StructType([
        StructField(m[1], _TYPES[m[2]] if m[2] else DecimalType(int(m[3]), int(m[4])), not m[5])
        for m in _COLUMN.finditer(columns)
    ])


SCHEMAS: dict[str, StructType] = {name: _struct(columns) for name, columns in _COLUMNS.items()}
TABLES = tuple(SCHEMAS)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "membership_tiers": ("tier_id",),
    "customers": ("customer_id",),
    "menu_items": ("item_id",),
    "promotions": ("promotion_id",),
    "orders": ("order_id",),
    "point_transactions": ("transaction_id",),
    "membership_history": ("history_id",),
    "customer_promotions": ("customer_id", "promotion_id"),
    "redemptions": ("redemption_id",),
    "set_meal_components": ("set_meal_id", "component_id"),
    "order_items": ("order_item_id",),
    "customer_activity": ("activity_id",),
}

UNIQUE_COLUMNS: dict[str, tuple[str, ...]] = {
    "membership_tiers": ("tier_name",),
    "customers": ("email", "phone"),
    "promotions": ("voucher_code",),
}


@dataclass(frozen=True)
class Reference:
    """A foreign key; deleting the parent row deletes the child row."""

    child: str
    column: str
    parent: str

    @property
    def parent_key(self) -> str:
        return PRIMARY_KEYS[self.parent][0]


# The foreign keys, parents before children.
REFERENCES: tuple[Reference, ...] = (
    Reference("customers", "tier_id", "membership_tiers"),
    Reference("promotions", "set_meal_id", "menu_items"),
    Reference("promotions", "applicable_tier_id", "membership_tiers"),
    Reference("orders", "customer_id", "customers"),
    Reference("point_transactions", "customer_id", "customers"),
    Reference("point_transactions", "order_id", "orders"),
    Reference("point_transactions", "promotion_id", "promotions"),
    Reference("membership_history", "customer_id", "customers"),
    Reference("membership_history", "old_tier_id", "membership_tiers"),
    Reference("membership_history", "new_tier_id", "membership_tiers"),
    Reference("customer_promotions", "customer_id", "customers"),
    Reference("customer_promotions", "promotion_id", "promotions"),
    Reference("redemptions", "customer_id", "customers"),
    Reference("redemptions", "promotion_id", "promotions"),
    Reference("redemptions", "order_id", "orders"),
    Reference("redemptions", "item_id", "menu_items"),
    Reference("set_meal_components", "set_meal_id", "menu_items"),
    Reference("set_meal_components", "component_id", "menu_items"),
    Reference("order_items", "order_id", "orders"),
    Reference("order_items", "item_id", "menu_items"),
    Reference("customer_activity", "customer_id", "customers"),
)

# Declared defaults. ``NOW`` stands for the as-of time, ``USER`` for who makes the change.
NOW, USER = object(), object()
DEFAULTS: dict[str, dict[str, object]] = {
    "membership_tiers": {
        "renewal_fee": 0, "birthday_bonus_points": 0, "points_expiry_months": 12, "base_earn_rate": 1,
        "created_date": NOW,
    },
    "customers": {
        "points_balance": 0, "is_member": "N", "membership_status": "ACTIVE", "join_date": NOW, "renewal_count": 0,
    },
    "menu_items": {"is_active": "Y", "valid_from": NOW},
    "promotions": {"is_auto_assign": "N"},
    "orders": {"order_date": NOW, "discount_amount": 0, "status": "COMPLETED"},
    "point_transactions": {"transaction_date": NOW},
    "membership_history": {"change_date": NOW, "changed_by": USER},
    "customer_promotions": {"date_acquired": NOW, "is_used": "N"},
    "redemptions": {"redemption_date": NOW, "redemption_status": "COMPLETED"},
    "set_meal_components": {"quantity": 1},
    "order_items": {"quantity": 1, "discount_applied": 0},
    "customer_activity": {"activity_date": NOW},
}

# First id handed out by each table's sequence (1 where not listed).
FIRST_IDS = {"customers": 1001, "orders": 5001}

# Check rules. A row breaks a rule only when it is FALSE, not when it is NULL.
RULES: dict[str, dict[str, str]] = {
    "membership_tiers": {
        "points_required": "points_required >= 0",
        "discount_percentage": "discount_percentage BETWEEN 0 AND 100",
    },
    "customers": {
        "points_balance": "points_balance >= 0",
        "is_member": "is_member IN ('Y', 'N')",
        "membership_status": "membership_status IN ('ACTIVE', 'CANCELLED', 'PENDING')",
    },
    "menu_items": {
        "item_type": "item_type IN ('A_LA_CARTE', 'SET_MEAL', 'INGREDIENT', 'SEASONAL')",
        "base_price": "base_price >= 0",
        "is_active": "is_active IN ('Y', 'N')",
        "menu_dates": "valid_to IS NULL OR valid_to >= valid_from",
    },
    "promotions": {
        "promotion_type": "promotion_type IN ('VOUCHER', 'SEASONAL', 'SET_MEAL')",
        "is_auto_assign": "is_auto_assign IN ('Y', 'N')",
        "subtype_attributes": "CASE promotion_type WHEN 'VOUCHER' THEN discount_value IS NOT NULL"
        " WHEN 'SEASONAL' THEN points_required IS NOT NULL"
        " WHEN 'SET_MEAL' THEN set_meal_id IS NOT NULL ELSE FALSE END",
        "valid_dates": "valid_to >= valid_from",
    },
    "orders": {
        "total_amount": "total_amount >= 0",
        "discount_amount": "discount_amount >= 0",
        "final_amount": "final_amount >= 0",
        "payment_method": "payment_method IN ('CASH', 'CARD', 'ONLINE')",
        "status": "status IN ('COMPLETED', 'CANCELLED', 'REFUNDED')",
        "order_amounts": "final_amount = total_amount - discount_amount",
    },
    "point_transactions": {
        "transaction_type": "transaction_type IN ('PURCHASE', 'REDEMPTION', 'BONUS', 'ADJUSTMENT', 'EXPIRY')",
        "points_sign": "CASE WHEN transaction_type IN ('REDEMPTION', 'EXPIRY') THEN points_amount <= 0"
        " ELSE points_amount >= 0 END",
    },
    "membership_history": {
        "change_reason": "change_reason IN ('SIGNUP', 'RENEWAL', 'UPGRADE', 'DOWNGRADE', 'ADMIN', 'AUTO')",
    },
    "customer_promotions": {
        "is_used": "is_used IN ('Y', 'N')",
        "acquisition_method": "acquisition_method IN"
        " ('AUTO_TIER', 'TIER_UPGRADE', 'POINT_REDEEM', 'MANUAL', 'BIRTHDAY')",
        "used_date": "is_used = 'N' OR used_date IS NOT NULL",
    },
    "redemptions": {
        "points_used": "points_used >= 0",
        "redemption_status": "redemption_status IN ('COMPLETED', 'CANCELLED')",
    },
    "set_meal_components": {
        "quantity": "quantity > 0",
        "no_self_component": "set_meal_id <> component_id",
    },
    "order_items": {
        "quantity": "quantity > 0",
        "price": "price >= 0",
        "discount_applied": "discount_applied >= 0",
    },
    "customer_activity": {
        "activity_type": "activity_type IN ('LOGIN', 'ORDER', 'SEASONAL_REDEMPTION', 'SEASONAL_EXPIRATION',"
        " 'VOUCHER_REDEMPTION', 'VOUCHER_GENERATION', 'TIER_CHANGE', 'RENEWAL', 'EXPIRATION',"
        " 'VOUCHER_ASSIGNMENT', 'BIRTHDAY')",
    },
}

# Declared lengths of text columns.
LENGTHS: dict[str, dict[str, int]] = {
    "membership_tiers": {"tier_name": 20},
    "customers": {"name": 100, "email": 100, "phone": 15, "membership_status": 20},
    "menu_items": {"item_type": 20, "name": 100, "description": 200},
    "promotions": {"promotion_type": 20, "name": 100, "voucher_code": 50},
    "orders": {"payment_method": 50, "status": 20},
    "point_transactions": {"transaction_type": 20, "description": 200},
    "membership_history": {"change_reason": 100, "changed_by": 30},
    "customer_promotions": {"acquisition_method": 20},
    "redemptions": {"redemption_status": 20},
    "customer_activity": {"activity_type": 30, "ip_address": 45, "details": 4000},
}
for _table, _columns in LENGTHS.items():
    RULES[_table] |= {f"{_column}_length": f"LENGTH({_column}) <= {_most}" for _column, _most in _columns.items()}
