"""The retail data model: column types, allowed values and the star."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# The four order states.
STATUSES = ("completed", "pending", "returned", "cancelled")
COMPLETED = "completed"
RETURNED = "returned"

PRICE = "decimal(10,2)"
LINE_AMOUNT = "decimal(12,2)"
# Sums get far more room than one line needs: at 10^12 rows the total of
# decimal(10,2) amounts no longer fits decimal(18,2).
MONEY_SUM = "decimal(28,2)"

# Raw feeds arrive as text; cleaning assigns the types.
RAW_CUSTOMERS = ("customer_id", "full_name", "email", "city", "signup_date")
RAW_PRODUCTS = ("product_id", "title", "category", "price")
RAW_ORDERS = ("order_id", "customer_id", "product_id", "quantity", "order_date", "status")
# Payment files carry no id: ``feeds.with_file_ids`` gives it.
RAW_PAYMENTS = ("payment_id", "order_id", "payment_date", "amount", "method")

# VARCHAR lengths of the operational tables.
TEXT_LIMITS = {
    "customers": {"full_name": 100, "email": 100, "city": 50},
    "products": {"title": 150, "category": 50},
    "orders": {"status": 20},
    "payments": {"method": 20},
}
# NUMERIC(precision, scale) of the operational tables.
NUMBER_LIMITS = {
    "products": {"price": (10, 2)},
    "payments": {"amount": (10, 2)},
    "fact_orders": {"unit_price": (10, 2), "total_amount": (12, 2)},
}


@dataclass(frozen=True)
class Star:
    """One fact and its three dimensions."""

    fact_orders: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    dim_date: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_customers": self.dim_customers,
            "dim_products": self.dim_products,
            "dim_date": self.dim_date,
            "fact_orders": self.fact_orders,
        }
