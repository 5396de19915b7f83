"""The metrics as views of the catalogue, for every session that shares it.

A stored view is SQL over the files of one published version, which its text names. Whoever
reads it, and however many versions are published meanwhile, sees that version whole. It moves
to the current one when it is stored again, each view at once; which version it shows stands in
its properties, and ``versions.remove_old`` keeps that version.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from tillwork.model import COMPLETED, MONEY_SUM
from tillwork.plans.versions import current_version, pin

VERSION = "tillwork.version"


def _mean(total: str, n: str) -> str:
    """To two places, half away from zero, of an exact sum; null for none."""
    return f"CAST(round({total} / nullif({n}, 0), 2) AS decimal(18,2))"


def _percent(part: str, whole: str) -> str:
    """A count as a percentage of another, half up, in whole hundredths; null of none."""
    part, whole = (f"CAST({x} AS {MONEY_SUM})" for x in (part, whole))
    hundredths = f"({part} * 20000 + {whole}) div nullif({whole} * 2, 0)"
    return f"CAST(CAST({hundredths} AS decimal(18,0)) / 100 AS decimal(18,2))"


def _sum(amount: str) -> str:
    return f"CAST(sum({amount}) AS {MONEY_SUM})"


def _definitions(folder: str, as_of: date | None) -> dict[str, str]:
    """The text of each view over the star in ``folder``."""
    fact, customers, products, days = (
        f"parquet.`{folder}/{name}`"
        for name in ("fact_orders", "dim_customers", "dim_products", "dim_date")
    )
    # Joined on the month as well, so that conditions on days prune the fact's folders.
    sold = f"""
        SELECT f.*, d.full_date FROM {fact} f JOIN {days} d
        ON f.date_key = d.date_key AND f.month_key = CAST(d.date_key div 100 AS int)
        WHERE f.status = '{COMPLETED}'"""
    today = f"DATE '{as_of.isoformat()}'" if as_of else "current_date()"
    summary = f"""
        SELECT customer_id, full_name, city, order_count, total_spend, first_order_date,
               last_order_date, datediff({today}, last_order_date) AS days_since_last_order
        FROM (SELECT customer_key, count(*) AS order_count, {_sum("total_amount")} AS total_spend,
                     min(full_date) AS first_order_date, max(full_date) AS last_order_date
              FROM ({sold}) GROUP BY customer_key)
        JOIN {customers} USING (customer_key)"""
    return {
        "vw_monthly_revenue": f"""
            SELECT date_format(_month, 'yyyy-MM') AS month, total_revenue, order_count,
                   {_mean("total_revenue", "order_count")} AS avg_order_value
            FROM (SELECT trunc(full_date, 'MM') AS _month, {_sum("total_amount")} AS total_revenue,
                         count(*) AS order_count FROM ({sold}) GROUP BY 1)
            ORDER BY month""",
        # Per product first: one row of each meets the dimension.
        "vw_category_performance": f"""
            SELECT category, {_sum("_revenue")} AS total_revenue, sum(_units) AS units_sold,
                   {_mean(_sum("_prices"), "sum(_orders)")} AS avg_price
            FROM (SELECT product_key, {_sum("total_amount")} AS _revenue, sum(quantity) AS _units,
                         {_sum("unit_price")} AS _prices, count(unit_price) AS _orders
                  FROM {fact} WHERE status = '{COMPLETED}' GROUP BY product_key)
            JOIN {products} USING (product_key) GROUP BY category
            ORDER BY total_revenue DESC, category""",
        "vw_customer_summary": f"{summary} ORDER BY total_spend DESC, customer_id",
        "vw_repeat_customers": f"""
            SELECT customer_id, full_name, city, order_count, total_spend,
                   (SELECT {_percent("count_if(order_count >= 2)", "count(*)")} FROM ({summary}))
                       AS repeat_purchase_rate_pct
            FROM ({summary}) WHERE order_count >= 2
            ORDER BY total_spend DESC, customer_id""",
    }


def _store(spark: SparkSession, name: str, root: str, version: str, text: str) -> None:
    # Pinned first, so that the version cannot go between.
    pin(spark, root, name, version)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') AS {text}"
    )


def store_views(
    spark: SparkSession, root: str, *, database: str = "default", as_of: date | None = None
) -> str:
    """Stores the metrics of the current version of the star below ``root`` as views of
    ``database``; returns the version. ``as_of`` is the day of reading if not given."""
    version = current_version(spark, root)
    for name, text in _definitions(f"{root}/v={version}", as_of).items():
        _store(spark, f"{database}.{name}", root, version, text)
    return version


def store_daily_sales_view(spark: SparkSession, root: str, *, database: str = "default") -> str:
    """Stores the current version of the daily sales below ``root`` as a view."""
    version = current_version(spark, root)
    text = f"SELECT * FROM parquet.`{root}/v={version}/daily_sales` ORDER BY sale_date"
    _store(spark, f"{database}.mvw_daily_sales", root, version, text)
    return version


def view_version(spark: SparkSession, name: str) -> str:
    """The version that a stored view shows."""
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{VERSION}')").first()["value"]
