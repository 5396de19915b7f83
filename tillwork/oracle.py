"""The same queries in plain SQL, as an independent check of their results.

Written for DuckDB over the unmodified test tables. Rounding is done in whole
cents, so that it does not depend on how an engine divides.
"""

from __future__ import annotations

from tillwork.model import STATUSES
from tillwork.plans import generate

_HEADER_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END"
)
_LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def _mean(total: str, n: str) -> str:
    """total / n to two places, half up, for totals that are not negative."""
    return (
        f"CAST(((2 * CAST({total} * 100 AS HUGEINT) + {n}) // (2 * {n})) / 100 AS DECIMAL(18,2))"
    )


def _percent(part: str, whole: str) -> str:
    """part of whole in percent to two places, half up, for counts."""
    return (
        f"CAST(((2 * 10000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole})) / 100 "
        "AS DECIMAL(18,2))"
    )


_TABLES: dict[str, str] = {
    "customers_v": """
        SELECT c_custkey AS customer_id, c_name AS full_name,
               concat('c', CAST(c_custkey AS VARCHAR), '@example.com') AS email,
               n_name AS city, CAST(NULL AS DATE) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products_v": """
        SELECT p_partkey AS product_id, p_name AS title, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM part""",
    "heads_v": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, {_HEADER_STATUS} AS status
        FROM orders""",
    "payments_v": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id,
               CAST(o_orderdate AS DATE) AS payment_date,
               CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderpriority AS method
        FROM orders""",
    "orders_v": f"""
        SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE {_HEADER_STATUS} END AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "orders_u": f"""
        SELECT l.order_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE {_HEADER_STATUS} END AS status
        FROM (SELECT *, row_number() OVER (ORDER BY {_LINE_ORDER}) AS order_id FROM lineitem) l
        JOIN orders ON l_orderkey = o_orderkey""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
               CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
               CAST(day(d) AS SMALLINT) AS day, CAST(isodow(d) AS SMALLINT) AS day_of_week,
               dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM orders_v)""",
    "fact": """
        SELECT order_id AS order_key, order_id, customer_id AS customer_key,
               product_id AS product_key,
               CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
               quantity, price AS unit_price,
               CAST(quantity * price AS DECIMAL(12,2)) AS total_amount, status, order_date
        FROM orders_u JOIN products_v USING (product_id)""",
    "done": "SELECT * FROM fact WHERE status = 'completed'",
    "monthly": f"""
        SELECT strftime(order_date, '%Y-%m') AS month,
               CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_revenue,
               count(*) AS order_count,
               {_mean("sum(total_amount)", "count(*)")} AS avg_order_value
        FROM done GROUP BY 1""",
    "by_category": f"""
        SELECT category, CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS units_sold,
               {_mean("sum(unit_price)", "count(*)")} AS avg_price
        FROM done JOIN products_v ON product_key = product_id GROUP BY 1""",
    "by_customer": """
        SELECT customer_id, full_name, city, count(*) AS order_count,
               CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_spend,
               min(order_date) AS first_order_date, max(order_date) AS last_order_date,
               CAST(date_diff('day', max(order_date), DATE '2002-01-01') AS INTEGER)
                   AS days_since_last_order
        FROM done JOIN customers_v ON customer_key = customer_id GROUP BY 1, 2, 3""",
    "daily": """
        SELECT order_date AS sale_date, CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_revenue,
               count(*) AS order_count, count(DISTINCT customer_key) AS unique_customers
        FROM done GROUP BY 1""",
    "customers_raw": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CASE WHEN c_custkey % 20 = 3 THEN '' ELSE c_name END AS full_name,
               CASE WHEN c_custkey % 20 = 5 THEN ''
                    WHEN c_custkey % 20 = 7
                        THEN concat('c', CAST(c_custkey AS VARCHAR), 'example.com')
                    WHEN c_custkey % 20 = 9
                        THEN concat('C', CAST(c_custkey - 1 AS VARCHAR), '@Example.com')
                    ELSE concat('c', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
               CASE WHEN c_custkey % 40 = 8 THEN '   ' ELSE n_name END AS city,
               CASE WHEN c_custkey % 20 = 11 THEN 'not-a-date'
                    WHEN c_custkey % 20 = 13 THEN NULL
                    WHEN c_custkey % 20 = 14 THEN '2024'
                    WHEN c_custkey % 20 = 15 THEN '2024-1-5' ELSE '2024-01-15' END AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "products_raw": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 20 = 3 THEN '' ELSE p_name END AS title,
               CASE WHEN p_partkey % 20 = 5 THEN '' ELSE p_type END AS category,
               CASE WHEN p_partkey % 25 = 7 THEN 'N/A' WHEN p_partkey % 33 = 8 THEN '-5.00'
                    WHEN p_partkey % 50 = 9 THEN '0'
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price
        FROM part""",
    "orders_raw": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 25 = 4 THEN '-99999999'
                    ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN o_orderkey % 25 = 6 THEN '-88888888'
                    ELSE CAST(o_orderkey % (SELECT count(*) FROM part) AS VARCHAR)
                    END AS product_id,
               CASE WHEN o_orderkey % 100 IN (1, 2, 3) THEN '0'
                    WHEN o_orderkey % 100 IN (4, 5) THEN '-2'
                    WHEN o_orderkey % 100 IN (6, 7) THEN 'two'
                    ELSE CAST(1 + o_orderkey % 5 AS VARCHAR) END AS quantity,
               CASE WHEN o_orderkey % 33 = 10 THEN '2025-13-40'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
               CASE WHEN o_orderkey % 20 = 9 THEN 'shipped' ELSE {_HEADER_STATUS} END AS status
        FROM orders""",
}


def _cleaning(customers: str, products: str, orders: str, prefix: str) -> dict[str, str]:
    """CTEs that clean three raw relations: <prefix>customers, ... with a column ``why``."""
    date_shape = "'^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$'"
    c, p, o = (prefix + n for n in ("customers", "products", "orders"))
    return {
        f"{c}_rules": f"""
            SELECT *, trim(coalesce(email, '')) AS e,
                   trim(coalesce(email, '')) LIKE '%@%' AND
                   regexp_extract(trim(coalesce(email, '')), '[^@]*$') LIKE '%.%' AS e_ok,
                   trim(coalesce(full_name, '')) = '' AS no_name,
                   trim(coalesce(city, '')) = '' AS no_city,
                   trim(coalesce(signup_date, '')) <> '' AND
                   (NOT regexp_matches(trim(signup_date), {date_shape})
                    OR try_cast(signup_date AS DATE) IS NULL) AS bad_date
            FROM {customers}""",
        f"{c}_first": f"""
            SELECT *, min(CAST(customer_id AS BIGINT))
                          FILTER (WHERE e_ok AND NOT no_name AND NOT no_city AND NOT bad_date)
                          OVER (PARTITION BY lower(e)) AS first_id
            FROM {c}_rules""",
        c: f"""
            SELECT customer_id, full_name, email, city, signup_date,
                   concat_ws('; ', CASE WHEN no_name THEN 'missing full_name' END,
                       CASE WHEN e = '' THEN 'missing email'
                            WHEN NOT e_ok THEN 'invalid email format'
                            WHEN CAST(customer_id AS BIGINT) > first_id THEN 'duplicate email' END,
                       CASE WHEN no_city THEN 'missing city' END,
                       CASE WHEN bad_date THEN 'invalid signup_date' END) AS why
            FROM {c}_first""",
        p: f"""
            SELECT *, concat_ws('; ',
                       CASE WHEN try_cast(price AS DOUBLE) IS NULL THEN 'invalid price'
                            WHEN CAST(price AS DOUBLE) <= 0 THEN 'price must be positive' END,
                       CASE WHEN title = '' THEN 'missing title' END,
                       CASE WHEN category = '' THEN 'missing category' END) AS why
            FROM {products}""",
        o: f"""
            SELECT o.*, concat_ws('; ',
                       CASE WHEN try_cast(quantity AS INTEGER) IS NULL THEN 'invalid quantity'
                            WHEN CAST(quantity AS INTEGER) <= 0
                                THEN 'quantity must be positive' END,
                       CASE WHEN status NOT IN ('completed', 'pending', 'returned', 'cancelled')
                            THEN 'invalid status' END,
                       CASE WHEN try_cast(order_date AS DATE) IS NULL
                            THEN 'invalid order_date' END,
                       CASE WHEN gc.customer_id IS NULL THEN 'customer_id not found' END,
                       CASE WHEN gp.product_id IS NULL THEN 'product_id not found' END) AS why
            FROM {orders} o
            LEFT JOIN (SELECT customer_id FROM {c} WHERE why = '') gc USING (customer_id)
            LEFT JOIN (SELECT product_id FROM {p} WHERE why = '') gp USING (product_id)""",
        f"{prefix}dead": f"""
            SELECT customer_id, full_name, email, city, signup_date,
                   'customers' AS source_table, why AS rejection_reason,
                   NULL AS product_id, NULL AS title, NULL AS category, NULL AS price,
                   NULL AS order_id, NULL AS quantity, NULL AS order_date, NULL AS status
            FROM {c} WHERE why <> ''
            UNION ALL
            SELECT NULL, NULL, NULL, NULL, NULL, 'products', why, product_id, title, category,
                   price, NULL, NULL, NULL, NULL
            FROM {p} WHERE why <> ''
            UNION ALL
            SELECT customer_id, NULL, NULL, NULL, NULL, 'orders', why, product_id, NULL, NULL,
                   NULL, order_id, quantity, order_date, status
            FROM {o} WHERE why <> ''""",
    }


def _draw(key: str, salt: str) -> str:
    return f"CAST(concat('0x', left(md5(concat('{salt}:', CAST({key} AS VARCHAR))), 15)) AS BIGINT)"


def _pick(key: str, salt: str, words: tuple[str, ...]) -> str:
    """One of the words, by a draw."""
    listed = ", ".join(f"'{w}'" for w in words)
    return f"(ARRAY[{listed}])[{_draw(key, '42' + salt)} % {len(words)} + 1]"


def _roll(key: str, field: int) -> str:
    """The number in the four hex digits a field owns, as a share of 65536."""
    digest = f"md5(concat('42:', CAST({key} AS VARCHAR)))"
    return f"CAST(concat('0x', substr({digest}, {4 * field + 1}, 4)) AS BIGINT)"


_TABLES |= _cleaning("customers_raw", "products_raw", "orders_raw", "ok_")
_TABLES |= {
    "gen_customers": f"""
        SELECT CAST(c.customer_id AS VARCHAR) AS customer_id,
               CASE WHEN {_roll("c.customer_id", 0)} < 3277 THEN '' ELSE c.full_name END
                   AS full_name,
               CASE WHEN roll < 3277 THEN '' WHEN roll < 6554 THEN replace(c.email, '@', '')
                    WHEN roll < 9830 THEN coalesce(l.email, c.email) ELSE c.email END AS email,
               CASE WHEN {_roll("c.customer_id", 2)} < 3277 THEN '' ELSE c.city END AS city,
               CASE WHEN {_roll("c.customer_id", 3)} < 3277 THEN 'not-a-date'
                    ELSE CAST(c.signup_date AS VARCHAR) END AS signup_date
        FROM (SELECT *, row_number() OVER (ORDER BY customer_id) AS nth,
                     {_roll("customer_id", 1)} AS roll FROM customers_v) c
        LEFT JOIN (SELECT *, row_number() OVER (ORDER BY customer_id) AS nth
                   FROM customers_v) l
             ON l.nth = {_draw("c.customer_id", "42lender")} % nullif(c.nth - 1, 0) + 1""",
    "gen_products": f"""
        SELECT CAST(product_id AS VARCHAR) AS product_id,
               CASE WHEN {_roll("product_id", 0)} < 3277 THEN '' ELSE title END AS title,
               CASE WHEN {_roll("product_id", 1)} < 3277 THEN '' ELSE category END
                   AS category,
               CASE WHEN roll < 2621 THEN 'N/A' WHEN roll < 4588 THEN CAST(-price AS VARCHAR)
                    WHEN roll < 5898 THEN '0' ELSE CAST(price AS VARCHAR) END AS price
        FROM (SELECT *, {_roll("product_id", 2)} AS roll FROM products_v)""",
    "gen_orders": f"""
        SELECT CAST(order_id AS VARCHAR) AS order_id,
               CASE WHEN {_roll("order_id", 0)} < 2621 THEN '-99999'
                    ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
               CASE WHEN {_roll("order_id", 1)} < 2621 THEN '-88888'
                    ELSE CAST(product_id AS VARCHAR) END AS product_id,
               CASE WHEN roll < 1966 THEN '0' WHEN roll < 3277 THEN '-2' WHEN roll < 4588 THEN 'two'
                    ELSE CAST(quantity AS VARCHAR) END AS quantity,
               CASE WHEN {_roll("order_id", 3)} < 1966 THEN '2025-13-40'
                    ELSE CAST(order_date AS VARCHAR) END AS order_date,
               CASE WHEN {_roll("order_id", 4)} < 3277 THEN 'shipped' ELSE status END
                   AS status
        FROM (SELECT *, {_roll("order_id", 2)} AS roll FROM orders_u)""",
}
_TABLES |= _cleaning("gen_customers", "gen_products", "gen_orders", "found_")
_TABLES |= {
    "typed_customers": """
        SELECT CAST(customer_id AS BIGINT) AS customer_id, nullif(full_name, '') AS full_name,
               lower(nullif(email, '')) AS email, nullif(trim(city), '') AS city,
               CASE WHEN regexp_matches(signup_date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
                    THEN try_cast(signup_date AS DATE) END AS signup_date
        FROM customers_raw""",
    "typed_products": """
        SELECT CAST(product_id AS BIGINT) AS product_id, nullif(title, '') AS title,
               nullif(category, '') AS category, try_cast(price AS DECIMAL(10,2)) AS price
        FROM products_raw""",
    "typed_orders": """
        SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
               CAST(product_id AS BIGINT) AS product_id, try_cast(quantity AS INTEGER) AS quantity,
               try_cast(order_date AS DATE) AS order_date, status
        FROM orders_raw""",
}

_TABLES |= {
    "payments_raw": """
        SELECT CAST(k AS VARCHAR) AS payment_id,
               CASE WHEN k % 25 = 4 THEN '-99999999' WHEN k % 100 = 31 THEN 'x'
                    ELSE CAST(k AS VARCHAR) END AS order_id,
               CASE WHEN k % 33 = 10 THEN '2025-13-40' ELSE CAST(payment_date AS VARCHAR) END
                   AS payment_date,
               CASE WHEN k % 20 = 3 THEN '0' WHEN k % 20 = 5 THEN 'ten'
                    WHEN k % 50 = 7 THEN '0.004' ELSE CAST(amount AS VARCHAR) END AS amount,
               CASE WHEN k % 20 = 9 THEN '' WHEN k % 100 = 41 THEN repeat(method, 20)
                    ELSE method END AS method
        FROM (SELECT payment_id AS k, * FROM payments_v)""",
    "ok_payments": """
        SELECT *, concat_ws('; ',
                   CASE WHEN try_cast(amount AS DECIMAL(10,2)) IS NULL THEN 'invalid amount'
                        WHEN CAST(amount AS DECIMAL(10,2)) <= 0 THEN 'amount must be positive' END,
                   CASE WHEN method = '' THEN 'missing method' END,
                   CASE WHEN try_cast(payment_date AS DATE) IS NULL
                        THEN 'invalid payment_date' END,
                   CASE WHEN order_id = 'x' THEN 'invalid order_id'
                        WHEN order_id = '-99999999' THEN 'order_id not found' END,
                   CASE WHEN length(method) > 20 THEN 'method too long' END) AS why
        FROM payments_raw""",
}

_TYPED_PAYMENT = (
    "CAST(payment_id AS BIGINT) AS payment_id, CAST(order_id AS BIGINT) AS order_id, "
    "CAST(payment_date AS DATE) AS payment_date, CAST(amount AS DECIMAL(10,2)) AS amount, method"
)
_STATUS_LIST = "('completed', 'pending', 'returned', 'cancelled')"


def _nulls_of(label: str, table: str, columns: str) -> list[str]:
    return [
        f"SELECT '{label}' AS tbl, 'not null' AS rule, '{c}' AS subject, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {table}"
        for c in columns.split()
    ]


def _unique_of(label: str, table: str, key: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in key.split(", "))
    return (
        f"SELECT '{label}' AS tbl, 'unique' AS rule, '{key}' AS subject, count(*) AS violations "
        f"FROM (SELECT 1 FROM {table} WHERE {present} GROUP BY {key} HAVING count(*) > 1)"
    )


def _broken(label: str, table: str, rule: str, subject: str, broken: str) -> str:
    return (
        f"SELECT '{label}' AS tbl, '{rule}' AS rule, '{subject}' AS subject, "
        f"count(*) FILTER (WHERE {broken}) AS violations FROM {table}"
    )


def _orphans(label: str, table: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{label}' AS tbl, 'foreign key' AS rule, '{column}' AS subject, "
        f"count(*) AS violations FROM {table} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {column} FROM {parent})"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _digits(column: str, precision: int) -> str:
    return f"{column} IS NOT NULL AND try_cast({column} AS DECIMAL({precision},2)) IS NULL"


_NULLS = {
    "customers": "customer_id full_name email city",
    "products": "product_id title category price",
    "orders": "order_id customer_id product_id quantity order_date status",
}
_ORDER_CHECKS = [
    _broken("orders", "typed_orders", "check", "quantity > 0", "NOT quantity > 0"),
    _broken(
        "orders", "typed_orders", "check", "status is known", f"NOT status IN {_STATUS_LIST}"
    ),
]
_PAYMENT_CHECK = _broken("payments", "payments_v", "check", "amount > 0", "NOT amount > 0")

_BODIES: dict[str, str] = {
    "q01_revenue_by_category": """
        SELECT category, count(order_id) AS total_orders,
               CAST(sum(quantity * price) AS DECIMAL(28,2)) AS total_revenue
        FROM orders_v JOIN products_v USING (product_id) WHERE status = 'completed' GROUP BY 1""",
    "q02_top_customers_by_payments": """
        SELECT full_name, city, count(order_id) AS orders_placed,
               CAST(sum(amount) AS DECIMAL(28,2)) AS total_spent
        FROM customers_v JOIN heads_v USING (customer_id) JOIN payments_v USING (order_id)
        WHERE status = 'completed' GROUP BY customer_id, full_name, city
        ORDER BY total_spent DESC, customer_id LIMIT 5""",
    "q03_monthly_payments": """
        SELECT strftime(date_trunc('month', payment_date), '%b %Y') AS month,
               count(payment_id) AS payments_received,
               CAST(sum(amount) AS DECIMAL(28,2)) AS monthly_revenue
        FROM payments_v JOIN heads_v USING (order_id) GROUP BY 1""",
    "q04_popular_products": """
        SELECT title, category, price, CAST(sum(quantity) AS BIGINT) AS units_sold,
               count(order_id) AS times_ordered
        FROM products_v JOIN orders_v USING (product_id) WHERE status <> 'returned'
        GROUP BY product_id, title, category, price
        ORDER BY units_sold DESC, product_id LIMIT 10""",
    "q05_customer_rank_in_city": """
        SELECT city, full_name, CAST(total AS DECIMAL(28,2)) AS total_spent,
               rank() OVER (PARTITION BY city ORDER BY total DESC) AS rank_in_city
        FROM (SELECT customer_id, full_name, city, sum(amount) AS total
              FROM customers_v JOIN heads_v USING (customer_id) JOIN payments_v USING (order_id)
              GROUP BY 1, 2, 3)""",
    "q06_running_revenue": """
        SELECT payment_date, amount,
               CAST(sum(amount) OVER (ORDER BY payment_date, payment_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2))
                    AS running_total
        FROM payments_v""",
    "q07_payment_vs_previous": """
        SELECT payment_id, payment_date, amount,
               lag(amount) OVER w AS previous_payment,
               CAST(amount - lag(amount) OVER w AS DECIMAL(11,2)) AS difference
        FROM payments_v WINDOW w AS (ORDER BY payment_date, payment_id)""",
    "q08_payment_vs_next": """
        SELECT payment_id, payment_date, amount,
               lead(amount) OVER w AS next_payment,
               CAST(lead(amount) OVER w - amount AS DECIMAL(11,2)) AS upcoming_change
        FROM payments_v WINDOW w AS (ORDER BY payment_date, payment_id)""",
    "q09_order_sequence": """
        SELECT full_name, order_id, order_date, status,
               row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id)
                   AS order_number
        FROM heads_v JOIN customers_v USING (customer_id)""",
    "q10_order_sizes": """
        SELECT order_id, full_name, title AS product, amount,
               CASE WHEN amount < 100000 THEN 'Small' WHEN amount < 300000 THEN 'Medium'
                    ELSE 'Large' END AS order_size
        FROM orders_v JOIN customers_v USING (customer_id) JOIN products_v USING (product_id)
        JOIN payments_v USING (order_id)""",
    "q11_never_completed": """
        SELECT full_name, email, city FROM customers_v
        WHERE customer_id NOT IN (SELECT customer_id FROM heads_v WHERE status = 'completed')""",
    "q12_preferred_payment_method": """
        SELECT city, method AS preferred_payment_method, usage_count
        FROM (SELECT city, method, count(*) AS usage_count,
                     rank() OVER (PARTITION BY city ORDER BY count(*) DESC) AS r
              FROM payments_v JOIN heads_v USING (order_id) JOIN customers_v USING (customer_id)
              GROUP BY 1, 2)
        WHERE r = 1""",
    "q13_return_rates": f"""
        SELECT title, total_orders, returns, {_percent("returns", "total_orders")}
                   AS return_rate_pct,
               CASE WHEN returns * 100 > 35 * total_orders THEN 'High Return Risk'
                    ELSE 'Normal' END AS return_flag
        FROM (SELECT product_id, title, count(order_id) AS total_orders,
                     count(*) FILTER (WHERE status = 'returned') AS returns
              FROM products_v JOIN orders_v USING (product_id) GROUP BY 1, 2)""",
    "r01_category_revenue": """
        SELECT category, CAST(sum(quantity * price) AS DECIMAL(28,2)) AS total_revenue
        FROM orders_v JOIN products_v USING (product_id) WHERE status = 'completed' GROUP BY 1""",
    "r02_top_customers": """
        SELECT customer_id, full_name, city,
               CAST(sum(quantity * price) AS DECIMAL(28,2)) AS total_spend
        FROM customers_v JOIN orders_v USING (customer_id) JOIN products_v USING (product_id)
        WHERE status = 'completed' GROUP BY 1, 2, 3 ORDER BY total_spend DESC, 1 LIMIT 5""",
    "r03_orders_by_status": "SELECT status, count(*) AS orders_count FROM orders_v GROUP BY 1",
    "star_dim_customers": "SELECT customer_id AS customer_key, * FROM customers_v",
    "star_dim_products": "SELECT product_id AS product_key, * FROM products_v",
    "star_dim_date": "SELECT * FROM dim_date",
    "star_fact_orders": "SELECT * EXCLUDE (order_date) FROM fact",
    "star_fact_of_clean_orders": """
        SELECT row_number() OVER (ORDER BY CAST(order_id AS BIGINT)) AS order_key,
               CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_key,
               o.product_id::BIGINT AS product_key,
               CAST(strftime(CAST(order_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
               CAST(quantity AS INTEGER) AS quantity,
               CAST(price AS DECIMAL(10,2)) AS unit_price,
               CAST(CAST(quantity AS INTEGER) * CAST(price AS DECIMAL(10,2)) AS DECIMAL(12,2))
                   AS total_amount, status
        FROM ok_orders o JOIN ok_products p ON o.product_id = p.product_id WHERE o.why = ''""",
    "star_unresolved_keys": """
        SELECT 'customer_key' AS key, count(*) AS rows FROM typed_orders
        WHERE customer_id NOT IN (SELECT customer_id FROM customers_v)
        UNION ALL SELECT 'product_key', count(*) FROM typed_orders
        WHERE product_id NOT IN (SELECT product_id FROM products_v)
        UNION ALL SELECT 'date_key', count(*) FROM typed_orders WHERE order_date IS NULL""",
    "star_unresolved_rows": """
        SELECT 'customer_key' AS key, count(*) AS rows, min(order_id) AS first_order,
               max(order_id) AS last_order FROM typed_orders
        WHERE customer_id NOT IN (SELECT customer_id FROM customers_v)
        UNION ALL SELECT 'product_key', count(*), min(order_id), max(order_id) FROM typed_orders
        WHERE product_id NOT IN (SELECT product_id FROM products_v)
        UNION ALL SELECT 'date_key', count(*), min(order_id), max(order_id) FROM typed_orders
        WHERE order_date IS NULL""",
    "v01_monthly_revenue": "SELECT * FROM monthly",
    "v02_category_performance": "SELECT * FROM by_category",
    "v03_customer_summary": "SELECT * FROM by_customer",
    "v04_repeat_customers": f"""
        SELECT customer_id, full_name, city, order_count, total_spend,
               (SELECT {_percent("count(*) FILTER (WHERE order_count >= 2)", "count(*)")}
                FROM by_customer) AS repeat_purchase_rate_pct
        FROM by_customer WHERE order_count >= 2""",
    "v05_daily_sales": "SELECT * FROM daily",
    "n01_kpi_summary": f"""
        SELECT (SELECT CAST(sum(total_revenue) AS DECIMAL(28,2)) FROM monthly) AS total_revenue,
               (SELECT count(*) FROM by_customer) AS total_customers,
               (SELECT CAST(sum(order_count) AS BIGINT) FROM monthly) AS total_orders,
               (SELECT category FROM by_category ORDER BY total_revenue DESC, category LIMIT 1)
                   AS best_category,
               (SELECT {_percent("count(*) FILTER (WHERE order_count >= 2)", "count(*)")}
                FROM by_customer) AS repeat_customer_rate_pct""",
    "n02_row_counts": _union(
        [
            f"SELECT '{label}' AS tbl, count(*) AS row_count FROM {table}"
            for label, table in (
                ("products", "products_v"),
                ("customers", "customers_v"),
                ("orders", "orders_u"),
                ("payments", "payments_v"),
                ("dim_customers", "customers_v"),
                ("dim_products", "products_v"),
                ("dim_date", "dim_date"),
                ("fact_orders", "fact"),
            )
        ]
    ),
    "n03_load_verification": """
        SELECT 'dim_customers' AS tbl, count(*) AS row_count,
               CAST(NULL AS DECIMAL(28,2)) AS completed_revenue FROM customers_v
        UNION ALL SELECT 'dim_products', count(*), NULL FROM products_v
        UNION ALL SELECT 'dim_date', count(*), NULL FROM dim_date
        UNION ALL SELECT 'fact_orders', count(*),
               CAST(sum(total_amount) FILTER (WHERE status = 'completed') AS DECIMAL(28,2))
        FROM fact""",
    "chart_monthly": "SELECT month, total_revenue FROM monthly",
    "chart_category": "SELECT category, total_revenue FROM by_category",
    "chart_top10": """
        SELECT full_name, total_spend FROM by_customer
        ORDER BY total_spend DESC, customer_id LIMIT 10""",
    "daily_sales_stored": "SELECT * FROM daily",
    "daily_sales_incremental": "SELECT * FROM daily",
    "daily_sales_changed_months": "SELECT * FROM daily",
    "v05_daily_sales_of_a_quarter": """
        SELECT * FROM daily WHERE year(sale_date) = 1996 AND quarter(sale_date) = 2""",
    "star_refused_loads": """
        SELECT load, true AS refused, (SELECT count(*) FROM heads_v) AS row_count
        FROM (VALUES ('no orders'), ('unknown customer'), ('unknown product'),
                     ('repeated order')) AS cases(load)""",
    "src_csv_null_words": f"""
        SELECT customer_id, nullif(full_name, '') AS full_name, nullif(email, '') AS email,
               CASE WHEN CAST(customer_id AS BIGINT) % 3 <> 1 THEN city END AS city,
               CASE WHEN CAST(customer_id AS BIGINT) % 3 <> 2 THEN signup_date END AS signup_date
        FROM customers_raw""",
    "dq_customers_clean": """
        SELECT CAST(customer_id AS BIGINT) AS customer_id, trim(full_name) AS full_name,
               trim(email) AS email, trim(city) AS city, CAST(signup_date AS DATE) AS signup_date
        FROM ok_customers WHERE why = ''""",
    "dq_customers_rejected": """
        SELECT customer_id, full_name, email, city, signup_date, 'customers' AS source_table,
               why AS rejection_reason
        FROM ok_customers WHERE why <> ''""",
    "dq_products_clean": """
        SELECT CAST(product_id AS BIGINT) AS product_id, title, category,
               CAST(price AS DECIMAL(10,2)) AS price
        FROM ok_products WHERE why = ''""",
    "dq_products_rejected": """
        SELECT product_id, title, category, price, 'products' AS source_table,
               why AS rejection_reason
        FROM ok_products WHERE why <> ''""",
    "dq_payments_clean": f"""
        SELECT {_TYPED_PAYMENT} FROM ok_payments WHERE why = ''""",
    "dq_payments_rejected": """
        SELECT payment_id, order_id, payment_date, amount, method, 'payments' AS source_table,
               why AS rejection_reason
        FROM ok_payments WHERE why <> ''""",
    "dq_payments_load": f"""
        SELECT {_TYPED_PAYMENT} FROM ok_payments
        WHERE why = '' AND order_id IN (SELECT order_id FROM ok_orders WHERE why = '')""",
    "dq_orders_clean": """
        SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
               CAST(product_id AS BIGINT) AS product_id, CAST(quantity AS INTEGER) AS quantity,
               CAST(order_date AS DATE) AS order_date, status
        FROM ok_orders WHERE why = ''""",
    "dq_orders_broken_parents": f"""
        SELECT order_id, customer_id, product_id, quantity, order_date, status,
               'orders' AS source_table, why AS rejection_reason
        FROM (SELECT *, concat_ws('; ',
                CASE WHEN quantity = 'two' THEN 'invalid quantity'
                     WHEN CAST(quantity AS BIGINT) <= 0 THEN 'quantity must be positive' END,
                CASE WHEN status NOT IN {_STATUS_LIST} THEN 'invalid status' END,
                CASE WHEN try_cast(order_date AS DATE) IS NULL THEN 'invalid order_date' END,
                CASE WHEN k % 10 IN (1, 2, 3) THEN 'invalid customer_id'
                     WHEN trim(customer_id) NOT IN (SELECT customer_id FROM ok_customers
                          WHERE why = '') THEN 'customer_id not found' END,
                CASE WHEN k % 15 = 1 THEN 'invalid product_id'
                     WHEN product_id NOT IN (SELECT product_id FROM ok_products WHERE why = '')
                     THEN 'product_id not found' END) AS why
              FROM (SELECT order_id, quantity, order_date, status, k,
                           CASE WHEN k % 10 = 1 THEN '' WHEN k % 10 = 2 THEN 'c' || customer_id
                                WHEN k % 10 = 3 THEN customer_id || '.5'
                                ELSE ' ' || customer_id END AS customer_id,
                           CASE WHEN k % 15 = 1 THEN 'none' ELSE product_id END AS product_id
                    FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM orders_raw)))
        WHERE why <> ''""",
    "dq_orders_rejected": """
        SELECT order_id, customer_id, product_id, quantity, order_date, status,
               'orders' AS source_table, why AS rejection_reason
        FROM ok_orders WHERE why <> ''""",
    "dq_dead_letter": "SELECT * FROM ok_dead",
    "dq_reason_counts": """
        SELECT source_table, reason, count(*) AS row_count
        FROM (SELECT source_table, unnest(string_split(rejection_reason, '; ')) AS reason
              FROM ok_dead) GROUP BY 1, 2""",
    "dq_load_counts": """
        SELECT 'customers' AS tbl, count(*) AS row_count FROM ok_customers WHERE why = ''
        UNION ALL SELECT 'products', count(*) FROM ok_products WHERE why = ''
        UNION ALL SELECT 'orders', count(*) FROM ok_orders WHERE why = ''
        UNION ALL SELECT 'rejected', count(*) FROM ok_dead""",
    "dq_operational_load": """
        SELECT 'customers' AS tbl, count(*) AS row_count FROM ok_customers WHERE why = ''
        UNION ALL SELECT 'products', count(*) FROM ok_products WHERE why = ''
        UNION ALL SELECT 'orders', count(*) FROM ok_orders WHERE why = ''
        UNION ALL SELECT 'dead_letter', count(*) FROM ok_dead""",
    "dq_constraints_nulls": _union(
        _nulls_of("customers", "typed_customers", _NULLS["customers"] + " signup_date")
        + _nulls_of("products", "typed_products", _NULLS["products"])
        + _nulls_of("orders", "typed_orders", _NULLS["orders"])
    ),
    "dq_constraints_samples": _union(
        [
            f"""SELECT 'orders' AS tbl, '{rule}' AS rule, '{subject}' AS subject,
                       count(*) AS violations, min(order_id) AS first, max(order_id) AS last
                FROM typed_orders WHERE {broken}"""
            for rule, subject, broken in [
                ("not null", "customer_id", "customer_id IS NULL"),
                ("not null", "product_id", "product_id IS NULL"),
                ("not null", "quantity", "quantity IS NULL"),
                ("not null", "order_date", "order_date IS NULL"),
                ("check", "quantity > 0", "quantity <= 0"),
                (
                    "check",
                    "status is known",
                    "status NOT IN ('completed', 'pending', 'returned', 'cancelled')",
                ),
            ]
        ]
    ),
    "dq_constraints_unique": _union(
        [
            _unique_of("customers", "typed_customers", "customer_id"),
            _unique_of("customers", "typed_customers", "email"),
            _unique_of("lines", "orders_v", "order_id"),
            _unique_of("lines", "orders_v", "order_id, product_id"),
            _unique_of("payments", "payments_v", "payment_id"),
        ]
    ),
    "dq_constraints_check": _union([*_ORDER_CHECKS, _PAYMENT_CHECK]),
    "dq_constraints_fk": _union(
        [
            _orphans("orders", "typed_orders", "customer_id", "customers_v"),
            _orphans("orders", "typed_orders", "product_id", "products_v"),
            _orphans("payments", "payments_v", "order_id", "heads_v"),
        ]
    ),
    "dq_constraints_width": _union(
        [
            _broken("customers", "typed_customers", "width", "email", "length(email) > 18"),
            _broken("products", "products_v", "width", "title", "length(title) > 9"),
            _broken("products", "products_v", "width", "price", _digits("price", 10)),
            _broken("payments", "payments_v", "width", "method", "length(method) > 20"),
            _broken("payments", "payments_v", "width", "amount", _digits("amount", 7)),
        ]
    ),
    "dq_constraints_all": _union(
        [
            *_nulls_of("customers", "typed_customers", _NULLS["customers"]),
            *_nulls_of("products", "typed_products", _NULLS["products"]),
            *_nulls_of("orders", "typed_orders", _NULLS["orders"]),
            *_nulls_of(
                "payments", "payments_v", "payment_id order_id payment_date amount method"
            ),
            _unique_of("customers", "typed_customers", "customer_id"),
            _unique_of("customers", "typed_customers", "email"),
            _unique_of("products", "typed_products", "product_id"),
            _unique_of("orders", "typed_orders", "order_id"),
            _unique_of("payments", "payments_v", "payment_id"),
            *_ORDER_CHECKS,
            _PAYMENT_CHECK,
            _broken("customers", "typed_customers", "width", "full_name", "length(full_name) > 100"),
            _broken("customers", "typed_customers", "width", "email", "length(email) > 100"),
            _broken("customers", "typed_customers", "width", "city", "length(city) > 50"),
            _broken("products", "typed_products", "width", "title", "length(title) > 150"),
            _broken("products", "typed_products", "width", "category", "length(category) > 50"),
            _broken("products", "typed_products", "width", "price", _digits("price", 10)),
            _broken("orders", "typed_orders", "width", "status", "length(status) > 20"),
            _broken("payments", "payments_v", "width", "method", "length(method) > 20"),
            _broken("payments", "payments_v", "width", "amount", _digits("amount", 10)),
            _orphans("orders", "typed_orders", "customer_id", "typed_customers"),
            _orphans("orders", "typed_orders", "product_id", "typed_products"),
            _orphans("payments", "payments_v", "order_id", "typed_orders"),
        ]
    ),
    "star_constraints": _union(
        [
            *_nulls_of(
                "dim_customers",
                "(SELECT customer_id AS customer_key, * FROM customers_v)",
                "customer_key customer_id full_name email city",
            ),
            *_nulls_of(
                "dim_products",
                "(SELECT product_id AS product_key, * FROM products_v)",
                "product_key product_id title category price",
            ),
            *_nulls_of(
                "dim_date",
                "dim_date",
                "date_key full_date year quarter month month_name day day_of_week day_name "
                "is_weekend",
            ),
            *_nulls_of("fact_orders", "orders_v", "order_id quantity status"),
            *_nulls_of("fact_orders", "fact", "unit_price total_amount"),
            _broken(
                "dim_customers", "customers_v", "width", "full_name", "length(full_name) > 100"
            ),
            _broken("dim_customers", "customers_v", "width", "email", "length(email) > 100"),
            _broken("dim_customers", "customers_v", "width", "city", "length(city) > 50"),
            _broken("dim_products", "products_v", "width", "title", "length(title) > 150"),
            _broken("dim_products", "products_v", "width", "category", "length(category) > 50"),
            _broken("dim_products", "products_v", "width", "price", _digits("price", 10)),
            _broken("fact_orders", "orders_v", "width", "status", "length(status) > 20"),
            _broken("fact_orders", "fact", "width", "unit_price", _digits("unit_price", 10)),
            _broken("fact_orders", "fact", "width", "total_amount", _digits("total_amount", 12)),
            _broken(
                "fact_orders",
                "orders_v",
                "check",
                "status is known",
                f"NOT status IN {_STATUS_LIST}",
            ),
            _unique_of("dim_customers", "customers_v", "customer_id").replace(
                "'customer_id' AS", "'customer_key' AS"
            ),
            _unique_of("dim_products", "products_v", "product_id").replace(
                "'product_id' AS", "'product_key' AS"
            ),
            _unique_of("dim_customers", "customers_v", "customer_id"),
            _unique_of("dim_products", "products_v", "product_id"),
            _unique_of("dim_date", "dim_date", "date_key"),
            _unique_of("dim_date", "dim_date", "full_date"),
            # Lines keep the id of their order here, so it repeats.
            _unique_of("fact_orders", "orders_v", "order_id"),
        ]
    ),
    "dq_duplicate_email_rows": """
        SELECT * FROM typed_customers WHERE email IN
            (SELECT email FROM typed_customers GROUP BY email HAVING count(*) > 1)""",
    "dq_orphan_order_rows": """
        SELECT * FROM typed_orders
        WHERE customer_id NOT IN (SELECT customer_id FROM customers_v)""",
    "ordered_dense_numbers": """
        SELECT payment_id, payment_date,
               row_number() OVER (ORDER BY payment_date, payment_id) AS payment_number
        FROM payments_v""",
    "dq_key_rules": """
        WITH copies(copy) AS (VALUES (0), (1)),
        rows AS (
            SELECT 'customers' AS source_table, 'customer_id' AS key_name, c_custkey AS k, copy,
                   CASE WHEN copy = 1 THEN c_name || ' again' WHEN c_custkey % 100 = 41
                        THEN repeat(c_name, 6) ELSE c_name END AS cell,
                   CASE WHEN c_custkey % 100 = 41 THEN 'full_name too long' END AS own
            FROM customer, copies
            UNION ALL
            SELECT 'products', 'product_id', p_partkey, copy,
                   CASE WHEN copy = 1 THEN p_name || ' again' WHEN p_partkey % 100 = 41
                        THEN repeat(p_name, 160) ELSE p_name END,
                   CASE WHEN p_partkey % 100 = 41 THEN 'title too long'
                        WHEN p_partkey % 100 = 51 THEN 'price must be positive' END
            FROM part, copies
            UNION ALL
            SELECT 'orders', 'order_id', o_orderkey, copy, CASE WHEN copy = 1 THEN '9' ELSE '1' END,
                   NULL
            FROM orders, copies)
        SELECT source_table, CASE WHEN k % 100 = 31 THEN 'x' ELSE '' END || k AS id, cell,
               CASE WHEN k % 100 = 31 THEN 'invalid ' || key_name
                    WHEN copy = 1 THEN 'duplicate ' || key_name ELSE own END AS rejection_reason
        FROM rows
        WHERE (copy = 0 OR k % 50 = 21) AND (k % 100 = 31 OR copy = 1 OR own IS NOT NULL)""",
    "src_csv_customers": """
        SELECT CAST(customer_id AS BIGINT) AS customer_id, trim(full_name) AS full_name,
               trim(email) AS email, trim(city) AS city, CAST(signup_date AS DATE) AS signup_date
        FROM ok_customers WHERE why = ''""",
    "src_file_order_ids": """
        SELECT row_number() OVER (ORDER BY product_id) AS product_id, title, category, price
        FROM products_v""",
    # CSV tells no empty cell from a missing one.
    "sink_dead_letter_csv": """
        SELECT * REPLACE (nullif(full_name, '') AS full_name, nullif(email, '') AS email,
                          nullif(city, '') AS city, nullif(title, '') AS title,
                          nullif(category, '') AS category) FROM ok_dead""",
    "gen_dirty_customers": "SELECT * FROM gen_customers",
    "gen_dirty_products": "SELECT * FROM gen_products",
    "gen_dirty_orders": "SELECT * FROM gen_orders",
    "gen_customers": f"""
        SELECT id AS customer_id, concat(first, ' ', last) AS full_name,
               concat(lower(first), '.', CAST(id AS VARCHAR), '@example.com') AS email, city,
               CAST(DATE '2002-01-01' - CAST({_draw("id", "42since")} % 366 AS INTEGER) AS DATE)
                   AS signup_date
        FROM (SELECT c_custkey AS id, {_pick("c_custkey", "first", generate.FIRST_NAMES)} AS first,
                     {_pick("c_custkey", "last", generate.LAST_NAMES)} AS last,
                     {_pick("c_custkey", "home", generate.CITIES)} AS city
              FROM customer) AS made(id, first, last, city)""",
    "gen_products": f"""
        SELECT p_partkey AS product_id,
               concat({_pick("p_partkey", "look", generate.LOOKS)}, ' ',
                      {_pick("p_partkey", "thing", generate.THINGS)}) AS title,
               {_pick("p_partkey", "kind", generate.CATEGORIES)} AS category,
               CAST(CAST(500 + {_draw("p_partkey", "42cents")} % 49501 AS DECIMAL(10,0)) / 100
                    AS DECIMAL(10,2)) AS price
        FROM part""",
    "gen_orders": f"""
        SELECT o_orderkey AS order_id,
               {_draw("o_orderkey", "42buyer")} % (SELECT count(*) FROM customer) + 1
                   AS customer_id,
               {_draw("o_orderkey", "42item")} % (SELECT count(*) FROM part) + 1 AS product_id,
               CAST({_draw("o_orderkey", "42units")} % 5 + 1 AS INTEGER) AS quantity,
               CAST(DATE '2002-01-01' - CAST({_draw("o_orderkey", "42when")} % 181 AS INTEGER)
                    AS DATE) AS order_date,
               {_pick("o_orderkey", "state", STATUSES)} AS status
        FROM orders""",
    "views_in_sql": """
        SELECT city, count(*) AS customers, CAST(sum(order_count) AS BIGINT) AS orders,
               count(*) FILTER (WHERE order_count >= 2) AS repeaters,
               max(days_since_last_order) AS longest_pause
        FROM by_customer GROUP BY 1""",
    "views_stored": """
        SELECT city, count(*) AS customers, CAST(sum(order_count) AS BIGINT) AS orders,
               count(*) FILTER (WHERE order_count >= 2) AS repeaters,
               max(days_since_last_order) AS longest_pause
        FROM by_customer GROUP BY 1""",
    "gen_reason_counts": """
        SELECT source_table, reason, count(*) AS row_count
        FROM (SELECT source_table, unnest(string_split(rejection_reason, '; ')) AS reason
              FROM found_dead) GROUP BY 1, 2""",
}
_BODIES["r04_month_over_month"] = """
    SELECT month, revenue, prev AS prev_month_revenue,
           CAST(revenue - prev AS DECIMAL(28,2)) AS mom_change,
           CAST(sign(revenue - prev)
                * ((2 * 10000 * CAST(abs(revenue - prev) * 100 AS HUGEINT)
                    + CAST(prev * 100 AS HUGEINT)) // nullif(2 * CAST(prev * 100 AS HUGEINT), 0))
                / 100 AS DECIMAL(18,2)) AS mom_change_pct
    FROM (SELECT *, lag(revenue) OVER (ORDER BY month) AS prev
          FROM (SELECT strftime(order_date, '%Y-%m') AS month,
                       CAST(sum(quantity * price) AS DECIMAL(28,2)) AS revenue
                FROM orders_v JOIN products_v USING (product_id)
                WHERE status = 'completed' GROUP BY 1))"""
_BODIES["sink_report"] = _BODIES["r04_month_over_month"]
_BODIES["sink_report_revenue_by_category"] = _BODIES["r01_category_revenue"]
_BODIES["sink_report_top_customers"] = _BODIES["r02_top_customers"]
_BODIES["sink_report_orders_by_status"] = _BODIES["r03_orders_by_status"]
_BODIES["sink_chart_files"] = _BODIES["chart_monthly"]
_BODIES["sink_kpi_json"] = _BODIES["n01_kpi_summary"]

# DuckDB evaluates only the relations a query refers to.
_WITH = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in _TABLES.items()) + "\n"

ORACLE: dict[str, str] = {
    name: body if body.lstrip().startswith("WITH") else _WITH + body
    for name, body in _BODIES.items()
}
