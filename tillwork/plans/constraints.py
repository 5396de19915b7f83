"""Table constraints as data-quality checks.

Each check returns rows of (tbl, rule, subject, violations); a null passes every
rule but the null check, as it does in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.model import NUMBER_LIMITS, STATUSES, TEXT_LIMITS, Star
from tillwork.operators.hot import spread


class ConstraintError(Exception):
    """A table breaks one of its constraints."""


# A rule about single rows: its kind, what it is about, and when a row breaks it.
Rule = tuple[str, str, Column]


def not_null(columns: list[str]) -> list[Rule]:
    return [("not null", c, F.col(c).isNull()) for c in columns]


def checks(conditions: dict[str, Column]) -> list[Rule]:
    return [("check", name, ~ok) for name, ok in conditions.items()]


def widths(
    text: dict[str, int] | None = None, numbers: dict[str, tuple[int, int]] | None = None
) -> list[Rule]:
    """Texts longer than allowed, and numbers that do not fit (precision, scale)."""
    rules: list[Rule] = [("width", c, F.length(c) > n) for c, n in (text or {}).items()]
    for c, (precision, scale) in (numbers or {}).items():
        fits = F.col(c).try_cast(f"decimal({precision},{scale})").isNotNull()
        rules.append(("width", c, F.col(c).isNotNull() & ~fits))
    return rules


def row_violations(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """Rows breaking each rule; one pass counts them all."""
    counts = df.agg(*[F.count_if(broken).alias(f"_{n}") for n, (_, _, broken) in enumerate(rules)])
    found = [
        F.struct(
            F.lit(table).alias("tbl"),
            F.lit(kind).alias("rule"),
            F.lit(subject).alias("subject"),
            F.col(f"_{n}").alias("violations"),
        )
        for n, (kind, subject, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*found)))


def rule_samples(df: DataFrame, table: str, rules: list[Rule], key: str) -> DataFrame:
    """``row_violations`` with the least and greatest ``key`` of the rows that break each rule.

    One pass counts and names them, whatever their number."""
    named = F.col(key)
    counts = df.agg(
        *[
            F.struct(
                F.lit(table).alias("tbl"),
                F.lit(kind).alias("rule"),
                F.lit(subject).alias("subject"),
                F.count_if(broken).alias("violations"),
                F.min(F.when(broken, named)).alias("first"),
                F.max(F.when(broken, named)).alias("last"),
            ).alias(f"_{n}")
            for n, (kind, subject, broken) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(F.array(*counts.columns)))


def any_broken(rules: list[Rule]) -> Column:
    """How many rows break a rule, in one measure."""
    nothing = F.lit(False)
    return F.count_if(reduce(Column.__or__, [F.coalesce(b, nothing) for _, _, b in rules], nothing))


def measures(df: DataFrame, rules: list[Rule]) -> dict[str, Column]:
    """What one pass over ``df`` tells: its rows, how many break each rule, and two of those."""
    row = F.struct(*df.columns)
    out = {"rows": F.count(F.lit(1))}
    for n, (_, _, broken) in enumerate(rules):
        out[f"broken_{n}"] = F.count_if(broken)
        out[f"first_{n}"] = F.min(F.when(broken, row))
        out[f"last_{n}"] = F.max(F.when(broken, row))
    return out


def broken_rules(table: str, rules: list[Rule], seen: dict) -> list[str]:
    """A line for each rule that rows of the table break, with the first and last of them."""
    lines = []
    for n, (kind, subject, _) in enumerate(rules):
        if seen[f"broken_{n}"]:
            rows = [seen[f"first_{n}"], seen[f"last_{n}"]]
            rows = rows[: min(seen[f"broken_{n}"], 2)]
            named = "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows)
            lines.append(f"{table}: {kind} ({subject}): {seen[f'broken_{n}']} such as {named}")
    return lines


def null_violations(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return row_violations(df, table, not_null(columns))


def check_violations(df: DataFrame, table: str, conditions: dict[str, Column]) -> DataFrame:
    return row_violations(df, table, checks(conditions))


def width_violations(
    df: DataFrame,
    table: str,
    text: dict[str, int] | None = None,
    numbers: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    return row_violations(df, table, widths(text, numbers))


def _repeated(df: DataFrame, key: list[str]) -> DataFrame:
    groups = df.dropna(subset=key).groupBy(*key, spread(*key))
    return groups.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)


def unique_violations(df: DataFrame, table: str, keys: list[list[str]]) -> DataFrame:
    """For each key, the number of its values that occur more than once.

    Several keys are counted in one pass, grouped by each of them in turn.
    """
    names = [", ".join(key) for key in keys]
    if len(keys) == 1:
        groups = [F.lit(True)]
        counted = _repeated(df, keys[0])
    else:
        columns = list(dict.fromkeys(c for key in keys for c in key))
        # The bits of grouping_id(), highest first, are set for columns outside the key.
        numbers = [int("".join("01"[c not in key] for c in columns), 2) for key in keys]
        counted = (
            df.groupingSets([[F.col(c) for c in key] for key in keys], *columns)
            .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
            .filter(F.col("_n") > 1)
        )
        groups = [
            reduce(Column.__and__, [F.col(c).isNotNull() for c in key], F.col("_set") == number)
            for key, number in zip(keys, numbers, strict=True)
        ]
    counts = counted.agg(*[F.count_if(group).alias(f"_{n}") for n, group in enumerate(groups)])
    found = [
        F.struct(
            F.lit(table).alias("tbl"),
            F.lit("unique").alias("rule"),
            F.lit(name).alias("subject"),
            F.col(f"_{n}").alias("violations"),
        )
        for n, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*found)))


def unique_violation_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key occurs more than once."""
    return df.join(_repeated(df, key).select(*key), key, "left_semi")


def _orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str | None) -> DataFrame:
    keys = parent.select(F.col(parent_key or column).alias(column))
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def foreign_key_violations(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str | None = None
) -> DataFrame:
    """The number of rows whose value is no key of ``parent``."""
    # Counted per value first, so a value in very many rows does not skew the join.
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return _orphans(values, column, parent, parent_key).agg(
        F.lit(table).alias("tbl"),
        F.lit("foreign key").alias("rule"),
        F.lit(column).alias("subject"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"),
    )


def foreign_key_violation_rows(
    df: DataFrame, column: str, parent: DataFrame, parent_key: str | None = None
) -> DataFrame:
    """The rows whose value is no key of ``parent``."""
    return _orphans(df, column, parent, parent_key)


def operational_rules() -> dict[str, list[Rule]]:
    """The rules about single rows of the operational tables."""
    order_checks = {
        "quantity > 0": F.col("quantity") > 0,
        "status is known": F.col("status").isin(*STATUSES),
    }
    return {
        "customers": not_null(["customer_id", "full_name", "email", "city"])
        + widths(TEXT_LIMITS["customers"]),
        "products": not_null(["product_id", "title", "category", "price"])
        + widths(TEXT_LIMITS["products"], NUMBER_LIMITS["products"]),
        "orders": not_null(
            ["order_id", "customer_id", "product_id", "quantity", "order_date", "status"]
        )
        + checks(order_checks)
        + widths(TEXT_LIMITS["orders"]),
        "payments": not_null(["payment_id", "order_id", "payment_date", "amount", "method"])
        + checks({"amount > 0": F.col("amount") > 0})
        + widths(TEXT_LIMITS["payments"], NUMBER_LIMITS["payments"]),
    }


def operational_key_violations(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    payments: DataFrame | None = None,
) -> DataFrame:
    """Repeated and unknown keys of the operational tables."""
    parts = [
        unique_violations(customers, "customers", [["customer_id"], ["email"]]),
        unique_violations(products, "products", [["product_id"]]),
        unique_violations(orders, "orders", [["order_id"]]),
        foreign_key_violations(orders, "orders", "customer_id", customers),
        foreign_key_violations(orders, "orders", "product_id", products),
    ]
    if payments is not None:
        parts += [
            unique_violations(payments, "payments", [["payment_id"]]),
            foreign_key_violations(payments, "payments", "order_id", orders),
        ]
    return reduce(DataFrame.unionByName, parts)


def _with_rows(tables: dict[str, DataFrame], rules: dict[str, list[Rule]], keys: DataFrame) -> DataFrame:
    parts = [row_violations(df, name, rules[name]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, [*parts, keys])


def operational_violations(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    payments: DataFrame | None = None,
) -> DataFrame:
    """All constraints of the operational tables."""
    tables = {"customers": customers, "products": products, "orders": orders}
    if payments is not None:
        tables["payments"] = payments
    keys = operational_key_violations(customers, products, orders, payments)
    return _with_rows(tables, operational_rules(), keys)


def star_rules(star: Star) -> dict[str, list[Rule]]:
    """The rules about single rows of the star."""
    facts = [c for c in star.fact_orders.columns if not c.endswith("_key")]
    return {
        "dim_customers": not_null(["customer_key", "customer_id", "full_name", "email", "city"])
        + widths(TEXT_LIMITS["customers"]),
        "dim_products": not_null(["product_key", "product_id", "title", "category", "price"])
        + widths(TEXT_LIMITS["products"], NUMBER_LIMITS["products"]),
        "dim_date": not_null(star.dim_date.columns),
        "fact_orders": not_null(facts)
        + checks({"status is known": F.col("status").isin(*STATUSES)})
        + widths(TEXT_LIMITS["orders"], NUMBER_LIMITS["fact_orders"]),
    }


def star_key_violations(star: Star, fact_keys: list[list[str]]) -> DataFrame:
    """Repeated keys of the star; its foreign keys are for ``star.unresolved_keys``."""
    parts = [
        unique_violations(star.dim_customers, "dim_customers", [["customer_key"], ["customer_id"]]),
        unique_violations(star.dim_products, "dim_products", [["product_key"], ["product_id"]]),
        unique_violations(star.dim_date, "dim_date", [["date_key"], ["full_date"]]),
        unique_violations(star.fact_orders, "fact_orders", fact_keys),
    ]
    return reduce(DataFrame.unionByName, parts)


def star_violations(star: Star, fact_keys: list[list[str]]) -> DataFrame:
    """All constraints of the star but its foreign keys, which ``star.unresolved_keys`` counts."""
    return _with_rows(star.tables(), star_rules(star), star_key_violations(star, fact_keys))


def enforce(violations: DataFrame) -> None:
    """Raises if a rule is broken; there is one row per rule, so this collects few."""
    broken = violations.filter(F.col("violations") > 0).collect()
    if broken:
        lines = [f"{r['tbl']}: {r['rule']} ({r['subject']}): {r['violations']}" for r in broken]
        raise ConstraintError("; ".join(lines))
