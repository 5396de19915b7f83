"""The star, its metrics, and stored versions of both."""

from dataclasses import replace
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.model import RAW_CUSTOMERS, RAW_ORDERS, RAW_PAYMENTS, RAW_PRODUCTS
from tillwork.plans import generate, metrics, publish, sinks, star, versions, views
from tillwork.plans.constraints import ConstraintError
from tillwork.sources.feeds import read_feed, with_file_ids

TODAY = date(2025, 6, 30)


def _ids(spark, n):
    return spark.range(1, n + 1)


@pytest.fixture(scope="module")
def tables(spark):
    customers = generate.make_customers(_ids(spark, 60), today=TODAY)
    products = generate.make_products(_ids(spark, 12))
    orders = generate.make_orders(_ids(spark, 500), customers=60, products=12, today=TODAY)
    return customers.cache(), products.cache(), orders.cache()


@pytest.fixture(scope="module")
def shop_star(tables):
    return star.build_star(*tables, dense_keys=True)


def test_date_dimension_spans_all_orders(tables):
    days = star.dim_date(tables[2])
    first, last = tables[2].agg(F.min("order_date"), F.max("order_date")).first()
    assert days.count() == (last - first).days + 1
    assert star.dim_date(tables[2].filter("false")).count() == 0


def test_fact_has_current_prices_and_dense_keys(tables, shop_star):
    orders = {r["order_id"]: r for r in tables[2].collect()}
    prices = dict(tuples(tables[1], "product_id", "price"))
    fact = shop_star.fact_orders.collect()
    assert [r["order_key"] for r in sorted(fact, key=lambda r: r["order_id"])] == list(
        range(1, 501)
    )
    for r in fact:
        o = orders[r["order_id"]]
        assert (r["customer_key"], r["product_key"]) == (o["customer_id"], o["product_id"])
        assert r["date_key"] == int(o["order_date"].strftime("%Y%m%d"))
        assert r["total_amount"] == prices[o["product_id"]] * o["quantity"]


def test_metrics_agree_with_each_other(shop_star):
    months = metrics.monthly_revenue(shop_star).agg(F.sum("total_revenue"), F.sum("order_count"))
    revenue, orders = months.first()
    kinds = metrics.category_performance(shop_star).agg(F.sum("total_revenue")).first()[0]
    days = metrics.daily_sales(shop_star).agg(F.sum("total_revenue"), F.sum("order_count")).first()
    summary = metrics.customer_summary(shop_star, TODAY)
    kpis = metrics.kpi_summary(shop_star).first()
    assert revenue == kinds == days[0] == kpis["total_revenue"]
    assert orders == days[1] == kpis["total_orders"]
    assert kpis["total_customers"] == summary.count()
    repeaters = metrics.repeat_customers(shop_star)
    rates = tuples(repeaters.select("repeat_purchase_rate_pct").distinct())
    assert rates == [(kpis["repeat_customer_rate_pct"],)]
    for r in summary.collect():
        assert r["days_since_last_order"] == (TODAY - r["last_order_date"]).days
    top = tuples(metrics.chart_series(shop_star)["top_customers"], "total_spend")
    assert top == sorted(top) and len(top) == 10
    assert top[-1] == summary.agg(F.max("total_spend")).first()


def test_kpis_count_all_sales_even_of_unknown_customers(tables, shop_star):
    some = shop_star.dim_customers.filter("customer_key > 3")
    star_ = metrics.Star(
        fact_orders=shop_star.fact_orders,
        dim_customers=some,
        dim_products=shop_star.dim_products,
        dim_date=shop_star.dim_date,
    )
    row = metrics.kpi_summary(star_).first()
    revenue, orders = metrics.monthly_revenue(star_).agg(
        F.sum("total_revenue"), F.sum("order_count")
    ).first()
    assert (row["total_revenue"], row["total_orders"]) == (revenue, orders)


def test_nobody_repeats(tables):
    customers, products, orders = tables
    once = orders.filter(F.col("status") == "completed").dropDuplicates(["customer_id"])
    built = star.build_star(customers, products, once)
    assert metrics.repeat_customers(built).count() == 0
    assert metrics.kpi_summary(built).first()["repeat_customer_rate_pct"] == D("0.00")


def test_metrics_of_an_empty_fact(tables):
    customers, products, orders = tables
    built = star.build_star(customers, products, orders.filter("false"))
    assert metrics.monthly_revenue(built).count() == 0
    assert tuples(metrics.kpi_summary(built)) == [(D("0.00"), 0, 0, None, D("0.00"))]


def test_load_is_verified_and_repeatable(spark, tables, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        publish.current_version(spark, root)
    first = publish.load_star(spark, root, *tables)
    second = publish.load_star(spark, root, *tables)
    assert first != second == publish.current_version(spark, root)
    stored = publish.read_star(spark, root)
    checked = {r["tbl"]: r for r in publish.verify(stored.tables()).collect()}
    assert checked["fact_orders"]["row_count"] == 500
    assert (
        checked["fact_orders"]["completed_revenue"]
        == metrics.kpi_summary(stored).first()["total_revenue"]
    )
    assert checked["dim_customers"]["completed_revenue"] is None
    # What was counted while writing is what stands there.
    assert sorted(tuples(publish.load_summary(spark, root))) == sorted(
        tuple(r) for r in checked.values()
    )
    months = stored.fact_orders.select("month_key").distinct().count()
    orders = tables[2].select(F.trunc("order_date", "MM"))
    assert months == orders.distinct().count()


@pytest.mark.parametrize(
    "fault", ["customer", "product", "status", "empty", "repeated id", "repeated parent"]
)
def test_a_bad_load_leaves_the_published_one(spark, tables, tmp_path, fault):
    customers, products, orders = tables
    root = str(tmp_path)
    version = publish.load_star(spark, root, *tables)
    one = F.col("order_id") == 7

    def changed(column, value):
        return F.when(one, value).otherwise(F.col(column))

    bad = {
        "customer": orders.withColumn("customer_id", changed("customer_id", -1)),
        "product": orders.withColumn("product_id", changed("product_id", -1)),
        "status": orders.withColumn("status", changed("status", "lost")),
        "empty": orders.filter("false"),
        "repeated id": orders.unionByName(orders.filter(one)),
        "repeated parent": orders,
    }[fault]
    if fault == "repeated parent":
        customers = customers.unionByName(customers.filter("customer_id = 3"))
    message = {
        "customer": r"customer_key: 1 \(orders 7 to 7\)",
        "product": r"not null \(unit_price\): 1 such as order_key=7",
        "status": r"check \(status is known\): 1 such as .*order_id=7, .*status=lost",
        "empty": "there are no orders",
        "repeated id": r"unique \(order_id\): 1",
        "repeated parent": r"dim_customers: unique \(customer_id\): 1",
    }[fault]
    with pytest.raises((star.IntegrityError, ConstraintError), match=message):
        publish.load_star(spark, root, customers, products, bad)
    assert publish.current_version(spark, root) == version


def test_unresolved_keys_are_counted_in_rows(tables):
    customers, products, orders = tables
    lost = orders.withColumn(
        "customer_id", F.when(F.col("order_id") <= 200, 99_999).otherwise(F.col("customer_id"))
    )
    built = star.build_star(customers, products.filter("product_id > 1"), lost)
    missing = orders.filter("product_id = 1").count()
    assert dict(tuples(star.unresolved_keys(built))) == {
        "customer_key": 200,
        "product_key": missing,
        "date_key": 0,
    }


def test_stored_daily_sales_are_stale_until_refreshed(spark, tables, tmp_path):
    customers, products, orders = tables
    warehouse, daily = str(tmp_path / "w"), str(tmp_path / "d")
    cut = date(2025, 4, 12)
    early = orders.filter(F.col("order_date") < cut)
    publish.load_star(spark, warehouse, customers, products, early)
    publish.refresh_daily_sales(spark, daily, publish.read_star(spark, warehouse))
    before = publish.read_daily_sales(spark, daily)
    old_rows = sorted(tuples(before))
    publish.load_star(spark, warehouse, *tables)
    full = publish.read_star(spark, warehouse)
    assert sorted(tuples(publish.read_daily_sales(spark, daily))) == old_rows
    months = [date(2025, 4, 30), date(2025, 5, 1), date(2025, 6, 1)]
    publish.refresh_daily_sales(spark, daily, full, months)
    assert sorted(tuples(publish.read_daily_sales(spark, daily))) == sorted(
        tuples(metrics.daily_sales(full))
    )
    # A reader that opened the old version still sees it whole.
    assert sorted(tuples(before)) == old_rows


def test_metrics_read_only_what_they_need(spark, tables, tmp_path):
    publish.load_star(spark, str(tmp_path), *tables)
    stored = publish.read_star(spark, str(tmp_path))
    plan = metrics.monthly_revenue(stored)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "total_amount" in x)
    assert "EqualTo(status,completed)" in scan
    assert "ReadSchema: struct<date_key:int,total_amount:decimal(12,2),status:string>" in scan


def test_incremental_refresh_reads_touched_months_only(spark, tables, tmp_path):
    root = str(tmp_path)
    publish.load_star(spark, root, *tables)
    fact = publish.read_star(spark, root).fact_orders.filter(F.col("month_key").isin([202504]))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan


def test_operational_load(spark, tables, tmp_path):
    customers, products, orders = tables
    raw = (
        generate.dirty_customers(customers),
        generate.dirty_products(products),
        generate.dirty_orders(orders),
    )
    root = str(tmp_path)
    publish.load_operational(spark, root, *raw)
    publish.load_operational(spark, root, *raw)
    names = ("customers", "products", "orders", "dead_letter")
    stored = {n: publish.read_table(spark, root, n) for n in names}
    counts = {n: df.count() for n, df in stored.items()}
    assert sum(counts.values()) == sum(df.count() for df in raw)
    assert counts["orders"] and counts["dead_letter"]
    # The accepted tables are fit for the star.
    publish.load_star(
        spark, f"{root}/star", stored["customers"], stored["products"], stored["orders"]
    )
    dead = sinks.write_dead_letter(stored["dead_letter"], str(tmp_path / "dead"))
    assert spark.read.option("header", True).csv(dead).count() == counts["dead_letter"]
    # A row that comes twice goes to the dead letter and stops nothing.
    repeated = raw[1].unionByName(raw[1])
    publish.load_operational(spark, root, raw[0], repeated, raw[2])
    again = {n: publish.read_table(spark, root, n).count() for n in names}
    assert again["products"] == counts["products"] and again["orders"] == counts["orders"]
    assert again["dead_letter"] == counts["dead_letter"] + products.count()


def test_all_rows_rejected(spark, tmp_path):
    def feed(columns, row):
        return spark.createDataFrame([row], ", ".join(f"{c} string" for c in columns))

    root = str(tmp_path)
    publish.load_operational(
        spark,
        root,
        feed(RAW_CUSTOMERS, ("1", "", "", "", None)),
        feed(RAW_PRODUCTS, ("1", "", "", "N/A")),
        feed(RAW_ORDERS, ("1", "1", "1", "1", "2025-01-01", "pending")),
    )
    assert publish.read_table(spark, root, "customers").count() == 0
    letters = publish.read_table(spark, root, "dead_letter", ["source_table", "rejection_reason"])
    assert dict(tuples(letters)) == {
        "customers": "missing full_name; missing email; missing city",
        "products": "invalid price; missing title; missing category",
        "orders": "customer_id not found; product_id not found",
    }


def test_report_and_kpi_files(spark, shop_star, tmp_path):
    report = {"a": spark.range(3), "b": spark.range(2).withColumnRenamed("id", "n")}
    root = str(tmp_path / "r")
    first = sinks.write_report(report, root)
    assert spark.read.option("header", True).csv(f"{first}/report=b").columns == ["n"]
    broken = {"a": spark.range(3).selectExpr("CAST(raise_error('no') AS int) AS n")}
    with pytest.raises(Exception, match="no"):
        sinks.write_report(broken, root)
    assert versions.current_folder(spark, root) == first
    kpi = sinks.write_kpis(metrics.kpi_summary(shop_star), str(tmp_path / "k"))
    kpis = spark.read.json(kpi).first()
    assert kpis["total_orders"] == metrics.kpi_summary(shop_star).first()["total_orders"]


def test_analytics_files(spark, tables, shop_star, tmp_path):
    out = sinks.write_analytics(shop_star, str(tmp_path / "out"))
    kpis = spark.read.json(f"{out}/summary_stats").first()
    assert kpis["best_category"] == metrics.kpi_summary(shop_star).first()["best_category"]
    months = spark.read.option("header", True).csv(f"{out}/charts/report=monthly_revenue")
    assert months.count() == metrics.monthly_revenue(shop_star).count()
    customers, products, orders = tables
    unsold = star.build_star(customers, products, orders.filter("status != 'completed'"))
    with pytest.raises(star.IntegrityError):
        sinks.write_analytics(unsold, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def _counted(spark, fact):
    """The fact with a status that counts how often a row is built."""
    built = spark.sparkContext.accumulator(0)

    def same(status):
        built.add(1)
        return status

    return fact.withColumn("status", F.udf(same, "string")("status")), built


def test_analytics_files_build_the_fact_once(spark, shop_star, tmp_path):
    fact, built = _counted(spark, shop_star.fact_orders)
    sinks.write_analytics(replace(shop_star, fact_orders=fact), str(tmp_path / "a"))
    assert built.value == 500


def test_a_load_builds_the_orders_once(spark, tables, tmp_path):
    orders, built = _counted(spark, tables[2])
    days = orders.withColumn("order_date", F.when(F.col("status").isNotNull(), F.col("order_date")))
    publish.load_star(spark, str(tmp_path), *tables[:2], days)
    stored = publish.read_star(spark, str(tmp_path)).dim_date
    assert sorted(tuples(stored)) == sorted(tuples(star.dim_date(tables[2])))
    assert built.value == 500


def test_two_writers_and_a_reader_across_a_switch(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def tables(n):
        return {"a": spark.range(n), "b": spark.range(n)}

    publish.publish(spark, root, tables(1))
    pinned = publish.read_tables(spark, root, ["a", "b"])
    # A second writer sees the numbers that were there before the first one switched.
    seen = versions._switches(spark, root)
    publish.publish(spark, root, tables(2))
    stale = iter([seen])
    real = versions._switches
    monkeypatch.setattr(versions, "_switches", lambda s, r: next(stale, None) or real(s, r))
    last = publish.publish(spark, root, tables(3))
    monkeypatch.undo()
    assert [n for n, _ in versions._switches(spark, root)] == [3, 2, 1]
    assert publish.current_version(spark, root) == last
    assert pinned["a"].count() == pinned["b"].count() == 1
    assert publish.read_table(spark, root, "b").count() == 3


def test_a_refresh_does_not_undo_another(spark, tables, tmp_path, monkeypatch):
    warehouse, daily = f"{tmp_path}/w", f"{tmp_path}/d"
    publish.load_star(spark, warehouse, *tables)
    full = publish.read_star(spark, warehouse)
    publish.refresh_daily_sales(spark, daily, full)
    compute = metrics.daily_customer_sales

    def meanwhile(star_):
        monkeypatch.undo()
        publish.refresh_daily_sales(spark, daily, full)
        return compute(star_)

    monkeypatch.setattr(metrics, "daily_customer_sales", meanwhile)
    with pytest.raises(versions.ConcurrentUpdate):
        publish.refresh_daily_sales(spark, daily, full, [date(2025, 4, 1)])
    assert len(versions._switches(spark, daily)) == 2
    monkeypatch.setattr(metrics, "daily_customer_sales", meanwhile)
    with pytest.raises(versions.ConcurrentUpdate):
        publish.add_daily_sales(spark, daily, full)
    assert len(versions._switches(spark, daily)) == 3


def test_a_number_that_is_taken_but_not_filled_is_a_conflict(spark, tables, tmp_path):
    """B creates its switch, A wants to switch on the same base, B fills its own."""
    warehouse, daily = f"{tmp_path}/w", f"{tmp_path}/d"
    publish.load_star(spark, warehouse, *tables)
    full = publish.read_star(spark, warehouse)
    first = publish.refresh_daily_sales(spark, daily, full)
    taken = tmp_path / "d" / "_published" / "000000000002"
    taken.write_text("")
    assert publish.current_version(spark, daily) == first
    with pytest.raises(versions.ConcurrentUpdate):
        publish.refresh_daily_sales(spark, daily, full, [date(2025, 4, 1)])
    with pytest.raises(versions.ConcurrentUpdate):
        publish.add_daily_sales(spark, daily, full)
    # B's refresh, whatever it made, is what readers see.
    theirs = publish.publish(spark, str(tmp_path / "other"), {"daily_sales": spark.range(3)})
    (tmp_path / "other" / f"v={theirs}").rename(tmp_path / "d" / f"v={theirs}")
    taken.write_text(theirs)
    assert publish.current_version(spark, daily) == theirs
    assert publish.read_daily_sales(spark, daily).count() == 3


def test_a_switch_appears_whole_and_never_replaces_another(spark, tmp_path):
    path = f"{tmp_path}/_published/000000000001"
    assert versions._take(spark, path, "one")
    assert not versions._take(spark, path, "two")
    assert (tmp_path / "_published" / "000000000001").read_text() == "one"
    # No draft is left, and none would be taken for a switch.
    assert [p.name for p in (tmp_path / "_published").iterdir()] == ["000000000001"]
    (tmp_path / "_published" / "_draft-x").write_text("three")
    assert versions.last_version(spark, str(tmp_path)) == "one"


def test_many_writers_at_once(spark, tmp_path):
    """Threads that switch on the base they read: each success follows the one before."""
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path)
    versions.switch(spark, root, "v0")

    def update(n):
        wins = 0
        for i in range(10):
            base = versions.last_version(spark, root)
            try:
                versions.switch(spark, root, f"{base}>{n}.{i}", based_on=base)
                wins += 1
            except versions.ConcurrentUpdate:
                pass
        return wins

    with ThreadPoolExecutor(4) as pool:
        wins = sum(pool.map(update, range(4)))
    switches = versions._filled(spark, root)
    assert len(switches) == wins + 1
    for (_, _, later), (_, _, earlier) in zip(switches, switches[1:]):
        assert later.startswith(f"{earlier}>") and ">" not in later[len(earlier) + 1 :]


def test_the_current_version_stays_whatever_writers_leave_behind(spark, tmp_path):
    root = str(tmp_path)
    publish.publish(spark, root, {"a": spark.range(5)})
    for n in (2, 3):
        (tmp_path / "_published" / f"{n:012d}").write_text("")
    assert versions.remove_old(spark, root, keep=2, older_than=-1) == 0
    assert publish.read_table(spark, root, "a").count() == 5
    publish.publish(spark, root, {"a": spark.range(6)})
    assert publish.read_table(spark, root, "a").count() == 6


def test_a_load_that_writes_for_long_is_left_alone(spark, tmp_path):
    import os
    import time

    root = str(tmp_path)
    publish.publish(spark, root, {"a": spark.range(5)})
    writing = tmp_path / "v=slow" / "a" / "_temporary"
    writing.mkdir(parents=True)
    (writing / "part-0").write_text("x")
    long_ago = time.time() - 100_000
    for p in (tmp_path / "v=slow", tmp_path / "v=slow" / "a"):
        os.utime(p, (long_ago, long_ago))
    assert versions.remove_old(spark, root, keep=1, older_than=50_000) == 0
    os.utime(writing / "part-0", (long_ago, long_ago))
    assert versions.remove_old(spark, root, keep=1, older_than=50_000) == 1
    assert not (tmp_path / "v=slow").exists()


def _star_of(full, condition):
    return replace(full, fact_orders=full.fact_orders.filter(condition))


def test_late_orders_are_added(spark, tables, tmp_path, monkeypatch):
    warehouse, daily = f"{tmp_path}/w", f"{tmp_path}/d"
    publish.load_star(spark, warehouse, *tables)
    full = publish.read_star(spark, warehouse)
    monkeypatch.setattr(publish, "MOST_PARTS", 3)
    n = F.pmod(F.xxhash64("order_id"), F.lit(7))
    publish.refresh_daily_sales(spark, daily, _star_of(full, n == 0))
    before = publish.read_daily_sales(spark, daily)
    old_rows = sorted(tuples(before))
    for k in range(1, 7):
        publish.add_daily_sales(spark, daily, _star_of(full, n == k))
        so_far = sorted(tuples(metrics.daily_sales(_star_of(full, n <= k))))
        assert sorted(tuples(publish.read_daily_sales(spark, daily))) == so_far
        # Whatever is removed, what the current version reads stays.
        versions.remove_old(spark, daily, keep=1, older_than=-1)
    parts = publish.read_table(spark, daily, "daily_parts").groupBy("month_key").count()
    assert parts.agg(F.max("count")).first()[0] <= 3
    nothing = _star_of(full, F.lit(False))
    publish.add_daily_sales(spark, daily, nothing)
    assert sorted(tuples(publish.read_daily_sales(spark, daily))) == so_far
    # A month that is computed again after that has the customers of all its parts.
    publish.refresh_daily_sales(spark, daily, full, [date(2025, 5, 1)])
    publish.add_daily_sales(spark, daily, nothing)
    assert sorted(tuples(publish.read_daily_sales(spark, daily))) == so_far
    assert old_rows != so_far


def test_adding_reads_the_late_rows_and_the_customers_of_their_months(spark, tables, tmp_path, monkeypatch):
    warehouse, daily = f"{tmp_path}/w", f"{tmp_path}/d"
    publish.load_star(spark, warehouse, *tables)
    full = publish.read_star(spark, warehouse)
    may = F.col("date_key").between(20250510, 20250512)
    publish.refresh_daily_sales(spark, daily, _star_of(full, ~may))
    read = []
    real = publish._customer_sales
    monkeypatch.setattr(publish, "_customer_sales", lambda s, r, like, parts: read.extend(parts) or real(s, r, like, parts))
    publish.add_daily_sales(spark, daily, _star_of(full, may))
    assert {month for month, _ in read} == {202505}
    assert sorted(tuples(publish.read_daily_sales(spark, daily))) == sorted(tuples(metrics.daily_sales(full)))
    fresh = publish.read_table(spark, daily, "daily_customers")
    assert {r[0] for r in tuples(fresh.select("sale_date"))} <= {date(2025, 5, d) for d in (10, 11, 12)}


def test_daily_sales_of_an_empty_star_can_be_added_to(spark, tables, shop_star, tmp_path):
    publish.refresh_daily_sales(spark, str(tmp_path), _star_of(shop_star, F.lit(False)))
    assert publish.read_daily_sales(spark, str(tmp_path)).count() == 0
    publish.add_daily_sales(spark, str(tmp_path), shop_star)
    assert sorted(tuples(publish.read_daily_sales(spark, str(tmp_path)))) == sorted(
        tuples(metrics.daily_sales(shop_star))
    )


def test_old_and_failed_versions_are_removed(spark, tmp_path):
    root = str(tmp_path)
    kept = [publish.publish(spark, root, {"a": spark.range(n)}) for n in range(5)][-2:]

    def fails(tables, rows):
        raise ConstraintError("bad")

    with pytest.raises(ConstraintError):
        publish.publish(spark, root, {"a": spark.range(9)}, check=fails)
    assert versions.remove_old(spark, root, older_than=3600) == 0
    assert versions.remove_old(spark, root, older_than=-1) == 4
    assert {p.name for p in tmp_path.glob("v=*")} == {f"v={v}" for v in kept}
    assert publish.read_table(spark, root, "a").count() == 4
    publish.publish(spark, root, {"a": spark.range(7)})
    assert publish.read_table(spark, root, "a").count() == 7


def test_payments_are_loaded_and_go_with_their_orders(spark, tables, tmp_path):
    customers, products, orders = (generate.dirty_customers(tables[0]), generate.dirty_products(tables[1]), generate.dirty_orders(tables[2]))
    path = tmp_path / "payments.csv"
    lines = [f"{n % 450},2025-05-0{n % 9 + 1},{n + 1}.50,Card" for n in range(600)]
    path.write_text("order_id,payment_date,amount,method\n" + "\n".join(lines) + "\n")
    feed = read_feed(spark, str(path), RAW_PAYMENTS[1:], position=True)
    raw = with_file_ids(feed, "payment_id")
    root = str(tmp_path / "r")
    publish.load_operational(spark, root, customers, products, orders, raw)
    stored = publish.read_tables(spark, root, ["orders", "payments", "dead_letter"])
    known = {r["order_id"] for r in stored["orders"].collect()}
    want = {n + 1 for n in range(600) if n % 450 in known}
    assert {r["payment_id"] for r in stored["payments"].collect()} == want
    lost = stored["dead_letter"].filter("source_table = 'payments'")
    assert lost.count() == 600 - len(want)
    assert {r[0] for r in tuples(lost, "rejection_reason")} == {"order_id not found"}
    # A reload without payments leaves none behind that could point nowhere.
    publish.load_operational(spark, root, customers, products, orders)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish.read_table(spark, root, "payments")


def test_a_filter_on_days_prunes_the_months_of_the_fact(spark, tables, tmp_path):
    publish.load_star(spark, str(tmp_path), *tables)
    full = publish.read_star(spark, str(tmp_path))
    quarter = metrics.of_days(full, (F.col("year") == 2025) & (F.col("quarter") == 2))
    daily = metrics.daily_sales(quarter)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "month_key" in plan
    want = [r for r in tuples(metrics.daily_sales(full)) if r[0].month in (4, 5, 6)]
    assert tuples(daily) == want and want

    def files_read(df):
        df.collect()
        found, nodes = 0, [df._jdf.queryExecution().executedPlan()]
        while nodes:
            node = nodes.pop()
            if "Adaptive" in node.nodeName():
                nodes.append(node.executedPlan())
            if "QueryStage" in node.nodeName():
                nodes.append(node.plan())
            if "order_id" in node.simpleString(1000) and node.metrics().contains("numFiles"):
                found += node.metrics().get("numFiles").get().value()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
        return found

    def only_facts(s):
        return s.fact_orders.select("order_id")

    months = full.fact_orders.select("month_key").distinct().count()
    assert files_read(only_facts(quarter)) == 3 < months <= files_read(only_facts(full))
    # The other metrics are of these days, too.
    assert tuples(metrics.category_performance(quarter)) != tuples(metrics.category_performance(full))
    assert metrics.monthly_revenue(quarter).count() == 3


def test_a_dead_letter_is_published_only_if_there_is_one(spark, tmp_path):
    rejects = spark.createDataFrame([("1", "customers")], "customer_id string, source_table string")
    root = str(tmp_path)
    assert sinks.write_dead_letter(rejects.filter("false"), root) is None
    assert versions.last_version(spark, root) is None and not list(tmp_path.glob("v=*"))
    first = sinks.write_dead_letter(rejects, root)
    assert sinks.write_dead_letter(rejects.filter("false"), root) is None
    assert versions.current_folder(spark, root) == first


def test_stored_views_show_one_version_whole(spark, tables, tmp_path):
    root, daily = f"{tmp_path}/w", f"{tmp_path}/d"
    customers, products, orders = tables
    first = publish.load_star(spark, root, *tables)
    old = publish.read_star(spark, root)
    publish.refresh_daily_sales(spark, daily, old)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    assert views.store_views(spark, root, database="shop", as_of=TODAY) == first
    views.store_daily_sales_view(spark, daily, database="shop")

    def shown():
        names = ["monthly_revenue", "category_performance", "customer_summary", "repeat_customers"]
        return [tuples(spark.table(f"shop.vw_{n}")) for n in names]

    def metrics_of(star_):
        return [
            tuples(metrics.monthly_revenue(star_)),
            tuples(metrics.category_performance(star_)),
            tuples(metrics.customer_summary(star_, TODAY)),
            tuples(metrics.repeat_customers(star_)),
        ]

    want = metrics_of(old)
    schemas = [metrics.monthly_revenue(old), metrics.category_performance(old),
               metrics.customer_summary(old, TODAY), metrics.repeat_customers(old)]
    for name, df in zip(("monthly_revenue", "category_performance", "customer_summary", "repeat_customers"), schemas):
        assert spark.table(f"shop.vw_{name}").dtypes == df.dtypes
    assert shown() == want
    for _ in range(2):
        second = publish.load_star(spark, root, customers, products, orders.filter("order_id % 2 = 0"))
    # Other versions are published and old ones removed: the views show what they showed.
    versions.remove_old(spark, root, keep=1, older_than=-1)
    assert shown() == want
    assert views.view_version(spark, "shop.vw_repeat_customers") == first
    assert tuples(spark.table("shop.mvw_daily_sales")) == tuples(metrics.daily_sales(old))
    # Another session with the same catalogue sees them, too.
    other = spark.newSession()
    assert tuples(other.table("shop.vw_monthly_revenue")) == want[0]
    views.store_views(spark, root, database="shop", as_of=TODAY)
    assert views.view_version(spark, "shop.vw_monthly_revenue") == second
    assert shown() == metrics_of(publish.read_star(spark, root)) != want
    versions.remove_old(spark, root, keep=1, older_than=-1)
    assert not (tmp_path / "w" / f"v={first}").exists()
    spark.sql("DROP DATABASE shop CASCADE")
