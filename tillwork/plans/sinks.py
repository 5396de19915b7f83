"""Result files for people and dashboards.

Each sink publishes a new folder below ``root`` and returns it; readers find the last one
with ``versions.current_folder``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwork.model import COMPLETED, Star
from tillwork.plans import metrics
from tillwork.plans.star import IntegrityError
from tillwork.plans.versions import publish_files, remove
from tillwork.session import shared_folder, staged


def _sections(sections: dict[str, DataFrame], folder: str, fmt: str) -> None:
    for name, df in sections.items():
        target = df.write.format(fmt)
        if fmt == "csv":
            target = target.option("header", True)
        target.save(f"{folder}/report={name}")


def write_dead_letter(rejects: DataFrame, root: str) -> str | None:
    """CSV with headers, one folder per source table; cells stay as they came, spaces too.

    Without rejects nothing is published, and None is returned.
    """

    def write(folder: str) -> bool:
        options = {"header": True, "escape": '"'} | {
            f"ignore{side}WhiteSpace": False for side in ("Leading", "Trailing")
        }
        seen = Observation()
        counted = rejects.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.options(**options).partitionBy("source_table").csv(folder)
        return seen.get["rows"] > 0

    return publish_files(rejects.sparkSession, root, write)


def write_report(sections: dict[str, DataFrame], root: str, fmt: str = "csv") -> str:
    """Each section as a dataset of its own, with its own headers: ``report=<name>``."""
    spark = next(iter(sections.values())).sparkSession
    return publish_files(spark, root, lambda folder: _sections(sections, folder, fmt))


def write_kpis(kpis: DataFrame, root: str) -> str:
    """The one KPI row as JSON."""
    return publish_files(kpis.sparkSession, root, lambda f: kpis.coalesce(1).write.json(f))


def write_analytics(star: Star, root: str) -> str:
    """The KPI row as JSON and the chart series as CSV, published together; stops if there
    is nothing to show."""
    spark = star.fact_orders.sparkSession
    work = shared_folder(spark)
    try:
        sold = _sold(star, work)
        kpis = metrics.kpi_summary(sold)
        row = kpis.first()
        if not row["total_orders"]:
            raise IntegrityError("the star has no completed orders")

        def write(folder: str) -> None:
            one = spark.createDataFrame([row], kpis.schema).coalesce(1)
            one.write.json(f"{folder}/summary_stats")
            _sections(metrics.chart_series(sold), f"{folder}/charts", "csv")

        return publish_files(spark, root, write)
    finally:
        remove(spark, work)


def _sold(star: Star, folder: str) -> Star:
    """The star with what the metrics read of its fact, and its days, written below ``folder``.

    A star that is not stored is made of joins over all orders, which each metric would do
    again.
    """
    read = ["customer_key", "product_key", "date_key", "month_key"]
    read += ["quantity", "unit_price", "total_amount", "status"]
    fact = star.fact_orders.filter(F.col("status") == COMPLETED)
    # Read again behind the filter, a status that is computed would be computed twice.
    fact = fact.withColumn("status", F.lit(COMPLETED))
    fact = fact.select(*[c for c in read if c in fact.columns])
    return replace(
        star,
        fact_orders=staged(fact, f"{folder}/fact_orders"),
        dim_date=staged(star.dim_date, f"{folder}/dim_date"),
    )
