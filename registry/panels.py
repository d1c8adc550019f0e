"""Panels of demand series derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandpanel.sources.tables import merge_keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month(column: str) -> Column:
    return F.trunc(F.to_date(column), "month").alias("ds")


def _day(column: str) -> Column:
    return F.to_date(column).alias("ds")


def _id(column: str) -> Column:
    return F.col(column).cast("string").alias("unique_id")


@dataclass(frozen=True)
class Panel:
    """``rows``: ``unique_id, ds`` and numbers, repeats included; ``y`` follows from the numbers' sums."""

    rows: Callable[[SparkSession, str], DataFrame]
    y: Callable[[], Column] = lambda: F.col("y")

    def merged(self, rows: DataFrame, partitions: int | None = None) -> DataFrame:
        numbers = [c for c in rows.columns if c not in ("unique_id", "ds")]
        sums = merge_keys(rows, dict.fromkeys(numbers, F.sum), partitions)
        return sums.select("unique_id", "ds", self.y().alias("y"))

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.merged(self.rows(spark, sf_dir))


def _nation_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    series = F.concat_ws("_", F.col("c_nationkey").cast("string"), "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        series.alias("unique_id"), _month("o_orderdate"), F.col("o_totalprice").alias("y")
    )


def _lines(series: str, period: Callable[[str], Column], *numbers: Callable[[], Column]) -> Panel:
    def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem")
        return lines.select(_id(series), period("l_shipdate"), *[n() for n in numbers])

    return Panel(rows)


def _quantity() -> Column:
    return F.col("l_quantity").alias("y")


def _returned() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("y")


def _open() -> Column:
    return F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("open")


def _user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(_id("user_id"), _day("ts"), F.col("value").alias("y"))


def _customer_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    final = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)
    return orders.select(_id("o_custkey"), _month("o_orderdate"), final.alias("y"))


def _order_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(_id("o_custkey"), _day("o_orderdate"), F.col("o_totalprice").alias("y"))


nation_segment = Panel(_nation_segment)
part_month = _lines("l_partkey", _month, _quantity)
supplier_month = _lines("l_suppkey", _month, _quantity)
supplier_day = _lines("l_suppkey", _day, _quantity)
part_returns = _lines("l_partkey", _month, _returned)
part_returns_nullable = Panel(
    _lines("l_partkey", _month, _returned, _open).rows, lambda: F.when(F.col("open") > 0, F.col("y"))
)
user_day = Panel(_user_day)
customer_refunds = Panel(_customer_refunds)
order_day = Panel(_order_day)


def part_month_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(_id("p_partkey"), "p_brand", "p_size")
    return part_month(spark, sf_dir).join(parts, "unique_id")


def _sql(series: str, period: str, target: str, source: str) -> str:
    return f"SELECT {series} AS unique_id, {period} AS ds, {target} AS y FROM {source} GROUP BY 1, 2"


def _month_sql(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


_RETURNED_SQL = "sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END)"
_PART = "CAST(l_partkey AS VARCHAR)"
_SUPPLIER = "CAST(l_suppkey AS VARCHAR)"

SQL: dict[str, str] = {
    "nation_segment": _sql(
        "CAST(c_nationkey AS VARCHAR) || '_' || c_mktsegment",
        _month_sql("o_orderdate"),
        "sum(o_totalprice)",
        "orders JOIN customer ON o_custkey = c_custkey",
    ),
    "part_month": _sql(_PART, _month_sql("l_shipdate"), "sum(l_quantity)", "lineitem"),
    "supplier_month": _sql(_SUPPLIER, _month_sql("l_shipdate"), "sum(l_quantity)", "lineitem"),
    "supplier_day": _sql(_SUPPLIER, "CAST(l_shipdate AS DATE)", "sum(l_quantity)", "lineitem"),
    "user_day": _sql("CAST(user_id AS VARCHAR)", "CAST(ts AS DATE)", "sum(value)", "events"),
    "part_returns": _sql(_PART, _month_sql("l_shipdate"), _RETURNED_SQL, "lineitem"),
    "part_returns_nullable": _sql(
        _PART,
        _month_sql("l_shipdate"),
        f"CASE WHEN count(*) FILTER (l_linestatus = 'O') > 0 THEN {_RETURNED_SQL} END",
        "lineitem",
    ),
    "customer_refunds": _sql(
        "CAST(o_custkey AS VARCHAR)",
        _month_sql("o_orderdate"),
        "sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END)",
        "orders",
    ),
    "order_day": _sql(
        "CAST(o_custkey AS VARCHAR)", "CAST(o_orderdate AS DATE)", "sum(o_totalprice)", "orders"
    ),
}
SQL["part_month_static"] = (
    f"SELECT m.unique_id, m.ds, m.y, p.p_brand, p.p_size FROM ({SQL['part_month']}) m "
    "JOIN part p ON m.unique_id = CAST(p.p_partkey AS VARCHAR)"
)
