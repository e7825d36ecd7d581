"""The published queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions import scalar, text
from tidemill.operators import facets, joins
from tidemill.plans import dau as dau_plan, orders as order_plan, sales as sale_plan
from tidemill.schemas import KPI_NAMES


def realtime_total(dau: DataFrame, orders: DataFrame, day: str) -> DataFrame:
    """The KPI board: active devices, new devices and order amount of the day."""
    parts = {
        "dau": (dau_plan.dau_total(dau, day), "total"),
        "new_mid": (dau_plan.new_devices(dau, day), "new_devices"),
        "order_amount": (order_plan.amount_total(orders, day), "total_amount"),
    }
    rows = [
        df.select(F.lit(key).alias("id"), F.lit(KPI_NAMES[key]).alias("name"),
                  F.col(column).cast("double").alias("value"))
        for key, (df, column) in parts.items()]
    return reduce(DataFrame.unionByName, rows)


# day, hour and, if it is summed, value of a metric's rows
_HOURS = {"dau": ("log_date", "log_hour"), "order_amount": ("create_date", "create_hour", "total_amount")}


def realtime_hour(metric: str, rows: DataFrame, day: str) -> DataFrame | None:
    """Hour curves of the day and the day before; None for an unknown metric.

    ``rows`` is the DAU table for ``dau`` and the order table for ``order_amount``.
    """
    columns = _HOURS.get(metric)
    if columns is None:
        return None
    today = F.lit(day)
    return joins.two_day_hours(rows, *columns[:2], today, scalar.yesterday(today), *map(F.col, columns[2:]))


def hour_maps(metric: str, rows: DataFrame, day: str) -> DataFrame | None:
    """The curves as two maps from hour to value in one row, hours without rows left out; an hour of which the
    rows add up to 0 stays."""
    columns = _HOURS.get(metric)
    if columns is None:
        return None
    today = F.lit(day)
    curves = joins.two_days(rows, *columns[:2], today, scalar.yesterday(today), *map(F.col, columns[2:]))

    def series(name: str) -> Column:
        return F.map_filter(scalar.pairs_map(F.col("hour"), F.col(name)), lambda h, v: v.isNotNull())
    return curves.agg(series("today").alias("today"), series("yesterday").alias("yesterday"))


def search(
    sales: DataFrame, day: str | None, keyword: str, tokenizer: text.Tokenizer = text.words
) -> DataFrame:
    """Sales whose product name holds every word of the keyword; ``day`` prunes to one partition.

    An operator over all days passes None; the published query requires a day.
    """
    hits = sales if day is None else sales.where(F.col("dt") == day)
    return hits.where(text.has_all_tokens(F.col("sku_name"), F.lit(keyword), tokenizer))


def sale_search(
    sales: DataFrame, day: str, keyword: str, page: int, size: int,
    tokenizer: text.Tokenizer = text.words,
) -> dict[str, DataFrame]:
    """Total, page of rows, age and gender shares of one day's hits."""
    if day is None:
        raise ValueError("a day is required")
    hits = search(sales, day, keyword, tokenizer)
    return {
        "total": facets.total_hits(hits),
        "detail": facets.page(hits, page, size, "order_detail_id"),
        "age": facets.age_share(hits),
        "gender": facets.gender_share(hits),
    }


def sale_search_document(
    sales: DataFrame, day: str, keyword: str, page: int, size: int,
    tokenizer: text.Tokenizer = text.words,
) -> DataFrame:
    """The same answer as one JSON document in one row; it holds at most ``size`` sales."""
    if day is None:
        raise ValueError("a day is required")
    hits = search(sales, day, keyword, tokenizer)
    head = facets.bands(hits).select("total", F.array(*[
        F.struct(F.lit(title).alias("title"), facets.options(kind).alias("options"))
        for kind, title in facets.TITLES.items()]).alias("stat"))
    rows = facets.page(hits, page, size, "order_detail_id")
    detail = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("detail"))
    both = head.unionByName(detail, allowMissingColumns=True)
    parts = [F.first(c, ignorenulls=True).alias(c) for c in ("stat", "total", "detail")]
    return both.agg(F.to_json(F.struct(*parts)).alias("document"))


def table_view(
    sales: DataFrame, day: str, keyword: str, start: int, length: int,
    tokenizer: text.Tokenizer = text.words,
) -> dict[str, DataFrame]:
    """:func:`sale_search` by row offset, as the table view asks for it."""
    return sale_search(sales, day, keyword, facets.page_of_row(start, length), length, tokenizer)


def demographics(sales: DataFrame, day: str | None, keyword: str) -> DataFrame:
    return facets.demographics(search(sales, day, keyword))


def province_sales(orders: DataFrame, day: str) -> DataFrame:
    return order_plan.province_sales(orders, day)


def product_sales(orders: DataFrame, details: DataFrame, day: str) -> DataFrame:
    return sale_plan.product_sales(orders, details, day)
