"""Scalar expressions of the pipelines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def log_date(ts: Column) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd``."""
    return F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd")


def log_hour(ts: Column) -> Column:
    """Epoch milliseconds to ``HH``."""
    return F.date_format(F.timestamp_millis(ts), "HH")


def create_date(create_time: Column) -> Column:
    return F.split_part(create_time, F.lit(" "), F.lit(1))


def create_hour(create_time: Column) -> Column:
    return F.split_part(F.split_part(create_time, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def mask_phone(tel: Column) -> Column:
    """Keep the first three characters and everything from the eighth on."""
    return F.concat(F.substring(tel, 1, 3), F.lit("****"), F.substr(tel, F.lit(8)))


def stamp_now() -> Column:
    """Server time in epoch milliseconds."""
    return F.unix_millis(F.current_timestamp())


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole days since the birthday over 365, truncated; NULL for an unreadable birthday."""
    days = F.datediff(as_of, birthday.try_cast("date"))
    return F.call_function("div", days, F.lit(365)).cast("int")


def to_price(text: Column) -> Column:
    return text.try_cast("double")


def yesterday(day: Column) -> Column:
    return F.date_format(F.date_sub(F.to_date(day), 1), "yyyy-MM-dd")


def compact_date(day: Column) -> Column:
    return F.replace(day, F.lit("-"), F.lit(""))


def epoch_minute(at: Column) -> Column:
    seconds = F.unix_seconds(at)
    return F.call_function("div", seconds - F.pmod(seconds, F.lit(60)), F.lit(60))


def minute_id(mid: Column, at: Column) -> Column:
    """Device and epoch minute: the key that allows one alert per device and minute."""
    return F.concat_ws("_", mid, epoch_minute(at))


def percent(part: Column, total: Column) -> Column:
    """Share in percent, rounded half up to one decimal; 0.0 when there is no total."""
    tenths = F.floor(F.try_divide(part * F.lit(1000.0), total) + F.lit(0.5))
    return F.coalesce(tenths / F.lit(10.0), F.lit(0.0))


def cents(amount: Column) -> Column:
    """An amount as an exact number of two decimals."""
    return amount.cast("decimal(18,2)")


def money(amount: Column) -> Column:
    """Exact sum of an amount; doubles would make the last digits depend on the row order."""
    return F.sum(cents(amount)).cast("double")


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def pairs_json(pairs: Column) -> Column:
    """Array of (name, value) structs to a JSON object; NULL values are left out."""
    held = F.filter(pairs, lambda p: p["value"].isNotNull())
    return F.to_json(F.map_from_entries(held))


def pairs_map(key: Column, value: Column) -> Column:
    """Key/value rows to one map; for results of a known small size, such as the 24 hours."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))
