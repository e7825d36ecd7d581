"""The shop's records as views over the given tables; FIXTURES.md states the mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.operators import joins
from tidemill.session import configure

SHOP_SCHEMA = "shop"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def startup_log(spark: SparkSession, folder: str) -> DataFrame:
    """Signups stand for app starts."""
    user = F.col("user_id")
    ios = user % 10 < 3
    at = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").where("event_type = 'signup'").select(
        F.concat(F.lit("mid_"), _text("user_id")).alias("mid"),
        _text("user_id").alias("uid"),
        F.lit("shop").alias("appid"),
        F.concat(F.lit("area_"), (user % 25).cast("string")).alias("area"),
        F.when(ios, "ios").otherwise("android").alias("os"),
        F.when(ios, "appstore").otherwise(F.concat(F.lit("ch_"), (user % 7).cast("string"))).alias("ch"),
        F.lit("startup").alias("type"),
        F.concat(F.lit("1."), (F.col("event_id") % 4).cast("string"), F.lit(".0")).alias("vs"),
        F.unix_millis(at).alias("ts"),
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """All other events, on five shared devices."""
    kind = F.col("event_type")
    at = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").where("event_type <> 'signup'").select(
        F.concat(F.lit("mid_"), (F.col("user_id") % 5).cast("string")).alias("mid"),
        _text("user_id").alias("uid"),
        F.lit("event").alias("type"),
        F.when(kind == "purchase", "coupon").when(kind == "view", "clickItem")
        .when(kind == "click", "addCart").otherwise("addComment").alias("evid"),
        (F.col("event_id") % 50).cast("string").alias("itemid"),
        F.unix_millis(at).alias("ts"),
        at.alias("event_time"),
    )


def _order_second():
    """The source's order hour is always 0, so the second of the day is derived."""
    return F.col("o_orderdate").cast("timestamp"), (F.col("o_orderkey") * 7919) % 86400


def _later(at, seconds):
    return F.timestamp_seconds(F.unix_seconds(at) + seconds)


def order_info(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    day, second = _order_second()
    create_ts = _later(day, second)
    return (
        table(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            _text("o_orderkey").alias("id"),
            _text("c_nationkey").alias("province_id"),
            F.concat(F.lit("138"), F.lpad(_text("o_custkey"), 8, "0")).alias("consignee_tel"),
            F.col("o_orderstatus").alias("order_status"),
            _text("o_custkey").alias("user_id"),
            F.col("o_totalprice").alias("total_amount"),
            F.date_format(create_ts, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
            create_ts.alias("order_ts"),
        )
    )


def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; a line's time lies 60 minutes before to 90 after its order's.

    The lines meet their orders dealt by order and salt, as the order joins deal them: a join to orders after this
    one shuffles no line again. The plain columns travel, the texts are made behind the join.
    """
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    orders = joins.salted(
        table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), joins.ORDER_SALTS, "_order_salt")
    quantity = F.col("l_quantity").cast("int").cast("string")
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", quantity)
    same_order = (_text("l_orderkey") == _text("o_orderkey")) & (
        joins.salt_of(line_id, joins.ORDER_SALTS) == F.col("_order_salt"))
    day, second = _order_second()
    detail_ts = _later(day, second + ((F.col("l_partkey") % 151) - 60) * 60)
    return (
        table(spark, folder, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, same_order)
        .select(
            line_id.alias("id"),
            _text("l_orderkey").alias("order_id"),
            F.col("p_name").alias("sku_name"),
            _text("l_partkey").alias("sku_id"),
            _text("l_extendedprice").alias("order_price"),
            quantity.alias("sku_num"),
            detail_ts.alias("detail_ts"),
        )
    )


def user_info(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in debt have no profile, so that orders without a user occur."""
    birthday = F.date_add(F.lit("1960-01-01").cast("date"), ((F.col("c_custkey") * 7919) % 14000).cast("int"))
    return table(spark, folder, "customer").where("c_acctbal >= 0").select(
        _text("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(birthday, "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def _after(*columns: str):
    return F.array(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Change entries of all records, among transaction marks and another schema's rows.

    Users are inserted (position 1), updated to the next level in two segments (2), and deleted below a
    balance (3). Orders change status after their insert.
    """
    def entry(rows, name, op, position, after, schema=SHOP_SCHEMA, kind="ROWDATA"):
        return rows.select(
            F.lit(kind).alias("entry_type"), F.lit(schema).alias("schema_name"),
            F.lit(name).alias("table_name"), F.lit(op).alias("op"),
            F.lit(position).cast("bigint").alias("position"), after.alias("rows"))

    users = user_info(spark, folder)
    user_columns = _after("id", "login_name", "user_level", "birthday", "gender")
    promoted = users.where(F.col("user_level").isin("BUILDING", "MACHINERY")).withColumn(
        "user_level", F.concat("user_level", F.lit("+")))
    gone = table(spark, folder, "customer").where("c_acctbal between 0 and 1000").select(
        F.col("c_custkey").alias("id"))
    orders = order_info(spark, folder)
    order_columns = _after("id", "province_id", "consignee_tel", "order_status", "user_id",
                           "total_amount", "create_time")
    details = order_detail(spark, folder)
    detail_columns = _after("id", "order_id", "sku_name", "sku_id", "order_price", "sku_num")
    suppliers = table(spark, folder, "supplier")
    parts = [
        entry(users, "user_info", "INSERT", 1, user_columns),
        entry(promoted, "user_info", "UPDATE", 2, user_columns),
        entry(gone, "user_info", "DELETE", 3, _after("id")),
        entry(orders, "order_info", "INSERT", 1, order_columns),
        entry(orders.where("order_status = 'F'"), "order_info", "UPDATE", 2, order_columns),
        entry(details, "order_detail", "INSERT", 1, detail_columns),
        entry(orders, "order_info", "INSERT", 1, order_columns, kind="TRANSACTIONBEGIN"),
        entry(suppliers.withColumn("id", F.col("s_suppkey")), "user_info", "INSERT", 1, _after("id"),
              schema="crm"),
    ]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log
