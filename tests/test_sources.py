"""Topics, routing, change log and day tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemill.sources import changes, tables, topics


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_takes_quoted_and_plain_numbers(spark):
    df = lines(spark, '{"mid":"m","ts":"7","pgid":3}', '{"ts":8,"itemid":"x"}', '{"ts":"late"}')
    got = [tuple(r) for r in topics.decode(df, "event_log").select("mid", "pgid", "itemid", "ts").collect()]
    assert got == [("m", "3", None, 7), (None, None, "x", 8), (None, None, None, None)]


def test_decode_order_amount(spark):
    df = lines(spark, '{"id":"1","total_amount":"12.50"}', '{"id":2,"total_amount":3}', '{"id":"3"}')
    got = [tuple(r) for r in topics.decode(df, "order_info").select("id", "total_amount").collect()]
    assert got == [("1", 12.5), ("2", 3.0), ("3", None)]


def test_bad_lines_go_to_the_side(spark):
    bad = ['{"mid":', "no json", "", None]
    df = lines(spark, '{"mid":"m"}', *bad)
    assert [r["mid"] for r in topics.decode(df, "startup_log").collect()] == ["m"]
    assert {r["value"] for r in topics.bad_records(df, "startup_log").collect()} == set(bad)


def test_stamp_overwrites_and_keeps_unknown_fields(spark):
    df = lines(spark, '{"type":"startup","ts":1,"extra":"e","n":null}', '{"mid":"a \\"q\\""}', "broken")
    got = topics.route_logs(topics.stamp(df, F.lit(99).cast("bigint"))).collect()
    assert [(r["topic"], json.loads(r["value"])) for r in got] == [
        ("startup", {"type": "startup", "ts": 99, "extra": "e"}), ("event", {"mid": 'a "q"', "ts": 99})]
    assert [r["value"] for r in topics.bad_lines(df).collect()] == ["broken"]


def test_stamp_with_a_repeated_field(spark):
    df = lines(spark, '{"mid":"first","mid":"last","ts":1,"ts":2}')
    got = json.loads(topics.stamp(df, F.lit(99).cast("bigint")).first()["value"])
    assert got == {"mid": "last", "ts": 99}


def test_stamp_keeps_the_types_of_values(spark):
    line = '{"n":12,"x":1.25,"yes":true,"none":null,"list":[1,"a",{"b":false}],"object":{"deep":{"n":3}},"text":"12"}'
    got = json.loads(topics.stamp(lines(spark, line), F.lit(99).cast("bigint")).first()["value"])
    want = {k: v for k, v in json.loads(line).items() if v is not None}
    assert got == want | {"ts": 99} and list(got) == [*want, "ts"]
    assert isinstance(got["n"], int) and got["yes"] is True


def test_unreadable_rows_have_a_reason(spark):
    found = topics.bad_records(lines(spark, '{"mid":"m"}', '{"mid":', None, "  ", "[1]"), "startup_log").collect()
    assert {(r["value"], r["reason"], r["record"]) for r in found} == {
        ('{"mid":', "no JSON object", "startup_log"), (None, "no value", "startup_log"),
        ("  ", "empty value", "startup_log"), ("[1]", "no JSON object", "startup_log")}


def test_stamp_defaults_to_the_clock(spark):
    before = datetime.now().timestamp() * 1000
    got = topics.stamp(lines(spark, "{}")).first()
    assert before - 60_000 < got["ts"] < before + 60_000


CHANGE = ("entry_type string, schema_name string, table_name string, op string, position long, "
          "rows array<array<struct<name: string, value: string>>>")


def test_change_routing(spark):
    def entry(table, op, kind="ROWDATA", schema="shop", rows=1):
        return (kind, schema, table, op, 1, [[("id", str(i)), ("v", None)] for i in range(rows)])

    log = spark.createDataFrame([
        entry("order_info", "INSERT", rows=2), entry("order_info", "UPDATE"), entry("order_detail", "INSERT"),
        entry("order_detail", "DELETE"), entry("user_info", "INSERT"), entry("user_info", "UPDATE"),
        entry("user_info", "DELETE"), entry("sku_info", "INSERT"), entry("order_info", "INSERT", "TRANSACTIONEND"),
        entry("order_info", "INSERT", schema="crm"), entry("order_info", "INSERT", schema="xshop"),
        entry("order_info", "INSERT", rows=0)], CHANGE)
    got = sorted(tuple(r) for r in changes.route_changes(log, r"shop\..*").select("topic", "key", "value").collect())
    assert got == [
        ("order", "0", '{"id":"0"}'), ("order", "1", '{"id":"1"}'), ("order_detail", "0", '{"id":"0"}'),
        ("user", "0", '{"id":"0"}'), ("user", "0", '{"id":"0"}')]


DAYS = StructType([StructField("id", LongType()), StructField("dt", StringType())])


def test_day_scan_reads_one_partition(spark, tmp_path):
    rows = spark.range(100).withColumn("dt", F.concat(F.lit("2020-01-0"), (F.col("id") % 4 + 1).cast("string")))
    path = str(tmp_path / "days")
    tables.write_days(rows, path)
    day = tables.read_days(spark, path, DAYS, "2020-01-02")
    assert day.count() == 25 and dict(day.dtypes)["dt"] == "string"
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert len(day.inputFiles()) >= 1
    # a rewrite of one day leaves the others alone
    tables.write_days(rows.where("dt = '2020-01-02' and id < 10"), path)
    assert tables.read_days(spark, path, DAYS).count() == 75 + 2 + (1 if 9 % 4 == 1 else 0)


def test_lookup_reads_only_the_keys_at_hand(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "1")], "user_id string, if_ordered string")
    wanted = spark.createDataFrame([("b",), ("b",), ("c",)], "user_id string")
    assert [tuple(r) for r in tables.lookup(table, wanted, "user_id", "if_ordered").collect()] == [("b", "1")]


def test_a_kafka_topic_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, "startup", **{"kafka.bootstrap.servers": "nowhere:1"})
