"""Operators against brute force and on edge cases."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemill.operators import facets, joins, keyed, windows
from tidemill.plans import alerts, dau, orders, sales, serve
from tidemill.sources import views


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# Alerts

def random_events(seed, seconds, n, start=1_600_000_000):
    rnd = random.Random(seed)
    return [
        (f"mid_{rnd.choice('aab')}", str(rnd.randrange(5)), rnd.choices(
            ["coupon", "addCart", "clickItem", "strange"], [6, 3, 1, 1])[0],
         str(rnd.randrange(4)), start + rnd.randrange(seconds))
        for _ in range(n)]


def brute_windows(events, size, slide):
    found = {}
    for mid, uid, evid, item, at in events:
        first = (at - size) // slide * slide + slide
        for start in range(first, at + 1, slide):
            if start <= at < start + size:
                w = found.setdefault((mid, start), (set(), set(), []))
                w[2].append(evid)
                if evid == "coupon":
                    w[0].add(uid)
                    w[1].add(item)
    return found


@pytest.mark.parametrize("size, slide", [(300, 5), (60, 60), (90, 20), (10, 60), (7, 3)])
def test_device_windows_against_brute_force(spark, size, slide):
    events = random_events(size, 900, 120)
    df = spark.createDataFrame(events, "mid string, uid string, evid string, itemid string, at long")
    df = df.withColumn("event_time", F.timestamp_seconds("at"))
    got = {}
    for r in windows.device_windows(df, size, slide).withColumn(
            "events", windows.event_list(F.col("event_counts"))).withColumn(
            "s", F.unix_seconds("window_start")).collect():
        assert (r["mid"], r["s"]) not in got
        got[r["mid"], r["s"]] = (set(r["uids"]), set(r["item_ids"]), r["events"], r["clicked"])
    expected = {
        k: (u, i, sorted(e), "clickItem" in e) for k, (u, i, e) in brute_windows(events, size, slide).items()}
    assert got == expected


def test_coupon_alerts_against_brute_force(spark):
    events = random_events(3, 3000, 200)
    df = spark.createDataFrame(events, "mid string, uid string, evid string, itemid string, at long")
    df = df.withColumn("event_time", F.timestamp_seconds("at"))
    got = {(r[0], r[1]) for r in alerts.coupon_alerts(df).select("mid", F.unix_seconds("window_start")).collect()}
    expected = {
        k for k, (u, _, e) in brute_windows(events, 300, 5).items() if len(u) >= 3 and "clickItem" not in e}
    assert got == expected and got


def test_one_alert_per_device_and_minute_the_last(spark):
    base = datetime(2024, 1, 1, 10, 0, 0)
    ends = [("m", base + timedelta(seconds=s), [str(s)]) for s in (0, 5, 55, 60, 125)]
    df = spark.createDataFrame(ends, "mid string, window_end timestamp, uids array<string>")
    df = df.withColumn("item_ids", F.col("uids")).withColumn("events", F.col("uids"))
    assert [r[0] for r in sorted(alerts.per_minute(df).select("uids").collect())] == [["125"], ["55"], ["60"]]


# Daily active devices

def test_first_startup_is_one_row_per_device_and_day(spark):
    data = [("a", "1", 1000), ("a", "2", 1000), ("a", "0", 2000), ("b", "1", 86_400_000), ("a", "1", 86_400_000)]
    df = dau.with_day(spark.createDataFrame(data, "mid string, uid string, ts long"))
    assert rows(dau.first_startup(df), "mid", "log_date", "uid") == [
        ("a", "1970-01-01", "1"), ("a", "1970-01-02", "1"), ("b", "1970-01-02", "1")]


def test_new_devices_by_day_and_for_one(spark):
    data = [("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-02"), ("c", "2024-01-02")]
    df = spark.createDataFrame(data, "mid string, log_date string")
    assert rows(dau.new_devices(df), "log_date", "new_devices") == [("2024-01-01", 1), ("2024-01-02", 2)]
    assert dau.new_devices(df, "2024-01-02").first()[0] == 2
    assert dau.new_devices(df, "2024-01-03").first()[0] == 0


# Orders

ORDERS = "id string, user_id string, create_time string"


def test_first_order_flag_with_ties_state_and_no_user(spark):
    data = [
        ("1", "u", "2020-01-01 00:00:01"), ("0", "u", "2020-01-01 00:00:01"), ("2", "u", "2020-01-02 00:00:00"),
        ("3", "known", "2020-01-01 00:00:00"), ("4", None, "2020-01-01 00:00:00"),
        ("5", None, "2020-01-03 00:00:00"), ("6", "unsure", "2020-01-01 00:00:00")]
    state = spark.createDataFrame(
        [("known", "1"), ("known", "1"), ("unsure", "0")], "user_id string, if_ordered string")
    flagged = orders.flag_first(spark.createDataFrame(data, ORDERS), state)
    assert rows(flagged, "id", "if_first_order") == [
        ("0", "1"), ("1", "0"), ("2", "0"), ("3", "0"), ("4", "1"), ("5", "0"), ("6", "1")]


def test_exactly_one_first_order_per_user(spark):
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("id"),
        # one user has a third of all orders
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("user_id"),
        F.concat(F.lit("2020-01-01 00:00:"), F.lpad((F.hash("id") % 60 + 60).cast("string"), 2, "0"))
        .alias("create_time"))
    flagged = orders.flag_first(df)
    assert flagged.count() == 2000
    per_user = flagged.groupBy("user_id").agg(F.count_if(F.col("if_first_order") == "1").alias("n"))
    assert per_user.where("n <> 1").isEmpty()


def test_amount_of_a_day_without_orders(spark):
    df = spark.createDataFrame([("2020-01-01", 5.0)], "create_date string, total_amount double")
    assert orders.amount_total(df, "2020-01-01").first()[0] == 5.0
    assert orders.amount_total(df, "2020-01-02").first()[0] == 0.0


# Joins

def test_full_outer_keeps_both_sides_once(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, user_id string")
    right = spark.createDataFrame(
        [("x", "1"), ("y", "1"), ("z", "9"), ("n", None)], "order_detail_id string, order_id string")
    got = {tuple(r) for r in joins.match_batch(left, right, "full_outer").select(
        "id", "order_detail_id", "detail_order_id").collect()}
    assert got == {("1", "x", "1"), ("1", "y", "1"), ("2", None, None), (None, "z", "9"), (None, "n", None)}
    assert rows(joins.match_batch(left, right), "id", "order_detail_id") == [("1", "x"), ("1", "y")]
    with pytest.raises(ValueError):
        joins.match_batch(left, right, "cross")


@pytest.mark.parametrize("salts", [1, 2, 4])
def test_interval_join_bounds(spark, salts):
    at = datetime(2020, 1, 1, 12)
    left = spark.createDataFrame([("1", at)], "id string, order_ts timestamp")
    hour, tick = timedelta(hours=1), timedelta(microseconds=1)
    times = {"in-": at - hour, "out-": at - hour - tick, "in+": at + hour, "out+": at + hour + tick}
    right = spark.createDataFrame(
        [(k, "1", v) for k, v in times.items()], "order_detail_id string, order_id string, detail_ts timestamp")
    got = joins.interval_join(left, right, salts=salts)
    assert rows(got, "order_detail_id") == [("in+",), ("in-",)]
    assert not {"_order_salt", "_detail_salt"} & set(got.columns)


def test_sale_without_user_keeps_age_zero(spark):
    pair = spark.createDataFrame(
        [("d1", "o1", "s", "2020-01-01 00:00:00", u, "k", 1.0, "n", "2020-01-01") for u in ("u", "v", None)],
        "order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
        "sku_id string, sku_price double, sku_name string, dt string")
    users = spark.createDataFrame(
        [("u", "x", "2", "1990-01-01", "F")],
        "id string, login_name string, user_level string, birthday string, gender string")
    got = {r["user_id"]: (r["user_age"], r["user_gender"]) for r in sales.enrich(pair, users, "2020-01-01").collect()}
    assert got == {"u": (30, "F"), "v": (0, None), None: (0, None)}


# Search

def hits(spark):
    data = [(f"{i:02d}", i, "M" if i % 3 else "F", "2020-01-01", "red ring") for i in range(40)]
    data += [("98", 0, None, "2020-01-01", "red ring"), ("99", 50, "F", "2020-01-02", "red gear")]
    return spark.createDataFrame(
        data, "order_detail_id string, user_age int, user_gender string, dt string, sku_name string")


def test_terms_are_limited_and_ordered(spark):
    found = hits(spark)
    assert [tuple(r) for r in facets.terms(found, "user_gender", 2).collect()] == [("M", 26), ("F", 15)]
    assert [tuple(r) for r in facets.terms(found, "user_age", 2).collect()] == [(0, 2), (1, 1)]


def test_shares(spark):
    found = hits(spark)
    assert [r["value"] for r in facets.age_share(found).collect()] == [50.0, 23.8, 26.2]
    assert [r["value"] for r in facets.age_share(found, drop_unknown=True).collect()] == [48.8, 24.4, 26.8]
    assert [r["value"] for r in facets.gender_share(found).collect()] == [61.9, 35.7]
    nothing = found.where("dt = 'x'")
    assert [r["value"] for r in facets.age_share(nothing).collect()] == [0.0, 0.0, 0.0]


def test_pages_cover_all_hits_once(spark):
    found = hits(spark)
    seen = []
    for start in range(0, 50, 10):
        number = facets.page_of_row(start, 10)
        seen += [r[0] for r in facets.page(found, number, 10, "order_detail_id").select("order_detail_id").collect()]
    assert seen == sorted(r[0] for r in found.select("order_detail_id").collect())


def test_deep_page_is_found_by_rank(spark):
    many = spark.range(300_000).select(F.format_string("%09d", "id").alias("k"))
    page = facets.page(many, 2001, 100, "k")
    assert [r[0] for r in page.collect()] == [f"{i:09d}" for i in range(200_000, 200_100)]
    # no task holds, and none gets, more rows than a page within its range needs
    text = plan(page)
    most = [int(n) for n in re.findall(r"(?:limit=|GlobalLimit |LocalLimit )(\d+)", text)]
    assert most and max(most) <= facets.HELD and "k" in re.search(r"Filter \(.*", text).group(0)


def test_pages_of_equal_and_missing_keys(spark):
    # a third of all rows have one key, another third none
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id")
    rows = rows.union(spark.createDataFrame([(7, 1)] * 200, "k long, id long"))
    seen = []
    for number in (1, 4, 11):
        seen.append(facets.page(rows, number, 300, "k", held=100).collect())
    assert [len(p) for p in seen] == [300, 300, 200]
    whole = sorted(rows.collect(), key=lambda r: (r.k is not None, r.k or 0))
    for number, page in zip((1, 4, 11), seen):
        assert [r.k for r in page] == [r.k for r in whole[(number - 1) * 300:number * 300]]
    # rows that differ come once, on whatever page they are
    ids = [r.id for p in seen for r in p if r.k != 7]
    assert len(ids) == len(set(ids))
    assert facets.page(rows, 99, 300, "k", held=100).collect() == []
    assert facets.page(rows.limit(0), 99, 300, "k", held=100).collect() == []


def test_search_document(spark):
    import json

    found = json.loads(serve.sale_search_document(hits(spark), "2020-01-01", "ring", 2, 5).first()[0])
    assert found["total"] == 41
    assert [d["order_detail_id"] for d in found["detail"]] == ["05", "06", "07", "08", "09"]
    assert [s["title"] for s in found["stat"]] == ["年龄占比", "性别占比"]
    assert [len(s["options"]) for s in found["stat"]] == [3, 2]
    empty = json.loads(serve.sale_search_document(hits(spark), "2020-01-01", "", 1, 5).first()[0])
    assert empty["total"] == 0 and empty["detail"] == []
    with pytest.raises(ValueError):
        serve.sale_search(hits(spark), None, "ring", 1, 5)


def test_unknown_metric_has_no_curve(spark):
    df = spark.createDataFrame([("2020-01-01", "05")], "log_date string, log_hour string")
    assert serve.realtime_hour("other", df, "2020-01-01") is None
    assert serve.hour_maps("other", df, "2020-01-01") is None
    maps = serve.hour_maps("dau", df, "2020-01-02").first()
    assert maps["today"] == {} and maps["yesterday"] == {"05": 1}


# Physical plans

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = dau.with_day(spark.range(100).select(
        (F.col("id") % 7).cast("string").alias("mid"), F.col("id").alias("ts"), F.lit("x").alias("uid")))
    text = plan(dau.first_startup(df))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "WindowGroupLimit" in text


def _events(spark, rows):
    df = spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, at long")
    return df.withColumn("event_time", F.timestamp_seconds("at"))


def test_windows_shuffle_before_they_multiply(spark):
    events = _events(spark, random_events(1, 100, 10))
    text = plan(windows.device_windows(events))
    assert text.count("Exchange") == 2
    assert text.index("Generate explode(sequence(lo") < text.index("Exchange")
    # sets and lists are collected of the windows that raise an alert, after the join with these
    text = plan(alerts.coupon_alerts(events))
    assert "collect_" in text and "collect_" not in text[text.index("Join"):]


@pytest.mark.parametrize("size, slide", [(300, 5), (60, 60), (90, 20), (10, 60), (7, 3)])
def test_sweep_counts_users_and_clicks_of_every_window(spark, size, slide):
    events = random_events(size + 1, 2000, 150)
    # a device and a user without a name, twice the same coupon, and one user all the time
    events += [(None, "7", "coupon", "1", 1_600_000_100), (None, "8", "coupon", "1", 1_600_000_101)]
    events += [("a", None, "coupon", "1", 1_600_000_050)] + [events[0]] * 2
    events += [("long", "9", "coupon", "1", 1_600_000_000 + s) for s in range(0, 2000, 2)]
    counted = windows.panes(_events(spark, events), size, slide)
    got = {}
    for r in windows.user_counts(counted, size, slide).collect():
        assert r["lo"] <= r["hi"]
        for w in range(r["lo"], r["hi"] + 1):
            assert (r["mid"], w * slide) not in got
            got[r["mid"], w * slide] = (r["users"], r["clicks"] > 0)
    expected = {k: (len(u - {None}), "clickItem" in e) for k, (u, _, e) in brute_windows(events, size, slide).items()}
    assert {k: v for k, v in got.items() if v != (0, False)} == {k: v for k, v in expected.items() if v != (0, False)}
    found = {(r["mid"], r["s"]) for r in alerts.coupon_alerts(_events(spark, events), size, slide, 2).select(
        "mid", F.unix_seconds("window_start").alias("s")).collect()}
    assert found == {k for k, (users, clicked) in expected.items() if users >= 2 and not clicked}


def test_a_busy_device_is_split_by_time(spark):
    # one device has all events of ten days, of three users that never pause
    events = spark.range(300_000).select(
        F.lit("hot").alias("mid"), (F.col("id") % 3).cast("string").alias("uid"), F.lit("coupon").alias("evid"),
        F.lit("1").alias("itemid"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 3).alias("event_time"))
    counted = windows.panes(events, 300, 5)
    swept = windows.user_counts(counted, 300, 5).cache()
    blocks = swept.select("block").distinct().count()
    assert blocks >= 700
    # ranges are merged: a block takes a few steps, not one for each event, and no window is made on the way
    assert swept.count() <= 4 * blocks
    per_block = windows.BLOCK * 300 // 5
    assert swept.agg(F.max(F.col("hi") - F.col("lo"))).first()[0] < per_block
    pieces = windows._pieces(counted, 300, 5).groupBy("block").count()
    assert pieces.agg(F.max("count")).first()[0] <= 3 * (per_block + 60)
    text = plan(alerts.alerts_of(counted))
    assert re.search(r"hashpartitioning\(hot#\d+, block#", text)


def test_no_python_and_no_cross_join_in_any_plan(spark):
    from tidemill.plans.registry import QUERIES

    for name, query in QUERIES.items():
        if name.startswith("stream_"):
            continue
        text = plan(query(spark, "/root/testdata/sf0.001"))
        for bad in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "ExistingRDD"):
            assert bad not in text, (name, bad)


@pytest.fixture
def eager_skew(spark):
    """Settings under which small data shows what AQE does with a large hot key."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, key):
    """20 000 rows, a third of which share one key."""
    n = F.col("id")
    return spark.range(0, 20_000, 1, 8).select(
        n.cast("string").alias("order_detail_id"),
        F.when(n % 3 == 0, "7").otherwise(n.cast("string")).alias(key),
        F.sha2(n.cast("string"), 256).alias("ballast"))


@pytest.mark.parametrize("how", ["inner", "full_outer"])
def test_a_hot_order_is_split(spark, eager_skew, how):
    order_rows = spark.range(0, 20_000, 1, 8).select(F.col("id").cast("string").alias("id"))
    # partitioned by id already, as flagged or deduplicated orders are
    order_rows = keyed.first_per_key(order_rows, ["id"], [F.col("id")])
    joined = joins.match_batch(order_rows, hot(spark, "order_id"), how)
    assert joined.where("order_detail_id is not null").count() == 20_000
    joined.write.format("noop").mode("overwrite").save()
    assert "skew=true" in split_plan(spark, joined)


def test_a_hot_user_is_spread(spark, eager_skew):
    state = spark.range(0, 5_000, 1, 8).select(
        F.col("id").cast("string").alias("user_id"), F.lit("1").alias("if_ordered"))
    # deduplicated, as a table read gives it: AQE alone would leave the hot user in one task
    state = keyed.first_per_key(state, ["user_id"], [F.col("if_ordered")])
    facts = hot(spark, "user_id").withColumnRenamed("order_detail_id", "id")
    joined = orders.with_user_state(facts, state)
    counts = Counter(r[0] for r in joined.select("if_ordered").collect())
    expected = sum(1 for i in range(20_000) if i % 3 == 0 or i < 5_000)
    assert counts == {"1": expected, "0": 20_000 - expected}
    tasks = joined.where("user_id = '7'").groupBy(F.spark_partition_id()).count().collect()
    # four salts; two of them may meet in one of the eight partitions
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 6_667 * 0.6


def split_plan(spark, df):
    """The final plan after running the whole of it."""
    df = df.select("*")
    df.collect()
    return plan(df)


def test_hours_that_add_up_to_zero_stay_in_the_map(spark):
    rows = spark.createDataFrame(
        [("2024-01-15", "05", 0.0), ("2024-01-15", "06", 1.0), ("2024-01-14", "07", None)],
        "create_date string, create_hour string, total_amount double")
    maps = serve.hour_maps("order_amount", rows, "2024-01-15").first()
    assert maps.today == {"05": 0.0, "06": 1.0} and maps.yesterday == {"07": 0.0}


def test_a_change_without_id_has_no_key(spark):
    from tidemill.sources import changes, views
    from tidemill.plans.registry import PATTERN

    log = views.change_log(spark, "/root/testdata/sf0.001")
    bare = log.withColumn("rows", F.transform("rows", lambda r: F.filter(r, lambda p: p["name"] != "id")))
    routed = changes.route_changes(bare, PATTERN)
    assert routed.count() > 0 and routed.where("key is not null").count() == 0


def test_lines_are_shuffled_once_for_their_orders(spark):
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    d = "/root/testdata/sf0.001"
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        read = [f(spark, d) for f in (views.order_info, views.order_detail, views.user_info)]
        for k, v in values.items():  # behind the views, which set what the jobs rely on
            spark.conf.set(k, v)
        text = plan(sales.sale_detail(*read, "2001-08-01"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # parts and lines, orders and lines, customers and orders, users and orders, and orders to the lines that lie there
    assert text.count("Exchange hashpartitioning") == 9


def test_a_profile_of_an_order_is_that_of_its_lines(spark):
    at = datetime(2020, 1, 1)
    placed = spark.createDataFrame(
        [("o", "s", "2020-01-01 00:00:00", "u", at), ("p", "s", "2020-01-01 00:00:00", None, at)],
        "id string, order_status string, create_time string, user_id string, order_ts timestamp")
    lines = spark.createDataFrame(
        [("1", "o", "k", "n", "1", at), ("2", "p", "k", "n", "x", at), ("2", "p", "k", "n", "x", at)],
        "id string, order_id string, sku_id string, sku_name string, order_price string, detail_ts timestamp")
    users = spark.createDataFrame(
        [("u", "1990-01-01", "F", "2")], "id string, birthday string, gender string, user_level string")
    # the day may be a column of the sales
    for day in ("2020-01-01", F.col("dt")):
        got = sales.sale_detail(placed, lines, users, day).collect()
        assert sorted((r["order_detail_id"], r["user_age"], r["user_gender"]) for r in got) == [
            ("1", 30, "F"), ("2", 0, None), ("2", 0, None)]
