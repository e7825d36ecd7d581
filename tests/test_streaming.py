"""The jobs: any split of the input gives the batch result; late rows, replays, restarts, compaction."""

import json
import random
import re
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oracle import connect, compare
from tidemill.operators import postings
from tidemill.plans import alerts as alert_plan, dau as dau_plan, orders as order_plan, registry, serve
from tidemill.plans.oracle import ORACLE
from tidemill.schemas import DAU_TABLE, TOPIC_COLUMNS
from tidemill.sources import topics, views
from tidemill.streaming import counters, jobs, replay, sinks, tables
from tidemill.streaming.tables import KeyedTable

SMALL = "/root/testdata/sf0.001"
STREAMS = [n for n in registry.QUERIES if n.startswith("stream_")]


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def put(spark, path, rows, topic="startup"):
    """Append one file with (value, timestamp) messages."""
    data = [(topic, None, v, i, t) for i, (v, t) in enumerate(rows)]
    spark.createDataFrame(data, TOPIC_COLUMNS).coalesce(1).write.mode("append").parquet(path)


def shuffled_files(spark, rows, path, files, seed):
    """The messages in files of arbitrary content, one a micro-batch."""
    dealt = rows.withColumn("f", F.pmod(F.xxhash64("value", F.lit(seed)), F.lit(files)))
    for n in random.Random(seed).sample(range(files), files):
        dealt.where(F.col("f") == n).drop("f").coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("name", STREAMS)
def test_registered_streams_match_duckdb(spark, name):
    con = connect(SMALL)
    compare(registry.QUERIES[name](spark, SMALL), con, ORACLE[name])


@pytest.mark.parametrize("files", [1, 5])
def test_dau_for_any_order_of_files(spark, tmp_path, files):
    startups = views.startup_log(spark, SMALL)
    path, table = f"{tmp_path}/topic", jobs.dau_table(f"{tmp_path}/dau").create(spark)
    shuffled_files(spark, replay.messages(startups, "startup", F.timestamp_millis("ts")), path, files, seed=files)
    seen = []
    session = replay.job_session(spark)
    jobs.dau(
        topics.read_topic(session, "startup", "parquet", path, per_trigger=1), table, f"{tmp_path}/cp",
        on_metrics=lambda batch, counts: seen.append(counts), drain=True).awaitTermination()
    expected = dau_plan.first_startup(dau_plan.with_day(startups)).select(*DAU_TABLE.names)
    same(table.read(spark), expected)
    # at most one file a batch, and the counts come from the same job as the write
    assert len(seen) == files
    assert sum(c["startups"] for c in seen) == startups.count()
    assert all(c["devices"] <= c["startups"] for c in seen)


@pytest.mark.parametrize("files", [1, 5])
def test_first_orders_for_any_order_of_files(spark, tmp_path, files):
    found = views.order_info(spark, SMALL)
    path = f"{tmp_path}/topic"
    shuffled_files(spark, replay.messages(found, "order", F.col("order_ts")), path, files, seed=files)
    session = replay.job_session(spark)
    table = jobs.order_table(f"{tmp_path}/orders").create(spark)
    state = jobs.user_state_table(f"{tmp_path}/state").create(spark)
    stream = topics.read_topic(session, "order", "parquet", path, per_trigger=1)
    jobs.orders(stream, table, f"{tmp_path}/cp1", drain=True).awaitTermination()
    jobs.user_state(stream, state, f"{tmp_path}/cp2", drain=True).awaitTermination()
    columns = ["id", "user_id", "consignee_tel", "total_amount", "create_date", "create_hour", "if_first_order"]
    expected = order_plan.flag_first(order_plan.prepare(found))
    same(jobs.flagged_orders(spark, table, state).select(*columns), expected.select(*columns))


def test_alerts_for_any_order_of_files(spark, tmp_path):
    rnd = random.Random(1)
    start = 1_600_000_000_000
    data = [
        ("m", str(rnd.randrange(6)), rnd.choices(["coupon", "clickItem", "share"], [8, 1, 2])[0],
         str(rnd.randrange(9)), start + rnd.randrange(1_200_000)) for _ in range(80)]
    events = spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, ts long")
    path, table = f"{tmp_path}/topic", jobs.pane_table(f"{tmp_path}/alerts").create(spark)
    shuffled_files(spark, replay.messages(events, "event", F.timestamp_millis("ts")), path, 3, seed=4)
    session = replay.job_session(spark)
    jobs.alerts(
        topics.read_topic(session, "event", "parquet", path, per_trigger=1), table, f"{tmp_path}/cp",
        delay="1 hour", drain=True).awaitTermination()
    batch = alert_plan.per_minute(alert_plan.coupon_alerts(
        events.withColumn("event_time", F.timestamp_millis("ts"))))
    assert not batch.isEmpty()
    same(jobs.current_alerts(spark, table), batch)
    day = batch.agg(F.min("dt")).first()[0]
    same(jobs.current_alerts(spark, table, day=day), batch.where(F.col("dt") == day))
    # an event is one row of state and of the table at most, although it lies in 60 windows
    assert table.read(spark).count() <= len(data)


def test_good_and_bad_rows_are_all_rows(spark, tmp_path):
    path, session = f"{tmp_path}/topic", replay.job_session(spark)
    at = datetime(2024, 1, 1)
    now = [('{"id":"%d","user_id":"u","create_time":"2024-01-01 10:00:00"}' % n, at) for n in range(20)]
    now[3], now[8], now[9] = ('{"id":"3"', at), (None, at), ("", at)
    bad, stored = f"{tmp_path}/bad", jobs.order_table(f"{tmp_path}/orders").create(spark)
    state, people = jobs.user_state_table(f"{tmp_path}/state").create(spark), jobs.user_table(f"{tmp_path}/u").create(spark)
    put(spark, path, now, "order")
    put(spark, path, now, "user")

    def run(name):
        stream = topics.read_topic(session, "order", "parquet", path)
        jobs.orders(stream, stored, f"{tmp_path}/cp{name}", bad=sinks.bad_rows(bad, "orders"),
                    drain=True).awaitTermination()
        # a job with state has the same beside it
        jobs.user_state(stream, state, f"{tmp_path}/cps{name}", drain=True).awaitTermination()
        jobs.bad_records(stream, "order_info", sinks.bad_rows(bad, "state"), f"{tmp_path}/cpb{name}",
                         drain=True).awaitTermination()
        jobs.users(topics.read_topic(session, "user", "parquet", path), people, f"{tmp_path}/cpu{name}",
                   bad=sinks.bad_rows(bad, "users"), drain=True).awaitTermination()

    def check():
        found = spark.read.parquet(bad).collect()
        for job, table, topic in (("orders", stored, "order"), ("users", people, "user"), ("state", stored, "order")):
            own = {(r["offset"], r["reason"], r["topic"]) for r in found if r["job"] == job}
            assert own == {(3, "no JSON object", topic), (8, "no value", topic), (9, "empty value", topic)}
            assert len(own) + table.read(spark).count() == len(now)
        assert len(found) == 9

    run("a")
    check()
    # the whole batch once more, as from a lost checkpoint
    run("b")
    check()


def test_counters_follow_late_startups_and_changed_orders(spark, tmp_path):
    day = 86_400_000
    path, session = f"{tmp_path}/topic", replay.job_session(spark)
    devices = counters.device_counters(f"{tmp_path}/devices").create(spark)
    table = jobs.dau_table(f"{tmp_path}/dau").create(spark)

    def run(batch):
        put(spark, path, [(f'{{"mid":"{m}","ts":"{t}"}}', datetime(2024, 1, 1)) for m, t in batch])
        jobs.dau(topics.read_topic(session, "startup", "parquet", path), table, f"{tmp_path}/cp", counted_at=devices,
                 drain=True).awaitTermination()

    def values(metric):
        rows = devices.counts.read(spark).where(F.col("metric") == metric).collect()
        return {int(r["day"][-2:]): int(r["value"]) for r in rows if r["value"]}

    run([("a", 5 * day), ("a", 5 * day + 9), ("b", 5 * day), ("c", 7 * day)])
    assert values("dau") == {6: 2, 8: 1} and values("new_mid") == {6: 2, 8: 1}
    # late: a earlier on a known day, c on an earlier day, d new; b again
    run([("a", 5 * day - 1), ("a", 5 * day), ("c", 2 * day), ("d", 7 * day), ("b", 8 * day)])
    assert values("dau") == {3: 1, 5: 1, 6: 2, 8: 2, 9: 1} and values("new_mid") == {3: 1, 5: 1, 6: 1, 8: 1}
    whole = dau_plan.new_devices(table.read(spark))
    assert {int(r["log_date"][-2:]): r["new_devices"] for r in whole.collect()} == values("new_mid")
    board = counters.board(devices.counts.read(spark), "1970-01-06")
    assert {r["id"]: r["value"] for r in board.collect()} == {"dau": 2.0, "new_mid": 1.0, "order_amount": 0.0}

    amounts = counters.counter_table(f"{tmp_path}/amounts").create(spark)
    stored = jobs.order_table(f"{tmp_path}/orders").create(spark)
    order = '{"id":"%s","total_amount":"%s","create_time":"2024-01-%s 10:00:00"}'
    for batch in ([("1", "1.10", "01"), ("2", "2.25", "01"), ("3", "", "02")], [("2", "7.50", "02"), ("1", "0.90", "01")]):
        put(spark, path, [(order % o, datetime(2024, 1, 1)) for o in batch], "order")
        jobs.orders(topics.read_topic(session, "order", "parquet", path), stored, f"{tmp_path}/cp-orders",
                    counts_at=amounts, drain=True).awaitTermination()
    assert {r["day"]: str(r["value"]) for r in amounts.read(spark).collect()} == {
        "2024-01-01": "0.90", "2024-01-02": "7.50"}


ORDER = '{"id":"%s","user_id":"u","create_time":"2024-01-01 10:00:00"}'
DETAIL = '{"id":"%s","order_id":"%s","order_price":"1.5","sku_name":"ring"}'


def test_sales_in_either_order_and_late_rows(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    path, users = f"{tmp_path}/topic", jobs.user_table(f"{tmp_path}/users").create(spark)
    table = jobs.sale_table(f"{tmp_path}/sales").create(spark)
    session = replay.job_session(spark)

    def run():
        jobs.sales(
            topics.read_topic(session, "order", "parquet", path),
            topics.read_topic(session, "order_detail", "parquet", path), users, table, f"{tmp_path}/cp",
            as_of="2024-01-01", delay="10 minutes", drain=True).awaitTermination()

    def known():
        return sorted(r["order_detail_id"] for r in table.read(spark).collect())

    # a line before its order, an order before its line, and both together
    put(spark, path, [(DETAIL % ("d1", "a"), at), (DETAIL % ("d0", "b"), at)], "order_detail")
    put(spark, path, [(ORDER % "b", at)], "order")
    run()
    assert known() == ["d0"]
    put(spark, path, [(ORDER % "a", at + timedelta(minutes=5))], "order")
    put(spark, path, [(DETAIL % ("d2", "b"), at + timedelta(minutes=59))], "order_detail")
    run()
    assert known() == ["d0", "d1", "d2"]
    # three hours on, both buffers have let go of order b
    later = at + timedelta(hours=3)
    put(spark, path, [(ORDER % "z", later)], "order")
    put(spark, path, [(DETAIL % ("d9", "y"), later)], "order_detail")
    run()
    put(spark, path, [(DETAIL % ("d3", "b"), at + timedelta(minutes=1))], "order_detail")
    run()
    assert known() == ["d0", "d1", "d2"]
    assert {r["user_age"] for r in table.read(spark).collect()} == {0}

    # the line that came behind the watermark is added by a repair, once, also if the run is made again
    repairs = jobs.sale_table(f"{tmp_path}/repairs").create(spark)
    rows = spark.read.schema(TOPIC_COLUMNS).parquet(path)
    for run_id in (0, 0, 1):
        jobs.repair_sales(
            rows.where("topic = 'order'"), rows.where("topic = 'order_detail'"), users, table, repairs, run_id,
            as_of="2024-01-01")
        assert [r["order_detail_id"] for r in repairs.read(spark).collect()] == ["d3"]
    assert sorted(r["order_detail_id"] for r in jobs.all_sales(spark, table, repairs).collect()) == [
        "d0", "d1", "d2", "d3"]


def test_search_by_the_index_that_the_job_keeps(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    path, users = f"{tmp_path}/topic", jobs.user_table(f"{tmp_path}/users").create(spark)
    table = jobs.sale_table(f"{tmp_path}/sales").create(spark)
    index = jobs.posting_table(f"{tmp_path}/words").create(spark)
    session = replay.job_session(spark)
    line = '{"id":"%s","order_id":"%s","order_price":"1.5","sku_name":"%s"}'

    def run():
        jobs.sales(
            topics.read_topic(session, "order", "parquet", path),
            topics.read_topic(session, "order_detail", "parquet", path), users, table, f"{tmp_path}/cp",
            as_of="2024-01-01", index=index, drain=True).awaitTermination()

    names = ["Small Ring", "ring ring", "small  ring, red", "", "red", "戒指 small"]
    put(spark, path, [(ORDER % o, at) for o in "ab"], "order")
    put(spark, path, [(line % (f"d{i}", "ab"[i % 2], n), at) for i, n in enumerate(names)], "order_detail")
    run()
    # a line comes again under another name
    put(spark, path, [(line % ("d2", "a", "big ring"), at)], "order_detail")
    run()

    def ids(keyword, day=None):
        found = postings.search(table.read(spark), index.read(spark), day, keyword)
        scanned = serve.search(table.read(spark), day, keyword)
        same(found, scanned)
        return sorted(r["order_detail_id"] for r in found.collect())

    for _ in range(2):
        assert ids("RING small") == ["d0"]
        assert ids("ring") == ["d0", "d1", "d2"] and ids("指") == ["d5"] and ids("", None) == ids("nothing") == []
        assert ids("ring", "2024-01-01") == ["d0", "d1", "d2"] and ids("ring", "2024-01-02") == []
        index.compact(spark, 5)
        index.vacuum(spark, 0)
    # only the folders of the words are read, and only their day
    tokens = postings.tokens_of(spark, "ring small")
    plan = postings.of_words(index.read(spark), tokens, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert "In(token, [" in plan and "EqualTo(dt,2024-01-01)" in plan


def test_users_insert_and_update(spark, tmp_path):
    path, table = f"{tmp_path}/topic", jobs.user_table(f"{tmp_path}/users").create(spark)
    session = replay.job_session(spark)
    user = '{"id":"%s","user_level":"%s"}'
    now = datetime(2024, 1, 1)
    for batch in ([("1", "a"), ("1", "b"), ("2", "a")], [("2", "c"), ("3", "a")]):
        put(spark, path, [(user % u, now) for u in batch], "user")
        jobs.users(topics.read_topic(session, "user", "parquet", path), table, f"{tmp_path}/cp",
                   drain=True).awaitTermination()
    levels = {r["id"]: r["user_level"] for r in table.read(spark).collect()}
    assert levels == {"1": "b", "2": "c", "3": "a"}
    wanted = spark.createDataFrame([("2",), ("9",)], "id string")
    assert [r["user_level"] for r in table.read(spark, wanted=wanted).collect()] == ["c"]


def test_append_only_dau_drops_repeats(spark, tmp_path):
    path, out = f"{tmp_path}/topic", f"{tmp_path}/out"
    startup = '{"mid":"%s","ts":"%d"}'
    day = 1_704_067_200_000  # 2024-01-01
    session = replay.job_session(spark)
    for batch in ([("a", day), ("a", day + 1), ("b", day)], [("a", day + 5000), ("a", day + 86_400_000)]):
        put(spark, path, [(startup % s, datetime(2024, 1, 1)) for s in batch])
        jobs.dau_append_only(topics.read_topic(session, "startup", "parquet", path), out, f"{tmp_path}/cp",
                             drain=True).awaitTermination()
    got = spark.read.schema(DAU_TABLE).parquet(out)
    assert sorted((r["mid"], r["log_date"]) for r in got.collect()) == [
        ("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-01")]


def table_of(spark, path):
    return jobs.dau_table(path).create(spark)


def batch_of(spark, rows):
    df = spark.createDataFrame(rows, "mid string, ts long")
    return dau_plan.with_day(df).select(*[
        F.col(c) if c in ("mid", "ts", "log_date", "log_hour") else F.lit("x").alias(c) for c in DAU_TABLE.names])


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    table = table_of(spark, f"{tmp_path}/t")
    table.upsert(batch_of(spark, [("a", 5), ("b", 7)]), 0)
    table.upsert(batch_of(spark, [("a", 3), ("c", 9)]), 1)
    before = sorted(table.read(spark).collect())
    table.upsert(batch_of(spark, [("a", 3), ("c", 9)]), 1)
    table.upsert(batch_of(spark, [("a", 5), ("b", 7)]), 0)
    assert sorted(table.read(spark).collect()) == before
    assert table.rows(spark).count() == 4
    assert {(r["mid"], r["ts"]) for r in before} == {("a", 3), ("b", 7), ("c", 9)}
    # what batch 1 saw the first time, it sees again
    assert {r["mid"] for r in table.rows(spark, before=1).collect()} == {"a", "b"}


def test_compaction_and_vacuum_keep_the_table(spark, tmp_path):
    day = 86_400_000
    table = table_of(spark, f"{tmp_path}/t")
    for n in range(4):
        table.upsert(batch_of(spark, [("a", 50 - n), ("b", day + n), (f"m{n}", 7)]), n)
    before = sorted(table.read(spark).collect())
    table.compact(spark, upto=1)
    assert sorted(table.read(spark).collect()) == before
    table.vacuum(spark, 0)
    assert sorted(table.read(spark).collect()) == before
    table.compact(spark, upto=3)
    table.vacuum(spark, 0)
    assert sorted(table.read(spark).collect()) == before
    assert table.rows(spark).count() == len(before)
    # a late, earlier startup of a folded day still wins, and a day without changes is left alone
    table.upsert(batch_of(spark, [("a", 1)]), 4)
    table.compact(spark, upto=4)
    table.vacuum(spark, 0)
    after = {r["mid"]: r["ts"] for r in table.read(spark).collect()}
    assert after["a"] == 1 and len(after) == len(before)
    one_day = table.read(spark).where("log_date = '1970-01-02'")
    text = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in text
    assert [r["mid"] for r in one_day.collect()] == ["b"]


def test_a_table_without_days(spark, tmp_path):
    table = jobs.user_state_table(f"{tmp_path}/t").create(spark)
    schema = "user_id string, if_ordered string, first_time string, first_order_id string"
    table.upsert(spark.createDataFrame([("u", "1", "2020-01-02", "2")], schema), 0)
    table.upsert(spark.createDataFrame([("u", "1", "2020-01-01", "1"), ("v", "1", "2020-01-01", "3")], schema), 1)
    table.compact(spark, upto=1)
    table.vacuum(spark, 0)
    assert {r["user_id"]: r["first_order_id"] for r in table.read(spark).collect()} == {"u": "1", "v": "3"}


def test_ingest_stamps_archives_and_routes(spark, tmp_path):
    lines, archive, routed = f"{tmp_path}/lines", f"{tmp_path}/archive", f"{tmp_path}/topics"
    now = F.lit(1_704_067_200_000).cast("bigint")
    session = replay.job_session(spark)

    def run():
        stream = session.readStream.schema("value string").text(lines)
        jobs.ingest_logs(stream, archive, sinks.topic_files(routed), f"{tmp_path}/cp", now=now,
                         bad=sinks.bad_rows(f"{tmp_path}/bad", "logs"), drain=True).awaitTermination()

    spark.createDataFrame(
        [('{"type":"startup","mid":"a","ts":1}',), ('{"type":"event","mid":"b"}',), ("broken",)],
        "value string").write.mode("append").text(lines)
    run()
    spark.createDataFrame([("also broken",)], "value string").write.mode("append").text(lines)
    run()  # nothing to write
    spark.createDataFrame([('{"mid":"c"}',)], "value string").write.mode("append").text(lines)
    run()
    got = {(r["topic"], r["value"]) for r in spark.read.parquet(routed).collect()}
    assert got == {
        ("startup", '{"type":"startup","mid":"a","ts":1704067200000}'),
        ("event", '{"type":"event","mid":"b","ts":1704067200000}'),
        ("event", '{"mid":"c","ts":1704067200000}')}
    assert {(r["value"], r["reason"]) for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {
        ("broken", "no JSON object"), ("also broken", "no JSON object")}
    archived = spark.read.text(archive)
    assert {r["value"] for r in archived.collect()} == {v for _, v in got}
    assert (tmp_path / "archive" / "dt=2024-01-01").is_dir()
    # the topic files feed a job
    table = table_of(spark, f"{tmp_path}/dau")
    jobs.dau(topics.read_topic(session, "startup", "parquet", routed), table, f"{tmp_path}/cp-dau",
             drain=True).awaitTermination()
    assert [(r["mid"], r["log_date"]) for r in table.read(spark).collect()] == [("a", "2024-01-01")]


def test_ingest_changes_to_topics(spark, tmp_path):
    entries, routed = f"{tmp_path}/entries", f"{tmp_path}/topics"
    log = views.change_log(spark, SMALL)
    log.write.parquet(entries)
    session = replay.job_session(spark)
    jobs.ingest_changes(
        session.readStream.schema(log.schema).parquet(entries), registry.PATTERN, sinks.topic_files(routed),
        f"{tmp_path}/cp", drain=True).awaitTermination()
    same(spark.read.parquet(routed).select("topic", "key", "value"), registry.route_changes(spark, SMALL))


def test_keyed_table_orders_by_several_columns(spark, tmp_path):
    schema = jobs.USER_TABLE
    table = KeyedTable(f"{tmp_path}/t", schema, ("id",), ("-batch_id", "-offset")).create(spark)
    def rows(level, offset):
        return spark.createDataFrame([("1", "n", level, None, None, offset)], schema)
    table.upsert(rows("a", 9), 0)
    table.upsert(rows("b", 1), 1)
    assert table.read(spark).first()["user_level"] == "b"


def _startup(mid, ts, day):
    return {"mid": mid, "uid": "u", "appid": "a", "area": "x", "os": "o", "ch": "c", "type": "startup", "vs": "1",
            "ts": ts, "log_date": day, "log_hour": "01"}


def test_rows_without_a_day_survive_compaction(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "dau")).create(spark)
    names = table.schema.names

    def put(batch_id, *rows):
        full = [tuple(_startup(*r).get(n) for n in names) for r in rows]
        table.upsert(spark.createDataFrame(full, table.schema), batch_id)

    for batch_id, row in enumerate([("a", 1, None), ("b", 2, None), ("c", 3, ""), ("d", 4, ""), ("e", 5, "2024-01-01")]):
        put(batch_id, row)
        table.compact(spark, batch_id)
        table.vacuum(spark, 0)
    assert sorted(r.mid for r in table.read(spark).collect()) == ["a", "b", "c", "d", "e"]


def test_an_empty_batch_leaves_no_folder(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "dau")).create(spark)
    full = [tuple(_startup("a", 1, "2024-01-01").get(n) for n in table.schema.names)]
    rows = spark.createDataFrame(full, table.schema)
    table.upsert(rows, 0)
    table.upsert(rows.limit(0), 1)
    table.upsert(rows, 2)
    table.upsert(rows.limit(0), 2)
    assert [p.name.rsplit("-", 1)[0] for p in (tmp_path / "dau/data").iterdir() if p.name in {
        part.folder for part in table.live(spark)}] == ["batch=0"]
    assert len(list((tmp_path / "dau/data").iterdir())) == 2  # batch 2 as well, until its first attempt is old
    table.vacuum(spark, 0)
    assert len(list((tmp_path / "dau/data").iterdir())) == 1 and table.read(spark).count() == 1


def test_folders_stay_few_over_many_batches(spark, tmp_path):
    table = jobs.dau_table(str(tmp_path / "dau"), fanout=4, keep=0).create(spark)
    most, want = 0, {}
    for n in range(50):
        rows = [("a", 100 - n), (f"m{n % 7}", 500 + n), (f"n{n}", n)]
        for mid, ts in rows:
            want[mid] = min(ts, want.get(mid, ts))
        table.upsert(batch_of(spark, rows).coalesce(1), n)
        if n % 10 == 9:
            # the last batch once more, as after a crash
            table.upsert(batch_of(spark, rows).coalesce(1), n)
        most = max(most, len(table.live(spark)))
        assert len(list((tmp_path / "dau/data").iterdir())) <= 2 * 4 + 9
    assert {r["mid"]: r["ts"] for r in table.read(spark).collect()} == want
    assert most <= 3 * 3 + 1 and len(table.live(spark)) < 8
    assert {p.level for p in table.live(spark)} == {0, 2} and max(p.last for p in table.live(spark)) == 49


def test_a_killed_fold_changes_nothing(spark, tmp_path, monkeypatch):
    table = jobs.dau_table(str(tmp_path / "dau"), fanout=100).create(spark)
    for n in range(3):
        table.upsert(batch_of(spark, [("a", 9 - n), (f"m{n}", n)]), n)
    before, live = sorted(table.read(spark).collect()), table.live(spark)
    reader = table.read(spark)

    def die(*_):
        raise RuntimeError("killed")
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_commit", die)
        with pytest.raises(RuntimeError):
            table.compact(spark, 2)
        with pytest.raises(RuntimeError):
            table.upsert(batch_of(spark, [("z", 1)]), 3)
    assert table.live(spark) == live and sorted(table.read(spark).collect()) == before
    assert len(list((tmp_path / "dau/data").iterdir())) == 5
    table.compact(spark, 2)
    # who began to read before the fold still finds the folders, until these are old
    table.vacuum(spark, 3600)
    assert sorted(reader.collect()) == before == sorted(table.read(spark).collect())
    table.vacuum(spark, 0)
    assert len(list((tmp_path / "dau/data").iterdir())) == 1
    assert sorted(table.read(spark).collect()) == before
    # a replay of a folded batch adds nothing
    table.upsert(batch_of(spark, [("a", 7), ("m2", 2)]), 2)
    assert table.rows(spark).count() == len(before)


def test_only_days_of_the_batch_are_read(spark, tmp_path):
    table = table_of(spark, f"{tmp_path}/t")
    day = 86_400_000
    table.upsert(batch_of(spark, [(f"m{n}", n * day) for n in range(60)]), 0)
    table.compact(spark, 0)
    # a clock that is wrong by decades does not make the days between part of the batch
    fresh = batch_of(spark, [("m0", 1), ("m59", 59 * day)]).persist()
    found = jobs._of_days(table.rows(spark, before=1), fresh)
    assert {r["mid"] for r in found.collect()} == {"m0", "m59"}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    fresh.unpersist()


def test_messages_without_a_time_are_fed(spark, tmp_path):
    rows = spark.sql("select string(id) value, if(id % 3 = 0, null, timestamp_seconds(id)) timestamp from range(9)")
    replay.feed(rows, str(tmp_path / "topic"), 3, lambda: None)
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 9


def test_a_single_folder_is_folded_as_it_is(spark, tmp_path, monkeypatch):
    index = jobs.posting_table(f"{tmp_path}/index").create(spark)
    rows = [(t, str(n), "2024-01-01", b) for n in range(20) for t, b in (("ring", "01"), ("small", "02"))]
    index.upsert(spark.createDataFrame(rows, "token string, order_detail_id string, dt string, bucket string"), 0)
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "winners", None)  # nothing to choose in one folder
        index.compact(spark, 0)
    assert sorted(map(tuple, index.read(spark).collect())) == sorted(rows)
    assert len(list((tmp_path / "index" / "data").glob("fold=*/bucket=*/*.parquet"))) == 2
    found = postings.lines_with(index.read(spark), {"ring": "01", "small": "02"})
    assert found.count() == 20
    raw = postings.lines_with(index.rows(spark), {"ring": "01", "small": "02"})
    assert raw._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("small, files", [(1000, 1), (10, 4)])
def test_a_large_batch_of_messages_is_written_where_it_lies(spark, tmp_path, monkeypatch, small, files):
    monkeypatch.setattr(sinks, "SMALL", small, raising=False)
    rows = spark.range(0, 100, 1, 4).select(F.lit("order").alias("topic"), F.col("id").cast("string").alias("value"))
    sinks.topic_files(f"{tmp_path}/topics")(rows, 0)
    assert len(list(tmp_path.glob("topics/topic=order/batch_id=0/*.parquet"))) == files
    assert spark.read.parquet(f"{tmp_path}/topics").count() == 100


def test_only_rows_near_the_watermark_wait(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    path, users = f"{tmp_path}/topic", jobs.user_table(f"{tmp_path}/users").create(spark)
    table = jobs.sale_table(f"{tmp_path}/sales").create(spark)
    session = replay.job_session(spark)

    def run(*lines):
        for name, message, time in lines:
            put(spark, path, [(message, time)], name)
        jobs.sales(
            topics.read_topic(session, "order", "parquet", path),
            topics.read_topic(session, "order_detail", "parquet", path), users, table, f"{tmp_path}/cp",
            as_of="2024-01-01", delay="10 minutes", drain=True).awaitTermination()
        newest = max((tmp_path / "cp" / "waiting").glob("after=*"), key=lambda p: int(p.name.split("=")[1]))
        return sorted(r["id"] for r in spark.read.parquet(str(newest)).collect())

    assert run(("order", ORDER % "a", at), ("order_detail", DETAIL % ("d1", "a"), at)) == ["a", "d1"]
    # a minute past the reach of the rows at hand; the old ones have let go
    later = at + timedelta(minutes=71)
    assert run(("order", ORDER % "b", later), ("order_detail", DETAIL % ("d2", "b"), later)) == ["b", "d2"]
    assert sorted(r["order_detail_id"] for r in table.read(spark).collect()) == ["d1", "d2"]


def test_slices_are_made_once(spark, tmp_path):
    at = [datetime(2024, 1, 1, h) for h in range(10)]
    rows = spark.createDataFrame([("t", None, str(i), i, t) for i, t in enumerate(at)], TOPIC_COLUMNS)
    rows = rows.coalesce(1).withColumn("value", F.uuid())
    seen = []
    replay.feed(rows, f"{tmp_path}/topic", 3, lambda: seen.append(spark.read.parquet(f"{tmp_path}/topic").count()))
    assert seen[-1] == 10 and seen == sorted(seen) and len(seen) == 3
    made = [r["value"] for p in tmp_path.glob("topic-*") for r in spark.read.parquet(f"{tmp_path}/topic").collect()]
    assert len(set(made)) == 10


def test_messages_that_come_last_and_times_from_elsewhere(spark, tmp_path):
    at = [datetime(2024, 1, 1, h) for h in range(10)]
    rows = spark.createDataFrame([("t", None, str(i), i, t) for i, t in enumerate(at)], TOPIC_COLUMNS)
    seen = []
    replay.feed(
        rows, f"{tmp_path}/topic", 2, lambda: seen.append(
            {int(r["value"]) for r in spark.read.parquet(f"{tmp_path}/topic").collect()}),
        times=rows.where("hour(timestamp) < 3"), last=F.col("value").isin("0", "9"))
    assert seen == [{1}, set(range(1, 9)), set(range(10))]


def kept_shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return set(re.findall(r"/shuffle_(\d+)_", files))


def test_jobs_leave_no_shuffle_files(spark, tmp_path):
    at, path = datetime(2024, 1, 1, 10), f"{tmp_path}/topic"
    users, table = (make(f"{tmp_path}/{n}").create(spark) for make, n in (
        (jobs.user_table, "users"), (jobs.sale_table, "sales")))
    put(spark, path, [(ORDER % o, at) for o in "ab"], "order")
    put(spark, path, [(DETAIL % (f"d{i}", "ab"[i % 2]), at) for i in range(4)], "order_detail")
    session = replay.job_session(spark)
    stood = kept_shuffles(spark)
    jobs.sales(
        topics.read_topic(session, "order", "parquet", path), topics.read_topic(session, "order_detail", "parquet", path),
        users, table, f"{tmp_path}/cp", as_of="2024-01-01", drain=True).awaitTermination()
    # files go in the background; those of the buyers, which are cached, stay until they are collected
    for _ in range(50):
        left = kept_shuffles(spark) - stood
        if len(left) > 1:
            time.sleep(0.2)
    assert len(left) <= 1
    assert table.read(spark).count() == 4


@pytest.mark.parametrize("most", [100, 0])
def test_lines_and_orders_that_come_again(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(tables, "MOST_REPEATED", most)
    at, path = datetime(2024, 1, 1, 10), f"{tmp_path}/topic"
    users, table = (make(f"{tmp_path}/{n}").create(spark) for make, n in (
        (jobs.user_table, "users"), (jobs.sale_table, "sales")))
    session = replay.job_session(spark)
    order = '{"id":"%s","user_id":"%s","create_time":"2024-01-01 %s:00:00"}'

    def run(orders, lines, level):
        users.upsert(spark.createDataFrame([("u", level, "2000-01-01", 1)], "id string, user_level string, "
                                           "birthday string, offset long").select(
            "id", F.lit(None).cast("string").alias("login_name"), "user_level", "birthday",
            F.lit("M").alias("gender"), "offset"), len(level))
        put(spark, path, [(order % o, at) for o in orders], "order")
        put(spark, path, [(json.dumps({"id": i, "order_id": o, "sku_name": n}), at) for i, o, n in lines],
            "order_detail")
        jobs.sales(
            topics.read_topic(session, "order", "parquet", path),
            topics.read_topic(session, "order_detail", "parquet", path), users, table, f"{tmp_path}/cp",
            as_of="2024-01-01", drain=True).awaitTermination()
        return sorted((r["order_detail_id"] or "", r["order_id"], r["create_time"][11:13], r["user_level"], r["user_age"])
                      for r in table.read(spark).collect())

    # d1 meets two orders, d2 one order that came twice, d3 comes twice, one line has no id and one is without its order
    assert run([("a", "u", "12"), ("b", "u", "11"), ("c", "u", "10"), ("c", "v", "09")],
               [("d1", "a", "x"), ("d1", "b", "x"), ("d2", "c", "x"), ("d3", "a", "x"), ("d3", "a", "x"), (None, "a", "x"),
                ("d4", "e", "x")],
               "1") == [
        ("", "a", "12", "1", 24), ("d1", "b", "11", "1", 24), ("d2", "c", "09", None, 0), ("d3", "a", "12", "1", 24)]
    # the order of the line that waits comes; a line comes again, with the profile of now
    assert run([("e", "u", "08")], [("d3", "a", "y")], "22") == [
        ("", "a", "12", "1", 24), ("d1", "b", "11", "1", 24), ("d2", "c", "09", None, 0), ("d3", "a", "12", "22", 24),
        ("d4", "e", "08", "22", 24)]


def test_a_whole_table_is_read_without_shuffling_its_rows(spark, tmp_path, monkeypatch):
    table, repairs = (jobs.sale_table(f"{tmp_path}/{n}").create(spark) for n in ("sales", "repairs"))

    def rows(day, *ids):
        return spark.createDataFrame(
            [(i, *[day] * 6, 1, day, 1.0, day, f"2024-01-0{day}") for i in ids], table.schema)

    table.upsert(rows("1", "a", "b", "c"), 0)
    repairs.upsert(rows("3", "x", "a"), 0)
    alone = table.read(spark, whole=True)
    assert len(alone.collect()) == 3
    # no row goes to the choice of the newest
    assert "EmptyRelation" in alone._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # c comes again on its day and b on another, which is another key; one id is none
    table.upsert(rows("1", "c", "d", None), 1)
    table.upsert(rows("2", "b", None), 2)
    for most in (100, 0):
        monkeypatch.setattr(tables, "MOST_REPEATED", most)
        same(table.read(spark, whole=True), table.read(spark))
        same(jobs.all_sales(spark, table, repairs, whole=True), jobs.all_sales(spark, table, repairs))
    found = jobs.all_sales(spark, table, repairs, whole=True).collect()
    assert sorted((r["order_detail_id"] or "", r["dt"][-1]) for r in found) == [
        ("", "1"), ("", "2"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", "1"), ("d", "1"), ("x", "3")]
