"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame.

Results are flat: sets and lists become sorted, comma-joined strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.functions import scalar
from tidemill.operators import facets, joins, postings, windows
from tidemill.plans import alerts, dau, orders, sales, serve
from tidemill.schemas import DAU_TABLE, SALE_DETAIL, TOPIC_COLUMNS
from tidemill.sources import changes, tables, topics, views
from tidemill.streaming import counters, jobs, replay, sinks

DAU_DAY = "2024-01-15"
ORDER_DAY = "1996-09-17"
AS_OF = "2001-08-01"
KEYWORD = "ring small"
DAY_KEYWORD = "small"
STAMP = 1700000000000
PATTERN = r"shop\..*"
# the alert windows (size, slide in seconds): wide ones too, as the tables hold few alerts in 5 minutes
WIDE = (1800, 60)
DENSE = (1800, 20)
PAGE, PAGE_SIZE = 1, 20
DEEP_PAGE = 2001


# Inputs

def _startups(spark: SparkSession, d: str) -> DataFrame:
    return dau.with_day(views.startup_log(spark, d))


def _dau(spark: SparkSession, d: str) -> DataFrame:
    return dau.first_startup(_startups(spark, d))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return orders.prepare(views.order_info(spark, d))


def _details(spark: SparkSession, d: str) -> DataFrame:
    return sales.as_details(views.order_detail(spark, d))


def _sales(spark: SparkSession, d: str) -> DataFrame:
    return sales.sale_detail(
        views.order_info(spark, d), views.order_detail(spark, d), views.user_info(spark, d), AS_OF)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    return serve.search(_sales(spark, d), None, KEYWORD)


def _day_search(spark: SparkSession, d: str) -> DataFrame:
    return serve.search(_sales(spark, d), ORDER_DAY, DAY_KEYWORD)


def _joined(column: str):
    return F.array_join(F.array_sort(column), ",").alias(column)


def _time(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# Scalars

def log_date_hour(spark, d):
    return _startups(spark, d).select("mid", "ts", "log_date", "log_hour")


def create_time_split(spark, d):
    return _orders(spark, d).select("id", "create_time", "create_date", "create_hour")


def mask_phone(spark, d):
    return _orders(spark, d).select("id", "consignee_tel")


def age_years(spark, d):
    age = scalar.age_years(F.col("birthday"), F.lit(AS_OF).cast("date"))
    return views.user_info(spark, d).select("id", "birthday", age.alias("age"))


def price_cast(spark, d):
    return views.order_detail(spark, d).select(
        "id", scalar.to_price(F.col("order_price")).alias("sku_price"))


def yesterday_compact(spark, d):
    return _orders(spark, d).select(
        "id", scalar.yesterday(F.col("create_date")).alias("yesterday"),
        scalar.compact_date(F.col("create_date")).alias("compact"))


# Ingest

def _log_lines(spark, d):
    startups = views.startup_log(spark, d)
    events = views.event_log(spark, d).drop("event_time")
    # the client sends its own ts, which the stamp must replace
    return startups.select(scalar.as_json(*startups.columns).alias("value")).unionByName(
        events.select(scalar.as_json(*events.columns).alias("value")))


def route_logs(spark, d):
    routed = topics.route_logs(topics.stamp(_log_lines(spark, d), F.lit(STAMP).cast("bigint")))
    fields = [F.get_json_object("value", f"$.{c}").alias(c) for c in ("mid", "uid", "type", "ts")]
    return routed.select("topic", *fields)


def stamped_lines(spark, d):
    """Whole stamped lines, with fields of every type."""
    startups = views.startup_log(spark, d)
    user = F.col("uid").cast("bigint")
    typed = startups.select(
        "mid", "type", user.alias("n"), (user % 2 == 0).alias("even"), (user / 4 + 0.125).alias("quarter"),
        F.struct("area").alias("place"), F.array(user, user + 1).alias("next"), "ts")
    lines = typed.select(scalar.as_json(*typed.columns).alias("value"))
    return topics.route_logs(topics.stamp(lines, F.lit(STAMP).cast("bigint"))).select("topic", "value")


def route_changes(spark, d):
    return changes.route_changes(views.change_log(spark, d), PATTERN).select("topic", "key", "value")


def decode_orders(spark, d):
    routed = changes.route_changes(views.change_log(spark, d), PATTERN).where("topic = 'order'")
    return topics.decode(routed, "order_info").select(
        "id", "province_id", "consignee_tel", "order_status", "user_id", "total_amount", "create_time")


def decode_logs(spark, d):
    lines = topics.route_logs(topics.stamp(_log_lines(spark, d), F.lit(STAMP).cast("bigint")))
    return topics.decode(lines, "event_log", "topic").where("topic = 'event'").select(
        "mid", "uid", "evid", "itemid", "ts")


# Daily active devices

def dau_first(spark, d):
    return _dau(spark, d).select("mid", "uid", "area", "os", "ch", "vs", "ts", "log_date", "log_hour")


def day_scan(spark, d):
    """The devices of one day from a table stored by day."""
    folder = replay.new_folder(spark, "days")
    tables.write_days(_dau(spark, d).select(*DAU_TABLE.names), folder, "log_date")
    return tables.read_days(spark, folder, DAU_TABLE, DAU_DAY, "log_date").select(
        "mid", "uid", "area", "os", "ch", "vs", "ts", "log_date", "log_hour")


def dau_drop_seen(spark, d):
    morning = _dau(spark, d).where("log_hour < '12'")
    return dau.drop_seen(_startups(spark, d), morning).select("mid", "log_date", "ts")


def dau_total(spark, d):
    return dau.dau_total(_dau(spark, d), DAU_DAY)


def dau_hour(spark, d):
    return dau.dau_hour(_dau(spark, d), DAU_DAY)


def new_devices(spark, d):
    return dau.new_devices(_dau(spark, d))


# Orders

def _state_before(spark, d):
    """Users who ordered before the day, as the state table would hold them."""
    past = views.order_info(spark, d).where(F.col("create_time") < ORDER_DAY)
    return past.select("user_id").distinct().withColumn("if_ordered", F.lit("1"))


def user_state_lookup(spark, d):
    return orders.with_user_state(_orders(spark, d), _state_before(spark, d)).select(
        "id", "user_id", "if_ordered")


def state_rows(spark, d):
    day = _orders(spark, d).where(F.col("create_date") == ORDER_DAY)
    return tables.lookup(_state_before(spark, d), day, "user_id", "if_ordered")


def first_order_flag(spark, d):
    return orders.flag_first(_orders(spark, d)).select("id", "user_id", "create_time", "if_first_order")


def first_order_flag_known(spark, d):
    later = _orders(spark, d).where(F.col("create_time") >= ORDER_DAY)
    return orders.flag_first(later, _state_before(spark, d)).select("id", "user_id", "if_first_order")


def new_user_state(spark, d):
    return orders.new_user_state(orders.flag_first(_orders(spark, d)))


def order_amount_total(spark, d):
    return orders.amount_total(_orders(spark, d), ORDER_DAY)


def order_amount_hour(spark, d):
    return orders.amount_hour(_orders(spark, d), ORDER_DAY)


def province_sales(spark, d):
    return orders.province_sales(_orders(spark, d))


# Sales

def _pair_columns(spark, d, how):
    order_rows = _orders(spark, d).select("id", "user_id", "create_time")
    lines = _details(spark, d).select("order_detail_id", "order_id", "sku_id")
    return joins.match_batch(order_rows, lines, how).select(
        "id", "user_id", "create_time", "order_detail_id", "detail_order_id", "sku_id")


def order_detail_inner(spark, d):
    return _pair_columns(spark, d, "inner")


def order_detail_full(spark, d):
    return _pair_columns(spark, d, "full_outer")


def order_detail_interval(spark, d):
    return sales.pair(views.order_info(spark, d), views.order_detail(spark, d)).select(
        "order_detail_id", "order_id", "user_id", "sku_id", "sku_price", "dt")


def latest_users(spark, d):
    routed = changes.route_changes(views.change_log(spark, d), PATTERN).where("topic = 'user'")
    return sales.latest_users(topics.decode(routed, "user_info", "offset"), "offset").select(
        "id", "login_name", "user_level", "birthday", "gender")


def sale_detail(spark, d):
    return _sales(spark, d)


def product_sales(spark, d):
    return sales.product_sales(_orders(spark, d), views.order_detail(spark, d))


# Search and shares

def keyword_match(spark, d):
    return _hits(spark, d).select("order_detail_id", "sku_name", "dt")


def _indexed(spark, d, day, keyword):
    """A search in stored sales by their stored index."""
    folder = replay.new_folder(spark, "index")
    _sales(spark, d).write.parquet(f"{folder}/sales")
    stored = spark.read.schema(SALE_DETAIL).parquet(f"{folder}/sales")
    table = jobs.posting_table(f"{folder}/words").create(spark)
    table.upsert(postings.postings(stored), 0)
    table.compact(spark, 0)
    return postings.search(stored, table.read(spark), day, keyword)


def keyword_match_indexed(spark, d):
    return _indexed(spark, d, None, KEYWORD).select("order_detail_id", "sku_name", "dt")


def sale_search_indexed(spark, d):
    return facets.page(_indexed(spark, d, ORDER_DAY, DAY_KEYWORD), 1, 5, "order_detail_id")


def total_hits(spark, d):
    return facets.total_hits(_hits(spark, d))


def sale_page(spark, d):
    return facets.page(_hits(spark, d), PAGE, PAGE_SIZE, "order_detail_id")


def sale_page_2(spark, d):
    return facets.page(_hits(spark, d), facets.page_of_row(PAGE_SIZE, PAGE_SIZE), PAGE_SIZE, "order_detail_id")


def sale_page_deep(spark, d):
    return facets.page(_sales(spark, d), DEEP_PAGE, PAGE_SIZE, "order_detail_id")


def gender_terms(spark, d):
    return facets.terms(_hits(spark, d), "user_gender", 2)


def age_terms(spark, d):
    return facets.terms(_hits(spark, d), "user_age", 100)


def age_share(spark, d):
    return facets.age_share(_hits(spark, d))


def age_share_known(spark, d):
    return facets.age_share(_hits(spark, d), drop_unknown=True)


def gender_share(spark, d):
    return facets.gender_share(_hits(spark, d))


def demographics(spark, d):
    return facets.demographics(_hits(spark, d))


# Published queries

def kpi_board(spark, d):
    return serve.realtime_total(_dau(spark, d), _orders(spark, d), DAU_DAY)


def kpi_board_orders(spark, d):
    return serve.realtime_total(_dau(spark, d), _orders(spark, d), ORDER_DAY)


def hour_compare_dau(spark, d):
    return serve.realtime_hour("dau", _dau(spark, d), DAU_DAY)


def hour_compare_amount(spark, d):
    return serve.realtime_hour("order_amount", _orders(spark, d), ORDER_DAY)


def hour_map_dau(spark, d):
    maps = serve.hour_maps("dau", _dau(spark, d), DAU_DAY)
    return maps.select(F.to_json("today").alias("today"), F.to_json("yesterday").alias("yesterday"))


def sale_search_total(spark, d):
    return serve.sale_search(_sales(spark, d), ORDER_DAY, DAY_KEYWORD, 1, 5)["total"]


def sale_search_page(spark, d):
    return serve.sale_search(_sales(spark, d), ORDER_DAY, DAY_KEYWORD, 1, 5)["detail"]


def sale_search_age(spark, d):
    return serve.sale_search(_sales(spark, d), ORDER_DAY, DAY_KEYWORD, 1, 5)["age"]


def sale_search_gender(spark, d):
    return serve.sale_search(_sales(spark, d), ORDER_DAY, DAY_KEYWORD, 1, 5)["gender"]


def sale_search_document(spark, d):
    return serve.sale_search_document(_sales(spark, d), ORDER_DAY, DAY_KEYWORD, 1, 5)


def table_view_page(spark, d):
    return serve.table_view(_sales(spark, d), ORDER_DAY, DAY_KEYWORD, 5, 5)["detail"]


def day_demographics(spark, d):
    return serve.demographics(_sales(spark, d), ORDER_DAY, DAY_KEYWORD)


def day_province_sales(spark, d):
    return serve.province_sales(_orders(spark, d), ORDER_DAY)


def day_product_sales(spark, d):
    return serve.product_sales(_orders(spark, d), views.order_detail(spark, d), ORDER_DAY)


# Alerts

def device_windows(spark, d):
    held = windows.device_windows(views.event_log(spark, d), *WIDE)
    events = windows.event_list(F.col("event_counts")).alias("events")
    return held.select("*", events).select(
        "mid", _time("window_start"), _time("window_end"), _joined("uids"), _joined("item_ids"),
        _joined("events"), "clicked")


def _flat_windows(found):
    return found.select("mid", _time("window_end"), _joined("uids"), _joined("item_ids"), _joined("events"))


def coupon_alerts(spark, d):
    return _flat_windows(alerts.coupon_alerts(views.event_log(spark, d), *WIDE))


def coupon_alerts_5min(spark, d):
    return _flat_windows(alerts.coupon_alerts(views.event_log(spark, d)))


def _flat_alerts(found):
    return found.select("id", "mid", _joined("uids"), _joined("item_ids"), _joined("events"), "ts", "dt")


def alerts_per_minute(spark, d):
    return _flat_alerts(alerts.per_minute(alerts.coupon_alerts(views.event_log(spark, d), *DENSE)))


# The streaming jobs, fed from the same tables in two runs with a restart between them

SLICES = 2


def _fed(spark, name, rows, run):
    """Run ``run(session, folder)`` over the messages; returns the folder."""
    folder, session = replay.new_folder(spark, name), replay.job_session(spark)
    replay.feed(rows, f"{folder}/topic", SLICES, lambda: run(session, folder))
    return folder


def _read(session, folder, topic):
    return topics.read_topic(session, topic, "parquet", f"{folder}/topic")


def stream_dau(spark, d):
    rows = replay.messages(views.startup_log(spark, d), "startup", F.timestamp_millis("ts"))

    def run(session, folder):
        table = jobs.dau_table(f"{folder}/dau").create(session)
        jobs.dau(_read(session, folder, "startup"), table, f"{folder}/cp", drain=True).awaitTermination()

    folder = _fed(spark, "dau", rows, run)
    return jobs.dau_table(f"{folder}/dau").read(spark).select(
        "mid", "uid", "area", "os", "ch", "vs", "ts", "log_date", "log_hour")


def stream_dau_compacted(spark, d):
    """The same from a table that folds every two folders and deletes folded ones at once, after many short runs."""
    rows = replay.messages(views.startup_log(spark, d), "startup", F.timestamp_millis("ts"))
    folder, session = replay.new_folder(spark, "dau"), replay.job_session(spark)
    table = jobs.dau_table(f"{folder}/dau", fanout=2, keep=0).create(spark)

    def run():
        jobs.dau(_read(session, folder, "startup"), table, f"{folder}/cp", drain=True).awaitTermination()

    replay.feed(rows, f"{folder}/topic", 5, run)
    return table.read(spark).select("mid", "uid", "area", "os", "ch", "vs", "ts", "log_date", "log_hour")


def _cut_messages(spark, d):
    """Startup messages, of which every fifth is cut off and every seventh has no value."""
    rows = replay.messages(views.startup_log(spark, d), "startup", F.timestamp_millis("ts"))
    cut = F.when(F.col("offset") % 5 == 0, F.lit('{"mid":')).when(F.col("offset") % 7 == 0, F.lit(None)).otherwise(
        F.col("value"))
    return rows.withColumn("offset", F.unix_millis("timestamp")).withColumn("value", cut)


def stream_bad_records(spark, d):
    rows = _cut_messages(spark, d)
    folder, session = replay.new_folder(spark, "bad"), replay.job_session(spark)
    table = jobs.dau_table(f"{folder}/dau").create(spark)

    def run():
        jobs.dau(_read(session, folder, "startup"), table, f"{folder}/cp", bad=sinks.bad_rows(f"{folder}/bad", "dau"),
                 drain=True).awaitTermination()

    replay.feed(rows, f"{folder}/topic", SLICES, run)
    return spark.read.parquet(f"{folder}/bad").select("job", "record", "topic", "offset", "value", "reason")


def stream_ingest_logs(spark, d):
    """Raw lines through the ingest job to topic files."""
    folder, session = replay.new_folder(spark, "ingest"), replay.job_session(spark)
    _log_lines(spark, d).write.text(f"{folder}/lines")
    stream = session.readStream.schema("value string").text(f"{folder}/lines")
    jobs.ingest_logs(stream, f"{folder}/archive", sinks.topic_files(f"{folder}/topics"), f"{folder}/cp",
                     now=F.lit(STAMP).cast("bigint"), bad=sinks.bad_rows(f"{folder}/bad", "logs"),
                     drain=True).awaitTermination()
    routed = spark.read.parquet(f"{folder}/topics")
    fields = [F.get_json_object("value", f"$.{c}").alias(c) for c in ("mid", "uid", "type", "ts")]
    return routed.select("topic", *fields)


def stream_ingest_changes(spark, d):
    """The change log through the ingest job to topic files."""
    folder, session = replay.new_folder(spark, "ingest"), replay.job_session(spark)
    log = views.change_log(spark, d)
    log.write.parquet(f"{folder}/entries")
    jobs.ingest_changes(
        session.readStream.schema(log.schema).parquet(f"{folder}/entries"), PATTERN,
        sinks.topic_files(f"{folder}/topics"), f"{folder}/cp", drain=True).awaitTermination()
    return spark.read.parquet(f"{folder}/topics").select("topic", "key", "value")


def _stream_board(spark, d, day):
    startups = replay.messages(views.startup_log(spark, d), "startup", F.timestamp_millis("ts"))
    placed = replay.messages(views.order_info(spark, d), "order", F.col("order_ts"))
    folder, session = replay.new_folder(spark, "board"), replay.job_session(spark)
    devices = counters.device_counters(f"{folder}/devices").create(spark)
    amounts = counters.counter_table(f"{folder}/amounts").create(spark)
    startup_table = jobs.dau_table(f"{folder}/dau").create(spark)
    order_table = jobs.order_table(f"{folder}/orders").create(spark)

    def run():
        jobs.dau(_read(session, folder, "startup"), startup_table, f"{folder}/cp-dau", counted_at=devices,
                 drain=True).awaitTermination()
        jobs.orders(_read(session, folder, "order"), order_table, f"{folder}/cp-orders", counts_at=amounts,
                    drain=True).awaitTermination()

    replay.feed(startups.unionByName(placed), f"{folder}/topic", SLICES, run)
    return counters.board(devices.counts.read(spark).unionByName(amounts.read(spark)), day)


def stream_kpi_board(spark, d):
    return _stream_board(spark, d, DAU_DAY)


def stream_kpi_board_orders(spark, d):
    return _stream_board(spark, d, ORDER_DAY)


def stream_first_order_flag(spark, d):
    rows = replay.messages(views.order_info(spark, d), "order", F.col("order_ts"))

    def run(session, folder):
        table = jobs.order_table(f"{folder}/orders").create(session)
        state = jobs.user_state_table(f"{folder}/state").create(session)
        stream = _read(session, folder, "order")
        jobs.orders(stream, table, f"{folder}/cp-orders", drain=True).awaitTermination()
        jobs.user_state(stream, state, f"{folder}/cp-state", drain=True).awaitTermination()

    folder = _fed(spark, "orders", rows, run)
    flagged = jobs.flagged_orders(
        spark, jobs.order_table(f"{folder}/orders"), jobs.user_state_table(f"{folder}/state"))
    return flagged.select("id", "user_id", "create_time", "if_first_order")


def _sale_messages(spark, d):
    """Orders, lines and users as messages."""
    order_rows = replay.messages(views.order_info(spark, d), "order", F.col("order_ts"))
    detail_rows = replay.messages(views.order_detail(spark, d), "order_detail", F.col("detail_ts"))
    # profiles are older than any order, so they come with the first run
    born = F.timestamp_seconds(F.lit(0))
    return order_rows, detail_rows, replay.messages(views.user_info(spark, d), "user", born)


def _run_sales(session, folder):
    table = jobs.sale_table(f"{folder}/sales").create(session)
    profile = jobs.user_table(f"{folder}/users").create(session)
    jobs.users(_read(session, folder, "user"), profile, f"{folder}/cp-users",
               drain=True).awaitTermination()
    jobs.sales(_read(session, folder, "order"), _read(session, folder, "order_detail"), profile,
               table, f"{folder}/cp-sales", as_of=AS_OF, drain=True).awaitTermination()


def _fed_sales(spark, name, d, last=None):
    """The sale jobs over the messages, which are made in a session for jobs as well: their shuffles are the largest.
    Orders divide the steps, as the time of a line is known only where it has met its order."""
    folder, session = replay.new_folder(spark, name), replay.job_session(spark)
    order_rows, detail_rows, user_rows = _sale_messages(session, d)
    replay.feed(order_rows.unionByName(detail_rows).unionByName(user_rows), f"{folder}/topic", SLICES,
                lambda: _run_sales(session, folder), times=order_rows, last=last)
    return folder, session


def stream_sale_detail(spark, d):
    folder, _ = _fed_sales(spark, "sales", d)
    return jobs.sale_table(f"{folder}/sales").read(spark, whole=True)


def stream_sale_detail_repaired(spark, d):
    """A tenth of the lines comes after all other records; a repair adds those that the stream lets go."""
    late = (F.col("topic") == "order_detail") & (F.pmod(F.xxhash64("value"), F.lit(10)) == 0)
    folder, session = _fed_sales(spark, "late-sales", d, late)
    messages = session.read.schema(TOPIC_COLUMNS).parquet(f"{folder}/topic")
    table = jobs.sale_table(f"{folder}/sales")
    repairs = jobs.sale_table(f"{folder}/repairs").create(spark)
    jobs.repair_sales(
        messages.where("topic = 'order'"), messages.where("topic = 'order_detail'"),
        jobs.user_table(f"{folder}/users"), table, repairs, 0, as_of=AS_OF)
    return jobs.all_sales(spark, table, repairs, whole=True)


def stream_latest_users(spark, d):
    routed = changes.route_changes(views.change_log(spark, d), PATTERN).where("topic = 'user'")
    rows = routed.withColumn("timestamp", F.timestamp_seconds("offset"))

    def run(session, folder):
        table = jobs.user_table(f"{folder}/users").create(session)
        jobs.users(_read(session, folder, "user"), table, f"{folder}/cp", drain=True).awaitTermination()

    folder = _fed(spark, "users", rows, run)
    return jobs.user_table(f"{folder}/users").read(spark).select(
        "id", "login_name", "user_level", "birthday", "gender")


def _stream_alerts(spark, d, size, slide):
    rows = replay.messages(views.event_log(spark, d), "event", F.timestamp_millis("ts"))

    def run(session, folder):
        table = jobs.pane_table(f"{folder}/panes").create(session)
        jobs.alerts(_read(session, folder, "event"), table, f"{folder}/cp", size, slide,
                    drain=True).awaitTermination()

    folder = _fed(spark, "alerts", rows, run)
    return _flat_alerts(jobs.current_alerts(spark, jobs.pane_table(f"{folder}/panes"), size, slide))


def stream_alerts_per_minute(spark, d):
    return _stream_alerts(spark, d, *WIDE)


def stream_alerts_5min(spark, d):
    return _stream_alerts(spark, d, 300, 5)


QUERIES = {f.__name__: f for f in [
    log_date_hour, create_time_split, mask_phone, age_years, price_cast, yesterday_compact,
    route_logs, stamped_lines, route_changes, decode_orders, decode_logs,
    dau_first, day_scan, dau_drop_seen, dau_total, dau_hour, new_devices,
    user_state_lookup, state_rows, first_order_flag, first_order_flag_known, new_user_state,
    order_amount_total, order_amount_hour, province_sales,
    order_detail_inner, order_detail_full, order_detail_interval, latest_users, sale_detail,
    product_sales,
    keyword_match, keyword_match_indexed, total_hits, sale_page, sale_page_2, sale_page_deep, gender_terms, age_terms, age_share,
    age_share_known, gender_share, demographics,
    kpi_board, kpi_board_orders, hour_compare_dau, hour_compare_amount, hour_map_dau,
    sale_search_total, sale_search_page, sale_search_age, sale_search_gender, sale_search_document, sale_search_indexed,
    table_view_page, day_demographics, day_province_sales, day_product_sales,
    device_windows, coupon_alerts, coupon_alerts_5min, alerts_per_minute,
    stream_bad_records, stream_ingest_logs, stream_ingest_changes, stream_dau, stream_dau_compacted, stream_kpi_board, stream_kpi_board_orders, stream_first_order_flag, stream_sale_detail, stream_sale_detail_repaired, stream_latest_users,
    stream_alerts_per_minute, stream_alerts_5min,
]}
