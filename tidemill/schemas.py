"""Record layouts, topic names and fixed labels.

Every record is decoded with all-string fields first, because row changes quote their numbers and
``from_json`` turns a quoted number under a numeric field into NULL; ``TYPES`` names the casts that follow.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

STARTUP_LOG = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts"]
EVENT_LOG = ["mid", "uid", "appid", "area", "os", "ch", "type", "evid", "pgid", "npgid", "itemid", "ts"]
ORDER_INFO = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
    "user_id", "img_url", "total_amount", "expire_time", "delivery_address", "create_time",
    "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
]
ORDER_DETAIL = ["id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num"]
USER_INFO = ["id", "login_name", "user_level", "birthday", "gender"]

RECORDS = {
    "startup_log": STARTUP_LOG,
    "event_log": EVENT_LOG,
    "order_info": ORDER_INFO,
    "order_detail": ORDER_DETAIL,
    "user_info": USER_INFO,
}

# The fields of a record that are not strings once decoded.
TYPES = {
    "startup_log": {"ts": "bigint"},
    "event_log": {"ts": "bigint"},
    "order_info": {"total_amount": "double"},
    "order_detail": {},
    "user_info": {},
}

TOPIC_STARTUP = "startup"
TOPIC_EVENT = "event"
TOPIC_ORDER = "order"
TOPIC_ORDER_DETAIL = "order_detail"
TOPIC_USER = "user"

# The columns of a topic that the pipelines read; a Kafka source has them under the same names.
TOPIC_COLUMNS = StructType([
    StructField("topic", StringType()),
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])


def strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


DAU_TABLE = StructType(
    strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
    + [StructField("ts", LongType())]
    + strings("log_date", "log_hour")
)
ORDER_TABLE = StructType(
    [StructField(n, DoubleType() if n == "total_amount" else StringType()) for n in ORDER_INFO]
    + strings("create_date", "create_hour")
)
USER_STATE_TABLE = StructType(strings("user_id", "if_ordered", "first_time", "first_order_id"))
USER_TABLE = StructType(strings(*USER_INFO) + [StructField("offset", LongType())])
SALE_DETAIL = StructType(
    strings("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
            "user_gender")
    + [StructField("user_age", IntegerType())]
    + strings("user_level")
    + [StructField("sku_price", DoubleType())]
    + strings("sku_name", "dt")
)

# Labels of the published results.
KPI_NAMES = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "新增交易额"}
AGE_TITLE = "年龄占比"
AGE_SHARE_NAMES = ["20岁以下", "20岁到30岁", "30岁及以上"]
GENDER_TITLE = "性别占比"
GENDER_NAMES = {"M": "男", "F": "女"}
AGE_COUNT_NAMES = ["20岁以下", "20-30岁", "30岁以上"]
