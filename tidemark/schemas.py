"""Record types of the event logs. Times stay epoch seconds or milliseconds until ingest."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields.items()])


SENSOR_READING = _struct(id=StringType, ts_s=LongType, temperature=DoubleType)
USER_BEHAVIOR = _struct(
    user_id=LongType, item_id=LongType, category_id=IntegerType, behavior=StringType, ts_s=LongType
)
LOGIN_EVENT = _struct(user_id=LongType, ip=StringType, status=StringType, ts_s=LongType)
ORDER_EVENT = _struct(order_id=LongType, event_type=StringType, tx_id=StringType, ts_s=LongType)
RECEIPT_EVENT = _struct(tx_id=StringType, pay_channel=StringType, ts_s=LongType)
AD_CLICK = _struct(
    user_id=LongType, ad_id=LongType, province=StringType, city=StringType, ts_s=LongType
)
MARKETING_EVENT = _struct(
    user_id=StringType, behavior=StringType, channel=StringType, ts_ms=LongType
)
ACCESS_LOG = _struct(
    ip=StringType, user_id=StringType, ts=TimestampType, method=StringType, url=StringType
)
ADS_LINE = _struct(
    ts_ms=LongType, area=StringType, city=StringType, user_id=StringType, ads_id=StringType
)
