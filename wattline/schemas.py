"""Column names, JSON schemas and the fixed value lists of the metering data model."""

from pyspark.sql import types as T

# The cumulative-register properties that usage is computed for.
METERED_CODES = ["A29", "B2", "C2", "D4", "E3", "G2", "I2", "J2", "F4"]

# Step name -> length in seconds; months and years follow the calendar.
STEP_SECONDS = {"1m": 60, "5m": 300, "10m": 600, "15m": 900, "30m": 1800, "1h": 3600, "1d": 86400}
CALENDAR_STEPS = ["1n", "1y"]
USAGE_STEPS = ["30m", "1h", "1d", "1n"]
ALL_STEPS = ["1m", "5m", "10m", "15m", "30m", "1h", "1d", "1n", "1y"]

# The compact time pattern and the zone offset of published epochs.
COMPACT_PATTERN = "yyyyMMddHHmmss"
ZONE_OFFSET_HOURS = 8

# What a feed row holds when it is created for a new input.
ORI, VAL = "ORI", "VAL"
NEW_FEED = {
    "feed_type": "NORMAL",
    "interval_unit_type": "DAY",
    "feed_value_type": ORI,
    "feed_log_value_type": "INSTANT",
}
BSN_VALID = "VALID"

# Values and flags stay text while decoding: a quoted number in a number field would reject the message.
CODE_VALUE = T.StructType([T.StructField("code", T.StringType()), T.StructField("value", T.StringType())])

MESSAGE = T.StructType(
    [
        T.StructField("sn", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("add", T.StringType()),
        T.StructField("data", T.ArrayType(CODE_VALUE)),
        T.StructField("from", T.StringType()),
        T.StructField("delay", T.StringType()),
        T.StructField("corrupt", T.StringType()),
    ]
)

HISTORY_PAYLOAD = T.ArrayType(CODE_VALUE)

FORMULA = T.StructType(
    [
        T.StructField("inputId", T.StringType()),
        T.StructField("feedId", T.StringType()),
        T.StructField("steps", T.StringType()),
        T.StructField(
            "computeInputList",
            T.ArrayType(
                T.StructType([T.StructField("inputId", T.StringType()), T.StructField("value", T.StringType())])
            ),
        ),
        T.StructField("corrupt", T.StringType()),
    ]
)

# What arrives on a topic or in a file: the text and its place in the arrival order.
ENVELOPE = T.StructType([T.StructField("value", T.StringType()), T.StructField("arrival", T.LongType())])
