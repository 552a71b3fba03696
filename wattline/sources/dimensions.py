"""Relational dimensions, read once per batch."""

from pyspark.sql import DataFrame, SparkSession

# The columns used of each dimension.
DIMENSIONS = {
    "registry": ["meter_key", "input_id", "feed_id"],
    "key_schema": ["ds_schema", "dev_seri_no"],
    "iot_device": ["ds_schema", "id", "dev_seri_no", "is_del"],
    "topic": ["ds_schema", "id", "device_id", "value", "is_del"],
    "instrument": ["ds_schema", "id", "addr", "device_id", "type"],
    "input": ["ds_schema", "id", "prop", "inst_addr", "inst_type", "inst_id"],
    "feed": ["ds_schema", "id", "device_id", "num", "input_id", "feed_type", "feed_value_type"],
    "iot_bsn": ["ds_schema", "inst_id", "status"],
}


def read_dimensions(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Dimension tables stored under one root."""
    return {
        name: spark.read.format(fmt).load(f"{root}/{name}").select(*columns) for name, columns in DIMENSIONS.items()
    }


def read_jdbc_dimension(spark: SparkSession, name: str, options: dict[str, str]) -> DataFrame:
    """A dimension from a database; needs the JDBC driver on the class path."""
    return spark.read.format("jdbc").options(dbtable=name, **options).load().select(*DIMENSIONS[name])
