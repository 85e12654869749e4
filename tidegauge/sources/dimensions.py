"""Small static tables (SRC-5).

They are local relations, so Catalyst knows their size and decides by
``spark.sql.autoBroadcastJoinThreshold`` whether to broadcast them. Nothing here
or elsewhere forces a broadcast: a dimension read from storage may be any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidegauge.model import DEVICES, METRICS, RULES, MetricDef

DEVICE_FIELDS = pa.schema(
    [
        ("device_id", pa.string()),
        ("stage", pa.string()),
        ("display_stage", pa.string()),
        ("display_order", pa.int32()),
        ("unit", pa.string()),
        ("lo", pa.float64()),
        ("hi", pa.float64()),
    ]
)
DEFINITION_FIELDS = pa.schema(
    [
        ("metric", pa.string()),
        ("device_id", pa.string()),
        ("size_s", pa.int64()),
        ("slide_s", pa.int64()),
    ]
)
RULE_FIELDS = pa.schema(
    [
        ("metric", pa.string()),
        ("rule", pa.string()),
        ("threshold", pa.float64()),
        ("n", pa.int32()),
    ]
)


def _local(spark: SparkSession, rows: Sequence[tuple], fields: pa.Schema) -> DataFrame:
    columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in fields]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields))


def device_table(spark: SparkSession, devices: Sequence[tuple] = DEVICES) -> DataFrame:
    return _local(spark, devices, DEVICE_FIELDS)


def definition_table(spark: SparkSession, metrics: Iterable[MetricDef] = METRICS) -> DataFrame:
    """One row per metric and device (EXT-3)."""
    rows = [(m.name, d, m.size_s, m.slide_s) for m in metrics for d in m.devices]
    return _local(spark, rows, DEFINITION_FIELDS)


def rule_table(spark: SparkSession, rules: Sequence[tuple] = RULES) -> DataFrame:
    """Thresholds of the rules per metric."""
    return _local(spark, rules, RULE_FIELDS)
