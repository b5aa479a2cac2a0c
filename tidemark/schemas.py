"""Table layouts and the select-and-cast step every write goes through."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(**columns: str) -> T.StructType:
    """Schema from name="type" pairs."""
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


CUSTOMER_FEED = table(
    event_id="long", customer_id="string", first_name="string", last_name="string",
    email="string", city="string", country="string", event_time="timestamp_ntz",
)
ORDER_FEED = table(
    order_id="string", customer_id="string", product_id="string", order_date="timestamp_ntz",
    quantity="integer", total_amount="decimal(12,2)",
)
PRODUCT_FEED = table(
    product_id="string", product_name="string", category="string", price="decimal(10,2)",
)
DIM_PRODUCT = table(
    product_sk="string", product_id="string", product_name="string", category="string",
    price="decimal(10,2)", created_at="timestamp_ntz",
)
DIM_DATE = table(
    date_sk="integer", full_date="date", year="integer", quarter="integer", month="integer",
    day="integer",
)
FACT_SALES = table(
    sales_sk="string", order_id="string", customer_sk="string", product_sk="string",
    date_sk="integer", quantity="integer", total_amount="decimal(12,2)",
    created_at="timestamp_ntz",
)
RUN_METRICS = table(
    pipeline_name="string", run_timestamp="timestamp_ntz", records_processed="long",
    records_failed="long", records_loaded="long", records_too_late="long",
)
SLA_LOG = table(
    pipeline_name="string", check_time="timestamp_ntz", latest_event_time="timestamp_ntz",
    freshness_minutes="long", sla_threshold_minutes="integer", status="string",
)


def select_to_schema(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """Exactly the columns of `schema`, cast; missing or NULL values take the column's default."""
    defaults = defaults or {}
    columns = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name])
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
