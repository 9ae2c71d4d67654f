"""Minute flow of each micro-batch, stored by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mallflow.operators.clean import clean_batch
from mallflow.operators.flow import minute_flow
from mallflow.operators.lookup import Dimensions
from mallflow.plans.warehouse import Warehouse
from mallflow.sources.tables import append_batch, scan
from mallflow.streaming.landing import land, messages_of

MINUTE_FLOW = T.StructType(
    [
        T.StructField("dt_hour", T.IntegerType()),
        T.StructField("dt_min", T.IntegerType()),
        T.StructField("all_flow", T.LongType()),
        T.StructField("all_customer", T.LongType()),
        T.StructField("p_dt", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def stream_minute_flow(
    lines: DataFrame, dimensions: Callable[[], Dimensions], house: Warehouse, p_dt: str, **trigger
) -> StreamingQuery:
    """Store each batch's pings under ``p_dt``, clean them against the static tables as they are then, store the flow."""

    def store(batch: DataFrame, batch_id: int) -> None:
        with messages_of(batch) as messages:
            if messages is None:
                return
            land(house, messages, p_dt, batch_id)
        rt = clean_batch(house.pings(p_dt, batch_id), dimensions())
        append_batch(minute_flow(rt), house.path("minute_flow"), p_dt, batch_id)

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", house.path("checkpoint"))
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def stored_minute_flow(house: Warehouse) -> DataFrame:
    return scan(house.spark, house.path("minute_flow"), MINUTE_FLOW)
