"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow import fixtures
from mallflow.functions import date_keys, date_path
from mallflow.operators import clean, floors, flow, links, parse, shops, visits
from mallflow.operators.lookup import Dimensions
from mallflow.plans import backfill, documents
from mallflow.plans.warehouse import LINKS, Warehouse
from mallflow.schema import CLEAN_PING, METRIC, PING, with_keys
from mallflow.session import configure, scratch_dir, size_for, stored_bytes, together
from mallflow.sources import ledger, messages, tables, text
from mallflow.sources.metrics import MetricStore
from mallflow.streaming import flow as flow_stream
from mallflow.streaming import landing
from mallflow.streaming.job import MallJob

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}

DATED_PING = with_keys(PING, ("p_dt", T.StringType()))


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        size_for(configure(spark), _events_size(spark, sf_dir))
        return fn(spark, sf_dir)

    _REGISTRY[fn.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _long(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def _round(name: str) -> Column:
    return F.round(name, 6).alias(name)


@lru_cache(maxsize=4)
def _events_size(spark: SparkSession, sf_dir: str) -> int:
    return stored_bytes(spark, f"{sf_dir}/events.parquet")


# The provided tables do not change, so frames over them are declared, and the lookup tables measured, once per session.
@lru_cache(maxsize=4)
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "events")


@lru_cache(maxsize=4)
def _dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return fixtures.dimensions(spark, sf_dir)


@lru_cache(maxsize=4)
def _pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.pings(_events(spark, sf_dir))


@lru_cache(maxsize=4)
def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_batch(_pings(spark, sf_dir), _dimensions(spark, sf_dir))


@lru_cache(maxsize=4)
def _dw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.wash_day(_pings(spark, sf_dir), _dimensions(spark, sf_dir))


def _rt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch: all clean pings, of every hour."""
    return _clean(spark, sf_dir)


def _dated_dw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dw(spark, sf_dir).withColumn("p_dt", F.lit(fixtures.FOLDED_DATE_KEY))


# --- parse ---------------------------------------------------------------------------------------


@query
def parse_pings(spark, sf_dir):
    return parse.parse_pings(fixtures.messages(_events(spark, sf_dir)))


@query
def grid_snap(spark, sf_dir):
    return _pings(spark, sf_dir).groupBy("posX", "posY").agg(F.count(F.lit(1)).alias("pings"))


@query
def date_key_parts(spark, sf_dir):
    ts = F.col("ts")
    named = [c.alias(name) for name, c in date_keys(ts).items()]
    return _events(spark, sf_dir).select("event_id", *named, date_path(ts).alias("path"))


# --- clean ---------------------------------------------------------------------------------------


@query
def enrich_shop(spark, sf_dir):
    return clean.enrich_shop(_pings(spark, sf_dir), _dimensions(spark, sf_dir).shops)


@query
def exclude_blacklist(spark, sf_dir):
    return clean.exclude_blacklist(_pings(spark, sf_dir), _dimensions(spark, sf_dir).blacklist)


@query
def wash_day(spark, sf_dir):
    return _dw(spark, sf_dir)


# --- flow ----------------------------------------------------------------------------------------


@query
def batch_counts(spark, sf_dir):
    return flow.batch_counts(_pings(spark, sf_dir), _rt(spark, sf_dir))


@query
def minute_flow(spark, sf_dir):
    return flow.minute_flow(_rt(spark, sf_dir)).select(_long("dt_hour"), _long("dt_min"), "all_flow", "all_customer")


@query
def mac_dwell(spark, sf_dir):
    return flow.mac_dwell(_dw(spark, sf_dir)).select("mac", _long("stay"))


@query
def today_flow(spark, sf_dir):
    return flow.today_flow(_rt(spark, sf_dir), _dw(spark, sf_dir)).select(
        _long("dt_hour"), _long("dt_min"), "all_flow", "all_customer", _round("stay_min")
    )


@query
def today_total(spark, sf_dir):
    return flow.today_total(_dw(spark, sf_dir)).select("all_customer", _round("all_stay"))


# --- shops and categories ------------------------------------------------------------------------


@query
def rt_top_shops(spark, sf_dir):
    return shops.rt_top_shops(_rt(spark, sf_dir))


@query
def day_shop_rank(spark, sf_dir):
    return shops.day_shop_rank(_dw(spark, sf_dir))


@query
def day_shop_trailing(spark, sf_dir):
    as_of = fixtures.FOLDED_MIDNIGHT + 15 * 3600
    return shops.day_shop_rank(clean.trailing(_dw(spark, sf_dir), as_of, 600))


@query
def day_top_category(spark, sf_dir):
    return shops.day_top_category(_dw(spark, sf_dir))


@query
def rt_top_category(spark, sf_dir):
    return shops.rt_top_category(_rt(spark, sf_dir))


# --- floors --------------------------------------------------------------------------------------


@query
def floor_dwell(spark, sf_dir):
    return floors.floor_dwell(_dw(spark, sf_dir)).select("locName", "total_mac", _round("stay_min"))


@query
def floor_shop_rank(spark, sf_dir):
    return floors.floor_shop_rank(_dw(spark, sf_dir)).select("locName", "name", "flow", _long("rank"))


@query
def rt_floor_flow(spark, sf_dir):
    return floors.rt_floor_flow(_rt(spark, sf_dir), _dw(spark, sf_dir)).select("floor", "uv", _round("stay"), "shop", "flow")


@query
def floor_minute_flow(spark, sf_dir):
    minutes = floors.floor_minute_flow(_dw(spark, sf_dir)).orderBy("locName", "dt_hour", "dt_min")
    return minutes.select("locName", _long("dt_hour"), _long("dt_min"), "cnt")


@query
def heat_map(spark, sf_dir):
    return floors.heat_map(_dw(spark, sf_dir)).select("floor", _long("x"), _long("y"), "cnt")


# --- links ---------------------------------------------------------------------------------------


@query
def brand_link_consecutive(spark, sf_dir):
    return links.consecutive_links(_dated_dw(spark, sf_dir)).drop("p_dt")


@query
def brand_link_anchor(spark, sf_dir):
    return links.anchor_links(_dated_dw(spark, sf_dir)).drop("p_dt")


@query
def brand_link_matrix(spark, sf_dir):
    return links.link_matrix(links.consecutive_links(_dated_dw(spark, sf_dir)))


# --- sources and sinks ---------------------------------------------------------------------------


@query
def scan_day(spark, sf_dir):
    root = scratch_dir(spark, "scan")
    tables.replace_partitions(fixtures.dated_pings(_events(spark, sf_dir)), root, "p_dt")
    day = tables.scan_day(spark, root, DATED_PING, fixtures.FOLDED_DATE_KEY)
    return _stored(day)


@query
def text_scan(spark, sf_dir):
    root = scratch_dir(spark, "text")
    lines = fixtures.messages(_events(spark, sf_dir))
    spot = F.split("value", ",")[5]
    lines.withColumn("spot", spot).hint("rebalance", F.col("spot")).write.partitionBy("spot").text(root)
    directories = [f"{root}/spot=F{n}" for n in range(1, 5)]
    return (
        text.read_directory(spark, *directories)
        .groupBy("directory")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"))
    )


@query
def sink_ods_append(spark, sf_dir):
    """Two batches on two processing dates; the second is written twice, as after a failure."""
    root = scratch_dir(spark, "ods")
    pings = _pings(spark, sf_dir)
    early, late = pings.where(F.col("dt_hour") < 12), pings.where(F.col("dt_hour") >= 12)
    tables.append_batch(early, root, "20240115", 0)
    tables.append_batch(late, root, "20240115", 1)
    tables.append_batch(late, root, "20240115", 1)
    tables.append_batch(early, root, "20240116", 2)
    return _stored(tables.scan(spark, root, DATED_PING))


@query
def sink_dw_overwrite(spark, sf_dir):
    """Two days are stored, then one is overwritten by its washed rows."""
    root = scratch_dir(spark, "dw")
    clean_pings, dw = _clean(spark, sf_dir), _dw(spark, sf_dir)
    tables.overwrite_day(clean_pings, root, "20240115")
    tables.overwrite_day(clean_pings, root, "20240116")
    tables.overwrite_day(dw, root, "20240115")
    return _stored(tables.scan(spark, root, backfill.DATED_CLEAN_PING))


def _stored(rows: DataFrame) -> DataFrame:
    return rows.groupBy("p_dt").agg(
        F.count(F.lit(1)).alias("pings"), F.count_distinct("mac").alias("macs"), F.sum("time_stamp").alias("seconds")
    )


@query
def sink_metric_replace(spark, sf_dir):
    """The day's shop ranking of all hours is stored, then replaced by that of the business hours; a third metric is emptied."""
    store = MetricStore(spark, scratch_dir(spark, "replace"))
    clean_pings, dw = _clean(spark, sf_dir), _dw(spark, sf_dir)
    for batch_id, day in enumerate((clean_pings, dw)):
        state = documents.snapshot(day, day)
        store.replace(documents.product_documents("day_max_shop", state, AS_OF), "day_max_shop", AS_OF_DATE, batch_id)
        emptied = state if batch_id == 0 else documents.snapshot(day, day.where(F.lit(False)))
        store.replace(documents.product_documents("day_catalog", emptied, AS_OF), "day_catalog", AS_OF_DATE, batch_id)
    return _flattened(store.read())


@query
def sink_metric_append(spark, sf_dir):
    """Flow of the day's two halves is added up; the second is written twice, as after a failure."""
    store = MetricStore(spark, scratch_dir(spark, "append"))
    clean_pings, dw = _clean(spark, sf_dir), _dw(spark, sf_dir)
    early, late = clean_pings.where(F.col("dt_hour") < 12), clean_pings.where(F.col("dt_hour") >= 12)
    for batch_id, batch in ((0, early), (1, late), (1, late)):
        state = documents.snapshot(batch, dw)
        store.append(documents.product_documents("today_flow", state, AS_OF), "today_flow", AS_OF_DATE, batch_id)
    return _flattened(store.read())


@query
def late_data_partition(spark, sf_dir):
    """Pings of many event dates arrive on one processing date and are stored under it, unchanged."""
    root = scratch_dir(spark, "late")
    tables.append_batch(fixtures.dated_pings(_events(spark, sf_dir)).drop("p_dt"), root, "20240131", 0)
    stored = tables.scan_day(spark, root, DATED_PING, "20240131")
    event_date = F.concat(F.substring("date_time", 1, 4), F.substring("date_time", 6, 2), F.substring("date_time", 9, 2))
    return stored.groupBy("p_dt", event_date.alias("event_date")).agg(F.count(F.lit(1)).alias("pings"))


@query
def brand_link_backfill(spark, sf_dir):
    dw_root, links_root = scratch_dir(spark, "dw"), scratch_dir(spark, "links")
    dw = clean.wash_day(fixtures.dated_pings(_events(spark, sf_dir)), _dimensions(spark, sf_dir))
    tables.replace_partitions(dw, dw_root, "p_dt")
    backfill.backfill_links(spark, dw_root, links_root)
    return tables.scan(spark, links_root, LINKS).drop("part")


# --- documents and streams -----------------------------------------------------------------------

AS_OF = "2024-01-15 23:30:00"
AS_OF_DATE = fixtures.FOLDED_DATE_KEY
_FRACTIONS = ("staty", "all_stay", "stay")


def _flattened(docs: DataFrame) -> DataFrame:
    """One row per document entry, fractions to six places."""
    rows = docs.select(
        *[c for c in METRIC.names if c != "bi_value"], F.explode("bi_value").alias("key", "value")
    )
    shown = F.round(F.col("value").try_cast("double"), 6).cast("string")
    return rows.withColumn("value", F.when(F.col("key").isin(*_FRACTIONS), shown).otherwise(F.col("value")))


@query
def metric_documents(spark, sf_dir):
    """All documents of one batch, which is the whole day. The clean pings are stored once and everything is read from them; the day's
    visits are merged into one small table that the day metrics share."""
    root = scratch_dir(spark, "documents")
    _clean(spark, sf_dir).write.parquet(f"{root}/batch")
    rt = spark.read.schema(CLEAN_PING).parquet(f"{root}/batch")
    dw = clean.business_hours(rt)
    together(
        spark,
        lambda: visits.visit_summary(dw).write.parquet(f"{root}/visits"),
        lambda: floors.floor_minute_flow(dw).write.parquet(f"{root}/minutes"),
    )
    day, minutes = (spark.read.parquet(f"{root}/{name}") for name in ("visits", "minutes"))
    moves = links.consecutive_links(dw.withColumn("p_dt", F.lit(AS_OF_DATE)))
    state = documents.Snapshot(rt, day, minutes, lambda: links.pair_counts(moves))
    docs = [documents.product_documents(bi_name, state, AS_OF) for bi_name in documents.PRODUCTS]
    return _flattened(reduce(DataFrame.unionByName, docs))


def _message_stream(spark: SparkSession, sf_dir: str, label: str, batches: int = 1) -> DataFrame:
    """The messages as text files, streamed in the given number of micro-batches."""
    root = scratch_dir(spark, label)
    files = batches * max(1, spark.sparkContext.defaultParallelism // batches)
    fixtures.messages(_events(spark, sf_dir)).repartition(files).write.text(root)
    return messages.file_messages(spark, root, files // batches)


@query
def stream_minute_flow(spark, sf_dir):
    house = Warehouse(spark, scratch_dir(spark, "flow"))
    lines = _message_stream(spark, sf_dir, "messages")
    job = flow_stream.stream_minute_flow(
        lines, lambda: fixtures.dimensions(spark, sf_dir), house, AS_OF_DATE, availableNow=True
    )
    job.awaitTermination()
    return flow_stream.stored_minute_flow(house).select(_long("dt_hour"), _long("dt_min"), "all_flow", "all_customer")


@query
def stream_ledger(spark, sf_dir):
    """What four micro-batches took from their source: messages in all, files, and messages left out, repeated or missed."""
    root, house = scratch_dir(spark, "inbox"), Warehouse(spark, scratch_dir(spark, "landed"))
    fixtures.messages(_events(spark, sf_dir)).repartition(8).write.text(root)

    def store(batch: DataFrame, batch_id: int) -> None:
        with landing.messages_of(batch) as found:
            if found is not None:
                landing.land(house, found, AS_OF_DATE, batch_id)

    stream = messages.file_messages(spark, root, 2, origins=True).writeStream.foreachBatch(store)
    stream.option("checkpointLocation", house.path("checkpoint")).trigger(availableNow=True).start().awaitTermination()
    rows = house.ledger.read()
    files = spark.read.text(root).groupBy(F.col("_metadata.file_path").alias("origin")).agg(F.count(F.lit(1)).alias("messages"))
    parts = [
        rows.agg(F.lit("taken").alias("kind"), F.sum("messages").alias("messages")),
        house.pings(AS_OF_DATE).agg(F.lit("landed").alias("kind"), F.count(F.lit(1)).alias("messages")),
        rows.agg(F.lit("batches").alias("kind"), F.count_distinct("batch_id").alias("messages")),
        rows.agg(F.lit("origins").alias("kind"), F.count(F.lit(1)).alias("messages")),
        ledger.breaks(rows).agg(F.lit("breaks").alias("kind"), F.coalesce(F.sum("messages"), F.lit(0)).alias("messages")),
        ledger.missed_files(rows, files).agg(F.lit("missed").alias("kind"), F.coalesce(F.sum("messages"), F.lit(0)).alias("messages")),
    ]
    return reduce(DataFrame.unionByName, parts)


TRAILING_AS_OF = "2024-01-15 15:00:00"


@query
def stream_trailing(spark, sf_dir):
    """Metrics over the last ten minutes and the last hour before a processing time, from the panes of two micro-batches."""
    house = Warehouse(spark, scratch_dir(spark, "trailing"))
    dims, names = (lambda: fixtures.dimensions(spark, sf_dir)), tuple(documents.TRAILING)
    job = MallJob(house, dims, clock=lambda _: TRAILING_AS_OF, products=(), links=False, trailing=names)
    job.start(_message_stream(spark, sf_dir, "messages", 2), availableNow=True).awaitTermination()
    return _flattened(house.metrics.read_day(AS_OF_DATE, *names))


STREAM_BATCHES = 2
_DAY_PRODUCTS = ("today_total", "day_max_shop", "day_catalog", "floor_day_flow", "heat_map", "brand_link")


@query
def stream_day_metrics(spark, sf_dir):
    """Day metrics, moves and step outcomes after all micro-batches."""
    house = Warehouse(spark, scratch_dir(spark, "mall"))
    job = MallJob(house, lambda: fixtures.dimensions(spark, sf_dir), clock=lambda _: AS_OF)
    job.start(_message_stream(spark, sf_dir, "messages", STREAM_BATCHES), availableNow=True).awaitTermination()
    metrics = _flattened(house.metrics.read_day(AS_OF_DATE, *_DAY_PRODUCTS))
    moves = links.link_matrix(house.links(AS_OF_DATE)).select(
        F.lit("brand_link").alias("bi_name"),
        F.concat_ws(">", "from_name", "to_name").alias("key"),
        F.col("times").cast("string").alias("value"),
    )
    outcomes = job.status(AS_OF_DATE).groupBy("step").agg(F.count_if("ok").cast("string").alias("value"))
    outcomes = outcomes.select(F.lit("status").alias("bi_name"), F.col("step").alias("key"), "value")
    return metrics.select("bi_name", "key", "value").unionByName(moves).unionByName(outcomes)
