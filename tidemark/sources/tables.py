"""Driver tables and the stated mappings onto the reference's feeds.

The driver's ``events`` table has no item, URL, ad or channel column, so each
feed is a fixed, documented projection of it.  Reads are column-pruned; every
mapping is a projection, so filters above it reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value lists that must equal the reference's.
CHANNELS = ["wechat", "weibo", "xiaomistore", "appstore", "huaweistore"]
PROVINCES = ["beijing", "anhui", "shanghai", "zhejiang"]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def item_of(props: Column | str = "props") -> Column:
    c = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(c, "$.k").cast("long")


def _pick(names: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (idx + 1).cast("int"))


def behaviour(events: DataFrame) -> DataFrame:
    """UserBehaviour feed: item = props.k, behaviour = event_type, seq = event_id."""
    return events.select(
        F.col("event_id").alias("seq"), "user_id", item_of().alias("item_id"),
        F.col("event_type").alias("behavior"), "ts")


def web_log(events: DataFrame) -> DataFrame:
    """Access-log feed: a click is a GET of ``/item/<k>``."""
    return events.select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "click", F.lit("GET")).otherwise(F.upper("event_type")).alias("method"),
        F.concat(F.lit("/item/"), item_of().cast("string")).alias("url"), "ts")


def marketing(events: DataFrame) -> DataFrame:
    """Marketing feed: channel = CHANNELS[user_id % 5]; behaviour = event_type."""
    return events.select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("behavior"),
        _pick(CHANNELS, F.pmod(F.col("user_id"), F.lit(len(CHANNELS)))).alias("channel"), "ts")


def ad_clicks(events: DataFrame) -> DataFrame:
    """Ad-click feed: ad = props.k % 2, province = PROVINCES[user_id % 4]."""
    return events.select(
        F.col("event_id").alias("seq"), "user_id",
        F.pmod(item_of(), F.lit(2)).alias("ad_id"),
        _pick(PROVINCES, F.pmod(F.col("user_id"), F.lit(len(PROVINCES)))).alias("province"), "ts")


def logins(events: DataFrame) -> DataFrame:
    """Login feed: an ``error`` event is a failed login, anything else a success."""
    return events.select(
        F.col("event_id").alias("seq"), "user_id",
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        "ts")


def order_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order feed for the state machine: a create at o_orderdate, a pay at each ship date.

    The state machine decides on the first pay of an order, so this is "pay at
    the first ship date"; the minimum is taken once, by the operator's own
    partially aggregated first-pay step.
    """
    creates = orders.select(F.col("o_orderkey").alias("order_id"), F.lit("create").alias("event_type"),
                            F.col("o_orderdate").alias("ts"))
    pays = lineitem.select(F.col("l_orderkey").alias("order_id"), F.lit("pay").alias("event_type"),
                           F.col("l_shipdate").alias("ts"))
    return creates.unionByName(pays)


def pays(orders: DataFrame) -> DataFrame:
    """Pay side of transaction matching: one pay per order at its order date."""
    return orders.select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("ts"),
                         "o_custkey", "o_totalprice")


def receipts(lineitem: DataFrame) -> DataFrame:
    """Receipt side: every line item, keyed by its order, at its ship date."""
    return lineitem.select(F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("ts"),
                           "l_linenumber", "l_partkey", "l_suppkey")
