"""Views that give the driver's tables the shape the operators work on.

The mappings are arbitrary but fixed; ``oracle.py`` states the same ones in SQL.
Functions that take ``events`` are row-wise and work on a stream as well.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsledger.functions.text import log_line
from opsledger.operators.events import route_events, with_channels
from opsledger.sinks.exposition import sample_line
from opsledger.sources.messages import encode_events
from opsledger.sources.rules import NOTIFICATION_RULES, default_channels, rules_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same file as a stream; the folder holds other tables, hence the filter."""
    schema = table(spark, sf_dir, name).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(sf_dir)
    )


def _choose(column: str, mapping: dict[str, str], otherwise: Column) -> Column:
    chosen = otherwise
    for key, value in mapping.items():
        chosen = F.when(F.col(column) == key, value).otherwise(chosen)
    return chosen


def fx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; product and quantity are null for an order without line items.

    A query that uses neither of the two never reads the line items: the
    optimizer drops a left join to a side that is unique on its key.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_partkey").alias("partkey"), F.sum("l_quantity").alias("qty"))
    )
    status = _choose(
        "o_orderstatus", {"O": "pending", "F": "confirmed", "P": "cancelled"}, F.col("o_orderstatus")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("partkey").cast("string").alias("product_id"),
            F.col("qty").cast("int").alias("quantity"),
            status.alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )
    )


def fx_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer")
    return keys.select((F.col("c_custkey") * 20).cast("string").alias("id"))


def fx_order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus"
    )
    status = _choose(
        "o_orderstatus", {"O": "pending", "F": "confirmed", "P": "cancelled"}, F.col("o_orderstatus")
    )
    quantity = F.when(F.col("l_partkey") % 100 == 0, "x").otherwise(
        F.col("l_quantity").cast("int").cast("string")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .select(
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            quantity.alias("quantity"),
            F.when(F.col("l_partkey") % 3 != 0, status).alias("status"),
        )
    )


_EVENT_TYPES = {
    "purchase": "order.created",
    "signup": "order.confirmed",
    "error": "order.cancelled",
    "click": "order.shipped",
    "view": "order.viewed",
}


def fx_events(events: DataFrame) -> DataFrame:
    payload = F.create_map(
        F.lit("order_id"),
        (F.col("event_id") * 2).cast("string"),
        F.lit("customer_id"),
        F.col("user_id").cast("string"),
    )
    return events.select(
        "event_id",
        "ts",
        _choose("event_type", _EVENT_TYPES, F.col("event_type")).alias("event_type"),
        payload.alias("payload"),
    )


def fx_messages(events: DataFrame) -> DataFrame:
    """Encoded events, and among them bad text, a bare array, no type, a null type, blanks
    around the object, single quotes, and payloads that are a list or a text."""
    kind = F.col("event_id") % 50
    typed = fx_events(events).withColumn("event_type", F.when(kind != 3, F.col("event_type")))
    untyped = F.to_json(F.struct("payload"))
    return encode_events(typed).select(
        "event_id",
        "ts",
        F.when(kind == 0, "not json {")
        .when(kind == 1, "[1]")
        .when(kind == 2, untyped)
        .when(kind == 4, F.concat(F.lit("\t"), F.col("body"), F.lit(" \n")))
        .when(kind == 5, "{'event_type':'order.created'}")
        .when(kind == 6, '{"event_type":"order.created","payload":[1]}')
        .when(kind == 7, '{"event_type":"order.created","payload":"{}"}')
        .otherwise(F.col("body"))
        .alias("body"),
    )


def fx_redelivered(events: DataFrame) -> DataFrame:
    """Events as JSON text; every tenth comes twice."""
    texts = fx_events(events).withColumn("payload", F.to_json("payload"))
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return texts.withColumn("copy", F.explode(copies)).drop("copy")


def rules(spark: SparkSession) -> tuple[DataFrame, Column]:
    """The rules in use; their config is bounded, so no join needs to measure them."""
    return rules_table(spark, NOTIFICATION_RULES), default_channels(NOTIFICATION_RULES)


def fx_topics(events: DataFrame) -> DataFrame:
    """Routing keys of four words: event type (two words), service, user."""
    kind = _choose("event_type", _EVENT_TYPES, F.col("event_type"))
    user = F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string"))
    return events.select("event_id", F.concat_ws(".", kind, _job(), user).alias("topic"))


def fx_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five patterns for each nation."""
    k = F.col("n_nationkey").cast("string")
    patterns = F.array(
        F.concat(F.lit("order.*.svc-"), (F.col("n_nationkey") % 5).cast("string"), F.lit(".u"), k),
        F.concat(F.lit("#.u"), k),
        F.concat(F.lit("*.created.#.u"), k),
        F.concat(F.lit("order.#.svc-"), k, F.lit(".*")),
        F.when(F.col("n_nationkey") == 0, "#").otherwise(F.concat(F.lit("order.created.u"), k)),
    )
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("binding"), F.explode(patterns).alias("pattern")
    )


def _attempts_needed() -> Column:
    return (F.col("event_id") % 5 + 1).cast("int")


def fx_attempts(events: DataFrame, spark: SparkSession) -> DataFrame:
    routed = route_events(fx_events(events), *rules(spark), is_small=True)
    return routed.withColumn("attempts_needed", _attempts_needed())


def fx_deliveries(events: DataFrame, spark: SparkSession) -> DataFrame:
    """One row per event, with its channels not yet exploded."""
    events = with_channels(fx_events(events), *rules(spark), is_small=True)
    return events.withColumn("attempts_needed", _attempts_needed())


def _job() -> Column:
    return F.concat(F.lit("svc-"), (F.col("user_id") % 5).cast("string"))


def _status_code() -> Column:
    return _choose("event_type", {"error": "500", "purchase": "201"}, F.lit("200"))


def fx_requests(events: DataFrame) -> DataFrame:
    post = F.col("event_type") == "purchase"
    return events.select(
        "ts",
        _job().alias("job"),
        F.when(post, "POST").otherwise("GET").alias("method"),
        F.when(post, "/orders").otherwise("/orders/{id}").alias("path"),
        _status_code().alias("status_code"),
        (F.col("value") / 100).alias("duration_seconds"),
    )


def fx_weighted(events: DataFrame) -> DataFrame:
    """Latencies ``v`` that count up to nine billion times, as a sampled trace would report."""
    weight = F.lit(1) + (F.col("event_id") % 7) * 1_500_000_000
    return events.select(
        "ts", _job().alias("job"), (F.col("value") / 100).alias("v"), weight.cast("long").alias("w")
    )


def fx_published(events: DataFrame) -> DataFrame:
    published = (F.col("job") != "svc-0") & (F.col("duration_seconds") <= 1)
    kinds = F.when(published, F.array(F.lit("created"), F.lit("published"))).otherwise(
        F.array(F.lit("created"))
    )
    return (
        fx_requests(events)
        .where("method = 'POST'")
        .select("ts", "job", F.explode(kinds).alias("kind"))
    )


def fx_counter(events: DataFrame) -> DataFrame:
    """Requests so far today per (job, status_code), at the last request of each hour."""
    hourly = (
        fx_requests(events)
        .groupBy("job", "status_code", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.count("*").alias("n"), F.max("ts").alias("ts"))
    )
    today = Window.partitionBy("job", "status_code", F.to_date("hour")).orderBy("hour")
    return hourly.select(
        "ts", "job", "status_code", F.sum("n").over(today).cast("double").alias("value")
    )


def fx_scrape(events: DataFrame) -> DataFrame:
    line = sample_line("requests_total", ["job", "status_code"], F.col("value"))
    return fx_counter(events).select("ts", line.alias("line"))


def fx_scrape_mixed(events: DataFrame) -> DataFrame:
    """Scrapes in which some samples have a time of their own and some lines are broken."""
    line = sample_line("requests_total", ["job", "status_code"], F.col("value"))
    own = F.unix_millis(F.col("ts").cast("timestamp")) + 60_000
    twice = F.concat(F.lit('requests_total{job="a",job="'), "job", F.lit('"} 1'))
    return fx_counter(events).select(
        "ts",
        F.when(F.col("value") % 11 == 0, F.replace(line, F.lit("}"), F.lit("")))
        .when(F.col("value") % 13 == 0, twice)
        .when(F.col("value") % 7 == 0, F.concat(line, F.lit(" "), own.cast("string")))
        .otherwise(line)
        .alias("line"),
    )


def fx_gauge(events: DataFrame) -> DataFrame:
    """Six gauges per event, in long form."""
    error = F.col("event_type") == "error"
    zero, one = F.lit(0.0), F.lit(1.0)
    gauges = {
        "up": F.when(error, zero).otherwise(one),
        "pod_ready": F.when(error, zero).otherwise(one),
        "job_failed": F.when(error, one).otherwise(zero),
        "volume_available": F.col("value"),
        "volume_capacity": F.lit(500.0),
        "cpu_usage": F.col("value"),
    }
    lines = F.array(
        *[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in gauges.items()]
    )
    pod = F.concat(F.lit("pod-"), (F.col("user_id") % 15).cast("string"))
    return events.select("ts", _job().alias("job"), pod.alias("pod"), F.inline(lines))


def fx_pods(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name"
    )
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .join(regions, "n_regionkey")
        .select(
            key.cast("string").alias("uid"),
            F.col("r_name").alias("namespace"),
            F.col("n_name").alias("pod"),
            F.lit("app").alias("container"),
            F.concat(F.lit("svc-"), (key % 5).cast("string")).alias("app"),
            F.when(key % 7 == 0, "Failed").otherwise("Running").alias("phase"),
        )
    )


def fx_logs(events: DataFrame) -> DataFrame:
    uid = (F.col("user_id") % 25).cast("string")
    message = _choose(
        "event_type",
        {"error": "upstream timeout", "view": "GET /health", "purchase": "order created"},
        F.lit("request completed"),
    )
    line = log_line(
        F.col("ts"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"),
        F.lit("src.main"),
        message,
        status_code=_status_code().cast("int"),
        duration_seconds=(F.col("value") / 100).cast("decimal(18,4)"),
        trace_id=F.col("event_id").cast("string"),
    )
    return events.select(
        "ts",
        F.concat(F.lit("/var/log/pods/"), uid, F.lit("/app/0.log")).alias("path"),
        line.alias("line"),
    )
