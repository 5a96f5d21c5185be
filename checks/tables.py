"""Queries that put single operators to work on the check tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.games import _avg
from checks.registry import query, spread, table
from questlake.functions.numeric import rounded_avg, weighted_score
from questlake.functions.text import embed_text, non_blank
from questlake.functions.variant import Field, lenient_date
from questlake.operators import aggregate, quality, series
from questlake.operators.cells import build_cells, search_cells
from questlake.operators.dedup import latest_by_key
from questlake.operators.embed import hashed_words, with_embedding
from questlake.operators.merge import enrich_merge, pending_rows, update_by_key, upsert_by_key
from questlake.operators.rank import global_rank, rank_in_group
from questlake.operators.validate import window_bounds, with_reason
from questlake.operators.vector import cosine_topk, cosine_topk_batch
from questlake.plans.staged import read_staged, stage_new_batches
from questlake.plans.staging import extract
from questlake.session import new_dir
from questlake.sources.bucketed import pending_in_buckets, upsert_in_buckets, write_bucketed
from questlake.sources.jsonl import entity_path, load_summary, read_raw, read_rejects, write_bronze
from questlake.sources.pages import page_results as results_of_pages
from questlake.sources.retention import expired_dates
from questlake.streaming.incremental import load_log, load_new_files, read_raw_table, read_rejected


def _lines(*columns: Column) -> Column:
    """A row as a JSON line, NULLs kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")


def _event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.parse_json("props").alias("props")
    document = _lines(F.col("event_id"), F.col("event_type"), F.col("value"), props, F.lit(None).cast("string").alias("note"))
    return table(spark, sf_dir, "events").select(document, F.to_date("ts").alias("ingest_date"))


_EVENT_FIELDS = (
    Field("event_id", "$.event_id", "bigint"),
    Field("event_type", "$.event_type", "string"),
    Field("value", "$.value", "double"),
    Field("k", "$.props.k", "int"),
    Field("note", "$.note", "string"),
)
_EVENT_SQL = """SELECT event_id, event_type, value, CAST(props->>'$.k' AS INTEGER) AS k,
  CAST(NULL AS VARCHAR) AS note{more} FROM events"""

# Loads and files


@query("raw_load", _EVENT_SQL.format(more=", TIMESTAMP '2026-01-05 03:00:00' AS loaded_at"))
def raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "lines")
    _event_docs(spark, sf_dir).select("value").write.text(path)
    raw = read_raw(spark, path, dt.datetime(2026, 1, 5, 3))
    return extract(raw, _EVENT_FIELDS, keep=["loaded_at"]).withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


@query("raw_rejects", """SELECT '{"name": "' || c_name || '", "open": ' AS value FROM customer""")
def raw_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines from the events, broken ones from the customers."""
    path = new_dir(spark, "lines")
    broken = table(spark, sf_dir, "customer").select(F.concat(F.lit('{"name": "'), "c_name", F.lit('", "open": ')).alias("value"))
    _event_docs(spark, sf_dir).select("value").union(broken).write.text(path)
    return read_rejects(spark, path).select("value")


@query("raw_incremental", "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders")
def raw_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file drop per order status, a load after each, and one more that finds nothing."""
    source, target, checkpoint = (new_dir(spark, n) for n in ("lines", "raw", "checkpoint"))
    orders = table(spark, sf_dir, "orders")
    line = _lines(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    for part in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        orders.where(part).select(line).write.mode("append").text(source)
        load_new_files(spark, source, target, checkpoint)
    load_new_files(spark, source, target, checkpoint)
    fields = [Field("id", "$.id", "bigint"), Field("status", "$.status", "string"), Field("price", "$.price", "double")]
    return extract(read_raw_table(spark, target), fields)


@query(
    "stg_incremental",
    """WITH n AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
       SELECT c_custkey AS id, c_name AS name,
         CASE WHEN p.n IS NOT NULL THEN 'P' WHEN o.n IS NOT NULL THEN 'O' ELSE 'F' END AS status, coalesce(p.n, o.n, f.n, 0) AS orders
       FROM customer LEFT JOIN n f ON f.o_custkey = c_custkey AND f.o_orderstatus = 'F'
       LEFT JOIN n o ON o.o_custkey = c_custkey AND o.o_orderstatus = 'O' LEFT JOIN n p ON p.o_custkey = c_custkey AND p.o_orderstatus = 'P'""",
)
def stg_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each staged when it came: all customers with their count of one order status, then those
    that have orders of the second, then of the third. Each run reads the batches of its load."""
    source, target, checkpoint, store = (new_dir(spark, n) for n in ("lines", "raw", "checkpoint", "staged"))
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    fields = [Field("id", "$.id", "bigint"), Field("name", "$.name", "string"), Field("status", "$.status", "string"), Field("orders", "$.orders", "bigint")]
    for day, status in enumerate("FOP"):
        counted = orders.where(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.count("*").alias("n"))
        met = customers.join(counted, F.col("c_custkey") == F.col("o_custkey"), "left" if status == "F" else "inner")
        count = F.coalesce("n", F.lit(0)).alias("orders")
        met.select(_lines(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(status).alias("status"), count)).write.mode("append").text(source)
        load_new_files(spark, source, target, checkpoint, dt.datetime(2026, 1, 5 + 7 * day))
        stage_new_batches(spark, target, store, fields)
    return read_staged(spark, store)


@query(
    "load_log",
    """SELECT o_orderstatus AS status, count(*) AS loaded, 0::BIGINT AS rejected FROM orders GROUP BY 1""",
)
def load_log_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load per order status, told apart in the log by the load time."""
    source, target, checkpoint = (new_dir(spark, n) for n in ("lines", "raw", "checkpoint"))
    orders = table(spark, sf_dir, "orders")
    for day, status in enumerate("FOP"):
        orders.where(F.col("o_orderstatus") == status).select(_lines(F.col("o_orderkey").alias("id"))).write.mode("append").text(source)
        load_new_files(spark, source, target, checkpoint, dt.datetime(2026, 1, 5 + day))
    log = load_log(spark, target).groupBy("loaded_at").agg(F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected"))
    status = F.substring(F.lit("FOP"), F.dayofmonth(F.to_timestamp("loaded_at")) - 4, F.lit(1))
    return log.select(status.alias("status"), "loaded", "rejected")


@query(
    "raw_incremental_rejects",
    """SELECT '{"name": "' || c_name || '", "open": ' AS value, (SELECT count(*) FROM orders) AS loaded,
         (SELECT count(*) FROM customer) AS rejected FROM customer""",
)
def raw_incremental_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with broken lines of customers between them: the rejects, and what the load counted."""
    source, target, checkpoint = (new_dir(spark, n) for n in ("lines", "raw", "checkpoint"))
    broken = table(spark, sf_dir, "customer").select(F.concat(F.lit('{"name": "'), "c_name", F.lit('", "open": ')).alias("value"))
    table(spark, sf_dir, "orders").select(_lines(F.col("o_orderkey").alias("id"))).union(broken).write.text(source)
    loaded, rejected = load_new_files(spark, source, target, checkpoint)
    return read_rejected(spark, target).select("value", F.lit(loaded).cast("bigint").alias("loaded"), F.lit(rejected).cast("bigint").alias("rejected"))


@query("bronze_roundtrip", _EVENT_SQL.format(more=", CAST(ts AS DATE) AS ingest_date"))
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates written, then written again: each date is replaced, not doubled."""
    base = new_dir(spark, "bronze")
    docs = _event_docs(spark, sf_dir).select(F.parse_json("value").alias("raw_data"), "ingest_date")
    for _ in range(2):
        write_bronze(docs, base, "events", compact=True)
    return extract(read_raw(spark, entity_path(base, "events")), _EVENT_FIELDS, keep=["ingest_date"])


@query(
    "retention_expired",
    """SELECT CAST(o_orderdate AS DATE) AS ingest_date, count(*) AS n FROM orders
       WHERE CAST(o_orderdate AS DATE) < DATE '1998-08-02' - 30 GROUP BY 1""",
)
def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("ingest_date"))
    return expired_dates(orders, "ingest_date", dt.date(1998, 8, 2))


@query(
    "load_summary",
    """SELECT 'documents' AS entity, count(*) AS loaded, count(*) FILTER (text <> '') AS described FROM documents
       UNION ALL SELECT 'parts', count(*), count(*) FILTER (p_size > 25) FROM part
       UNION ALL SELECT 'pages', count(*), 0 FROM pages""",
)
def load_summary_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    def docs(name: str, entity: str, text: Column) -> DataFrame:
        document = F.to_variant_object(F.struct(text.alias("description_raw")))
        return table(spark, sf_dir, name).select(F.lit(entity).alias("entity"), document.alias("raw_data"))

    named = F.when(F.col("p_size") > 25, F.col("p_name")).when(F.col("p_size") > 10, F.lit(""))
    all_docs = docs("documents", "documents", F.col("text")).union(docs("part", "parts", named))
    return load_summary(all_docs.union(docs("pages", "pages", F.lit(None).cast("string"))))


@query(
    "page_results",
    """SELECT l_orderkey AS page, l_partkey AS id, l_linenumber AS line, l_quantity AS quantity FROM lineitem
       UNION ALL SELECT l_orderkey, l_suppkey, NULL, l_extendedprice FROM lineitem""",
)
def page_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per line item, holding a record of its part and one of its supplier."""

    def record(key: str, line: Column, quantity: str) -> Column:
        return F.struct(F.col(key).alias("id"), line.alias("line"), F.col(quantity).alias("quantity"))

    records = F.array(
        record("l_partkey", F.col("l_linenumber"), "l_quantity"),
        record("l_suppkey", F.lit(None).cast("int"), "l_extendedprice"),
    )
    envelope = F.struct(records.alias("results"), F.lit(None).cast("string").alias("next"))
    lines = spread(table(spark, sf_dir, "lineitem"))
    pages = lines.select(F.col("l_orderkey").alias("page"), F.to_variant_object(envelope).alias("raw_data"))
    fields = [Field("id", "$.id", "bigint"), Field("line", "$.line", "int"), Field("quantity", "$.quantity", "double")]
    return extract(results_of_pages(pages, keep=("page",)), fields, keep=["page"])


# Projections and filters


@query("int_rounding", "SELECT l_orderkey, l_linenumber, CAST(round(l_quantity / 2 - 0.0000001) AS BIGINT) AS v FROM lineitem")
def int_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers just below a half, read as whole numbers."""
    document = F.to_variant_object(F.struct((F.col("l_quantity") / 2 - 0.0000001).alias("v")))
    raw = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", document.alias("raw_data"))
    return extract(raw, [Field("v", "$.v", "bigint")], keep=["l_orderkey", "l_linenumber"])


@query("json_extract", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("raw_data"))
    return extract(raw, [Field("k", "$.k", "int")], keep=["event_id"])


def _date_text(day: str) -> Column:
    """Dates in several forms by line number: full, year and month, junk, compact, ISO week,
    unpadded, and missing."""
    line, date = F.col("l_linenumber"), F.col(day)
    week = F.format_string("%04d-W%02d-%d", F.expr(f"extract(YEAROFWEEK FROM {day})"), F.weekofyear(date), F.weekday(date) + 1)
    return (
        F.when(line == 2, F.date_format(date, "yyyy-MM"))
        .when(line == 3, "TBA")
        .when(line == 4, F.date_format(date, "yyyyMMdd"))
        .when(line == 5, week)
        .when(line == 6, F.date_format(date, "yyyy-M-d"))
        .when(line >= 7, F.when(F.col("l_returnflag") == "A", ""))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


_LONG = "(month(l_shipdate) >= 10 AND day(l_shipdate) >= 10)"


@query(
    "try_date",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 OR (l_linenumber = 6 AND {_LONG})
          THEN CAST(l_shipdate AS DATE) END AS day FROM lineitem""",
)
def try_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "lineitem"))
    return rows.select("l_orderkey", "l_linenumber", lenient_date(_date_text("l_shipdate")).alias("day"))


_WINDOW = (dt.date(1999, 6, 30), 365)
_REASON = f"""CASE WHEN l_linenumber >= 7 THEN 'missing'
  WHEN l_linenumber IN (2, 3) OR (l_linenumber = 6 AND NOT {_LONG}) THEN 'unparseable'
  WHEN CAST(l_shipdate AS DATE) NOT BETWEEN DATE '1998-07-01' AND DATE '1999-06-30' THEN 'out_of_window' END"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "lineitem"))
    return with_reason(rows, _date_text("l_shipdate"), *window_bounds(*_WINDOW))


@query(
    "validate_window",
    f"""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE {_REASON} IS NULL""",
)
def validate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = _judged(spark, sf_dir).where(F.col("reject_reason").isNull())
    return accepted.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))


@query(
    "validate_window_reasons",
    f"SELECT l_orderkey, l_linenumber, {_REASON} AS reject_reason FROM lineitem WHERE {_REASON} IS NOT NULL",
)
def validate_window_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _judged(spark, sf_dir).where(F.col("reject_reason").isNotNull())
    return rejected.select("l_orderkey", "l_linenumber", "reject_reason")


@query(
    "score",
    """SELECT l_orderkey, l_linenumber,
         round(CAST(round(l_discount * 1000) AS INTEGER) / 100.0 * 5 * 0.6 + l_quantity / 10 * 0.4, 2) AS score
       FROM lineitem""",
)
def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    critic = F.round(F.col("l_discount") * 1000).cast("int")
    value = weighted_score(critic, F.col("l_quantity") / 10)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", value.alias("score"))


# Joins


@query(
    "pending_rows",
    """SELECT doc_id, lang FROM documents WHERE trim(text) <> ''
       AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = doc_id AND embedding IS NOT NULL)""",
)
def pending_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "documents").where(non_blank(F.col("text"))).select("doc_id", "lang")
    stored = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return pending_rows(source, stored, "doc_id", filled="embedding")


@query(
    "pending_rows_bucketed",
    """SELECT doc_id, lang FROM documents WHERE trim(text) <> ''
       AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = doc_id AND embedding IS NOT NULL)""",
)
def pending_documents_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``pending_rows``, against vectors stored in buckets of their id, which are not shuffled."""
    source = table(spark, sf_dir, "documents").where(non_blank(F.col("text"))).select("doc_id", "lang")
    path, buckets = new_dir(spark, "vectors"), 32
    stored = write_bucketed(table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id"), path.rsplit("/", 1)[1].replace("-", "_"), path, "doc_id", buckets)
    return pending_in_buckets(source, stored, "doc_id", buckets, filled="embedding")


@query(
    "enrich_merge",
    """SELECT c_custkey AS id, c_name AS name, CASE WHEN o_orderkey IS NULL THEN c_acctbal END AS rating,
         o_totalprice AS price, o_orderstatus AS status
       FROM customer LEFT JOIN (SELECT *, row_number() OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
         ON o_custkey = c_custkey AND rn = 1""",
)
def enrich_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details carry a null rating, which overrides the record's."""
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("rating"))
    records = table(spark, sf_dir, "customer").select("c_custkey", F.to_variant_object(record).alias("raw_data"))
    detail = F.struct(
        F.lit(None).cast("double").alias("rating"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status")
    )
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    latest = latest_by_key(orders, ["c_custkey"], F.col("o_orderdate"), [F.desc("o_orderkey")])
    details = latest.select("c_custkey", F.to_variant_object(detail).alias("raw_data"))
    fields = [
        Field("id", "$.id", "bigint"),
        Field("name", "$.name", "string"),
        Field("rating", "$.rating", "double"),
        Field("price", "$.price", "double"),
        Field("status", "$.status", "string"),
    ]
    return extract(enrich_merge(records, details, "c_custkey"), fields)


_UPSERT_SQL = """SELECT coalesce(vec_id, doc_id) AS id, CASE WHEN doc_id IS NULL THEN 'old' ELSE source END AS name,
         CASE WHEN doc_id IS NULL THEN 0 ELSE n_chars END AS n_chars, label, embedding IS NOT NULL AS has_embedding,
         CASE WHEN doc_id IS NULL THEN DATE '2026-01-05' ELSE DATE '2026-01-12' END AS synced_on
       FROM embeddings FULL JOIN documents ON doc_id = vec_id"""


def _stored_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    target = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.lit("old").alias("name"),
        F.lit(0).cast("bigint").alias("n_chars"),
        "label",
        "embedding",
        F.lit(dt.date(2026, 1, 5)).alias("synced_on"),
    )
    source = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("name"), "n_chars")
    return target, source


@query(
    "upsert_by_key",
    _UPSERT_SQL,
)
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document metadata into the vector table: stored rows keep label and vector."""
    target, source = _stored_and_new(spark, sf_dir)
    merged = upsert_by_key(target, source, "id", ["name", "n_chars"], {"synced_on": F.lit(dt.date(2026, 1, 12))})
    return merged.withColumn("has_embedding", F.col("embedding").isNotNull()).drop("embedding")


@query("upsert_bucketed", _UPSERT_SQL)
def upsert_documents_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into vectors stored in buckets of their id, and read back from the buckets that it writes."""
    target, source = _stored_and_new(spark, sf_dir)
    buckets = 32

    def stored(df: DataFrame, aligned: bool) -> DataFrame:
        path = new_dir(spark, "vectors")
        return write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, "id", buckets, aligned)

    merged = upsert_in_buckets(stored(target, False), source, "id", buckets, ["name", "n_chars"], {"synced_on": F.lit(dt.date(2026, 1, 12))})
    return stored(merged, True).withColumn("has_embedding", F.col("embedding").isNotNull()).drop("embedding")


@query(
    "update_by_key",
    """SELECT d.doc_id, lang, CASE WHEN l.doc_id IS NULL THEN -1 ELSE quality END AS quality, toxic
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def update_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.lit(-1).alias("quality"), F.lit(None).cast("int").alias("toxic")
    )
    return update_by_key(target, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")


# Aggregations and windows


@query(
    "catalog_stats",
    f"""SELECT count(*) AS total, count(nullif(o_orderstatus, 'O')) AS closed, count(o_orderpriority) AS with_priority,
          {_avg("CAST(round(o_totalprice * 100) AS BIGINT)", 100, 2)} AS avg_price FROM orders""",
)
def order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("closed_status", F.nullif("o_orderstatus", F.lit("O")))
    return aggregate.catalog_stats(
        orders,
        counted={"closed": "closed_status", "with_priority": "o_orderpriority"},
        averaged={"avg_price": ("o_totalprice", 2)},
        total="total",
    )


@query(
    "rounded_avg",
    f"""SELECT CAST(l_shipdate AS DATE) AS day, {_avg("CAST(round(l_extendedprice * 100) AS BIGINT)", 100, 2)} AS avg_price,
          {_avg("CAST(round(l_discount * 100) AS BIGINT)", 100, 1)} AS avg_discount FROM lineitem GROUP BY 1""",
)
def average_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"))
    return rows.agg(
        rounded_avg(F.col("l_extendedprice"), 2).alias("avg_price"), rounded_avg(F.col("l_discount"), 1).alias("avg_discount")
    )


@query(
    "rounded_avg_huge",
    """SELECT l_returnflag, 1e22 AS same, 1e25 AS largest,
         CAST((2 * sum(CAST(round(l_quantity) AS HUGEINT)) * 100 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS cancelled
       FROM lineitem GROUP BY 1""",
)
def averages_of_huge_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums far beyond 38 digits with twelve places, and huge values of either sign that leave a small average."""
    lines = table(spark, sf_dir, "lineitem")
    signs = F.explode(F.array(F.lit(1e24), F.lit(-1e24), F.lit(0.0))).alias("extra")
    spread = lines.select("l_returnflag", F.lit(1e22).alias("same"), F.lit(1e25).alias("largest"), "l_quantity", signs)
    cancelled = F.when(F.col("extra") == 0, F.col("l_quantity") * 3).otherwise(F.col("extra"))
    return spread.groupBy("l_returnflag").agg(
        rounded_avg(F.col("same"), 2).alias("same"), rounded_avg(F.col("largest"), 1).alias("largest"), rounded_avg(cancelled, 2).alias("cancelled")
    )


@query(
    "rounded_avg_wide",
    """SELECT l_returnflag, round(avg(l_discount * 1e-6), 10) AS tiny, round(avg(l_extendedprice * 1e10), -4) AS large,
         avg(CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE ELSE l_tax END) AS not_a_number FROM lineitem GROUP BY 1""",
)
def average_of_tiny_and_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("l_linenumber") == 7, float("nan")).otherwise(F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        rounded_avg(F.col("l_discount") * 1e-6, 10).alias("tiny"),
        rounded_avg(F.col("l_extendedprice") * 1e10, -4).alias("large"),
        rounded_avg(odd, 2).alias("not_a_number"),
    )


@query(
    "genre_trends",
    f"""SELECT name, CAST(year(l_shipdate) AS INTEGER) AS release_year, count(DISTINCT l_orderkey) AS game_count,
          {_avg("CAST(round(l_quantity) AS BIGINT)", 1, 2)} AS avg_user_rating,
          {_avg("CAST(round(l_discount * 100) AS BIGINT)", 1, 1)} AS avg_metacritic,
          round(max(l_quantity), 2) AS best_rating, round(min(l_quantity), 2) AS worst_rating
        FROM (SELECT *, unnest([l_returnflag, l_linestatus, l_returnflag]) AS name FROM lineitem)
        WHERE year(l_shipdate) >= 1996 GROUP BY 1, 2""",
)
def flag_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys repeat over rows and names within a row, so the distinct count is needed."""
    rows = spread(table(spark, sf_dir, "lineitem")).withColumn("percent", F.round(F.col("l_discount") * 100).cast("int"))
    names = F.array("l_returnflag", "l_linestatus", "l_returnflag", F.lit(None).cast("string"))
    return aggregate.name_trends(
        rows, names, day="l_shipdate", key="l_orderkey", rating="l_quantity", critic="percent", name="name", min_year=1996
    )


_DAYS = f"""SELECT CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_custkey) AS buyers,
  {_avg("CAST(round(o_totalprice * 100) AS BIGINT)", 100, 2)} AS avg_price,
  count(DISTINCT CASE WHEN o_orderstatus <> 'O' THEN o_custkey END) AS closed_buyers FROM orders GROUP BY 1"""


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("day"), "o_custkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("O")).alias("closed")
    )
    return series.daily_counts(
        orders, "day", "o_custkey", counted="buyers", averaged="o_totalprice", scored="closed", average="avg_price",
        scored_count="closed_buyers",
    )


@query("daily_counts", _DAYS)
def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir)


@query(
    "rolling_counts",
    f"""SELECT *, CAST(sum(buyers) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling,
          CAST(sum(buyers) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM ({_DAYS})""",
)
def rolling_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.running_sums(_order_days(spark, sf_dir), "day", "buyers", "rolling", "cumulative")


@query("string_agg_distinct", "SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1")
def brand_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.string_agg_distinct(table(spark, sf_dir, "part"), ["p_brand"], "p_type", "types")


@query(
    "string_agg_hot",
    """SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'half' WHEN l_linenumber < 7 THEN l_returnflag END AS key,
         coalesce(string_agg(DISTINCT CASE WHEN l_linenumber < 7 THEN CAST(l_orderkey AS VARCHAR) END, '|'
           ORDER BY CASE WHEN l_linenumber < 7 THEN CAST(l_orderkey AS VARCHAR) END), '') AS orders
       FROM lineitem GROUP BY 1""",
)
def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key holds half of all rows, and a NULL key has NULL values alone."""
    some = F.col("l_linenumber") < 7
    key = F.when(F.col("l_orderkey") % 2 == 0, "half").when(some, F.col("l_returnflag"))
    rows = spread(table(spark, sf_dir, "lineitem")).select(key.alias("key"), F.when(some, F.col("l_orderkey")).alias("value"))
    return aggregate.string_agg_distinct(rows, ["key"], "value", "orders", "|")


@query(
    "latest_by_key",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) AS rn
         FROM orders) WHERE rn = 1""",
)
def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    return latest_by_key(orders, ["o_custkey"], F.col("day"), [F.asc("o_orderkey")])


@query(
    "global_rank",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey)
         AS overall_rank FROM orders""",
)
def rank_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(orders, [F.desc_nulls_first("o_totalprice"), F.asc_nulls_last("o_orderkey")])


@query(
    "rank_in_group",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (
         PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS rank FROM orders""",
)
def rank_orders_in_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three statuses: each holds about a third of the rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rank_in_group(orders, ["o_orderstatus"], [F.desc_nulls_first("o_totalprice"), F.asc_nulls_last("o_orderkey")])


# Vectors

_COSINE = "round(1 - list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 10)"
_ONE_QUERY = f"""SELECT vec_id, round(1 - distance, 6) AS similarity FROM (
  SELECT v.vec_id, {_COSINE} AS distance FROM embeddings v,
    (SELECT embedding FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)) q
  WHERE v.embedding IS NOT NULL ORDER BY distance, v.vec_id LIMIT 10)"""


def _first_vector(vectors: DataFrame) -> list[float]:
    """The query: the stored vector with the lowest id."""
    return vectors.orderBy("vec_id").select("embedding").first().embedding


@query("vector_topk", _ONE_QUERY)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = cosine_topk(vectors, _first_vector(vectors), 10, "vec_id")
    return hits.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("vector_topk_ann", _ONE_QUERY)
def vector_topk_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell index, made exact by its second step."""
    vectors, path = table(spark, sf_dir, "embeddings"), new_dir(spark, "cells")
    build_cells(vectors, path, "vec_id")
    hits = search_cells(spark, path, _first_vector(vectors), 10, "vec_id")
    return hits.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(
    "vector_topk_batch",
    f"""SELECT query_id, vec_id, rank, round(1 - distance, 6) AS similarity FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM (
            SELECT q.vec_id AS query_id, v.vec_id, {_COSINE} AS distance FROM embeddings q, embeddings v
            WHERE q.embedding IS NOT NULL AND v.embedding IS NOT NULL)) WHERE rank <= 10""",
)
def vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored vector as a query."""
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    hits = cosine_topk_batch(vectors, queries, 10, "vec_id", "query_id")
    return hits.select("query_id", "vec_id", "rank", F.round("similarity", 6).alias("similarity"))


@query(
    "embed_text",
    """SELECT doc_id, concat_ws(' | ', source, nullif(lang, ''), nullif(substring(text, 1, 2000), '')) AS embed_text
       FROM documents""",
)
def embed_text_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 characters are the embedding input's own limit."""
    text = embed_text(F.col("source"), F.col("lang"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("embed_text"))


@query(
    "embed_text_full",
    "SELECT doc_id, concat_ws(' | ', source, nullif(lang, ''), nullif(text, '')) AS embed_text FROM documents",
)
def embed_text_in_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = embed_text(F.col("source"), F.col("lang"), F.col("text"), max_chars=None)
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("embed_text"))


@query(
    "embed_documents",
    r"""WITH counts AS (
          SELECT doc_id, slot, CAST(count(*) AS DOUBLE) AS n FROM (
            SELECT doc_id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 64 AS slot FROM (
              SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM documents))
          GROUP BY doc_id, slot),
        norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY doc_id)
        SELECT doc_id, slot, round(CAST(CAST(n / norm AS FLOAT) AS DOUBLE), 4) AS weight FROM counts JOIN norms USING (doc_id)""",
)
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of every document; the non-zero slots of its vector."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    vectors = with_embedding(documents, F.col("text"), hashed_words(64), batch_size=200)
    slots = vectors.select("doc_id", F.posexplode("embedding").alias("slot", "weight")).where("weight > 0")
    return slots.select("doc_id", F.col("slot").cast("bigint").alias("slot"), F.round(F.col("weight").cast("double"), 4).alias("weight"))


# Data-quality tests


@query("dq_unique", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(table(spark, sf_dir, "orders"), "o_custkey")


@query(
    "dq_not_null",
    """SELECT 'l_orderkey' AS "column", count(*) FILTER (l_orderkey IS NULL) AS failures FROM lineitem
       UNION ALL SELECT 'status', count(*) FILTER (l_linestatus = 'F') FROM lineitem
       UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem""",
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("status", F.nullif("l_linestatus", F.lit("F")))
    return quality.null_counts(rows, ["l_orderkey", "status", "l_quantity"])
