"""Queries for the operators that the larger questions do not show on their
own: sources and sinks, scalar helpers, generated attributes, intervals,
coverage, unions, segments, model calls, late actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.functions.scalar import clip, count_distinct_if, id_string, one_hot, round_half_up, safe_div, uniform_int, value_map
from quarry.operators.calendar import calendar, mod_label
from quarry.operators.ml import improvement
from quarry.operators.monitor import monitor_baseline
from quarry.operators.relational import coverage, holdout_tail, split_history_future, topk
from quarry.operators.text import explode_segments, extract_fields, map_model, typed
from quarry.operators.timeseries import future_stubs, intervals_to_labels, scd_intervals
from quarry.plans.capacity import H, SQL_DAILY, daily_series
from quarry.plans.common import sql_r
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import versioned
from quarry.sources.sinks import append_by_name, ctas, save, snapshot, union_all, with_comments
from quarry.sources.tables import from_local, list_files, load, read_files, seq, values

# ---------------------------------------------------------------------------
# Scalar helpers on the customers.
# ---------------------------------------------------------------------------
SEGMENT_CODES = {"BUILDING": "B", "MACHINERY": "M", "AUTOMOBILE": "A"}

SCALAR_SQL = f"""
SELECT c_custkey, 'CUST_' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_code,
       CASE c_mktsegment {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_CODES.items())} ELSE '?' END AS segment_code,
       CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_building, CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS is_machinery,
       CAST(CAST('0x' || substr(md5(concat_ws('|', c_custkey, 'draw')), 1, 8) AS BIGINT) % 10 + 1 AS BIGINT) AS draw,
       least(greatest(c_nationkey, 3), 20) AS clipped,
       least(greatest(c_nationkey, 3), 20) * 10 + CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS reused
FROM customer
"""


@query("customer_scalars", SCALAR_SQL)
def customer_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    c = c.select(
        "c_custkey",
        id_string("CUST_", "c_custkey", 8).alias("customer_code"),
        value_map("c_mktsegment", SEGMENT_CODES, "?").alias("segment_code"),
        "c_mktsegment",
        uniform_int(1, 10, "c_custkey", F.lit("draw")).alias("draw"),
        clip("c_nationkey", 3, 20).alias("clipped"),
    )
    c = one_hot(c, "c_mktsegment", {"BUILDING": "is_building", "MACHINERY": "is_machinery"})
    return c.withColumn("reused", F.col("clipped") * 10 + F.col("is_building"))


# ---------------------------------------------------------------------------
# Dates as text in two formats, read leniently and written as ISO.
# ---------------------------------------------------------------------------
DATES_SQL = """
SELECT o_orderkey, raw, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS iso
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'week of ' || strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y')
                     ELSE strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y') END AS raw FROM orders)
"""


@query("lenient_dates", DATES_SQL)
def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("d"))
    o = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("week of "), "d")).otherwise(F.col("d")).alias("raw"))
    o = typed(o, {"parsed": ("raw", "date", "dd.MM.yyyy")})
    return o.select("o_orderkey", "raw", "parsed", F.date_format("parsed", "yyyy-MM-dd").alias("iso"))


# ---------------------------------------------------------------------------
# A literal table, a generated sequence and a local frame, all
# joined to the orders they describe.
# ---------------------------------------------------------------------------
PRIORITIES = [("1-URGENT", 1.0), ("2-HIGH", 0.6), ("3-MEDIUM", 0.3)]

LITERAL_SQL = f"""
WITH w(p, weight) AS (VALUES {', '.join(f"('{p}', CAST({w} AS DOUBLE))" for p, w in PRIORITIES)}),
b AS (SELECT o_orderpriority, CAST(floor(o_totalprice / 50000) AS BIGINT) AS band FROM orders)
SELECT r.range AS band, p AS priority, COUNT(*) AS n, {sql_r('SUM(weight)', 4)} AS weighted
FROM b JOIN w ON p = o_orderpriority JOIN range(12) r ON r.range = band GROUP BY 1, 2
"""


@query("literal_weights", LITERAL_SQL)
def literal_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    import pandas as pd

    names = values(spark, [(p,) for p, _ in PRIORITIES], "priority string")
    weights = from_local(spark, pd.DataFrame(PRIORITIES, columns=["priority", "weight"]), "priority string, weight double")
    bands = seq(spark, 12, "band")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.floor(F.col("o_totalprice") / 50000).alias("band"))
    j = o.join(F.broadcast(names), "priority").join(F.broadcast(weights), "priority").join(F.broadcast(bands), "band")
    return j.groupBy("band", "priority").agg(F.count(F.lit(1)).alias("n"), round_half_up(F.sum("weight"), 4).alias("weighted"))


# ---------------------------------------------------------------------------
# A table written as text files, listed, and read back whole.
# ---------------------------------------------------------------------------
FILES_SQL = """
SELECT line, CAST(COUNT(*) AS BIGINT) AS n, true AS listed
FROM (SELECT concat_ws(';', s_suppkey, s_name, s_nationkey) AS line FROM supplier) GROUP BY line
"""


@query("text_files_round_trip", FILES_SQL)
def text_files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "text-files")
    s = load(spark, sf_dir, "supplier").select(F.concat_ws(";", "s_suppkey", "s_name", "s_nationkey").alias("line"))
    s.repartition(4, "line").write.text(root)
    listed = list_files(spark, root, "*.txt").filter("size > 0").agg(F.count(F.lit(1)) > 0).scalar()
    lines = read_files(spark, root, "*.txt").select(F.explode(F.split(F.rtrim("text"), "\n")).alias("line")).filter("line <> ''")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).withColumn("listed", listed)


# ---------------------------------------------------------------------------
# Tables created, appended to by name and combined.
# ---------------------------------------------------------------------------
SINKS_SQL = """
SELECT c_custkey, c_mktsegment, c_nationkey, 'created' AS part FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, c_mktsegment, c_nationkey, 'appended' FROM customer WHERE c_custkey % 3 = 1
UNION ALL SELECT c_custkey, c_mktsegment, c_nationkey, 'united' FROM customer WHERE c_custkey % 3 = 2
"""


@query("tables_created_and_appended", SINKS_SQL)
def tables_created_and_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "sinks")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")

    def third(n: int, part: str) -> DataFrame:
        return c.filter(F.col("c_custkey") % 3 == n).withColumn("part", F.lit(part))

    ctas(third(0, "created"), f"{root}/t")
    ctas(third(1, "skipped"), f"{root}/t", if_exists="skip")  # the table is there: nothing happens
    append_by_name(third(1, "appended").select("part", "c_nationkey", "c_mktsegment", "c_custkey"), ["c_custkey", "c_mktsegment", "c_nationkey", "part"], f"{root}/t")
    save(third(2, "lost"), f"{root}/u")
    save(third(2, "united").select("part", "c_custkey", "c_nationkey", "c_mktsegment"), f"{root}/u")
    return union_all([spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/u")])


# ---------------------------------------------------------------------------
# S11, M19, ST5: predictions whose actuals arrive late are updated in place of
# their keys; unmatched rows stay open.
# ---------------------------------------------------------------------------
LATE_SQL = """
SELECT o_orderkey, round(o_totalprice / 1000) * 1000 AS predicted, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS actual,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus ELSE 'open' END AS state
FROM orders
"""


@query("late_actuals", LATE_SQL)
def late_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    waiting = o.select("o_orderkey", (F.round(F.col("o_totalprice") / 1000) * 1000).alias("predicted"), F.lit(None).cast("double").alias("actual"), F.lit("open").alias("state"))
    arrived = o.filter(F.col("o_orderkey") % 2 == 1).select("o_orderkey", F.col("o_totalprice").alias("actual"), F.col("o_orderstatus").alias("state"))
    # the table's first version, then the day's changes: only the buckets they fall into are rewritten
    root = scratch_path(spark, "late-actuals")
    versioned.create(waiting, root, ["o_orderkey"])
    versioned.merge(spark, root, arrived, 1, cols=["actual", "state"])
    return versioned.read(spark, root, 1)


# ---------------------------------------------------------------------------
# A versioned snapshot with its manifest and column comments.
# ---------------------------------------------------------------------------
SNAPSHOT_SQL = """
SELECT o_orderstatus, COUNT(*) AS n, (SELECT COUNT(DISTINCT o_orderstatus) FROM orders) AS manifest_rows, 'v1' AS version,
       'orders by status' AS about_n
FROM orders GROUP BY o_orderstatus
"""


@query("dataset_snapshot", SNAPSHOT_SQL)
def dataset_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "snapshots")
    d = load(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    d = with_comments(d, {"n": "orders by status"})
    kept = snapshot(d, root, "by_status", "v1", sources=["orders"])
    manifest = spark.read.json(f"{root}/by_status/v1/manifest")  # one row
    about = kept.schema["n"].metadata.get("comment")
    told = {"manifest_rows": manifest.select("rows").scalar(), "version": manifest.select("version").scalar()}
    return kept.withColumns(told).withColumn("about_n", F.lit(about))


# ---------------------------------------------------------------------------
# How complete the columns are, one row each.
# ---------------------------------------------------------------------------
COVERAGE_SQL = """
SELECT 'value' AS col, COUNT(*) AS n_rows, COUNT(CASE WHEN value >= 50 THEN value END) AS n_non_null FROM events
UNION ALL SELECT 'props', COUNT(*), COUNT(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) FROM events
UNION ALL SELECT 'buyers', COUNT(DISTINCT user_id), COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) FROM events
"""


@query("event_coverage", COVERAGE_SQL)
def event_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select(
        F.when(F.col("value") >= 50, F.col("value")).alias("value"), F.get_json_object("props", "$.k").try_cast("bigint").alias("props"), "user_id", "event_type"
    )
    buyers = e.agg(F.count_distinct("user_id").alias("n_rows"), count_distinct_if("user_id", F.col("event_type") == "purchase").alias("n_non_null"))
    parts = [coverage(e, "value"), coverage(e, "props"), buyers]
    return union_all([p.withColumn("col", F.lit(n)) for p, n in zip(parts, ["value", "props", "buyers"])])


# ---------------------------------------------------------------------------
# Turns gathered into one array per conversation, and back
# to rows with their speaker.
# ---------------------------------------------------------------------------
SEGMENTS_SQL = """
SELECT conv_id, turn, role, length(text) AS chars, COUNT(*) OVER (PARTITION BY conv_id) AS turns FROM conversations
"""


@query("conversation_segments", SEGMENTS_SQL)
def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "conversations")
    whole = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("segments"), F.count(F.lit(1)).alias("turns"))
    rows = explode_segments(whole, "segments", ["turn", "role", "text"])
    return rows.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"), "turns")


# ---------------------------------------------------------------------------
# Schema-driven extraction with grouped and ungrouped patterns.
# ---------------------------------------------------------------------------
# The fields of the schema.
FIELDS = {
    "first_ip": (r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}", "string", False),
    "password": (r"password=([0-9a-f]+)", "string", False),
    "area_code": (r"\+1 \(([0-9]{3})\)", "int", False),
    "mail_hosts": (r"@(mail[0-9]+)\.example", "string", True),
}

FIELDS_SQL = """
SELECT doc_id, nullif(regexp_extract(text, '(?:[0-9]{1,3}\\.){3}[0-9]{1,3}'), '') AS first_ip,
       nullif(regexp_extract(text, 'password=([0-9a-f]+)', 1), '') AS password,
       TRY_CAST(nullif(regexp_extract(text, '\\+1 \\(([0-9]{3})\\)', 1), '') AS INTEGER) AS area_code,
       array_to_string(list_sort(list_distinct(regexp_extract_all(text, '@(mail[0-9]+)\\.example', 1))), ',') AS mail_hosts
FROM documents
"""


@query("doc_fields", FIELDS_SQL)
def doc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = extract_fields(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", FIELDS)
    return d.select("doc_id", "first_ip", "password", "area_code", F.array_join("mail_hosts", ",").alias("mail_hosts"))


# ---------------------------------------------------------------------------
# T1, E13, UD1: a model called with lists of prompts; prompts it refuses are
# errors as data, the rest of their list is answered.
# ---------------------------------------------------------------------------
REFUSED = 97


def count_words(prompts: list[str]) -> list[int]:
    """A deterministic stand-in model: the number of words; refuses some lengths."""
    if any(len(p) % REFUSED == 0 for p in prompts):
        raise ValueError("refused")
    return [len(p.split()) for p in prompts]


MODEL_SQL = f"""
SELECT conv_id, turn, CASE WHEN length(text) % {REFUSED} <> 0 THEN CAST(len(regexp_extract_all(text, '\\S+')) AS VARCHAR) END AS words,
       CASE WHEN length(text) % {REFUSED} = 0 THEN 'ValueError: refused' END AS words_error
FROM conversations WHERE text IS NOT NULL
"""


@query("model_answers", MODEL_SQL)
def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", "text")
    return map_model(c, "text", "words", count_words, batch=16).drop("text")


# ---------------------------------------------------------------------------
# JSON text as typed fields (from_json) and as a variant.
# ---------------------------------------------------------------------------
JSON_SQL = """
SELECT event_type, CAST(SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_typed,
       CAST(SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_variant, COUNT(*) AS n
FROM events GROUP BY event_type
"""


@query("json_fields", JSON_SQL)
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint").alias("j"), F.try_parse_json("props").alias("v"))
    return e.groupBy("event_type").agg(
        F.sum("j.k").alias("k_typed"), F.sum(F.try_variant_get("v", "$.k", "bigint")).alias("k_variant"), F.count(F.lit(1)).alias("n")
    )


# ---------------------------------------------------------------------------
# Orders per business day of the calendar; days without orders count 0.
# ---------------------------------------------------------------------------
BUSINESS_SQL = """
WITH r AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
c AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM r)
SELECT d AS full_date, COUNT(o_orderkey) AS n FROM c LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d WHERE isodow(d) <= 5 GROUP BY d
"""


@query("business_day_orders", BUSINESS_SQL)
def business_day_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    days = calendar(spark, o.agg(F.min("o_orderdate")).scalar(), o.agg(F.max("o_orderdate")).scalar(), weekdays_only=True).select("full_date")
    per_day = o.groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "full_date", "left").select("full_date", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


# ---------------------------------------------------------------------------
# Attributes by key, round robin over label lists.
# ---------------------------------------------------------------------------
TEAMS = ["north", "south", "east", "west", "centre"]

ROBIN_SQL = f"""
SELECT c_custkey, [{', '.join(f"'{t}'" for t in TEAMS)}][c_custkey % {len(TEAMS)} + 1] AS team,
       ['gold', 'plain'][(c_custkey + 1) % 2 + 1] AS tier
FROM customer
"""


@query("round_robin_teams", ROBIN_SQL)
def round_robin_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", mod_label("c_custkey", TEAMS).alias("team"), mod_label("c_custkey", ["gold", "plain"], 1).alias("tier"))


# ---------------------------------------------------------------------------
# Each customer's orders as validity intervals, and the end of every
# closed interval as a labelled event.
# ---------------------------------------------------------------------------
INTERVAL_SQL = """
WITH h AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
i AS (SELECT o_custkey, d, LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d) AS until FROM h)
SELECT i.o_custkey, i.d AS effective, i.until, e.renewed
FROM i LEFT JOIN (SELECT DISTINCT o_custkey, until AS date, 1 AS renewed FROM i WHERE until IS NOT NULL) e ON e.o_custkey = i.o_custkey AND e.date = i.d
"""


@query("order_intervals", INTERVAL_SQL)
def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = load(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("effective")).distinct()
    i = scd_intervals(h, "o_custkey", "effective", "until")
    ended = intervals_to_labels(i.filter(F.col("until").isNotNull()), "o_custkey", "until", "renewed")
    return i.join(ended.withColumnRenamed("date", "effective"), ["o_custkey", "effective"], "left")


# ---------------------------------------------------------------------------
# History and rows still to be predicted, told apart.
# ---------------------------------------------------------------------------
SPLIT_SQL = f"""
WITH d AS ({SQL_DAILY})
SELECT series, COUNT(*) AS history_rows, CAST({H} AS BIGINT) AS future_rows, MAX(ds) AS last_known, CAST(MAX(ds) + {H} AS DATE) AS last_asked FROM d GROUP BY series
"""


@query("history_and_future", SPLIT_SQL)
def history_and_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, asked = split_history_future(future_stubs(daily_series(spark, sf_dir), "series", "ds", "y", H, ["value_sum"]), "y")
    a = known.groupBy("series").agg(F.count(F.lit(1)).alias("history_rows"), F.max("ds").alias("last_known"))
    b = asked.groupBy("series").agg(F.count(F.lit(1)).alias("future_rows"), F.max("ds").alias("last_asked"))
    return a.join(b, "series")


# ---------------------------------------------------------------------------
# Hold-out rows joined to predictions made from the training
# rows (their mean), next to the baseline whose prediction is the actual.
# ---------------------------------------------------------------------------
HOLDOUT_SQL = f"""
WITH d AS ({SQL_DAILY}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY ds DESC) AS rd FROM d),
p AS (SELECT series, CAST(SUM(y) AS DOUBLE) / COUNT(*) AS yhat FROM r WHERE rd > {H} GROUP BY series)
SELECT r.series, ds, y, {sql_r('yhat', 6)} AS predicted, y AS baseline FROM r JOIN p ON p.series = r.series WHERE rd <= {H}
"""


@query("holdout_predictions", HOLDOUT_SQL)
def holdout_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held = holdout_tail(daily_series(spark, sf_dir).select("series", "ds", "y"), "series", "ds", H)
    pred = train.groupBy("series").agg(round_half_up(safe_div(F.sum("y"), F.count("y")), 6).alias("predicted"))
    base = monitor_baseline(held, "series", "ds", "y", "baseline").drop("y")
    return held.join(pred, "series").join(base, ["series", "ds"])


# ---------------------------------------------------------------------------
# M6, M7: logged errors of two naive forecasts and the improvement in percent.
# ---------------------------------------------------------------------------
IMPROVED_SQL = f"""
WITH d AS ({SQL_DAILY}),
p AS (SELECT y, LAG(y, 1) OVER w AS a, LAG(y, 7) OVER w AS b FROM d WINDOW w AS (PARTITION BY series ORDER BY ds)),
m AS (SELECT CAST(SUM(abs(y - a)) AS DOUBLE) / COUNT(*) AS ma, CAST(SUM(abs(y - b)) AS DOUBLE) / COUNT(*) AS mb FROM p WHERE b IS NOT NULL)
SELECT 'mae' AS metric, {sql_r('ma', 6)} AS a, {sql_r('mb', 6)} AS b, {sql_r('(ma - mb) / NULLIF(ma, 0) * 100', 6)} AS improvement_pct FROM m
"""


@query("naive_improvement", IMPROVED_SQL)
def naive_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("series").orderBy("ds")
    p = daily_series(spark, sf_dir).select("y", F.lag("y", 1).over(w).alias("a"), F.lag("y", 7).over(w).alias("b")).filter("b IS NOT NULL")
    mae = p.agg(*[safe_div(F.sum(F.abs(F.col("y") - F.col(c))), F.count(F.lit(1))).alias(c) for c in ("a", "b")])
    runs = mae.selectExpr("stack(2, 'lag_1', a, 'lag_7', b) AS (run, value)").select("run", F.lit("metric").alias("kind"), F.lit("mae").alias("key"), F.col("value").cast("string").alias("value"))
    out = improvement(runs, "lag_1", "lag_7", "mae")
    return out.select("metric", *[round_half_up(c, 6).alias(c) for c in ("a", "b", "improvement_pct")])


# ---------------------------------------------------------------------------
# O2, O3: the ten dearest orders, ties by key.
# ---------------------------------------------------------------------------
@query("dearest_orders", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def dearest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return topk(o, [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


# ---------------------------------------------------------------------------
# The headings of every page, in order.
# ---------------------------------------------------------------------------
HEADINGS_SQL = r"""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]\s*>', 1)) AS raw,
                  generate_subscripts(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]\s*>', 1), 1) AS i FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS i, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(raw, '<[^>]*>', ' ', 'g'),
       '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')) AS heading FROM h
"""


@query("page_headings", HEADINGS_SQL)
def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.operators.text import parse_pages

    p = parse_pages(load(spark, sf_dir, "pages")).select("page_id", F.posexplode("headings").alias("i", "heading"))
    return p.select("page_id", (F.col("i") + 1).cast(T.IntegerType()).alias("i"), "heading")


# ---------------------------------------------------------------------------
# M1: the named date ranges of the training data, rows and span of each.
# ---------------------------------------------------------------------------
@query(
    "named_date_ranges",
    """
    SELECT name, COUNT(*) AS n, MIN(d) AS first_day, MAX(d) AS last_day FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
    JOIN (VALUES ('early', DATE '1992-01-01', DATE '1994-12-31'), ('late', DATE '1995-01-01', DATE '1998-12-31')) r(name, lo, hi) ON d BETWEEN lo AND hi
    GROUP BY name
    """,
)
def named_date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.operators.features import split_by_date

    o = load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    parts = split_by_date(o, "d", {"early": ("1992-01-01", "1994-12-31"), "late": ("1995-01-01", "1998-12-31")})
    named = [p.agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first_day"), F.max("d").alias("last_day")).withColumn("name", F.lit(k)) for k, p in parts.items()]
    return union_all(named).filter("n > 0")
