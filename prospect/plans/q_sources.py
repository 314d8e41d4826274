"""Registered scan / sink / preview queries.

The scan queries first write data Spark derives from the given tables in the format the
original jobs read (``;``-separated with header, all-string CSV, headerless TSV) into the shared
scratch folder, then read it back with the operator under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospect.operators import metrics as M
from prospect.operators import prep as P
from prospect.plans.oracle import with_ctes
from prospect.plans.q_stats import Y_NUM, cts
from prospect.plans.registry import register
from prospect.session import scratch_path
from prospect.sources import sinks
from prospect.sources.contacts import MACRO_DOTTED, dotted, ratings, rule_scored
from prospect.sources.tables import Tables, read_all_string, read_delimited, read_positional, read_quarantined

RUN_DATE = "2018-08-03"

_CONTACT_TYPES = [
    ("contact_id", T.LongType()), ("job", T.StringType()), ("marital", T.StringType()),
    ("education", T.StringType()), ("nation", T.StringType()), ("month", T.StringType()),
    ("day_of_week", T.StringType()), ("poutcome", T.StringType()), ("duration", T.DoubleType()),
    ("campaign", T.LongType()), ("pdays", T.LongType()), ("previous", T.LongType()),
    ("emp_var_rate", T.DoubleType()), ("cons_conf_idx", T.DoubleType()), ("euribor3m", T.DoubleType()),
    ("nr_employed", T.DoubleType()), ("y", T.StringType())]


def contact_schema(dotted_names: bool = True) -> T.StructType:
    """Explicit schema of the contact file (no inference pass)."""
    return T.StructType([T.StructField(MACRO_DOTTED.get(n, n) if dotted_names else n, t, True)
                         for n, t in _CONTACT_TYPES])


def _write_contacts_csv(spark, d, sep=";", dotted_names=True):
    path = scratch_path(spark, "contacts-csv")
    c = cts(spark, d)
    (dotted(c) if dotted_names else c).write.option("header", True).option("sep", sep).csv(path)
    return path


@register("scan_delimited", with_ctes("SELECT * FROM contacts"))
def q_scan_delimited(spark, d):
    path = _write_contacts_csv(spark, d)
    return P.sanitize_columns(read_delimited(spark, path, contact_schema(), sep=";"))


@register("load_contacts", with_ctes("SELECT * FROM contacts_t", extra=Y_NUM))
def q_load_contacts(spark, d):
    """A4: delimited scan + rename + numeric target in one call."""
    from prospect.sources.contacts import load_contacts
    return load_contacts(spark, _write_contacts_csv(spark, d), contact_schema())


def _broken(column: str) -> str:
    return (f"CASE WHEN contact_id % 29 = 3 THEN 'broken' WHEN contact_id % 31 = 4 THEN 'short' ELSE {column} END")


@register("quarantine_counts", with_ctes(f"""
SELECT kind, count(*) AS n, sum(contact_id) FILTER (WHERE kind = 'good') AS id_sum, '{RUN_DATE}' AS run_date
FROM (SELECT contact_id, {_broken("'good'")} AS kind FROM contacts) GROUP BY kind
"""))
def q_quarantine_counts(spark, d):
    """A1: a file in which some lines have text for a number and some too few fields: typed good rows, and the
    rejected lines in a dated sink, counted."""
    base = scratch_path(spark, "quarantine")
    c = dotted(cts(spark, d))
    text = {x: F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in c.columns}
    bad = {**text, "nr.employed": F.when(F.col("contact_id") % 29 == 3, F.lit("n/a")).otherwise(text["nr.employed"])}
    line = F.concat_ws(";", *bad.values())
    short = F.concat_ws(";", *list(bad.values())[:9])
    is_short = (F.col("contact_id") % 31 == 4) & (F.col("contact_id") % 29 != 3)
    c.select(F.when(is_short, short).otherwise(line).alias("value")).write.text(f"{base}/in")
    good, rejected = read_quarantined(spark, f"{base}/in", contact_schema(), sep=";", header=False)
    sinks.write_dated(rejected, f"{base}/rejected", RUN_DATE)
    fields = F.size(F.split("record", ";"))
    bad_rows = sinks.read_dated(spark, f"{base}/rejected", RUN_DATE).select(
        F.when(fields < len(c.columns), "short").otherwise("broken").alias("kind"), F.lit(None).cast("long").alias("contact_id"))
    rows = good.select(F.lit("good").alias("kind"), F.col("contact_id")).unionByName(bad_rows)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("contact_id").alias("id_sum"), F.lit(RUN_DATE).alias("run_date"))


_AS_TEXT = ["contact_id", "job", "marital", "duration", "campaign", "pdays", "cons_conf_idx", "y"]


@register("scan_all_string", with_ctes(
    f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _AS_TEXT)} FROM contacts"))
def q_scan_all_string(spark, d):
    path = scratch_path(spark, "contacts-text")
    cts(spark, d).select(*_AS_TEXT).write.option("header", True).csv(path)
    return read_all_string(spark, path)


@register("cast_numeric", with_ctes(
    "SELECT contact_id, CAST(duration AS DOUBLE) AS duration, CAST(campaign AS DOUBLE) AS campaign, "
    "CAST(pdays AS DOUBLE) AS pdays, cons_conf_idx FROM contacts"))
def q_cast_numeric(spark, d):
    path = scratch_path(spark, "contacts-text")
    cts(spark, d).select(*_AS_TEXT).write.option("header", True).csv(path)
    s = P.cast_columns(read_all_string(spark, path), ["duration", "campaign", "pdays", "cons_conf_idx"], "double")
    return P.cast_columns(s, ["contact_id"], "bigint").select("contact_id", "duration", "campaign", "pdays",
                                                             "cons_conf_idx")


@register("scan_tsv_positional", with_ctes("SELECT userId, itemId, rating FROM ratings"))
def q_scan_tsv_positional(spark, d):
    path = scratch_path(spark, "ratings-tsv")
    ratings(Tables(spark, d)).write.option("header", False).option("sep", "\t").csv(path)
    r = read_positional(spark, path, ["userId", "itemId", "rating"], sep="\t")
    return P.cast_columns(P.cast_columns(r, ["userId", "itemId"], "string"), ["rating"], "double")


@register("sink_roundtrip", with_ctes(
    f"SELECT contact_id, label, prediction, score, '{RUN_DATE}' AS run_date FROM scored"))
def q_sink_roundtrip(spark, d):
    base = scratch_path(spark, "predictions")
    s = rule_scored(cts(spark, d))
    sinks.write_dated(s, base, RUN_DATE)
    return sinks.read_dated(spark, base, RUN_DATE)


@register("metrics_report", with_ctes(f"""
SELECT round((tp + tn) / nullif(tp + tn + fp + fn, 0), 4) AS accuracy, round(tp / nullif(tp + fp, 0), 4) AS precision,
       round(tp / nullif(tp + fn, 0), 4) AS recall, '{RUN_DATE}' AS run_date
FROM (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn,
             count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
             count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp FROM scored)
"""))
def q_metrics_report(spark, d):
    base = scratch_path(spark, "metrics")
    sinks.write_dated(M.binary_metrics(rule_scored(cts(spark, d))), base, RUN_DATE, fmt="csv")
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in ("accuracy", "precision", "recall")])
    return sinks.read_dated(spark, base, RUN_DATE, fmt="csv", schema=schema)


_PREVIEW = ["contact_id", "job", "marital", "education", "month", "day_of_week", "poutcome", "campaign",
            "pdays", "previous", "y"]


@register("preview_transposed", with_ctes(f"""
SELECT CAST(rn AS INTEGER) AS row_pos, "column", value FROM (
  SELECT row_number() OVER (ORDER BY contact_id) AS rn, * FROM (SELECT * FROM contacts ORDER BY contact_id LIMIT 5))
UNPIVOT INCLUDE NULLS (value FOR "column" IN ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _PREVIEW)}))
"""))
def q_preview_transposed(spark, d):
    """First rows by id, one (row, column, value) line per cell; only ``n`` rows leave the scan."""
    head = cts(spark, d).orderBy("contact_id").limit(5)
    w = Window.orderBy("contact_id")  # five rows
    head = head.select(F.row_number().over(w).alias("row_pos"), *[F.col(c).cast("string").alias(c) for c in _PREVIEW])
    return head.unpivot(["row_pos"], _PREVIEW, "column", "value")


def _top_user_sql():
    return "(SELECT userId FROM ratings GROUP BY userId ORDER BY count(*) DESC, userId LIMIT 1)"


@register("items_x_user", with_ctes(f"SELECT DISTINCT itemId, {_top_user_sql()} AS userId FROM ratings"))
def q_items_x_user(spark, d):
    from prospect.operators.recommend import candidate_items, most_active_user
    r = ratings(Tables(spark, d))
    return candidate_items(r, most_active_user(r))


@register("distinct_items", with_ctes("SELECT DISTINCT itemId FROM ratings"))
def q_distinct_items(spark, d):
    return ratings(Tables(spark, d)).select("itemId").distinct()


@register("topk_items", with_ctes(
    "SELECT itemId, sum(rating) AS total FROM ratings GROUP BY itemId ORDER BY total DESC, itemId LIMIT 10"))
def q_topk_items(spark, d):
    from prospect.operators.recommend import top_k
    r = ratings(Tables(spark, d)).groupBy("itemId").agg(F.sum("rating").alias("total"))
    return top_k(r, "total", 10, tie="itemId")


_VEC_COLS = ["campaign", "pdays", "nr_employed", "cons_conf_idx"]


@register("csv_export", with_ctes(
    "SELECT contact_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(_VEC_COLS))
    + " FROM contacts"))
def q_csv_export(spark, d):
    """A12 + B15: an assembled vector column written as CSV with a header in overwrite mode
    (vectors as text, which CSV can hold), read back and parsed; the text form round-trips."""
    from pyspark.ml.feature import VectorAssembler
    path = scratch_path(spark, "scored-csv")
    v = VectorAssembler(inputCols=_VEC_COLS, outputCol="features").transform(cts(spark, d))
    out = v.select("contact_id", "features")
    sinks.vectors_to_text(out).write.mode("overwrite").option("header", True).csv(path)
    back = spark.read.option("header", True).schema("contact_id long, features string").csv(path)
    parts = F.split(F.regexp_replace("features", r"[\[\]]", ""), ",")
    return back.select("contact_id", *[parts[i].cast("double").alias(f"f{i}") for i in range(len(_VEC_COLS))])


@register("single_csv", with_ctes("""
SELECT round((tp + tn) / nullif(tp + tn + fp + fn, 0), 4) AS accuracy, round(tp / nullif(tp + fp, 0), 4) AS precision,
       round(tp / nullif(tp + fn, 0), 4) AS recall, CAST(1 AS BIGINT) AS n_files
FROM (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn,
             count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
             count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp FROM scored)
"""))
def q_single_csv(spark, d):
    """The metrics row exported as one CSV file (behind a row bound), read back."""
    path = scratch_path(spark, "metrics-single")
    sinks.write_single_csv(M.binary_metrics(rule_scored(cts(spark, d))), path)
    back = spark.read.option("header", True).schema("accuracy double, precision double, recall double").csv(path)
    # One row read back; the same aggregate counts the files it came from.
    return back.withColumn("_file", F.input_file_name()).agg(
        *[F.max(c).alias(c) for c in ("accuracy", "precision", "recall")],
        F.count_distinct("_file").alias("n_files"))


@register("temp_view_sql", with_ctes("SELECT marital, count(*) AS n, round(avg(nr_employed), 6) AS mean FROM contacts GROUP BY marital"))
def q_temp_view_sql(spark, d):
    """The contacts as a temporary view, queried by SQL text."""
    view = f"contacts_{uuid.uuid4().hex[:8]}"
    cts(spark, d).createOrReplaceTempView(view)
    return spark.sql(f"SELECT marital, count(*) AS n, round(avg(nr_employed), 6) AS mean FROM {view} GROUP BY marital")


@register("schema_listing", with_ctes("SELECT count(*) AS n_rows, 17 AS n_columns, 'contact_id:bigint' AS first_column FROM contacts"))
def q_schema_listing(spark, d):
    """Names and types of the table's columns, next to its size."""
    c = cts(spark, d)
    return c.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(c.dtypes)).alias("n_columns"),
                 F.lit(":".join(c.dtypes[0])).alias("first_column"))


@register("schema_rows", with_ctes("\nUNION ALL ".join(
    f"SELECT {i} AS pos, '{n}' AS name, '{t.simpleString()}' AS type, count({n}) AS n_values FROM contacts" for i, (n, t) in enumerate(_CONTACT_TYPES))))
def q_schema_rows(spark, d):
    """A row a column: position, name, type, and how many rows have a value."""
    c = cts(spark, d)
    one = c.agg(*[F.count(F.col(n)).alias(n) for n in c.columns])
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(t).alias("type"), F.col(n).alias("n_values"))
                     for i, (n, t) in enumerate(c.dtypes)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


@register("position_slice", with_ctes("SELECT contact_id, job, marital, education FROM contacts"))
def q_position_slice(spark, d):
    """Columns picked by position."""
    return P.columns_at(cts(spark, d), 0, 4)


@register("rows_with_null", with_ctes("SELECT contact_id, campaign, pdays FROM contacts WHERE duration IS NULL"))
def q_rows_with_null(spark, d):
    """Rows whose value is missing."""
    return P.rows_with_null(cts(spark, d), "duration").select("contact_id", "campaign", "pdays")


@register("rarest_first", with_ctes(
    "SELECT nation, n, row_number() OVER (ORDER BY n, nation) AS position FROM (SELECT nation, count(*) AS n FROM contacts GROUP BY nation)"))
def q_rarest_first(spark, d):
    """Categories by ascending frequency, ties by name; positions over one row a category."""
    n = cts(spark, d).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))
    return n.select("nation", "n", F.row_number().over(Window.orderBy("n", "nation")).cast("bigint").alias("position"))


@register("auc_missing_scores", with_ctes(
    "SELECT round((sum(CASE WHEN label = 1 THEN r END) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0) "
    "/ (count_if(label = 1) * count_if(label <> 1)), 6) AS auc FROM ranked", extra="""
known AS (SELECT label, CASE WHEN contact_id % 7 > 0 AND contact_id % 11 > 0 THEN score END AS score FROM scored),
ranked AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM known WHERE score IS NOT NULL)
"""))
def q_auc_missing_scores(spark, d):
    """H8 with NULL and NaN scores, which are left out together with their labels."""
    s = rule_scored(cts(spark, d))
    gone = F.when(F.col("contact_id") % 7 == 0, F.lit(None)).when(F.col("contact_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("score"))
    return M.auc_exact(s.withColumn("score", gone))
