"""Registered feature-encoding and sampling queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from prospect.functions.hashing import hash_unit
from prospect.operators import features as FE
from prospect.operators import sampling as SA
from prospect.operators.recommend import index_interactions
from prospect.plans.oracle import md5_unit, with_ctes
from prospect.plans.q_stats import cts
from prospect.plans.registry import register
from prospect.session import stored
from prospect.sources.contacts import ratings
from prospect.sources.tables import Tables
from prospect.spec import CONTACTS, TableSpec

CATS = list(CONTACTS.categorical)
ASM_NUMS = ["campaign", "pdays", "previous", "cons_conf_idx", "nr_employed"]
ASM_SPEC = TableSpec(categorical=tuple(CATS), numeric=tuple(ASM_NUMS))


def _dicts():
    return ",\n".join(
        f"d_{f} AS (SELECT value, row_number() OVER (ORDER BY n DESC, value) - 1 AS idx, count(*) OVER () AS nf "
        f"FROM (SELECT {f} AS value, count(*) AS n FROM contacts GROUP BY {f}))" for f in CATS)


@register("string_index", with_ctes(
    "SELECT c.contact_id, " + ", ".join(f"CAST(d_{f}.idx AS DOUBLE) AS {f}_index" for f in CATS)
    + " FROM contacts c " + " ".join(f"JOIN d_{f} ON c.{f} = d_{f}.value" for f in CATS), extra=_dicts()))
def q_string_index(spark, d):
    c = cts(spark, d)
    m = StringIndexer(inputCols=CATS, outputCols=[f"{f}_index" for f in CATS], handleInvalid="keep").fit(c)
    return m.transform(c).select("contact_id", *[f"{f}_index" for f in CATS])


def _onehot_sql(drop_last: bool):
    cond = " WHERE d.idx < d.nf - 1" if drop_last else ""
    return with_ctes("\nUNION ALL ".join(
        f"SELECT c.contact_id, '{f}' AS feature, CAST(d.idx AS INTEGER) AS slot, 1.0::DOUBLE AS value "
        f"FROM contacts c JOIN d_{f} d ON c.{f} = d.value{cond}" for f in CATS), extra=_dicts())


def _onehot(spark, d, drop_last):
    c = cts(spark, d)
    # The original layout: unseen values are an error, so dropLast removes the last real category.
    stages = FE.encoding_stages(TableSpec(categorical=tuple(CATS), numeric=()), drop_last=drop_last,
                                handle_invalid="error", impute=False)[:-1]
    t = Pipeline(stages=stages).fit(c).transform(c)
    # One transform, one explode of (feature, vector) structs.
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), vector_to_array(f"{f}_vec").alias("v")) for f in CATS]))
    e = t.select("contact_id", each.alias("e")).select("contact_id", "e.feature", F.posexplode("e.v").alias("slot", "value"))
    return e.where(F.col("value") != 0)


@register("one_hot", _onehot_sql(True))
def q_one_hot(spark, d):
    return _onehot(spark, d, True)


@register("dummies", _onehot_sql(False))
def q_dummies(spark, d):
    return _onehot(spark, d, False)


def _assemble_sql():
    offs = []
    for i, f in enumerate(CATS):
        prev = " + ".join(f"(SELECT max(nf) - 1 FROM d_{g})" for g in CATS[:i]) or "0"
        offs.append(f"SELECT c.contact_id, {prev} + d.idx AS slot, 1.0::DOUBLE AS value "
                    f"FROM contacts c JOIN d_{f} d ON c.{f} = d.value WHERE d.idx < d.nf - 1")
    total = " + ".join(f"(SELECT max(nf) - 1 FROM d_{g})" for g in CATS)
    for j, n in enumerate(ASM_NUMS):
        offs.append(f"SELECT contact_id, {total} + {j} AS slot, CAST({n} AS DOUBLE) AS value FROM contacts")
    body = "\nUNION ALL ".join(offs)
    return with_ctes(f"SELECT contact_id, CAST(slot AS INTEGER) AS slot, value FROM ({body}) WHERE value <> 0",
                     extra=_dicts())


def _assembled(spark, d):
    c = cts(spark, d)
    model = FE.feature_pipeline(ASM_SPEC, handle_invalid="error", impute=False).fit(c)
    return model.transform(c)


@register("assemble", _assemble_sql())
def q_assemble(spark, d):
    return FE.vector_long(_assembled(spark, d), "contact_id", "features")


@register("feature_count", with_ctes(
    "SELECT CAST(" + " + ".join(f"(SELECT max(nf) - 1 FROM d_{g})" for g in CATS) + f" + {len(ASM_NUMS)} AS INTEGER)"
    " AS n_features", extra=_dicts()))
def q_feature_count(spark, d):
    t = _assembled(spark, d)
    n = FE.feature_count(t)
    # One value read from the fitted vector's metadata: a row of its own, whatever the table holds.
    return spark.range(1).select(F.lit(n).cast("int").alias("n_features"))


@register("id_index")
def q_id_index(spark, d):
    """Dense integer user / item ids without a driver-side label list (rows-only check)."""
    indexed, _, _ = index_interactions(ratings(Tables(spark, d)))
    return indexed.select("userId", "itemId", "rating", "userIndex", "itemIndex")


def _id_summary_sql(col: str, short: str) -> str:
    n = f"count(DISTINCT {col})"
    return (f"{n} AS n_{short}, {n} AS {short}_ids, {n} AS {short}_pairs, "
            f"CAST(0 AS BIGINT) AS {short}_min, {n} - 1 AS {short}_max")


@register("id_index_check", with_ctes(
    f"SELECT count(*) AS n_rows, {_id_summary_sql('userId', 'u')}, {_id_summary_sql('itemId', 'i')} FROM ratings"))
def q_id_index_check(spark, d):
    """E9 exact: the user / item ids are dense (0 .. n-1), one per value, one value per id."""
    indexed, _, _ = index_interactions(ratings(Tables(spark, d)))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for col, idx, short in (("userId", "userIndex", "u"), ("itemId", "itemIndex", "i")):
        aggs += [F.count_distinct(col).alias(f"n_{short}"), F.count_distinct(idx).alias(f"{short}_ids"),
                 F.count_distinct(col, idx).alias(f"{short}_pairs"),
                 F.min(idx).cast("bigint").alias(f"{short}_min"), F.max(idx).cast("bigint").alias(f"{short}_max")]
    return indexed.agg(*aggs)


# ---- sampling (F) ----

@register("hash_split", with_ctes(
    f"SELECT contact_id, CASE WHEN {md5_unit('contact_id', 420)} < 0.8 THEN 'train' ELSE 'test' END AS split "
    f"FROM contacts"))
def q_hash_split(spark, d):
    return SA.hash_split(cts(spark, d), "contact_id", {"train": 0.8, "test": 0.2}, seed=420).select(
        "contact_id", "split")


@register("stratified_sample", with_ctes(
    f"SELECT contact_id, y FROM contacts WHERE {md5_unit('contact_id', 7)} < "
    f"CASE WHEN y = 'yes' THEN 1.0 WHEN y = 'no' THEN 0.2 ELSE 0.0 END"))
def q_stratified_sample(spark, d):
    return SA.hash_sample_by(cts(spark, d), "contact_id", "y", {"yes": 1.0, "no": 0.2}, seed=7).select(
        "contact_id", "y")


@register("holdout_disjoint", with_ctes(f"""
SELECT (SELECT count(*) FROM bal) AS n_train_balanced, (SELECT count(*) FROM ho) AS n_holdout,
       (SELECT count(*) FROM bal JOIN ho USING (contact_id)) AS n_overlap,
       (SELECT count(*) FILTER (WHERE y = 'yes') FROM bal) AS n_train_yes
""", extra=f"""
ho AS (SELECT * FROM contacts WHERE NOT ({md5_unit('contact_id', 11)} < 0.8)),
tr AS (SELECT * FROM contacts WHERE {md5_unit('contact_id', 11)} < 0.8),
bal AS (SELECT * FROM tr WHERE {md5_unit('contact_id', 12)} <
        CASE WHEN y = 'yes' THEN 1.0 WHEN y = 'no' THEN 0.2 ELSE 0.0 END)
"""))
def q_holdout_disjoint(spark, d):
    bal, ho = SA.holdout_then_balance(cts(spark, d), "contact_id", "y", {"yes": 1.0, "no": 0.2},
                                      holdout=0.2, seed=11)
    b = bal.select("contact_id", "y").withColumn("in_bal", F.lit(1))
    h = ho.select("contact_id").withColumn("in_ho", F.lit(1))
    j = b.join(h, "contact_id", "full")
    return j.agg(F.count("in_bal").alias("n_train_balanced"), F.count("in_ho").alias("n_holdout"),
                 F.count_if(F.col("in_bal").isNotNull() & F.col("in_ho").isNotNull()).alias("n_overlap"),
                 F.count_if(F.col("y") == "yes").alias("n_train_yes"))


# ---- SMOTE (F4) ----

SMOTE_COLS = ["cons_conf_idx", "nr_employed"]


def _smote_sql():
    key = "(CAST(m.contact_id AS VARCHAR) || ':' || CAST(g.copy AS VARCHAR))"
    return with_ctes(f"""
SELECT r.contact_id, CAST(r.copy AS INTEGER) AS copy, nn.nid,
       round(x.a + r.u * (p.a - x.a), 6) AS cons_conf_idx, round(x.b + r.u * (p.b - x.b), 6) AS nr_employed
FROM r JOIN nn ON nn.qid = r.contact_id AND nn.rank = r.pick
JOIN m x ON x.contact_id = r.contact_id JOIN m p ON p.contact_id = nn.nid
""", extra=f"""
m AS (SELECT contact_id, cons_conf_idx AS a, nr_employed AS b FROM contacts WHERE y = 'yes'),
st AS (SELECT min(a) AS lo_a, max(a) AS hi_a, min(b) AS lo_b, max(b) AS hi_b, count(*) AS n,
              (SELECT count(*) FROM contacts WHERE y = 'no') - count(*) AS n_new FROM m),
z AS (SELECT contact_id, (a - lo_a) / (hi_a - lo_a) AS z0, (b - lo_b) / (hi_b - lo_b) AS z1 FROM m, st),
nn AS (SELECT q.contact_id AS qid, p.contact_id AS nid,
              row_number() OVER (PARTITION BY q.contact_id
                                 ORDER BY sqrt((p.z0 - q.z0) * (p.z0 - q.z0) + (p.z1 - q.z1) * (p.z1 - q.z1)), p.contact_id) AS rank
       FROM z q JOIN z p ON p.contact_id <> q.contact_id QUALIFY rank <= 5),
kk AS (SELECT qid, count(*) AS kk FROM nn GROUP BY qid),
hr AS (SELECT contact_id, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || CAST(contact_id AS VARCHAR)), 1, 8))::BIGINT,
                                               contact_id) - 1 AS rank0 FROM m),
reps AS (SELECT hr.contact_id, n_new // n + CASE WHEN rank0 < n_new % n THEN 1 ELSE 0 END AS reps FROM hr, st),
r AS (SELECT m.contact_id, g.copy,
             CAST(floor({md5_unit(key, 43)} * kk.kk) + 1 AS INTEGER) AS pick, {md5_unit(key, 44)} AS u
      FROM reps m JOIN kk ON kk.qid = m.contact_id, LATERAL (SELECT range AS copy FROM range(0, m.reps)) g)
""")


@register("smote_exact", _smote_sql())
def q_smote_exact(spark, d):
    """synthetic minority rows to parity on two numeric features; exact grid k-NN (k = 5)."""
    from prospect.operators.smote import synthetic_rows
    c = stored(cts(spark, d).select("contact_id", "y", *SMOTE_COLS), "smote-contacts")
    n_no = c.where(F.col("y") == "no").count()
    m = c.where(F.col("y") == "yes").select("contact_id", *SMOTE_COLS)
    syn = synthetic_rows(m, "contact_id", SMOTE_COLS, n_no - m.count(), k=5, seed=42)
    return syn.select("contact_id", "copy", "nid", *[F.round(x, 6).alias(x) for x in SMOTE_COLS])


# Numerics whose missing values count as zero here, so that both sides of the comparison agree on them to the bit.
MIXED_NUMERIC = ["duration", "campaign", "pdays", "previous", "emp_var_rate", "cons_conf_idx", "euribor3m", "nr_employed"]
MIXED_NOMINAL = list(CONTACTS.categorical)
#: Digits of the synthetic values: six for rates, three for columns of thousands and more.
MIXED_DIGITS = {c: 6 if c in ("emp_var_rate", "euribor3m") else 3 for c in MIXED_NUMERIC}


def _smote_mixed_sql():
    key = "(CAST(m.contact_id AS VARCHAR) || ':' || CAST(g.copy AS VARCHAR))"
    nums, cats = MIXED_NUMERIC, MIXED_NOMINAL
    fill = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in nums)
    scaled = ", ".join(f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) "
                       f"ELSE 0.0 END AS z{i}" for i, c in enumerate(nums))
    differ = " + ".join(f"(CASE WHEN p.{c} <> q.{c} THEN 1 ELSE 0 END)" for c in cats)
    square = f"2.0 * ({differ})::DOUBLE" + "".join(f" + (p.z{i} - q.z{i}) * (p.z{i} - q.z{i})" for i in range(len(nums)))
    return with_ctes(f"""
SELECT r.contact_id, CAST(r.copy AS INTEGER) AS copy, nn.nid,
       {", ".join(f"round(x.{c} + r.u * (p.{c} - x.{c}), {MIXED_DIGITS[c]}) AS {c}" for c in nums)},
       {", ".join(f"CASE WHEN r.u <= 0.5 THEN x.{c} ELSE p.{c} END AS {c}" for c in cats)}
FROM r JOIN nn ON nn.qid = r.contact_id AND nn.rank = r.pick
JOIN m x ON x.contact_id = r.contact_id JOIN m p ON p.contact_id = nn.nid
""", extra=f"""
m AS (SELECT contact_id, {fill}, {", ".join(cats)} FROM contacts WHERE y = 'yes'),
st AS (SELECT count(*) AS n, (SELECT count(*) FROM contacts WHERE y = 'no') - count(*) AS n_new FROM m),
z AS (SELECT contact_id, {", ".join(cats)}, {scaled} FROM m),
nn AS (SELECT q.contact_id AS qid, p.contact_id AS nid,
              row_number() OVER (PARTITION BY q.contact_id ORDER BY {square}, p.contact_id) AS rank
       FROM z q JOIN z p ON p.contact_id <> q.contact_id QUALIFY rank <= 5),
kk AS (SELECT qid, count(*) AS kk FROM nn GROUP BY qid),
hr AS (SELECT contact_id, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || CAST(contact_id AS VARCHAR)), 1, 8))::BIGINT,
                                               contact_id) - 1 AS rank0 FROM m),
reps AS (SELECT hr.contact_id, n_new // n + CASE WHEN rank0 < n_new % n THEN 1 ELSE 0 END AS reps FROM hr, st),
r AS (SELECT m.contact_id, g.copy,
             CAST(floor({md5_unit(key, 43)} * kk.kk) + 1 AS INTEGER) AS pick, {md5_unit(key, 44)} AS u
      FROM reps m JOIN kk ON kk.qid = m.contact_id, LATERAL (SELECT range AS copy FROM range(0, m.reps)) g)
""")


@register("smote_mixed", _smote_mixed_sql())
def q_smote_mixed(spark, d):
    """F4 over all inputs: neighbours over seven nominal and eight numeric columns together, synthetic minority
    rows to parity."""
    from prospect.operators.smote import synthetic_rows
    c = stored(cts(spark, d), "smote-contacts")
    n = {r["y"]: r["n"] for r in c.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    m = stored(c.where(F.col("y") == "yes").select("contact_id", *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in MIXED_NUMERIC],
                                                   *MIXED_NOMINAL), "smote-minority")
    syn = synthetic_rows(m, "contact_id", MIXED_NUMERIC, n.get("no", 0) - n.get("yes", 0), k=5, seed=42, nominal=MIXED_NOMINAL)
    return syn.select("contact_id", "copy", "nid", *[F.round(x, MIXED_DIGITS[x]).alias(x) for x in MIXED_NUMERIC], *MIXED_NOMINAL)


@register("smote_class_counts", with_ctes(f"""
SELECT CAST(l AS DOUBLE) AS label, n_rows, CASE WHEN l = 1 THEN yes ELSE no END AS n_original,
       n_rows - CASE WHEN l = 1 THEN yes ELSE no END AS n_synthetic, CAST(0 AS BIGINT) AS n_in_holdout
FROM (SELECT count(*) FILTER (WHERE y = 'yes') AS yes, count(*) FILTER (WHERE y = 'no') AS no,
             greatest(count(*) FILTER (WHERE y = 'yes'), count(*) FILTER (WHERE y = 'no')) AS n_rows
      FROM contacts WHERE {md5_unit('contact_id', 420)} < 0.8), (SELECT unnest([0, 1]) AS l)
"""))
def q_smote_class_counts(spark, d):
    """The training rows and synthetic ones that the balanced models are fitted on; none of the hold-out."""
    from prospect.operators.smote import oversampled
    p = SA.split_frames(stored(cts(spark, d), "smote-contacts"), "contact_id", {"train": 0.8, "test": 0.2}, seed=420)
    rows = FE.labelled(p["train"], CONTACTS).select("label", "contact_id", *CONTACTS.categorical, *CONTACTS.numeric)
    both = oversampled(rows, CONTACTS).select("label", "contact_id")
    held = p["test"].select("contact_id", F.lit(True).alias("held"))
    own = rows.select("contact_id", F.lit(True).alias("own"))
    j = both.join(own, "contact_id", "left").join(held, "contact_id", "left")
    return j.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.count("own").alias("n_original"),
                                  F.count_if(F.col("own").isNull()).alias("n_synthetic"), F.count("held").alias("n_in_holdout"))
