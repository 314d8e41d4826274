"""Mixing sources to target weights by temperature.

Token shares p of the sources are raised to an exponent a in [0, 1] and normalised: a = 1 keeps the
corpus, a = 0 makes sources equal. The exponent is bisected to the largest one whose entropy
reaches the target; if a source would then be repeated more often than allowed, it is bisected
again to the smallest one that keeps the limit. Sixty-three inner points of a dyadic grid are
tried in one pass, which is six steps of bisection at once.

Weights become rows by a budgeted block permutation: a source's target is its weight times the
budget; whole copies of the source are emitted as often as they fit, the rest is taken from the front
of a permutation. Documents are dealt into blocks by a hash, blocks follow one another in hash order,
documents in a block too; whole blocks are taken while they fit, and of the next one the documents
that fit. So a hot source is cut into blocks by its size, and what is ever
ordered in one task is a block's documents, or a 4096th of a source's blocks.

A document's tokens are its words plus one for its end, so empty and null texts weigh 1. A null
source is a source of its own. Repeated rows are documents of their own (equal ones share a place
in the permutation). A very long text is one row with many tokens, and may be a block of its own. An
empty table gives no rows. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prospect.llm.common import col, table, temp_name, written

#: Target entropy as a share of the way from the corpus's own to equal sources, copies of a
#: document at most, and tokens in a block.
TOWARDS_EQUAL = 0.5
MOST_COPIES = 4.0
BLOCK_TOKENS = 50_000
SEED = 17
ROUNDS, STEPS = 7, 64


def n_tokens(text: Column) -> Column:
    return (F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1).cast("long")


def hash_order(seed: int, *key: Column) -> Column:
    """A repeatable random place: hex of md5, so that any SQL engine finds the same."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key]))


def exponent(shares: DataFrame, entropy: float | None, most_copies: float | None, budget: float) -> float:
    """``shares``: one row a source with its tokens ``n`` and share ``p``. Only ``STEPS`` numbers a
    round reach the driver, whatever the number of sources."""
    def bisect(good_low: bool, test) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [lo + (hi - lo) * k / STEPS for k in range(STEPS + 1)]
            at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(a).alias("a")) for k, a in enumerate(points)]))
            grid = shares.select("n", "p", at.alias("at")).select("n", "p", "at.k", "at.a")
            pa = F.pow("p", F.col("a"))
            rows = grid.groupBy("k").agg(F.max("a").alias("a"), F.sum(pa).alias("z"), F.sum(pa * F.log("p")).alias("s"),
                                         F.max(pa / F.col("n")).alias("c")).collect()
            ok = {r["k"]: test(r) for r in rows}
            if good_low and ok[STEPS] and hi == 1.0:
                return 1.0
            if good_low:  # true up to some point
                k = max([0, *(k for k in range(STEPS) if ok[k])])
            else:  # true from some point on
                k = min([STEPS - 1, *(k - 1 for k in range(1, STEPS + 1) if ok[k])])
            lo, hi = points[k], points[k + 1]
        return lo if good_low else hi

    def rich(r) -> bool:
        from math import log
        return log(r["z"]) - r["a"] * r["s"] / r["z"] >= entropy - 1e-12

    def within(r) -> bool:
        return budget * r["c"] / r["z"] <= most_copies

    a = 1.0 if entropy is None else bisect(True, rich)
    if most_copies is not None:
        worst = shares.agg(F.sum(F.pow("p", F.lit(a))).alias("z"), F.max(F.pow("p", F.lit(a)) / F.col("n")).alias("c")).first()
        if budget * worst["c"] / worst["z"] > most_copies:
            a = bisect(False, within)
    return a


def source_weights(docs: DataFrame, towards_equal: float = TOWARDS_EQUAL, entropy: float | None = None,
                   most_copies: float | None = MOST_COPIES, budget: int | None = None) -> DataFrame:
    """``source, n, p, weight, target`` from rows ``(source, tokens)``. The target entropy is
    ``entropy``, or that share of the way from the corpus's entropy to log(sources)."""
    sums = written(docs.groupBy("source").agg(F.sum("tokens").alias("n")), "mix-sources")
    whole = sums.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    total, k = whole["n"] or 0, whole["k"]
    if not k:
        return sums.select("source", "n", F.lit(1.0).alias("p"), F.lit(1.0).alias("weight"), F.lit(0.0).alias("target"))
    budget = budget or total
    shares = sums.withColumn("p", F.col("n") / F.lit(float(total)))
    if entropy is None:
        from math import log
        own = -(shares.agg(F.sum(F.col("p") * F.log("p")).alias("h")).first()["h"])
        entropy = own + towards_equal * (log(k) - own)
    a = exponent(shares, entropy, most_copies, float(budget)) if k > 1 else 1.0
    z = shares.agg(F.sum(F.pow("p", F.lit(a))).alias("z")).first()["z"]
    weight = F.pow("p", F.lit(a)) / F.lit(z)
    return shares.select("source", "n", "p", weight.alias("weight"), (weight * F.lit(float(budget))).alias("target"))


def mix(df: DataFrame, id_col: str, text_col: str, source_col: str, towards_equal: float = TOWARDS_EQUAL,
        entropy: float | None = None, most_copies: float | None = MOST_COPIES, budget: int | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """``id, h, source, tokens, copies, block``: how often each document is in the mix (not in
    it: no row). ``h`` tells rows of one id apart by their text."""
    text = col(text_col)
    rows = df.select(col(id_col).alias("id"), F.md5(F.coalesce(text, F.lit(""))).alias("h"),
                     col(source_col).alias("source"), n_tokens(text).alias("tokens"))
    rows = written(rows, "mix-tokens")
    weights = written(source_weights(rows, towards_equal, entropy, most_copies, budget), "mix-weights")
    per = weights.select(F.col("source").alias("src"), "n", "target",
                         F.floor(F.col("target") / F.col("n") + 1e-9).cast("long").alias("whole"),
                         F.ceil(F.col("n") / F.lit(block_tokens)).cast("long").alias("blocks"))
    place = hash_order(seed, F.col("id"), F.col("h"))
    dealt = (rows.join(per, F.col("source").eqNullSafe(F.col("src")))
             .withColumn("place", place)
             .withColumn("block", F.conv(F.substring("place", 1, 12), 16, 10).cast("long") % F.col("blocks"))
             .withColumn("rest", F.col("target") - F.col("whole") * F.col("n")))
    blocks = (dealt.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"), F.max("rest").alias("rest"))
              .withColumn("at", hash_order(seed, F.col("source"), F.col("block"))))
    # Prefix sums in two levels: over 4096 ranges of the order, and inside each range.
    blocks = blocks.withColumn("range", F.substring("at", 1, 3))
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = blocks.groupBy("source", "range").agg(F.sum("block_tokens").alias("s")).select(
        F.col("source").alias("rs"), F.col("range").alias("rr"), F.coalesce(F.sum("s").over(over), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "range").orderBy("at", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.withColumn("here", F.coalesce(F.sum("block_tokens").over(inside), F.lit(0)))
              .join(ranges, F.col("source").eqNullSafe(F.col("rs")) & (F.col("range") == F.col("rr")))
              .select(F.col("source").alias("bs"), F.col("block").alias("bb"), "block_tokens",
                      (F.col("ahead") + F.col("here")).alias("before")))
    placed = dealt.join(blocks, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
    left = F.col("rest") - F.col("before")
    placed = placed.withColumn("left", left)
    inside = F.col("left") >= F.col("block_tokens")
    cut = (~inside) & (F.col("left") > 0)
    known = placed.where(~cut).select("id", "h", "source", "tokens", "block", "whole", F.when(inside, 1).otherwise(0).alias("more"))
    running = Window.partitionBy("source", "block").orderBy("place", "id", "h").rowsBetween(Window.unboundedPreceding, 0)
    edge = (placed.where(cut).withColumn("upto", F.sum("tokens").over(running))
            .select("id", "h", "source", "tokens", "block", "whole",
                    F.when(F.col("upto") <= F.col("left"), 1).otherwise(0).alias("more")))
    return (known.unionAll(edge).withColumn("copies", F.col("whole") + F.col("more")).where("copies > 0")
            .select("id", "h", "source", "tokens", "copies", "block"))


ORACLE_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, md5(coalesce(text, '')) AS h, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens FROM documents),
sums AS (SELECT source, sum(tokens)::BIGINT AS n FROM rows GROUP BY source),
tot AS (SELECT sum(n)::BIGINT AS total, count(*) AS k FROM sums),
shares AS (SELECT source, n, n / total::DOUBLE AS p FROM sums, tot),
aim AS (SELECT -sum(p * ln(p)) + 0.5 * (ln(max(k)) + sum(p * ln(p))) AS entropy FROM shares, tot),
rich AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT step, lo, hi, mid, ln(sum(pow(p, mid))) - mid * sum(pow(p, mid) * ln(p)) / sum(pow(p, mid)) >= max(entropy) - 1e-12 AS ok
        FROM (SELECT *, (lo + hi) / 2 AS mid FROM rich WHERE step < 42), shares, aim GROUP BY step, lo, hi, mid)),
first AS (SELECT CASE WHEN (SELECT k FROM tot) > 1 THEN max(lo) ELSE 1.0 END AS a FROM rich WHERE step = 42),
spare AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT step, lo, hi, mid, max(total) * max(pow(p, mid) / n) / sum(pow(p, mid)) <= 4.0 AS ok
        FROM (SELECT *, (lo + hi) / 2 AS mid FROM spare WHERE step < 42), shares, tot GROUP BY step, lo, hi, mid)),
expo AS (SELECT CASE WHEN max(total) * max(pow(p, a) / n) / sum(pow(p, a)) > 4.0 AND max(k) > 1
                     THEN (SELECT max(hi) FROM spare WHERE step = 42) ELSE max(a) END AS a FROM shares, tot, first),
norm AS (SELECT max(a) AS a, sum(pow(p, a)) AS z FROM shares, expo),
per AS (SELECT source AS src, n, pow(p, a) / z * total AS target, floor(pow(p, a) / z * total / n + 1e-9)::BIGINT AS whole,
               ceil(n / 50000.0)::BIGINT AS blocks FROM shares, norm, tot),
dealt AS (SELECT doc_id, h, source, tokens, whole, target - whole * n AS rest, md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || h) AS place,
                 ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || h), 1, 12))::BIGINT % blocks AS block
          FROM rows JOIN per ON source IS NOT DISTINCT FROM src),
blocks AS (SELECT source AS bs, block AS bb, sum(tokens) AS block_tokens,
                  md5('17:' || coalesce(source, '') || ':' || block::VARCHAR) AS place FROM dealt GROUP BY source, block),
ahead AS (SELECT bs, bb, block_tokens, coalesce(sum(block_tokens) OVER (PARTITION BY bs ORDER BY place, bb
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM blocks),
placed AS (SELECT *, rest - before AS remains, sum(tokens) OVER (PARTITION BY source, block ORDER BY place, doc_id, h
                  ROWS UNBOUNDED PRECEDING) AS upto
           FROM dealt JOIN ahead ON source IS NOT DISTINCT FROM bs AND block = bb)
SELECT doc_id, source, tokens::BIGINT AS tokens,
       (whole + CASE WHEN remains >= block_tokens OR upto <= remains THEN 1 ELSE 0 END)::BIGINT AS copies, block
FROM placed WHERE whole + CASE WHEN remains >= block_tokens OR upto <= remains THEN 1 ELSE 0 END > 0
"""


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return out.select(F.col("id").alias("doc_id"), "source", "tokens", "copies", "block")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix has it."""
    picks = mix(docs, "doc_id", "text", "source")
    # Equal rows have equal copies; one pick row each joins all of them.
    picks = picks.groupBy("id", "h", "source").agg(F.max("copies").alias("copies"))
    a, b, c = (temp_name(docs, x) for x in ("mix_id", "mix_h", "mix_source"))
    n = temp_name(docs, "mix_copies")
    picks = picks.toDF(a, b, c, n)
    on = (col("doc_id").eqNullSafe(F.col(a)) & (F.md5(F.coalesce(col("text"), F.lit(""))) == F.col(b))
          & col("source").eqNullSafe(F.col(c)))
    return (docs.join(picks, on).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
            .select(*[col(x) for x in docs.columns]))
