"""URL filters by a character language-model ratio, behind allow and block rules.

Rules name a host (with its subdomains) and a path prefix; the longest that fits decides. URLs that
no rule decides go to two variable-order Markov models of characters, one learned on the URLs that
rules accept and one on those they reject. A model's probability of a character after a context is
the context's own counts, smoothed by the probability after the context less its first character,
down to single characters and a uniform floor; so a long context counts as far as it has been seen.
The score is the difference of the two log-likelihoods per character. Its threshold is calibrated on
ruled URLs kept out of learning: between the means of the two classes, nearer to the narrower one.

Only the table of distinct character runs of ``ORDER + 1`` holds model values; lower orders are sums
over it. URLs are cut into runs, joined to that table, and summed again. Columns and joins only.

Null URLs and those without ``://`` have an empty host and path, hence no rule; the models read
what is there, and a URL without a character is allowed, as there is nothing against it. Without ruled
URLs (or an empty table) scores are 0 and allow. Repeated URLs get equal answers. Long URLs are
read whole. Columns other than the two named play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, table, written

#: Characters of context at most, weight of the shorter context, size of the uniform floor, and one
#: ruled URL in so many that is kept out of learning for the threshold.
ORDER = 4
WEIGHT = 2.0
FLOOR = 256
FOLDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the task (fixed values): verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits; null if none does."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in longest]
    pick = lambda values: F.coalesce(*[F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True)])
    return pick([h + p for _, h, p in longest]), pick([v for v, _, _ in longest])


def _runs(urls: DataFrame) -> DataFrame:
    """One row for each character of ``s``: the run ``g`` of it and the ORDER before it."""
    padded = F.concat(F.lit("\x01" * ORDER), F.col("s"), F.lit("\x02"))
    at = F.explode(F.sequence(F.lit(1), F.length("s") + 1))
    return urls.withColumn("padded", padded).select("*", at.alias("i")).withColumn(
        "g", F.substring(F.col("padded"), F.col("i"), F.lit(ORDER + 1))).drop("padded", "i", "s")


def ratio_table(grams: DataFrame) -> DataFrame:
    """``(g, llr)`` from the distinct runs with their counts ``a`` (accepted) and ``r`` (rejected)."""
    out = grams.select("g")
    total = grams.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("r"), F.lit(0)).alias("r")).first()
    pa = pr = F.lit(1.0 / FLOOR)
    for k in range(ORDER + 1):
        run = F.substring("g", ORDER + 1 - k, k + 1)
        context = F.substring("g", ORDER + 1 - k, k)
        for name, key in (("n", run), ("c", context))[:2 if k else 1]:
            sums = grams.groupBy(key.alias(f"key_{name}{k}")).agg(F.sum("a").alias(f"a_{name}{k}"), F.sum("r").alias(f"r_{name}{k}"))
            out = out.join(sums, key == F.col(f"key_{name}{k}"))
        seen_a, seen_r = (F.col(f"a_c{k}"), F.col(f"r_c{k}")) if k else (F.lit(total["a"]), F.lit(total["r"]))
        pa = (F.col(f"a_n{k}") + WEIGHT * pa) / (seen_a + WEIGHT)
        pr = (F.col(f"r_n{k}") + WEIGHT * pr) / (seen_r + WEIGHT)
    return out.select("g", (F.log(pa) - F.log(pr)).alias("llr"))


def kept_out(s: Column) -> Column:
    """Whether a ruled URL is kept for the threshold: a hash that any SQL engine finds the same."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("fold:"), s)), 1, 8), 16, 10).cast("long") % FOLDS == 0


def url_scores(urls: DataFrame) -> tuple[DataFrame, float]:
    """``urls``: distinct ``s`` with ``verdict`` (null where no rule decides). Scores ``(s, score)``
    of the undecided ones, and the threshold."""
    named = urls.select("s", "verdict", F.xxhash64("s").alias("u"), F.xxhash64(F.lit("url"), "s").alias("v"),
                        kept_out(F.col("s")).alias("kept"))
    runs = _runs(named)
    learn = ~F.col("kept")
    grams = written(runs.groupBy("g").agg(
        F.count(F.when(learn & (F.col("verdict") == "allow"), 1)).alias("a"),
        F.count(F.when(learn & (F.col("verdict") == "block"), 1)).alias("r")), "url-runs")
    ratios = written(ratio_table(grams), "url-ratios")
    judged = runs.where(F.col("verdict").isNull() | F.col("kept")).join(ratios, "g")
    scores = written(judged.groupBy("u", "v").agg(F.avg("llr").alias("score")), "url-scores")
    scored = named.join(scores, ["u", "v"])
    stats = {r["verdict"]: r for r in scored.where(F.col("verdict").isNotNull()).groupBy("verdict").agg(
        F.avg("score").alias("m"), F.stddev_pop("score").alias("d")).collect()}
    threshold = 0.0
    if len(stats) == 2:
        a, b = stats["allow"], stats["block"]
        spread = a["d"] + b["d"]
        threshold = (a["m"] * b["d"] + b["m"] * a["d"]) / spread if spread else (a["m"] + b["m"]) / 2
    return scored.where(F.col("verdict").isNull()).select("s", "score"), threshold


def filter_urls(df: DataFrame, id_col: str, url_col: str, rules=RULES) -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)`` of every row."""
    url = col(url_col)
    host, path = host_and_path(url)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    at = F.instr(url, "://")
    text = F.translate(F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(url), UPPER, LOWER)
    rows = (df.select(col(id_col).alias("id"), host.alias("host"), path.alias("path"), text.alias("s"))
            .select("*", rule.alias("rule"), verdict.alias("ruled")))
    urls = rows.where(F.length("s") > 0).groupBy("s").agg(F.max("ruled").alias("verdict"))
    scores, threshold = url_scores(written(urls, "urls"))
    scores = scores.withColumnRenamed("s", "text")
    judged = rows.join(scores, F.when(F.col("ruled").isNull(), F.col("s")) == F.col("text"), "left")
    own = F.when(F.col("score") < F.lit(threshold), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("ruled", own).alias("verdict"), F.round("score", 6).alias("score"))


def _sql() -> str:
    """The same models in SQL: one count table over runs of every order."""
    orders = range(ORDER + 1)
    case = lambda pick: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{pick(v, h, p)}'"
        for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))) + " END"
    value = {"a": f"{1 / FLOOR}::DOUBLE", "r": f"{1 / FLOOR}::DOUBLE"}
    for k in orders:
        value = {c: f"((n{k}.{c} + {WEIGHT} * {v}) / (c{k}.{c} + {WEIGHT}))" for c, v in value.items()}
    run = lambda k, g="g": f"substr({g}, {ORDER + 1 - k}, {k + 1})"
    context = lambda k, g="g": f"substr({g}, {ORDER + 1 - k}, {k})"
    tables = ", ".join(f"n{k} AS (SELECT {run(k)} AS x, sum(a) AS a, sum(r) AS r FROM grams GROUP BY 1), "
                       f"c{k} AS (SELECT {context(k)} AS x, sum(a) AS a, sum(r) AS r FROM grams GROUP BY 1)" for k in orders)
    joins = " ".join(f"JOIN n{k} ON n{k}.x = {run(k, 'grams.g')} JOIN c{k} ON c{k}.x = {context(k, 'grams.g')}" for k in orders)
    lower = f"'{UPPER}', '{LOWER}'"
    return f"""
WITH cut AS (SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
named AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), {lower}) AS host,
                 regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path, translate(coalesce(rest, url), {lower}) AS s FROM cut),
judged AS (SELECT *, {case(lambda v, h, p: h + p)} AS rule, {case(lambda v, h, p: v)} AS ruled FROM named),
urls AS (SELECT s, max(ruled) AS verdict, ('0x' || substr(md5('fold:' || s), 1, 8))::BIGINT % {FOLDS} = 0 AS kept
         FROM judged WHERE length(s) > 0 GROUP BY s),
runs AS (SELECT s, verdict, kept, substr(repeat(chr(1), {ORDER}) || s || chr(2), i, {ORDER + 1}) AS g
         FROM urls, unnest(range(1, length(s) + 2)) t(i)),
grams AS (SELECT g, count(CASE WHEN verdict = 'allow' AND NOT kept THEN 1 END) AS a,
          count(CASE WHEN verdict = 'block' AND NOT kept THEN 1 END) AS r FROM runs GROUP BY g),
{tables},
ratios AS (SELECT grams.g, ln({value['a']}) - ln({value['r']}) AS llr FROM grams {joins}),
scores AS (SELECT s, max(verdict) AS verdict, avg(llr) AS score FROM runs JOIN ratios USING (g) WHERE verdict IS NULL OR kept GROUP BY s),
stats AS (SELECT avg(score) FILTER (WHERE verdict = 'allow') AS am, stddev_pop(score) FILTER (WHERE verdict = 'allow') AS ad,
                 avg(score) FILTER (WHERE verdict = 'block') AS bm, stddev_pop(score) FILTER (WHERE verdict = 'block') AS bd FROM scores),
level AS (SELECT CASE WHEN am IS NULL OR bm IS NULL THEN 0 WHEN ad + bd > 0 THEN (am * bd + bm * ad) / (ad + bd) ELSE (am + bm) / 2 END AS t FROM stats)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score < t THEN 'block' ELSE 'allow' END) AS verdict,
       round(CASE WHEN ruled IS NULL THEN score END, 6) AS score
FROM judged CROSS JOIN level LEFT JOIN scores ON judged.ruled IS NULL AND judged.s = scores.s
"""


ORACLE_SQL = _sql()


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), "page_id", "url")
