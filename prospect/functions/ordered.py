"""Global running sums without a single-partition window.

A window ``ORDER BY x`` with no ``PARTITION BY`` moves every row into one task. Here the
ordered column is first cut into value ranges from approximate quantiles (a bounded array of
split points, computed by one aggregate), per-range totals give each range an offset (a table of
at most ``n_buckets`` rows), and the running sum inside each range is a window partitioned by the
range. Results are exact; only the range boundaries are approximate, which changes the balance
of the tasks, never the sums.

The same offset idea gives dense ids (``dense_index``: hash buckets + bucket offsets) and a
per-key row number / lag that a hot key cannot concentrate in one task (``keyed_sequence``).
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_range_bucket"


def default_buckets(df: DataFrame) -> int:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, 4 * n)


def add_range_bucket(df: DataFrame, col: str, n_buckets: int | None = None,
                     accuracy: int = 10_000) -> DataFrame:
    """Add ``_range_bucket``: a monotone, roughly equal-count range id of ``col`` (double)."""
    n_buckets = n_buckets or default_buckets(df)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("q")).first()
    qs = sorted({float(v) for v in (row["q"] or []) if v is not None})
    splits = [float("-inf")] + qs + [float("inf")]
    if len(splits) < 3:
        return df.withColumn(BUCKET, F.lit(0.0))
    tmp = "_range_src"
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=BUCKET, handleInvalid="keep").transform(
        df.withColumn(tmp, F.col(col).cast("double")))
    return out.drop(tmp)


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = False,
                 n_buckets: int | None = None, prefix: str = "cum_") -> DataFrame:
    """For rows with distinct ``order_col`` values, add inclusive running totals ``cum_<c>``.

    ``df`` should already hold one row per distinct order value (aggregate first): the range
    windows then hold distinct values only, so a hot value is a single row, not a hot task.
    """
    b = add_range_bucket(df, order_col, n_buckets)
    if descending:
        b = b.withColumn(BUCKET, -F.col(BUCKET))
    totals = b.groupBy(BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    # At most n_buckets rows: a global window here is bounded by construction.
    wt = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(BUCKET).alias("_ob"), *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0)).alias(f"_o_{c}")
                                                          for c in sum_cols])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(F.broadcast(offsets), F.col(BUCKET).eqNullSafe(F.col("_ob")))  # a NULL is a range of its own
    return out.select(
        *[c for c in df.columns],
        *[(F.sum(c).over(w) + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sum_cols])


def dense_index(df: DataFrame, col: str, out: str, n_buckets: int | None = None) -> DataFrame:
    """``(col, out)``: a dense 0-based integer id for every distinct value of ``col``.

    Unlike ``StringIndexer`` no label list passes through the driver: distinct values are spread
    over ``n_buckets`` hash buckets (balanced by construction), bucket sizes give offsets (a table
    of ``n_buckets`` rows), and a row number inside each bucket completes the id. Ids are unique,
    dense and repeatable; their order is hash order, which is all an id needs.
    """
    n_buckets = n_buckets or default_buckets(df)
    d = df.select(col).distinct().where(F.col(col).isNotNull())
    d = d.withColumn("_h", F.xxhash64(col)).withColumn(BUCKET, F.pmod(F.col("_h"), F.lit(n_buckets)))
    sizes = d.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    wt = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # n_buckets rows
    offsets = sizes.select(BUCKET, F.coalesce(F.sum("_n").over(wt), F.lit(0)).alias("_o"))
    w = Window.partitionBy(BUCKET).orderBy("_h", col)
    return (d.join(F.broadcast(offsets), BUCKET)
            .select(col, (F.col("_o") + F.row_number().over(w) - 1).cast("int").alias(out)))


def keyed_sequence(df: DataFrame, key: str, order: list[str], lags: dict[str, str],
                   number: str | None = None) -> DataFrame:
    """Per ``key``, in ``order``: a 0-based row number and the previous row's value of some
    columns, i.e. ``row_number() - 1`` and ``lag(c)`` over ``PARTITION BY key ORDER BY order``,
    without sending a whole key to one task.

    ``order[0]`` is a coarse ordering column (a date); ``order[1:]`` breaks ties inside it, and
    the whole of ``order`` must be a total order within a key. Three steps:

    1. one row per ``(key, order[0])`` with its size and its last row: a partial aggregate, so
       a hot key is combined map-side before the shuffle;
    2. a window per key over that table gives each group the number of earlier rows of its key
       and the last row of the group before; a key has at most one row per distinct coarse
       value (for a date: per calendar day), whatever its row count;
    3. rows are numbered inside their ``(key, order[0])`` group, and joined to step 2 on the
       same columns, so the window and the join share one shuffle.

    A key with a third of all rows is thus spread over as many tasks as it has distinct coarse
    values. ``key`` and ``order[0]`` must be non-null (rows with nulls there get null results).
    ``lags`` maps output name -> source column; returns ``df`` plus those and ``number``.
    """
    if len(order) < 2:
        raise ValueError("order needs a coarse column and at least one tie-breaker")
    coarse, fine = order[0], order[1:]
    src = list(lags.values())
    last = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(src)])
    groups = df.groupBy(key, coarse).agg(F.count(F.lit(1)).alias("_c"),
                                         F.max_by(last, F.struct(*fine)).alias("_last"))
    wg = Window.partitionBy(key).orderBy(coarse)
    groups = groups.select(
        key, coarse,
        F.coalesce(F.sum("_c").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lag("_last").over(wg).alias("_prev"))
    w = Window.partitionBy(key, coarse).orderBy(*fine)
    local = df.select("*", F.row_number().over(w).alias("_lrn"),
                      *[F.lag(c).over(w).alias(f"_ll{i}") for i, c in enumerate(src)])
    j = local.join(groups, [key, coarse], "left")
    first = F.col("_lrn") == 1
    extra = [F.when(first, F.col(f"_prev.v{i}")).otherwise(F.col(f"_ll{i}")).alias(out)
             for i, out in enumerate(lags)]
    if number:
        extra.append((F.col("_off") + F.col("_lrn") - 1).cast("bigint").alias(number))
    return j.select(*[F.col(f"`{c}`") for c in df.columns], *extra)
