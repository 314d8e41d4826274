"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint bit is the majority over the 64-bit hashes of a text's shingles. Fingerprints
within ``RADIUS`` bits are linked. For radius r every bit position gets a non-zero vector of
r + 1 bits; table v (of the 2^(r+1) - 1 non-zero vectors) keys a fingerprint by the positions
whose vector has an odd overlap with v. Any r positions leave some v orthogonal to all of their
vectors, so two fingerprints that differ only there agree on table v's key: no pair is missed.

Tables never hold pairs. Equal fingerprints are one entry. Entries that meet under a key are
linked inside their bucket and leave as a star to the smallest member, one row an entry. A
bucket of more than ``HOT`` entries is keyed once more by covering masks over the positions that
its own key leaves open: two of its members that are within the radius differ only there, so they
meet again, and what two keys leave open bounds such a bucket to ``2 ** 12`` entries or so.

A text without words has fingerprint zero (null texts too), and is linked like any other.
Repeated rows, equal texts and ties share an entry. ``component_id`` is the smallest id reached;
null ids come out as they are and take no part in that minimum (null if all are null). A very long
text is one pass over its shingles; an empty table gives no rows; columns other than the two named play no
part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, connected_components, ship, table, temp_name, written

SHINGLE = 3
RADIUS = 2
SEED = 42
HOT = 1024


def fingerprint_of(text: str | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of one text; A-Z are lowered, words split at ASCII space."""
    if not text:
        return 0
    words = text.encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype="<u8")
    else:
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        starts.append(at)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b - 1], seed) for a, b in zip(starts, starts[k:], strict=False)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str, out: str, k: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Add the signed 64-bit fingerprint ``out`` of every whole text."""
    ship(df.sparkSession)

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), k, seed) for t in texts], pa.int64())

    return df.withColumn(out, fingerprint(col(text)))


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """One mask per table; a pair that differs in ``radius`` of ``positions`` or fewer agrees on
    some mask. Every position gets a non-zero vector, dealt in turn, so tables are balanced."""
    vectors = range(1, 1 << (radius + 1))
    dealt = {p: 1 + i % len(vectors) for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (dealt[p] & v).bit_count() & 1) for v in vectors]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(masks: list[int], fp: Column) -> Column:
    return F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for t, m in enumerate(masks)])


def local_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest member each entry of a bucket is connected to, and its direct links there."""
    n = len(fps)
    root, links = np.arange(n), np.zeros(n, dtype=np.int64)
    u = fps.view(np.uint64)
    near = []
    for i in range(0, n, 256):  # blocks: 256 rows against the bucket
        hit = np.bitwise_count(u[i:i + 256, None] ^ u[None, :]) <= radius
        a, b = np.nonzero(hit)
        keep = a + i != b
        near.append((a[keep] + i, b[keep]))
        links[i:i + 256] = hit.sum(axis=1) - 1
    a, b = np.concatenate([x for x, _ in near]), np.concatenate([x for _, x in near])
    while len(a):
        least = root.copy()
        np.minimum.at(least, a, root[b])
        least = least[least]
        if (least == root).all():
            break
        root = least
    return root, links


def link_fingerprints(fps: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """``(fp, root)`` for distinct fingerprints that have a link; ``fps`` has one column ``fp``."""
    masks = covering_masks(list(range(64)), radius)
    entries = fps.select("fp", F.explode(_keys(masks, F.col("fp"))).alias("k")).select("fp", "k.t", "k.key")
    sizes = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    met = entries.join(sizes, ["t", "key"])
    met = written(met, "simhash-met")
    plain = met.where(F.col("n") <= hot).select("t", "key", F.lit(-1).alias("t2"), F.lit(0).cast("long").alias("key2"), "fp")
    large = met.where(F.col("n") > hot)
    again = None
    for t, m in enumerate(masks):
        open_bits = [p for p in range(64) if not m >> p & 1]
        part = large.where(F.col("t") == t).select(
            "t", "key", F.explode(_keys(covering_masks(open_bits, radius), F.col("fp"))).alias("k"), "fp").select(
            "t", "key", F.col("k.t").alias("t2"), F.col("k.key").alias("key2"), "fp")
        again = part if again is None else again.unionAll(part)
    buckets = (plain.unionAll(again).groupBy("t", "key", "t2", "key2")
               .agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1).select("fps"))

    def stars(batches):
        for batch in batches:
            a, b = [], []
            for x in batch.column(0):
                fps = np.array(x.values.to_numpy(zero_copy_only=False), dtype=np.int64)
                root, _ = local_links(fps, radius)
                far = root != np.arange(len(fps))
                a.append(fps[far])
                b.append(fps[root[far]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return connected_components(buckets.mapInArrow(stars, "a long, b long")).select(
        F.col("node").alias("fp"), "root")


def _prints(df: DataFrame, id_col: str, text_col: str, k: int, seed: int) -> DataFrame:
    """``(id, h1, h2, fp)`` of every row, written; h1 and h2 name a row by id and text."""
    rows = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    h1, h2 = row_hashes("id", "text")
    return written(fingerprints(rows.select("id", "text", h1.alias("h1"), h2.alias("h2")), "text", "fp", k, seed)
                   .select("id", "h1", "h2", "fp"), "simhash-fp")


def row_hashes(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.xxhash64(col(id_col), col(text_col)), F.xxhash64(F.lit("row"), col(text_col), col(id_col))


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint."""
    distinct = written(prints.select("fp").distinct(), "simhash-distinct")
    roots = link_fingerprints(distinct, radius)
    return written(distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")),
                   "simhash-classes")


def simhash_components(df: DataFrame, id_col: str, text_col: str, k: int = SHINGLE, radius: int = RADIUS,
                       seed: int = SEED) -> DataFrame:
    """``(id_col, fp, component_id)``, one row per row of ``df``."""
    prints = _prints(df, id_col, text_col, k, seed)
    least = prints.groupBy("fp").agg(F.min("id").alias("least")).join(_classes(prints, radius), "fp")
    least = written(least, "simhash-least")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = least.join(ids, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def simhash_keep(df: DataFrame, id_col: str, text_col: str, k: int = SHINGLE, radius: int = RADIUS,
                 seed: int = SEED) -> DataFrame:
    """One row of each group, with all of ``df``'s columns: the smallest id (nulls last), rows
    that share it by a hash of id and text. Equal rows leave one."""
    prints = _prints(df, id_col, text_col, k, seed)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")).alias("first")
    by_fp = prints.groupBy("fp").agg(first).join(_classes(prints, radius), "fp")
    keep = by_fp.groupBy("root").agg(F.min("first").alias("first")).select("first.h1", "first.h2")
    a, b = temp_name(df, "h1"), temp_name(df, "h2")
    h1, h2 = row_hashes(id_col, text_col)
    rows = df.withColumns({a: h1, b: h2})
    return (rows.join(keep.toDF(a, b), [a, b], "left_semi").dropDuplicates([a, b])
            .select(*[col(c) for c in df.columns]))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return simhash_keep(docs, "doc_id", "text")
