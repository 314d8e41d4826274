"""Document fingerprints by spot signatures.

A signature is a common word (the anchor) with the next ``CHAIN`` content words after it; anchors
are spread over running text and rare in boilerplate, so the set of a text's signatures follows
its prose. Sets are compared by Jaccard likeness. Two sets whose sizes differ by more than the
threshold allows can't be alike, so a comparison is cut off by sizes first and, signature by
signature, as soon as the rest can't reach the threshold; the near-duplicate join deals sets out
by size band.

Words are lower-cased runs of ASCII letters, digits and non-ASCII characters. A text without any
signature but with characters has one that stands for the whole text; null and empty texts have
none, and two empty sets are alike (1.0). Equal texts have equal sets. Very long texts are one
pass over their words. Rows that repeat an id are neighbours in the order of a text hash, null ids come
last; ids are numbers for the neighbour comparison (ranges of them are dealt out) and anything for the
join. An empty table gives no rows. Columns other than the two named play no part, whatever their names;
``signature_sets`` replaces a column named like its result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.functions.ordered import BUCKET, add_range_bucket, default_buckets
from prospect.llm.common import col, ship, table

CHAIN = 3
#: Common words of four languages (fixed values).
ANCHORS = frozenset(w.encode() for w in """
the of and to in is by for with was be that on as at it he this from or are an a
le la les de des du et en un une que qui dans par pour sur pas est au
der die das und von zu mit den dem ist im ein eine für auf nicht sich
el los las y una por con para del se lo su es no
""".split())
WORD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def signatures(text: str | None, chain: int = CHAIN) -> frozenset[int]:
    """64-bit signatures of one whole text."""
    if not text:
        return frozenset()
    words = text.lower().encode().translate(WORD).split()
    content = [w for w in words if w not in ANCHORS]
    digest, out, k, last = xxhash.xxh3_64_intdigest, set(), 0, len(content) - chain
    for w in words:
        if w not in ANCHORS:
            k += 1
        elif k <= last:
            out.add(digest(b" ".join([w, *content[k:k + chain]])))
    if not out:
        out.add(digest(b"\0" + text.encode()))
    return frozenset(out)


def jaccard(a: frozenset, b: frozenset, least: float = 0.0) -> float:
    """Likeness of two sets; 0.0 as soon as it can't reach ``least``."""
    if not a and not b:
        return 1.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < least * len(large):
        return 0.0
    if least <= 0:
        both = len(small & large)
    else:
        both, spare = 0, len(small) - math.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9)
        for x in small:
            if x in large:
                both += 1
            else:
                spare -= 1
                if spare < 0:
                    return 0.0
    like = both / (len(a) + len(b) - both)
    return like if like >= least else 0.0


def fingerprint(sigs: frozenset[int]) -> str:
    """Size and digest of the set."""
    data = b"".join(x.to_bytes(8, "big") for x in sorted(sigs))
    return f"{len(sigs)}:{xxhash.xxh3_128_hexdigest(data)}"


def signature_sets(df: DataFrame, text: str, out: str = "signatures") -> DataFrame:
    """Add ``out``: sorted array<long> of the text's signatures."""
    ship(df.sparkSession)

    @F.arrow_udf("array<long>")
    def sets(texts: pa.Array) -> pa.Array:
        rows = [sorted(x - (1 << 64) if x >> 63 else x for x in signatures(t.as_py())) for t in texts]
        return pa.array(rows, pa.list_(pa.int64()))

    return df.withColumn(out, sets(col(text)))


def near_sets(df: DataFrame, id_col: str, text_col: str, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate join: ``members`` (id, set_id) and ``pairs`` (a, b, likeness) of distinct
    sets with likeness >= ``least``; ``set_id`` names a distinct set, so copies are no pairs.

    Sets are dealt out by size band (geometric, ratio ``least``: partners are in the same or the
    next band) and by their rarest signatures: of n, the n - ceil(least * n) + 1 that are rarest
    in the corpus, one of which any partner shares.
    """
    rows = signature_sets(df.select(col(id_col).alias("id"), col(text_col).alias("text")), "text", "s").select("id", "s")
    rows = rows.withColumn("set_id", F.xxhash64("s"))
    sets = rows.groupBy("set_id").agg(F.first("s").alias("s")).withColumn("n", F.size("s"))
    one = sets.where("n > 0").select("set_id", "n", F.explode("s").alias("x"))
    seen = one.groupBy("x").agg(F.count(F.lit(1)).alias("f"))
    rare = one.join(seen, "x").groupBy("set_id", "n").agg(F.sort_array(F.collect_list(F.struct("f", "x"))).alias("o"))
    probes = F.expr(f"slice(o, 1, n - cast(ceil({least} * n - 1e-9) as int) + 1)")
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(least) + 1e-9).cast("int")
    keys = rare.select("set_id", "n", band.alias("band"), F.explode(probes).alias("p")).select("set_id", "n", "band", "p.x")
    a, b = keys.toDF("a", "na", "band", "x"), keys.select("set_id", "n", F.explode(F.array("band", F.col("band") - 1)).alias("band"), "x").toDF("b", "nb", "band", "x")
    found = (a.join(b, ["band", "x"]).where(f"na <= nb and (na < nb or a < b) and a <> b and na >= {least} * nb - 1e-9")
             .select("a", "b").distinct())
    pairs = (found.join(sets.select(F.col("set_id").alias("a"), F.col("s").alias("sa")), "a")
             .join(sets.select(F.col("set_id").alias("b"), F.col("s").alias("sb")), "b")
             .withColumn("both", F.size(F.array_intersect("sa", "sb")))
             .select("a", "b", (F.col("both") / (F.size("sa") + F.size("sb") - F.col("both"))).alias("likeness"))
             .where(F.col("likeness") >= least))
    return rows.select(F.col("id").alias(id_col), "set_id"), pairs


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (id, text, h, part, tail) so that, in the order (part, tail, id nulls last, h), every
    row but a part's last (tail = 1) is followed by the next one by id; the last by the first.

    Parts are ranges of the id, about equally long. The first row of a part is sent to the part
    before as well: a table of one row a part, whose number is fixed by the caller's partitions.
    """
    n = default_buckets(docs)
    rows = add_range_bucket(docs.select("id", "text", F.xxhash64("text", F.lit(1)).alias("h")), "id", n)
    rows = rows.withColumn(BUCKET, F.coalesce(BUCKET, F.lit(float("inf"))))  # null ids: a part of their own, the last
    key = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    firsts = rows.groupBy(BUCKET).agg(F.min(key).alias("first")).collect()
    parts = sorted((r[BUCKET], r["first"]) for r in firsts)
    before = [(b, f["id"], f["h"], parts[i - 1][0]) for i, (b, f) in enumerate(parts)]
    edge = docs.sparkSession.createDataFrame(before, f"{BUCKET} double, fid {docs.schema['id'].dataType.simpleString()}, fh long, before double")
    marked = rows.join(F.broadcast(edge), BUCKET, "left")
    is_first = F.col("id").eqNullSafe(F.col("fid")) & F.col("h").eqNullSafe(F.col("fh"))
    to = F.when(is_first, F.array(F.struct(F.col(BUCKET).alias("part"), F.lit(0).alias("tail")),
                                  F.struct(F.col("before").alias("part"), F.lit(1).alias("tail")))).otherwise(
        F.array(F.struct(F.col(BUCKET).alias("part"), F.lit(0).alias("tail"))))
    return marked.select("id", "text", "h", F.explode(to).alias("to")).select("id", "text", "h", "to.part", "to.tail"), n


def edited_text(text: str, following: str) -> str:
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def neighbour_likeness(df: DataFrame, id_col: str, text_col: str, chain: int = CHAIN) -> DataFrame:
    """Per row: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, where the edited text ends in the beginning of the next document's."""
    ship(df.sparkSession)
    rows, n = with_next(df.select(col(id_col).alias("id"), col(text_col).alias("text")))
    dealt = rows.repartition(n // 4, "part").sortWithinPartitions("part", "tail", F.col("id").asc_nulls_last(), "h")
    id_type = pa.int64() if df.schema[id_col].dataType.simpleString() == "bigint" else None
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            ids, texts, parts, tails = (batch.column(c) for c in ("id", "text", "part", "tail"))
            for i, part, tail in zip(range(len(ids)), parts.to_pylist(), tails.to_pylist(), strict=True):
                if tail and (held is None or held[0] != part):
                    continue  # a first row that is repeated: its part has been closed
                text = texts[i].as_py() or ""
                sigs = signatures(text, chain)
                if held is not None:
                    _, hid, htext, hsigs = held
                    new = edited_text(htext, text)
                    esigs = signatures(new, chain)
                    out.append((hid, len(htext), hashlib.sha256(new.encode()).hexdigest(), fingerprint(hsigs),
                                fingerprint(esigs), jaccard(hsigs, esigs), jaccard(hsigs, sigs)))
                held = None if tail else (part, ids[i].as_py(), text, sigs)
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], id_type)] + [pa.array(c, t) for c, t in zip(cols[1:], types, strict=True)],
                                                 ["id", *names])

    kind = df.schema[id_col].dataType.simpleString()
    out = dealt.select("id", "text", "part", "tail").mapInArrow(
        compare, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)


def op7_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_likeness(table(spark, sf_dir, "documents"), "doc_id", "text")
