"""Substring dedup with fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document; a word is removed if a window over it
occurs anywhere else (same document included). Reference blocks are the non-overlapping runs of
``BLOCK`` words at multiples of ``BLOCK`` in each document. With WINDOW >= 2 * BLOCK - 1 every
window holds a whole reference block of its own document, and if the window occurs twice, that
block's words also start elsewhere. So the work is:

1. index every reference block and probe the index with every rolling run of BLOCK words;
2. extend: each hit block proposes the windows that hold it, and a proposed window counts if it is
   proposed from another place as well; windows that overlap join into maximal repeats;
3. take the covered words out.

Texts are dealt once into batches of about ``BATCH_BYTES`` at random, in a table bucketed by batch,
so that later steps find a batch's texts without moving them again. Hashes travel as sets: a batch
sends each distinct hash once (with a mark if it has it more than once), cut by hash range, and gets
back the ones that others have too. A passage that a third of all documents share is one entry a
batch, whatever its count, and no occurrence is ever paired with another. Probes are 48 bits of
XXH3-64 (a false hit only proposes windows in vain); windows are compared by 96 bits of XXH3-128.

Null texts count as empty: no words, the hash of the empty string. A text shorter than a window
keeps all words. A batch holds whole texts, so a very long one makes its batch longer. Repeated rows
are copies of each other and lose their windows; an empty table gives no row. Columns other than the
two named play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, parallelism, ship, table, written
from prospect.session import scratch_path

WINDOW = 35
BLOCK = 18
#: Text in a batch: larger ones mean fewer, longer messages; executors with more memory take more.
BATCH_BYTES = 12 << 20
MOST_BUCKETS = 50_000

MESSAGE = pa.schema([("range", pa.int32()), ("batch", pa.int32()), ("hi", pa.binary()), ("lo", pa.binary()),
                     ("marks", pa.binary())])
MESSAGE_DDL = "range int, batch int, hi binary, lo binary, marks binary"
REPLY = pa.schema([("batch", pa.int32()), ("step", pa.int32()), ("hi", pa.binary()), ("lo", pa.binary())])
REPLY_DDL = "batch int, step int, hi binary, lo binary"


def split_words(text: str | None) -> tuple[bytes, list[bytes], list[int]]:
    """Words joined by one blank, the words, and their starts in the joined text (one past the end last)."""
    words = (text or "").encode().split()
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    starts.append(at)
    return b" ".join(words), words, starts


def rolling(joined: bytes, starts: list[int], block: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(joined[a:b - 1]) for a, b in zip(starts, starts[block:], strict=False)], dtype=np.uint64)


def _ranges(values: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Where the ``n`` hash ranges begin in sorted ``values`` of ``bits`` bits."""
    cuts = np.array([(i << bits) // n for i in range(1, n)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(values, cuts), [len(values)]))


def pack(values: np.ndarray) -> bytes:
    """Sorted values below 2**48 as differences: 4 bytes each where they fit, else 8."""
    steps = np.diff(values, prepend=np.uint64(0))
    first, rest = steps[:1], steps[1:]
    if len(rest) and int(rest.max()) >> 32:
        return b"8" + steps.astype("<u8").tobytes()
    return b"4" + first.astype("<u8").tobytes() + rest.astype("<u4").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"8":
        return np.cumsum(np.frombuffer(data, "<u8", offset=1))
    return np.cumsum(np.concatenate((np.frombuffer(data, "<u8", 1, 1), np.frombuffer(data, "<u4", offset=9).astype(np.uint64))))


def _texts(rows: pa.Table):
    for chunk in rows.column("text").chunks:
        for x in chunk:
            yield x.as_py()


def probe_messages(rows: pa.Table, ranges: int, block: int) -> pa.Table:
    """Step 1, one batch: its distinct rolling hashes; mark 1: a reference block, 2: here twice."""
    parts = []
    for text in _texts(rows):
        joined, words, starts = split_words(text)
        if len(words) >= block:
            h = rolling(joined, starts, block) >> np.uint64(15) & np.uint64((1 << 49) - 2)
            h[::block] |= np.uint64(1)  # the low bit tells reference blocks apart
            parts.append(h)
    if not parts:
        return MESSAGE.empty_table()
    h = np.sort(np.concatenate(parts))
    v = h >> np.uint64(1)
    begin = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    end = np.append(begin[1:], len(v))
    marks = ((h[end - 1] & np.uint64(1)).astype(np.uint8) | ((end - begin > 1).astype(np.uint8) << 1))
    v = v[begin]
    cut = _ranges(v, 48, ranges)
    full = [i for i in range(ranges) if cut[i] < cut[i + 1]]
    batch = rows.column("batch")[0].as_py()
    return pa.table([pa.array(full, pa.int32()), pa.array([batch] * len(full), pa.int32()),
                     pa.array([pack(v[cut[i]:cut[i + 1]]) for i in full], pa.binary()),
                     pa.array([b""] * len(full), pa.binary()),
                     pa.array([marks[cut[i]:cut[i + 1]].tobytes() for i in full], pa.binary())], schema=MESSAGE)


def probe_replies(rows: pa.Table) -> pa.Table:
    """Step 1, one hash range: to each batch, those of its reference blocks that occur elsewhere."""
    values = [unpack(x) for x in rows.column("hi").to_pylist()]
    marks = [np.frombuffer(x, np.uint8) for x in rows.column("marks").to_pylist()]
    every = np.sort(np.concatenate(values))
    hit = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *[v[m >= 2] for v, m in zip(values, marks, strict=True)]]))
    del every
    out: dict[int, list[np.ndarray]] = {}
    for batch, v, m in zip(rows.column("batch").to_pylist(), values, marks, strict=True):
        own = v[(m & 1) == 1]
        own = own[_among(own, hit)]
        if len(own):
            out.setdefault(batch, []).append(own)
    return _reply(1, {b: (np.concatenate(x), np.empty(0, np.uint32)) for b, x in out.items()})


def _among(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(found, values), len(found) - 1)
    return found[at] == values


def _reply(step: int, by: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    return pa.table([pa.array(list(by), pa.int32()), pa.array([step] * len(by), pa.int32()),
                     pa.array([hi.astype("<u8").tobytes() for hi, _ in by.values()], pa.binary()),
                     pa.array([lo.astype("<u4").tobytes() for _, lo in by.values()], pa.binary())], schema=REPLY)


def _received(replies: pa.Table, step: int) -> tuple[np.ndarray, np.ndarray]:
    """What a batch was sent in a step, as sorted hashes (and their low parts)."""
    hi, lo = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)]
    for s, a, b in zip(*(replies.column(c).to_pylist() for c in ("step", "hi", "lo")), strict=True):
        if s == step:
            hi.append(np.frombuffer(a, "<u8"))
            lo.append(np.frombuffer(b, "<u4"))
    h, w = np.concatenate(hi), np.concatenate(lo)
    order = np.argsort(h, kind="stable")
    return h[order], w[order] if len(w) == len(h) else w


def proposed(joined: bytes, starts: list[int], hits: np.ndarray, window: int, block: int) -> np.ndarray:
    """Starts of the windows that hold a hit reference block."""
    n = len(starts) - 1
    if n < window or not len(hits):
        return np.empty(0, np.int64)
    at = list(range(0, n - block + 1, block))
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(joined[starts[i]:starts[i + block] - 1]) for i in at], dtype=np.uint64) >> np.uint64(16)
    found = np.flatnonzero(_among(own, hits)) * block
    holds = np.zeros(n + 2, dtype=np.int64)
    np.add.at(holds, np.maximum(found + block - window, 0), 1)
    np.add.at(holds, found + 1, -1)
    return np.flatnonzero(np.cumsum(holds)[:n - window + 1] > 0)


def window_hashes(joined: bytes, starts: list[int], where: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(joined[starts[i]:starts[i + window] - 1]) for i in where.tolist()])
    both = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].astype(np.uint32)


def window_messages(rows: pa.Table, replies: pa.Table, ranges: int, window: int, block: int) -> pa.Table:
    """Step 2, one batch: the distinct windows that its hit blocks propose; mark 2: here twice."""
    hits, _ = _received(replies, 1)
    his, los = [], []
    for text in _texts(rows) if len(hits) else ():
        joined, _, starts = split_words(text)
        where = proposed(joined, starts, hits, window, block)
        if len(where):
            hi, lo = window_hashes(joined, starts, where, window)
            his.append(hi)
            los.append(lo)
    if not his:
        return MESSAGE.empty_table()
    hi, lo, many = _distinct(np.concatenate(his), np.concatenate(los))
    marks = (many > 1).astype(np.uint8) << 1
    cut = _ranges(hi, 64, ranges)
    full = [i for i in range(ranges) if cut[i] < cut[i + 1]]
    batch = rows.column("batch")[0].as_py()
    part = lambda x, i: x[cut[i]:cut[i + 1]].tobytes()
    return pa.table([pa.array(full, pa.int32()), pa.array([batch] * len(full), pa.int32()),
                     *[pa.array([part(x, i) for i in full], pa.binary()) for x in (hi.astype("<u8"), lo.astype("<u4"), marks)]],
                    schema=MESSAGE)


def _distinct(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    begin = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
    return hi[begin], lo[begin], np.diff(np.append(begin, len(hi)))


def window_replies(rows: pa.Table) -> pa.Table:
    """Step 2, one hash range: to each batch, those of its windows that occur twice or more."""
    his = [np.frombuffer(x, "<u8") for x in rows.column("hi").to_pylist()]
    los = [np.frombuffer(x, "<u4") for x in rows.column("lo").to_pylist()]
    marks = np.concatenate([np.frombuffer(x, np.uint8) for x in rows.column("marks").to_pylist()])
    source = np.repeat(np.arange(len(his)), [len(x) for x in his])
    hi, lo = np.concatenate(his), np.concatenate(los)
    order = np.lexsort((lo, hi))
    hi, lo, source, marks = hi[order], lo[order], source[order], marks[order]
    same = (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])
    keep = (marks >= 2) | np.concatenate((same, [False])) | np.concatenate(([False], same))
    hi, lo, source = hi[keep], lo[keep], source[keep]
    order = np.argsort(source, kind="stable")
    hi, lo, source = hi[order], lo[order], source[order]
    batches = rows.column("batch").to_pylist()
    cut = np.searchsorted(source, np.arange(len(his) + 1))
    return _reply(2, {batches[i]: (hi[cut[i]:cut[i + 1]], lo[cut[i]:cut[i + 1]])
                      for i in range(len(his)) if cut[i] < cut[i + 1]})


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    over = np.zeros(n + 1, dtype=np.int64)
    np.add.at(over, starts, 1)
    np.add.at(over, starts + window, -1)
    return np.cumsum(over[:n]) > 0


def removed_words(rows: pa.Table, replies: pa.Table, window: int, block: int) -> list[tuple[int, bytes]]:
    """Step 3, one batch: ``(n_words, n_removed, kept text)`` of each row."""
    hits, _ = _received(replies, 1)
    hi, lo = _received(replies, 2)
    repeated = set(zip(hi.tolist(), lo.tolist(), strict=True))
    out = []
    for text in _texts(rows):
        joined, words, starts = split_words(text)
        where = proposed(joined, starts, hits, window, block) if repeated else np.empty(0, np.int64)
        if len(where):
            a, b = window_hashes(joined, starts, where, window)
            where = where[np.fromiter((x in repeated for x in zip(a.tolist(), b.tolist(), strict=True)), bool, len(a))]
        if len(where):
            gone = covered(len(words), where, window)
            joined = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
            out.append((len(words), int(gone.sum()), joined))
        else:
            out.append((len(words), 0, joined))
    return out


def substring_dedup(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, block: int = BLOCK,
                    batch_bytes: int = BATCH_BYTES, with_text: bool = False) -> DataFrame:
    """``(id_col, n_words, n_removed, kept_sha256)`` of every row, and ``kept`` on request: its
    words that no repeated window covers, joined by one blank."""
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole reference block: window >= 2 * block - 1")
    spark = df.sparkSession
    ship(spark)
    rows = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(parallelism(spark), -(-size // batch_bytes))
    buckets = min(batches, MOST_BUCKETS)
    name = f"anchor_texts_{uuid.uuid4().hex}"
    # By content, so that a task that runs again deals its rows out alike, whatever their order; the input
    # partition parts equal rows.
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(batches)).cast("int"))
    try:
        (dealt.repartition(buckets, "batch").write.bucketBy(buckets, "batch")
         .option("path", scratch_path(spark, "anchor-texts")).saveAsTable(name))
        texts = spark.table(name)

        probes = texts.select("batch", "text").groupBy("batch").applyInArrow(
            lambda t: probe_messages(t, batches, block), MESSAGE_DDL)
        hits = written(probes.groupBy("range").applyInArrow(probe_replies, REPLY_DDL), "anchor-hits")
        windows = texts.select("batch", "text").groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(
            lambda t, r: window_messages(t, r, batches, window, block), MESSAGE_DDL)
        repeats = written(windows.groupBy("range").applyInArrow(window_replies, REPLY_DDL), "anchor-repeats")

        kind = df.schema[id_col].dataType.simpleString()
        ddl = f"id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

        def take_out(t: pa.Table, r: pa.Table) -> pa.Table:
            found = removed_words(t, r, window, block)
            cols = {"id": t.column("id"), "n_words": pa.array([n for n, _, _ in found], pa.int64()),
                    "n_removed": pa.array([n for _, n, _ in found], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for _, _, k in found], pa.string())}
            if with_text:
                cols["kept"] = pa.array([k.decode() for _, _, k in found], pa.string())
            return pa.table(cols)

        done = texts.groupBy("batch").cogroup(hits.unionAll(repeats).groupBy("batch")).applyInArrow(take_out, ddl)
        done = written(done, "anchor-kept")
        return done.withColumnRenamed("id", id_col)
    finally:  # a failed run leaves no table behind
        spark.sql(f"DROP TABLE IF EXISTS {name}")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, row_number() OVER () AS r FROM documents),
p AS (SELECT r, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END AS h
      FROM d, unnest(range(1, len(w) + 1)) t(i)),
again AS (SELECT h FROM p WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
m AS (SELECT r, i, word, max(CASE WHEN again.h IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
      FROM p LEFT JOIN again ON p.h = again.h),
a AS (SELECT r, count(*) AS n, sum(gone) AS g, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM m GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(g, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (r)
"""


def op5_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), "doc_id", "text")
