"""Token-id files compressed by Re-Pair grammars.

Documents are tokenised, an end id follows each, and ids are written in ascending document order.
A shard is a run of whole documents of ``SHARD_IDS`` ids or a little more (a longer document is a
shard of its own length). In each shard frequent id pairs are replaced by new symbols, round by
round until no pair is used ``LEAST_USES`` times; a shard's record holds the rules (two symbols each),
the expansion length of every rule, and the remaining symbols. Lengths let a reader find and expand any
range of ids without the rest.

The files are Parquet written by Spark (one record a shard, in ``path``), so any store that
Spark knows holds them and a lost executor's shards are written again. Record columns:
``part, seq`` (order of shards), ``doc_ids``, ``doc_lengths`` (ids, end id included), ``base``
(first symbol of a rule), ``rules`` (uint32 pairs), ``lengths`` (uint32), ``symbols`` (uint32).

Ids of documents are whole numbers (others raise when Spark casts them). Null texts count as empty and
have the end id alone; rows that repeat an id follow each other in the order of a text hash; null ids
come last; very long texts make long shards and are held whole by one task; an empty table gives no
shard. Columns other than the two named play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prospect.llm.byte_ids import byte_ids, tokenizer_path
from prospect.llm.common import col, parallelism, ship, table
from prospect.session import scratch_path

END_ID = 2
SHARD_IDS = 1 << 20
#: Uses that a pair must have to be replaced; pairs looked at in one round (the others wait).
LEAST_USES = 8
RULES_A_ROUND = 8192
SLOT_BITS = 20


def compress(ids: np.ndarray, most: int = RULES_A_ROUND, least: int = LEAST_USES) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """``(base, rules (n, 2), lengths (n), symbols)`` of one shard. Rounds go on until no pair stands
    ``least`` times side by side; every round shortens the sequence, so they end.

    A round replaces every hit of its pairs or takes one of its symbols away, so what is frequent
    afterwards holds a symbol of the round: the next one looks at those places only, unless pairs
    were left waiting."""
    seq = ids.astype(np.uint64)
    base = int(seq.max()) + 1 if len(seq) else 0
    rules, lengths = [np.empty((0, 2), np.int64)], np.empty(0, np.int64)
    top, fresh = base, 0  # symbols from ``fresh`` on are looked at
    while len(seq) > least:
        if fresh:
            new = seq >= np.uint64(fresh)
            place = np.flatnonzero(new[:-1] | new[1:])
            keys = seq[place] << np.uint64(32) | seq[place + 1]
        else:
            place, keys = None, seq[:-1] << np.uint64(32) | seq[1:]
        ordered = np.sort(keys)
        if len(ordered) < least:
            break
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        uses = np.diff(np.append(edge, len(ordered)))
        frequent = np.flatnonzero(uses >= least)
        if not len(frequent):
            break
        waiting = len(frequent) > most
        if waiting:
            frequent = frequent[np.argsort(-uses[frequent], kind="stable")[:most]]
        pairs = np.sort(ordered[edge[frequent]])
        slots = np.full(1 << SLOT_BITS, -1, dtype=np.int32)  # a hash table; a pair that another one covers waits
        own = _slot(pairs)
        slots[own] = np.arange(len(pairs), dtype=np.int32)
        waiting |= bool((slots[own] != np.arange(len(pairs))).any())
        at = slots[_slot(keys)]
        hit = np.flatnonzero(at >= 0)
        hit = hit[pairs[at[hit]] == keys[hit]]
        at, where = at[hit], hit if place is None else place[hit]
        # pairs overlap: of a chain of hits every other one is replaced, from the left
        first = np.concatenate(([True], where[1:] != where[:-1] + 1))
        odd = (where - where[first][np.cumsum(first) - 1]) & 1 == 0
        take, at = where[odd], at[odd]
        is_used = np.zeros(len(pairs), dtype=np.int64)
        is_used[at] = 1
        used, number = np.flatnonzero(is_used), np.cumsum(is_used) - 1
        seq[take] = (top + number[at]).astype(np.uint64)
        keep = np.ones(len(seq), dtype=bool)
        keep[take + 1] = False
        seq = seq[keep]
        rule = np.stack([pairs[used] >> np.uint64(32), pairs[used] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64)
        lengths = np.append(lengths, _size(rule[:, 0], base, lengths) + _size(rule[:, 1], base, lengths))
        rules.append(rule)
        fresh = 0 if waiting else top
        top += len(used)
    return base, np.concatenate(rules).astype(np.uint32), lengths.astype(np.uint32), seq.astype(np.uint32)


def _slot(pairs: np.ndarray) -> np.ndarray:
    """Some bits of a multiplicative hash."""
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).view(np.int64)


def _size(symbols: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    made = symbols >= base
    out[made] = lengths[symbols[made] - base]
    return out


def _unfold(base: int, rules: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Ids of a run of symbols, rule by rule until none is left."""
    seq = symbols
    while len(seq):
        made = seq >= base
        if not made.any():
            break
        at = np.arange(len(seq)) + np.concatenate(([0], np.cumsum(made)[:-1]))
        out = np.empty(len(seq) + int(made.sum()), dtype=np.uint32)
        out[at[~made]] = seq[~made]
        pair = rules[seq[made] - base]
        out[at[made]], out[at[made] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq.astype(np.uint32)


def expand(base: int, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Ids of a run of symbols. Every rule that occurs is unfolded once; the stored lengths say where its
    ids go, so the run itself is written in one pass, however deep the rules are."""
    made = symbols >= base
    used, which = np.unique(symbols[made], return_inverse=True)
    flat = _unfold(base, rules, used)
    size = lengths[used - base].astype(np.int64)
    begin = np.cumsum(size) - size
    long = np.ones(len(symbols), np.int64)
    long[made] = n = size[which]
    ends = np.cumsum(long)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
    starts = ends - long
    out[starts[~made]] = symbols[~made]
    before = np.cumsum(n) - n
    step = np.arange(int(n.sum()))
    out[step + np.repeat(starts[made] - before, n)] = flat[step + np.repeat(begin[which] - before, n)]
    return out


def read_range(base: int, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, start: int, n: int) -> np.ndarray:
    """``n`` ids from position ``start`` of a shard: only the symbols that cover them are expanded."""
    ends = np.cumsum(_size(symbols, base, lengths.astype(np.int64)))
    a = int(np.searchsorted(ends, start, side="right"))
    b = int(np.searchsorted(ends, start + n, side="left")) + 1
    skip = start - (int(ends[a - 1]) if a else 0)
    return expand(base, rules, lengths, symbols[a:b])[skip:skip + n]


RECORD = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_lengths", pa.list_(pa.int64())), ("base", pa.int64()), ("rules", pa.binary()),
                    ("lengths", pa.binary()), ("symbols", pa.binary())])
RECORD_DDL = ("part int, seq int, doc_ids array<long>, doc_lengths array<long>, base long, rules binary, "
              "lengths binary, symbols binary")


def write_ids(df: DataFrame, id_col: str, text_col: str, tokenizer: str, path: str, end_id: int = END_ID,
              shard_ids: int = SHARD_IDS) -> None:
    """Write the shards of ``df`` to ``path``. Documents are dealt out by ranges of their id and
    sorted within; a range is a ``part``, its shards are numbered by ``seq``."""
    ship(df.sparkSession)
    rows = df.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    h = F.xxhash64("text")
    order = [F.col("id").asc_nulls_last(), h]
    dealt = rows.repartitionByRange(parallelism(df.sparkSession), *order).sortWithinPartitions(*order)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = byte_ids(tokenizer), TaskContext.get().partitionId(), 0
        docs: list[int] = []
        held: list[bytes] = []
        end = np.array([end_id], dtype="<u4").tobytes()
        n = 0

        def record():
            base, rules, lengths, symbols = compress(np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "doc_ids": docs, "doc_lengths": [len(x) // 4 for x in held], "base": base,
                "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
                "symbols": symbols.astype("<u4").tobytes()}], RECORD)

        for batch in batches:
            for doc, ids in zip(batch.column("id").to_pylist(), enc.encode(batch.column("text"), end), strict=True):
                docs.append(doc)
                held.append(ids)
                n += len(ids) // 4
                if n >= shard_ids:
                    yield record()
                    docs, held, n, seq = [], [], 0, seq + 1
        if held:
            yield record()

    dealt.mapInArrow(shards, RECORD_DDL).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the files.

    ``start`` adds up shard sizes: within a part by a window over its shards, and over the parts,
    whose number is that of the writer's partitions.
    """
    ship(spark)
    files = spark.read.schema(RECORD_DDL).parquet(path)
    sizes = files.select("part", "seq", F.aggregate("doc_lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    starts = (sizes.select("part", "seq", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("here"))
              .join(parts, "part").select("part", "seq", (F.col("before") + F.col("here")).alias("shard_start")))

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in RECORD.names}
                rules, lengths, symbols = (np.frombuffer(r[c], "<u4") for c in ("rules", "lengths", "symbols"))
                ids = expand(r["base"], rules.reshape(-1, 2), lengths, symbols)
                ends = np.cumsum(r["doc_lengths"])
                begins = ends - r["doc_lengths"]
                raw = ids.astype("<u4").tobytes()
                out = {"part": [r["part"]] * len(ends), "seq": [r["seq"]] * len(ends), "doc_id": r["doc_ids"],
                       "offset": begins, "n_tokens": r["doc_lengths"],
                       "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]}
                if with_ids:
                    out["ids"] = [ids[a:b].astype(np.int64) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_pydict(out, pa.schema(
                    [("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("offset", pa.int64()),
                     ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids))

    ddl = "part int, seq int, doc_id long, offset long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = files.mapInArrow(docs, ddl)
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op8_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "repair-ids")
    write_ids(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path(), path)
    return read_ids(spark, path)
