"""Packing of documents into fixed-length training sequences, shortest pack first over the length histogram.

Every document is tokenised and an end id follows it. Runs of ``size`` ids are sequences of their own;
what is left of a document (1 to ``size`` - 1 ids) is known to the packing by its length only. From
the histogram of these lengths, the longest first, all pieces of one length are placed at once: into the
packs with the most room (the shortest packs) that take them, otherwise into new ones. A pattern is
the lengths in a pack and stands with a count, so the work depends on the number of lengths, not of
documents. Packs that stay open with ``LEAST_CUT`` places or more are then levelled: as many of the
emptiest as the others have room for are taken apart, and their pieces, cut where needed, fill the
rest. So an unlucky histogram (say, one length of 600 only) costs cuts and not padding.

Patterns name pieces by rank: the k-th document with a length belongs to the pattern whose range holds
k. Ranks are counted where documents are tokenised, task by task, and made global by offsets from a
table of one row per task and length, so a length that a third of all documents share is ranked by all
tasks. Nothing but the histogram (``size`` - 1 rows at most) reaches the driver.

Null texts count as empty and have the end id alone. Rows that repeat an id are documents of their own,
null ids too. Very long texts become sequences of their own and a rest, and are held whole by one task.
An empty table gives no pieces. Columns other than the two named play no part, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prospect.llm.byte_ids import byte_ids, tokenizer_path
from prospect.llm.common import col, ship, table, written

SIZE = 1024
END_ID = 0
#: Ids that a cut piece has at least; packs with less room than this are closed.
LEAST_CUT = 8
#: Segments of the plan that are sent to every task at most; a longer plan is joined by shuffle.
BROADCAST_SEGMENTS = 100_000


# ---- the histogram, on the driver ------------------------------------------------------------

class Piece(NamedTuple):
    """``length`` ids from ``start`` of the rests of ``rest`` ids, from rank ``rank`` on."""
    rest: int
    rank: int
    start: int
    length: int


class Packs(NamedTuple):
    """``count`` packs alike: the i-th holds the i-th document of every piece, in order."""
    count: int
    room: int
    pieces: tuple[Piece, ...]


def _shift(pieces: tuple[Piece, ...], by: int) -> tuple[Piece, ...]:
    return tuple(p._replace(rank=p.rank + by) for p in pieces) if by else pieces


class Histogram:
    """Packs by room, and the placing of pieces of one length at a time."""

    def __init__(self, size: int, least_cut: int):
        self.size, self.least_cut = size, least_cut
        self.by_room: dict[int, list[Packs]] = defaultdict(list)
        self.rooms: list[int] = []  # heap of negative rooms, some of them stale

    def add(self, packs: Packs) -> None:
        if packs.count:
            if not self.by_room[packs.room]:
                heapq.heappush(self.rooms, -packs.room)
            self.by_room[packs.room].append(packs)

    def shortest(self) -> int:
        """The room of the shortest packs; 0 if there are none."""
        while self.rooms and not self.by_room[-self.rooms[0]]:
            heapq.heappop(self.rooms)
        return -self.rooms[0] if self.rooms else 0

    def put(self, room: int, piece: Piece, n: int) -> int:
        """Put the first ``n`` of ``piece``, or as many as there are packs, into packs of ``room``."""
        packs = self.by_room[room].pop()
        k = min(n, packs.count)
        self.add(Packs(packs.count - k, room, _shift(packs.pieces, k)))
        self.add(Packs(k, room - piece.length, (*packs.pieces, piece)))
        return k

    def place(self, piece: Piece, n: int, cut: bool) -> list[tuple[Piece, int]]:
        """Place ``n`` documents' pieces; returned are the remainders of those that were cut."""
        left = []
        while n:
            room = self.shortest()
            if room >= piece.length:
                k = self.put(room, piece, n)
            elif cut and min(room, piece.length - self.least_cut) >= self.least_cut:
                here = min(room, piece.length - self.least_cut)
                k = self.put(room, piece._replace(length=here), n)
                left.append((piece._replace(start=piece.start + here, length=piece.length - here), k))
            else:
                k = self.open(piece, n, cut, left)
            piece, n = piece._replace(rank=piece.rank + k), n - k
        return left

    def open(self, piece: Piece, n: int, cut: bool, left: list) -> int:
        """New packs for pieces of one length: full ones for as many as fill such, else a single pack."""
        q, rest = divmod(self.size, piece.length)
        cut = cut and min(rest, piece.length - rest) >= self.least_cut
        each = q + cut
        if n < each:
            self.add(Packs(1, self.size - min(n, q) * piece.length, tuple(piece._replace(rank=piece.rank + i) for i in range(min(n, q)))))
            return min(n, q)
        packs = n // each
        inside = [piece._replace(rank=piece.rank + i * packs) for i in range(each)]
        if cut:
            last = inside[q]
            inside[q] = last._replace(length=rest)
            left.append((last._replace(start=last.start + rest, length=last.length - rest), packs))
        self.add(Packs(packs, 0 if cut else rest, tuple(inside)))
        return packs * each

    def fill(self, supply: dict[int, list[tuple[Piece, int]]], cut: bool) -> None:
        for length in range(max(supply, default=0), 0, -1):
            for piece, n in supply.pop(length, []):
                for p, k in self.place(piece, n, cut):
                    supply[p.length].append((p, k))

    def level(self) -> None:
        """Take the emptiest open packs apart to fill the others."""
        loose = [self.by_room.pop(r) for r in sorted(self.by_room, reverse=True) if r >= self.least_cut]
        loose = [x for some in loose for x in some]
        packs = sum(x.count for x in loose)
        needed = -(-sum(x.count * (self.size - x.room) for x in loose) // self.size)
        supply: dict[int, list[tuple[Piece, int]]] = defaultdict(list)
        spare = packs - needed
        self.rooms = [-r for r in self.by_room]
        heapq.heapify(self.rooms)
        for x in loose:  # most room first
            k = min(spare, x.count)
            spare -= k
            for p in x.pieces if k else ():
                supply[p.length].append((p, k))
            self.add(Packs(x.count - k, x.room, _shift(x.pieces, k)))
        self.fill(supply, cut=True)

    def packs(self) -> list[Packs]:
        return [x for r in sorted(self.by_room) for x in self.by_room[r]]


class Segment(NamedTuple):
    """Rests of ``rest`` ids with ranks ``first`` to ``last``: ``(start, length, sequence, offset)`` of
    their pieces, the sequence being that of ``first`` and rising with the rank."""
    rest: int
    first: int
    last: int
    pieces: list[tuple[int, int, int, int]]


def plan(counts: dict[int, int], size: int = SIZE, least_cut: int = LEAST_CUT) -> tuple[list[Segment], int]:
    """Segments for all ranks of all rests, and the number of sequences (0 to that less 1)."""
    h = Histogram(size, least_cut)
    h.fill(defaultdict(list, {rest: [(Piece(rest, 0, 0, rest), n)] for rest, n in counts.items() if n}), cut=False)
    h.level()
    slots: dict[int, list[tuple[int, int, tuple[int, int, int, int]]]] = defaultdict(list)
    sequences = 0
    for x in h.packs():
        offset = 0
        for p in x.pieces:
            slots[p.rest].append((p.rank, p.rank + x.count, (p.start, p.length, sequences, offset)))
            offset += p.length
        sequences += x.count
    out = []
    for rest, got in slots.items():
        edges = sorted({e for a, b, _ in got for e in (a, b)})
        inside = {a: [] for a in edges}
        at = {e: i for i, e in enumerate(edges)}
        for a, b, (start, length, sequence, offset) in got:
            for e in edges[at[a]:at[b]]:
                inside[e].append((start, length, sequence + e - a, offset))
        out += [Segment(rest, a, b - 1, sorted(inside[a])) for a, b in zip(edges, edges[1:], strict=False)]
    return out, sequences


# ---- the operator ----------------------------------------------------------------------------

def _tokenised(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """``id, part, full, rank, n, ids``: the ids of every document, its task, and within the task the
    full sequences before it and its rank among rests of its length."""
    ship(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = byte_ids(tokenizer), TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        full, seen = 0, np.zeros(size, np.int64)
        for batch in batches:
            ids = enc.encode(batch.column("text"), end)
            n = np.array([len(x) // 4 for x in ids], np.int64)
            fulls, rests = n // size, n % size
            rank = np.empty(len(n), np.int64)
            for i, r in enumerate(rests.tolist()):
                rank[i] = seen[r]
                seen[r] += 1
            before = full + np.cumsum(fulls) - fulls
            full += int(fulls.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.full(len(n), part, np.int32)), pa.array(before), pa.array(rank), pa.array(n),
                 pa.array(ids, pa.binary())], ["id", "part", "full", "rank", "n", "ids"])

    return rows.mapInArrow(encode, f"id {id_type}, part int, full long, rank long, n long, ids binary")


def pack_documents(df: DataFrame, id_col: str, text_col: str, tokenizer: str, size: int = SIZE, end_id: int = END_ID,
                   least_cut: int = LEAST_CUT) -> DataFrame:
    """``(id_col, start, length, n_tokens, sequence_id, offset, ids)``, a row a piece; ``ids`` are
    little-endian uint32 bytes. Tokenised documents are written once to the shared folder."""
    spark = df.sparkSession
    docs = written(_tokenised(df, id_col, text_col, tokenizer, end_id, size), "packing-ids")
    rest = F.pmod("n", F.lit(size)).cast("int")
    counts = written(docs.select("part", rest.alias("rest"), "n").groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.floor(F.col("n") / size)).alias("fulls")), "packing-counts")
    histogram = {r["rest"]: r["docs"] for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("docs").alias("docs")).collect()}
    segments, packed = plan(histogram, size, least_cut)

    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a task: a window over all of them is bounded by the number of input splits.
    parts = counts.groupBy("part").agg(F.sum("fulls").alias("fulls")).select(
        "part", F.coalesce(F.sum("fulls").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("fulls_before"))
    offsets = counts.select("part", "rest", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("ranks_before")).join(parts, "part")
    seg = spark.createDataFrame(segments, "rest int, first long, last long, pieces array<struct<start:int,length:int,sequence:long,at:int>>")
    if len(segments) <= BROADCAST_SEGMENTS:
        seg = F.broadcast(seg)
    placed = (docs.withColumn("rest", rest).join(offsets, ["part", "rest"])
              .withColumn("rank", F.col("rank") + F.col("ranks_before")).withColumnRenamed("rest", "own")
              .join(seg, (F.col("own") == F.col("rest")) & F.col("rank").between(F.col("first"), F.col("last")), "left"))

    def piece(start, length, sequence, at):
        return F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), sequence.cast("long").alias("sequence_id"),
                        at.cast("long").alias("offset"),
                        F.substring(F.col("ids"), (4 * start + 1).cast("int"), (4 * length).cast("int")).alias("ids"))

    fulls = (F.col("n") / size).cast("long")
    first = F.col("fulls_before") + F.col("full") + F.lit(packed)
    runs = F.when(fulls > 0, F.transform(F.sequence(F.lit(0), F.greatest(fulls - 1, F.lit(0))), lambda i: piece(i * size, F.lit(size), first + i, F.lit(0))))
    rests = F.transform("pieces", lambda p: piece(fulls * size + p["start"], p["length"], p["sequence"] + F.col("rank") - F.col("first"), p["at"]))
    none = F.array().cast("array<struct<start:long,length:long,sequence_id:long,offset:long,ids:binary>>")
    out = placed.select(F.col("id"), F.col("n").alias("n_tokens"),
                        F.explode(F.concat(F.coalesce(runs, none), F.coalesce(rests, none))).alias("p"))
    return out.select(F.col("id").alias(id_col), "p.start", "p.length", "n_tokens", "p.sequence_id", "p.offset", "p.ids")


def sequences(pieces: DataFrame, size: int = SIZE, pad_id: int = END_ID) -> DataFrame:
    """``(sequence_id, ids array<int>, lengths array<int>)``: whole sequences of ``pack_documents``, padded
    to ``size``, and the lengths of their pieces (the attention blocks). A sequence has at most ``size`` ids."""
    ship(pieces.sparkSession)

    @F.arrow_udf("array<int>")
    def padded(parts: pa.Array) -> pa.Array:
        out = np.full((len(parts), size), pad_id, np.int32)
        for i, x in enumerate(parts):
            ids = np.frombuffer(b"".join(p["ids"] for p in x.as_py()), "<u4")
            out[i, :len(ids)] = ids
        return pa.ListArray.from_arrays(np.arange(0, out.size + 1, size, dtype=np.int32), out.ravel())

    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return held.select("sequence_id", padded("p").alias("ids"), F.col("p.length").cast("array<int>").alias("lengths"))


def op11_shortest_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("n_tokens").alias("doc_tokens"),
                      "sequence_id", "offset")
