"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; it is named by its smallest member conversation and its
depth, which is unique: two nodes of one depth share no member. Prefixes are told apart by four running
sums of 32-bit hashes of (depth, turn), so they are additive and need no pass over a conversation in one
task: turns are numbered in ranges of (conversation, turn) whose counts are carried over, and sums
are carried over from block to block of ``BLOCK`` turns. ``paths`` holds the node of every conversation
at every depth.

Subtree totals come from a centroid decomposition of the forest of parent edges. A node's weight is the
number of its members, at least 1, so the weight of a subtree is known from one aggregate over the
paths. In a component the nodes whose subtree weighs half of it or more form a path from the top (two
that are no ancestors of each other would weigh more than all of it, with the top); the lowest one is
the centroid. Without it the component falls apart: below every child of the centroid a component of at
most half the weight, and the rest above, whose path nodes lose the centroid's weight. The totals of the
components below, with the centroid's own values, are added to the nodes from the centroid to the top,
and all parts are decomposed alike: a chain of any depth takes as many rounds as its weight has
binary digits. A node finds the child of the centroid that it lies under by looking up its own
conversation's path at the depth below the centroid; no ancestors are walked. Components of at
most ``SMALL`` weight (and so nodes) are finished inside tasks, many in each, by the same recursion.

Conversation ids are whole numbers or strings. Rows without one are left out. Turns are ordered by turn
(null first), then by the MD5 of role and text; null role or text count as empty; equal rows are turns
of their own. Very long texts are hashed where they are read. An empty table has no node. Columns other
than those named play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from prospect.llm.common import col, parallelism, ship, table, written

#: Turns whose prefix sums one window holds at most, weight that one task finishes in memory, bytes of
#: joined ids in one row.
BLOCK = 4096
SMALL = 4096
CHUNK = 1 << 16
#: Components that a round sends to every task at most (a row each); more are joined by shuffle.
BROADCAST_COMPONENTS = 50_000
LANES = ["s0", "s1", "s2", "s3"]


# ---- turns -----------------------------------------------------------------------------------

def numbered_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, i, t, size)``: every turn's number from 1, the digest of role and text, the text's length."""
    spark = df.sparkSession
    text = lambda c: F.coalesce(col(c).cast("string"), F.lit(""))
    role = text(role_col)
    conv = col(conv_col) if isinstance(df.schema[conv_col].dataType, StringType) else col(conv_col).cast("long")
    rows = df.where(col(conv_col).isNotNull()).select(
        conv.alias("conv"), col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text(text_col)))).alias("t"),
        F.length(text(text_col)).cast("long").alias("size"))
    # Equal rows are one row with a count, so that not even a turn repeated without end fills a task.
    rows = rows.groupBy("conv", "turn", "t", "size").agg(F.count(F.lit(1)).alias("m"))
    order = [F.col("turn").asc_nulls_first(), F.col("t")]
    dealt = written(rows.repartitionByRange(parallelism(spark), F.col("conv"), *order)
                    .withColumn("part", F.spark_partition_id()), "trie-turns")
    within = Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Conversations that lie in one range, nearly all, need no carry: the right side is small.
    carry = (dealt.groupBy("conv", "part").agg(F.sum("m").alias("n"))
             .select("conv", "part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before")).where("before > 0"))
    last = (dealt.withColumn("here", F.sum("m").over(within)).join(carry, ["conv", "part"], "left")
            .select("conv", "t", "size", "m", (F.col("here") + F.coalesce("before", F.lit(0))).alias("last")))
    # Numbers of equal rows, in blocks: no array is longer than BLOCK.
    start = F.col("last") - F.col("m") + 1 + F.col("block") * BLOCK
    return (last.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / BLOCK))))
            .select("conv", "t", "size", F.explode(F.sequence(start, F.least(start + (BLOCK - 1), "last"))).alias("i")))


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(steps, convs)`` of conversations as they stand."""
    convs = turns.groupBy("conv").agg(F.max("i").alias("length"))
    return turns.select("conv", F.col("i").alias("depth"), "t", "size"), convs


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """``(steps, convs)`` of conversations rebuilt: the first h turns of the conversation that opens the
    block of ``every`` ids, then the own ones after the first h; h = crc32(id) % ``most``."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    heads = (turns.where((F.pmod("conv", F.lit(every)) == 0) & (F.col("i") < most))
             .groupBy(F.col("conv").alias("head")).agg(F.sort_array(F.collect_list(F.struct("i", "t", "size"))).alias("first")))
    convs = (turns.groupBy("conv").agg(F.max("i").alias("own")).withColumn("h", h)
             .withColumn("head", F.col("conv") - F.col("conv") % every).join(heads, "head", "left")
             .withColumn("first", F.slice(F.coalesce("first", F.array().cast("array<struct<i:long,t:binary,size:long>>")), F.lit(1), F.col("h").cast("int")))
             .withColumn("shared", F.size("first").cast("long")))
    convs = written(convs.select("conv", "h", "first", "shared", (F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
                    "trie-convs")
    shared = convs.select("conv", F.explode("first").alias("x")).select("conv", F.col("x.i").alias("depth"), "x.t", "x.size")
    own = (turns.where(F.col("i") > h).join(convs.select("conv", "h", "shared"), "conv")
           .select("conv", (F.col("i") - F.col("h") + F.col("shared")).alias("depth"), "t", "size"))
    return shared.unionAll(own), convs.select("conv", "length")


# ---- nodes -----------------------------------------------------------------------------------

def _prefixes(steps: DataFrame) -> DataFrame:
    """``steps`` with the running sums of the four lanes."""
    a, b = F.xxhash64("depth", "t"), F.xxhash64(F.lit("prefix"), "depth", "t")
    half = lambda x, by: F.shiftrightunsigned(x, by).bitwiseAND(F.lit(0xFFFFFFFF))
    lanes = [half(a, 0), half(a, 32), half(b, 0), half(b, 32)]
    rows = steps.select("conv", "depth", "size", F.floor(F.col("depth") / BLOCK).alias("block"),
                        *[x.alias(n) for x, n in zip(lanes, LANES, strict=True)])
    within = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(*[F.sum(n).alias(n) for n in LANES])
    carry = blocks.where("block > 0").select("conv").distinct()  # longer conversations only
    carry = blocks.join(carry, "conv", "left_semi").select("conv", "block", *[F.sum(n).over(over).alias(f"c_{n}") for n in LANES])
    return (rows.select("conv", "depth", "size", "block", *[F.sum(n).over(within).alias(n) for n in LANES])
            .join(carry, ["conv", "block"], "left")
            .select("conv", "depth", "size", *[(F.col(n) + F.coalesce(f"c_{n}", F.lit(0))).alias(n) for n in LANES]))


def prefix_trie(steps: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``nodes (conv, depth, parent, n, size, weight)``, ``paths (conv, depth, node, parent)`` and ``ends
    (conv, depth, member)``; ``conv, depth`` name a node, ``parent`` is the name's conversation one step up."""
    top = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.sum(F.col("length") + 1).alias("weight")).where("n > 0")
    top = written(top.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast(top.schema["conv"].dataType).alias("parent"),
                             "n", F.lit(0).cast("long").alias("size"), "weight"), "trie-top")
    found = top.first()
    root = F.lit(found["conv"] if found else None).cast(top.schema["conv"].dataType)
    key = ["depth", *LANES]
    marked = written(_prefixes(steps).join(convs, "conv"), "trie-prefixes")
    known = written(marked.groupBy(*key).agg(F.min("conv").alias("node"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"),
                                             F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "trie-known")
    # Prefixes of one conversation name themselves; the others are looked up (a common first turn is a
    # hot key with a single row on the right, left to the skew-join rule).
    named = written(marked.join(known.where("n > 1").select(*key, "node"), key, "left")
                    .select("conv", "depth", F.coalesce("node", "conv").alias("node"), (F.col("depth") == F.col("length")).alias("last")), "trie-named")
    up = named.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    paths = written(named.join(up, ["conv", "depth"], "left").withColumn("parent", F.coalesce("parent", root)), "trie-paths")
    nodes = (known.select(F.col("node").alias("conv"), "depth", "n", "size", "weight")
             .join(paths.select("conv", "depth", "parent"), ["conv", "depth"]).select(*top.columns))
    ends = paths.where("last").select(F.col("node").alias("conv"), "depth", F.col("conv").alias("member")).unionAll(
        convs.where("length = 0").select(root.alias("conv"), F.lit(0).cast("long").alias("depth"), F.col("conv").alias("member")))
    return written(nodes.unionAll(top), "trie-nodes"), paths, ends


# ---- centroid decomposition ------------------------------------------------------------------

def decompose(parent: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree totals of one component in memory; ``parent`` are places (-1: the top), parents first."""
    totals = [list(v) for v in values]
    todo = [list(range(len(parent)))]
    while todo:
        part = todo.pop()
        if len(part) == 1:
            continue
        inside = dict.fromkeys(part, 1)
        for v in reversed(part):
            up = parent[v]
            if up in inside:
                inside[up] += inside[v]
        centroid = [v for v in part if 2 * inside[v] >= len(part)][-1]
        below: dict[int, list[int]] = {}
        owner: dict[int, int] = {}
        above = []
        for v in part:
            up = parent[v]
            if v == centroid:
                continue
            if up == centroid or up in owner:
                owner[v] = v if up == centroid else owner[up]
                below.setdefault(owner[v], []).append(v)
            else:
                above.append(v)
        sums = [[sum(column[v] for v in some) for column in values] for some in below.values()]  # totals of components
        added = [sum(s) for s in zip(*sums, strict=True)] if sums else [0] * len(values)
        own = [column[centroid] for column in values]
        v = centroid
        while v in inside:  # from the centroid to the top
            for k, a in enumerate(added):
                totals[k][v] += a + (own[k] if v != centroid else 0)
            v = parent[v]
        todo += below.values()
        if above:
            todo.append(above)
    return totals


def _finish(parts: DataFrame, values: list[str]) -> DataFrame:
    """Totals of components that fit in memory: ``(conv, depth, *values)``."""
    ship(parts.sparkSession)
    kind = parts.schema["conv"].dataType.simpleString()
    names = ["conv", "depth", "parent", "top_conv", "top_depth", *values]
    order = ["top_conv", "top_depth", "depth", "conv"]
    dealt = parts.select(*names).repartition(parallelism(parts.sparkSession), "top_conv", "top_depth").sortWithinPartitions(*order)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in names]

        def component(a: int, b: int, out: list[list]) -> None:
            conv, depth = held[0][a:b], held[1][a:b]
            place = {x: i for i, x in enumerate(zip(conv, depth, strict=True))}
            parent = [place.get((p, d - 1), -1) for p, d in zip(held[2][a:b], depth, strict=True)]
            for o, c in zip(out, [conv, depth, *decompose(parent, [h[a:b] for h in held[5:]])], strict=True):
                o += c

        def batch_of(out: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], ["conv", "depth", *values])

        types = [pa.string() if kind == "string" else pa.int64()] + [pa.int64()] * (1 + len(values))
        for batch in batches:
            for h, c in zip(held, batch.columns, strict=True):
                h += c.to_pylist()
            tops = list(zip(held[3], held[4], strict=True))
            edges = [0, *[i for i in range(1, len(tops)) if tops[i] != tops[i - 1]]]  # the last one may go on
            out: list[list] = [[] for _ in types]
            for a, b in zip(edges, edges[1:], strict=False):
                component(a, b, out)
            for h in held:
                del h[:edges[-1]]
            yield batch_of(out)
        if held[0]:
            out = [[] for _ in types]
            component(0, len(held[0]), out)
            yield batch_of(out)

    return dealt.mapInArrow(solve, f"conv {kind}, depth long, " + ", ".join(f"{v} long" for v in values))


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], small: int = SMALL) -> DataFrame:
    """``(conv, depth, *values)``: the sums of ``values`` (longs) over every node's subtree, itself included.

    ``nodes`` has conv, depth, parent (null at the top), weight and ``values``; ``paths`` as by ``prefix_trie``.
    """
    name = ["conv", "depth"]
    tops = nodes.where("parent is null").select(F.col("conv").alias("top_conv"), F.col("depth").alias("top_depth"), F.col("weight").alias("all"))
    one = tops.first()
    if one is None:
        return nodes.select(*name, *values)
    parts = nodes.select(*name, "parent", "weight", *values, F.lit(one["top_conv"]).cast(nodes.schema["conv"].dataType).alias("top_conv"),
                         F.lit(one["top_depth"]).cast("long").alias("top_depth"), F.lit(one["all"]).cast("long").alias("all"))
    top = ["top_conv", "top_depth"]
    # Components of more than ``small`` weight are disjoint, so there are at most all / small of them.
    few = (lambda d: F.broadcast(d)) if one["all"] // small <= BROADCAST_COMPONENTS else (lambda d: d)
    added: list[DataFrame] = []
    done: list[DataFrame] = []
    while True:
        done.append(parts.where(F.col("all") <= small))
        parts = parts.where(F.col("all") > small)
        if parts.isEmpty():
            break
        on_path = 2 * F.col("weight") >= F.col("all")
        centroids = (parts.where(on_path).groupBy(*top).agg(F.min(F.struct("weight", "depth", "conv")).alias("c"))
                     .select(*top, F.col("c.weight").alias("c_weight"), F.col("c.depth").alias("c_depth"), F.col("c.conv").alias("c_conv")))
        step = paths.select(F.col("conv").alias("l_conv"), F.col("depth").alias("l_depth"), F.col("node").alias("child"), F.col("parent").alias("child_parent"))
        seen = (parts.join(few(centroids), top).withColumn("on_path", on_path)
                .withColumn("look", F.when(~F.col("on_path") & (F.col("depth") > F.col("c_depth")), F.col("c_depth") + 1))
                .join(step, (F.col("conv") == F.col("l_conv")) & (F.col("look") == F.col("l_depth")), "left"))
        is_centroid = (F.col("depth") == F.col("c_depth")) & (F.col("conv") == F.col("c_conv"))
        under = F.coalesce(F.col("child_parent") == F.col("c_conv"), F.lit(False))
        split = written(seen.select(
            *name, "parent", *values, *top, "on_path", under.alias("under"), is_centroid.alias("is_centroid"),
            F.when(F.col("on_path") & ~is_centroid, F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
            F.when(under, F.col("child")).otherwise(F.col("top_conv")).alias("new_conv"),
            F.when(under, F.col("look")).otherwise(F.col("top_depth")).alias("new_depth"),
            (F.col("all") - F.col("c_weight")).alias("rest")), "trie-split")
        below = split.where("under").groupBy(*top, "new_conv", "new_depth").agg(
            F.max("weight").alias("all"), *[F.sum(v).alias(v) for v in values])  # component totals
        totals = (below.select(*top, *values).unionAll(split.where("is_centroid").select(*top, *values))
                  .groupBy(*top).agg(*[F.sum(v).alias(f"t_{v}") for v in values]))
        # What the centroid's path gains; its own values are counted at the end.
        added.append(split.where("on_path").join(few(totals), top).select(
            *name, *[(F.col(f"t_{v}") - F.when(F.col("is_centroid"), F.col(v)).otherwise(0)).alias(v) for v in values]))
        done.append(split.where("is_centroid").select(
            *name, "parent", "weight", *values, F.col("conv").alias("top_conv"), F.col("depth").alias("top_depth"), F.lit(1).cast("long").alias("all")))
        parts = written(split.where("not is_centroid").drop(*top).withColumnsRenamed({"new_conv": "top_conv", "new_depth": "top_depth"})
                        .join(below.select(F.col("new_conv").alias("top_conv"), F.col("new_depth").alias("top_depth"), "all"), top, "left")
                        .select(*name, "parent", "weight", *values, *top, F.coalesce("all", "rest").alias("all")), "trie-parts")
    local = done[0]
    for d in done[1:]:
        local = local.unionByName(d)
    out = _finish(local, values)
    for a in added:
        out = out.unionByName(a)
    return out.groupBy(*name).agg(*[F.sum(v).alias(v) for v in values])


# ---- digests of members ----------------------------------------------------------------------

def joined_digests(groups: DataFrame, key: list[str], member: str) -> DataFrame:
    """``(*key, sha256)`` of each group's members in ascending order, as decimals joined by commas.

    Ranges of (key, member) are joined to texts of at most ``CHUNK`` bytes where they lie, so a group of
    any size is written by many tasks; one task then runs the hash over its chunks, one after the other."""
    ship(groups.sparkSession)
    spark = groups.sparkSession
    ddl = ", ".join(f"{k} {groups.schema[k].dataType.simpleString()}" for k in key)
    dealt = (groups.select(*key, F.col(member).alias("member")).repartitionByRange(parallelism(spark), *key, "member")
             .sortWithinPartitions(*key, "member").withColumn("part", F.spark_partition_id()))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, int, int]]:
        """Stretches of equal keys of every batch."""
        for batch in batches:
            keys = list(zip(*[c.to_pylist() for c in batch.columns[:len(key)]], strict=True))
            a = 0
            for b in range(1, len(keys) + 1):
                if b == len(keys) or keys[b] != keys[a]:
                    yield keys[a], batch, a, b
                    a = b

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, step = 0, max(1, CHUNK // 24)
        for i, (k, batch, a, b) in enumerate(runs(batches)):
            part = batch.column("part")[a].as_py()
            texts = list(map(str, batch.column("member").slice(a, b - a).to_pylist()))
            for x in range(0, len(texts), step):
                joined = ",".join(texts[x:x + step])
                rows.append((*k, part, i, x, joined))
                held += len(joined)
                if len(rows) >= 4096 or held >= 64 * CHUNK:
                    yield as_batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield as_batch(rows, schema)

    def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    types = [groups.schema[k].dataType.simpleString() for k in key]
    schema = pa.schema([*[(k, pa.string() if t == "string" else pa.int64()) for k, t in zip(key, types, strict=True)],
                        ("part", pa.int32()), ("run", pa.int64()), ("at", pa.int64()), ("joined", pa.string())])
    texts = dealt.mapInArrow(chunks, f"{ddl}, part int, run long, at long, joined string")
    out_schema = pa.schema([*[schema.field(k) for k in key], ("sha256", pa.string())])
    order = [*key, "part", "run", "at"]
    sorted_texts = texts.repartition(parallelism(spark), *key).sortWithinPartitions(*order)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        done: list[tuple] = []
        for k, batch, a, b in runs(batches):
            if k != now:
                if now is not None:
                    done.append((*now, h.hexdigest()))
                now, h, lead = k, hashlib.sha256(), ""
            for text in batch.column("joined").slice(a, b - a).to_pylist():
                h.update((lead + text).encode())
                lead = ","
            if len(done) >= 4096:
                yield as_batch(done, out_schema)
                done = []
        if now is not None:
            done.append((*now, h.hexdigest()))
        if done:
            yield as_batch(done, out_schema)

    return sorted_texts.mapInArrow(digest, f"{ddl}, sha256 string")


# ---- the operator ----------------------------------------------------------------------------

Steps = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def conversation_trie(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, steps: Steps = as_they_are,
                      small: int = SMALL) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` of every node."""
    turns = written(numbered_turns(df, conv_col, turn_col, role_col, text_col), "trie-numbered")
    nodes, paths, ends = prefix_trie(*steps(turns))
    name = ["conv", "depth"]
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("children"))
    nodes = written(nodes.join(children, name, "left").withColumn("children", F.coalesce("children", F.lit(0)))
                    .withColumn("leaves", (F.col("children") == 0).cast("long"))
                    .withColumn("saved", (F.col("n") - 1) * F.col("size")), "trie-valued")
    totals = rollup(nodes, paths, ["leaves", "saved"], small)
    out = (nodes.drop("leaves", "saved").join(totals, name, "left")
           .join(joined_digests(ends, name, "member"), name, "left"))
    none = hashlib.sha256().hexdigest()
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("sha256", F.lit(none)).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", with_shared_heads)


#: Prefixes as texts of digests; ancestors by cutting them.
ORACLE_SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS t,
         length(coalesce(text, '')) AS size, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, t, size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) AS i FROM t),
crc AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS v FROM own
  UNION ALL
  SELECT c, s, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END
  FROM (SELECT c, s, k, CASE WHEN k % 8 = 0 THEN xor(v, CAST(ascii(substr(s, CAST(k // 8 + 1 AS BIGINT), 1)) AS BIGINT)) ELSE v END AS x
        FROM crc WHERE k < 8 * length(s))),
convs AS (SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % 6 AS h, c - c % 100 AS head FROM crc WHERE k = 8 * length(s)),
shared AS (SELECT convs.c, count(own.i) AS n, any_value(h) AS h FROM convs LEFT JOIN own ON own.c = convs.head AND own.i <= convs.h GROUP BY convs.c),
steps AS (SELECT convs.c, own.i AS depth, t, size FROM convs JOIN own ON own.c = convs.head AND own.i <= convs.h
  UNION ALL SELECT own.c, own.i - shared.h + shared.n, t, size FROM own JOIN shared ON own.c = shared.c AND own.i > shared.h),
prefixes AS (SELECT c, depth, size, string_agg(t, '') OVER (PARTITION BY c ORDER BY depth) AS p FROM steps
  UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (SELECT p, depth, min(c) AS conv, count(*) AS n, max(size) AS size FROM prefixes GROUP BY p, depth),
lengths AS (SELECT c, max(depth) AS depth FROM prefixes GROUP BY c),
ends AS (SELECT p, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM prefixes JOIN lengths USING (c, depth) GROUP BY p),
children AS (SELECT left(p, 32 * (depth - 1)) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
sub AS (SELECT left(nodes.p, 32 * d) AS p, sum(CASE WHEN children.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((nodes.n - 1) * size) AS saved
  FROM nodes LEFT JOIN children ON children.p = nodes.p, range(0, nodes.depth + 1) r(d) GROUP BY 1)
SELECT nodes.conv AS conv_id, CAST(nodes.depth AS BIGINT) AS depth, up.conv AS parent_conv_id, nodes.n AS n_convs, coalesce(children.n, 0) AS n_children,
       CAST(sub.leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM nodes JOIN sub ON sub.p = nodes.p LEFT JOIN children ON children.p = nodes.p LEFT JOIN ends ON ends.p = nodes.p
LEFT JOIN nodes up ON nodes.depth > 0 AND up.p = left(nodes.p, 32 * (nodes.depth - 1))
"""
