"""Embedding near-dedup on a robust-pruned flat graph.

Vectors are compared within their label. Equal vectors are one node with a count. Each label is cut
into clusters of about ``SHARD_ROWS`` nodes around centres fitted on a bounded sample, and every
node is put into its ``OVERLAP`` nearest clusters. Sample rows closer than twice the link angle stand
as one, so a dense group has the centres of one row, however many near copies it holds, and its links
stay inside common clusters. Per cluster a flat proximity graph is built: nodes
are inserted in batches, a greedy beam search from the medoid finds a node's neighbourhood, and robust
pruning keeps those neighbours that no kept one is much closer to; back links are pruned likewise.
A node's adjacency lists from all its clusters are united. Every node is then searched for in each of
its clusters: greedily from the medoid, then outwards over the united lists as long as nodes within
the range (widened by ``SLACK``) turn up. Links are checked in double precision, so none is wrong.

A pair that shares several clusters counts in the first of them only, so links are counted without
being listed; clusters report stars, which are joined into components over all clusters. Recall is
measured by ``audit``: a bounded sample of nodes against all nodes of their labels, in blocks.

Clusters that are larger than ``MOST_ROWS`` (a label may hold a third of all rows, or centres may
not part it) are cut by hash into parts with a graph each, and their nodes are searched in every part.

Vectors that are null, empty, zero, or hold a null or non-finite component, and rows without a
label, link with nothing. Repeated rows are vectors of their own. Null ids come last and never
name a component that has another id. Vectors of different lengths are never linked. An empty
table gives no rows. Columns other than the three named play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, connected_components, ship, table, written

MIN_COSINE = 0.98
SHARD_ROWS = 1000
MOST_ROWS = 4000
OVERLAP = 3
#: Centres a label at most; sample rows a centre for fitting; fitting rounds.
MOST_CENTRES = 4096
SAMPLE_A_CENTRE = 16
FIT_ROUNDS = 5
#: Nodes of a large label that meet its centres in one task.
CHUNK_ROWS = 20_000
DEGREE = 24
BEAM = 40
ALPHA = 1.2
SLACK = 0.02
AUDIT_NODES = 500


# ---- one cluster, in numpy -------------------------------------------------------------------

def _top(ids: np.ndarray, sims: np.ndarray, done: np.ndarray, k: int):
    order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (ids, sims, done))


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> np.ndarray:
    """Greedy search of all ``queries`` at once: ids of the ``beam`` best nodes met (-1: none)."""
    n = len(queries)
    ids = np.full((n, beam), -1, dtype=np.int64)
    sims = np.full((n, beam), -np.inf, dtype=np.float32)
    done = np.ones((n, beam), dtype=bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ x[start], False
    rows = np.arange(n)
    while True:
        open_sims = np.where(done, -np.inf, sims)
        at = open_sims.argmax(axis=1)
        live = np.flatnonzero(open_sims[rows, at] > -np.inf)
        if not len(live):
            return ids
        done[live, at[live]] = True
        near = graph[ids[live, at[live]]]
        fresh = (near >= 0) & ~(near[:, :, None] == ids[live][:, None, :]).any(axis=2)
        value = np.einsum("nrd,nd->nr", x[near], queries[live])
        value = np.where(fresh, value, -np.inf).astype(np.float32)
        a = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        b = np.concatenate([sims[live], value], axis=1)
        c = np.concatenate([done[live], ~fresh], axis=1)
        ids[live], sims[live], done[live] = _top(a, b, c, beam)


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node the closest candidates of which no kept one is ``alpha`` times closer to another."""
    ok = (candidates >= 0) & (candidates != nodes[:, None])
    v = x[candidates]
    dist = np.where(ok, 1 - np.einsum("nkd,nd->nk", v, x[nodes]), np.inf)
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(candidates, order, 1), np.take_along_axis(dist, order, 1)
    v = np.take_along_axis(v, order[:, :, None], 1)
    same = np.zeros_like(dist, dtype=bool)
    between = 1 - np.matmul(v, v.transpose(0, 2, 1))
    alive = np.isfinite(dist) & ~same
    out = np.full((len(nodes), degree), -1, dtype=np.int64)
    rows = np.arange(len(nodes))
    for r in range(degree):
        at = alive.argmax(axis=1)
        some = alive[rows, at]
        if not some.any():
            break
        out[some, r] = cand[rows, at][some]
        gone = alpha * between[rows, at] <= dist
        alive &= ~(gone & some[:, None]) & (cand != cand[rows, at][:, None])
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """``(adjacency (n, degree), medoid)`` of unit vectors; nodes are inserted in doubling batches."""
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax()) if n else 0
    graph = np.full((n, degree), -1, dtype=np.int64)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([medoid], order[order != medoid])) if n else order
    at = 1
    while at < n:
        new = order[at:at + min(max(at, 8), 512)]
        at += len(new)
        found = beam_search(x, graph, medoid, x[new], beam)
        if at <= 2 * beam:  # while small, whatever has been inserted is a candidate
            found = np.concatenate([found, np.broadcast_to(order[:at], (len(new), at))], axis=1)
        graph[new] = robust_prune(x, new, found, degree, alpha)
        a, b = np.repeat(new, degree), graph[new].ravel()
        a, b = a[b >= 0], b[b >= 0]
        by = np.argsort(b, kind="stable")
        a, b = a[by], b[by]
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        many = np.diff(np.append(first, len(b)))
        back = np.full((len(first), int(many.max())), -1, dtype=np.int64)
        back[np.repeat(np.arange(len(first)), many), np.arange(len(b)) - np.repeat(first, many)] = a
        to = b[first]
        lists = np.concatenate([graph[to], back], axis=1)
        lists = np.sort(lists, axis=1)  # a repeat would be kept apart by distance zero only
        lists[:, 1:][lists[:, 1:] == lists[:, :-1]] = -1
        fits = (lists >= 0).sum(axis=1) <= degree
        graph[to[fits]] = -np.sort(-lists[fits], axis=1)[:, :degree]
        for i in range(0, int((~fits).sum()), 256):
            part = np.flatnonzero(~fits)[i:i + 256]
            graph[to[part]] = robust_prune(x, to[part], lists[part], degree, alpha)
    return graph, medoid


def range_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, least: float,
                 slack: float = SLACK, beam: int = BEAM) -> np.ndarray:
    """(queries, nodes) booleans: nodes within ``least`` found from the beam outwards.

    All queries expand together: a step marks, for every query, the neighbours of its frontier. Where
    frontiers hold many nodes, as in a dense group, that is one OR over the edges sorted by their end;
    where they hold few, their edges are listed. Both mark the same nodes, and only nodes that an edge
    reaches are compared.
    """
    n = len(x)
    seen = np.zeros((len(queries), n), dtype=bool)
    near = np.zeros_like(seen)
    found = beam_search(x, graph, start, queries, beam)
    q, v = np.nonzero(found >= 0)
    reached = np.zeros_like(seen)
    reached[q, found[q, v]] = True
    ends = graph.ravel()
    order = np.flatnonzero(ends >= 0)
    order = order[np.argsort(ends[order], kind="stable")]
    sources, ends = order // graph.shape[1], ends[order]
    first = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1]))) if len(ends) else ends
    while reached.any():
        seen |= reached
        q, v = np.nonzero(reached)
        close = np.zeros(len(q), dtype=bool)
        for i in range(0, len(q), 1 << 15):
            part = slice(i, i + (1 << 15))
            close[part] = np.einsum("nd,nd->n", x[v[part]], queries[q[part]]) >= least - slack
        frontier = np.zeros_like(seen)
        frontier[q[close], v[close]] = True
        near |= frontier
        reached = np.zeros_like(seen)
        live = np.flatnonzero(frontier.any(axis=1))
        if not len(live) or not len(ends):
            return near
        q, v = q[close], v[close]
        if len(q) * graph.shape[1] <= len(live) * len(ends) >> 4:  # few nodes: their edges one by one
            a, b = np.repeat(q, graph.shape[1]), graph[v].ravel()
            reached[a[b >= 0], b[b >= 0]] = True
            live = live[:0]
        for i in range(0, len(live), 32):
            some = live[i:i + 32]
            reached[np.ix_(some, ends[first])] = np.logical_or.reduceat(frontier[some][:, sources], first, axis=1)
        reached &= ~seen
    return near


# ---- centres and clusters --------------------------------------------------------------------

def fit_centres(sample: np.ndarray, k: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    centres = sample[:k].copy()
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return centres


def leaders(sample: np.ndarray, least: float, block: int = 512) -> np.ndarray:
    """Rows of ``sample``, in order, that no earlier kept row is as near as ``least`` to."""
    kept, n = np.empty_like(sample), 0
    for i in range(0, len(sample), block):
        b = sample[i:i + block]
        if n:
            b = b[(b @ kept[:n].T).max(axis=1) < least]
        near = b @ b.T >= least
        take = np.zeros(len(b), dtype=bool)
        for j in range(len(b)):
            take[j] = not (near[j, :j] & take[:j]).any()
        b = b[take]
        kept[n:n + len(b)] = b
        n += len(b)
    return kept[:n]


def thinned_centres(sample: np.ndarray, k: int, least: float) -> np.ndarray:
    """Centres of the sample's leaders at twice the link angle, ``k`` less the thinned rows' share."""
    apart = np.cos(min(2 * np.arccos(np.clip(least, -1, 1)), np.pi))
    rows = leaders(sample, apart)
    return fit_centres(rows, max(1, -(-k * len(rows) // len(sample))))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def label_centres(nodes: DataFrame, shard_rows: int, overlap: int, least: float = MIN_COSINE) -> DataFrame:
    """``(label, dim, count, centres)`` of every (label, length) with more nodes than a cluster takes; clusters
    of dense groups are larger than ``shard_rows`` and cut by hash later on.

    A hash threshold from the label's count lets about ``SAMPLE_A_CENTRE`` nodes for each of at most
    ``MOST_CENTRES`` centres through where nodes are read, so a hot label's rows don't meet; each label's
    sample, bounded by that, is fitted in a task of its own. Centres are a table, flattened by rows.
    """
    sizes = nodes.groupBy("label", "dim").count().where(F.col("count") > shard_rows)
    want = sizes.withColumn("k", F.least(F.ceil(F.col("count") * overlap / shard_rows), F.lit(MOST_CENTRES)).cast("int"))
    share = F.col("k") * SAMPLE_A_CENTRE / F.col("count")
    sample = (nodes.join(want, ["label", "dim"])
              .where(F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "node"), 11) < share * F.lit(2.0 ** 53))
              .select("label", "dim", "count", "k", "node", "unit"))
    kind = nodes.schema["label"].dataType.simpleString()

    def fit(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        x = _matrix(t.column("unit"))
        centres = thinned_centres(x, t.column("k")[0].as_py(), least)
        return pa.table({"label": t.column("label").slice(0, 1), "dim": t.column("dim").slice(0, 1), "count": t.column("count").slice(0, 1),
                         "centres": pa.array([centres.ravel()], pa.list_(pa.float64()))})

    return written(sample.groupBy("label", "dim").applyInArrow(fit, f"label {kind}, dim int, count long, centres array<double>"), "graph-centres")


def with_clusters(nodes: DataFrame, centres: DataFrame, overlap: int, chunk: int = CHUNK_ROWS) -> DataFrame:
    """Add ``cells``: sorted numbers of the node's clusters within its label. Nodes of a label that has
    centres meet them in chunks of about ``chunk``; the others have the one cluster 0."""
    group = ["label", "dim"]
    plain = nodes.join(centres.select(*group), group, "left_anti").withColumn("cells", F.array(F.lit(0)))
    chunks = F.ceil(F.col("count") / chunk).cast("int")
    own = nodes.join(centres.select(*group, chunks.alias("chunks")), group).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    sent = centres.select(*group, "centres", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
    names = nodes.columns

    def place(t: pa.Table, c: pa.Table) -> pa.Table:
        if not len(t):
            return t.select(names).append_column("cells", pa.array([], pa.list_(pa.int32())))
        x = _matrix(t.column("unit"))
        by = np.array(c.column("centres")[0].as_py()).reshape(-1, x.shape[1])
        near = np.concatenate([np.argsort(-(x[i:i + 4096] @ by.T), axis=1, kind="stable")[:, :overlap] for i in range(0, len(x), 4096)])
        return t.select(names).append_column("cells", pa.array(np.sort(near, axis=1).tolist(), pa.list_(pa.int32())))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    placed = (own.groupBy(*group, "chunk").cogroup(sent.groupBy(*group, "chunk")).applyInArrow(place, f"{kinds}, cells array<int>"))
    return plain.unionByName(placed)


# ---- the operator ----------------------------------------------------------------------------

def _nodes(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, node) and nodes (node, label, dim, unit, copies, least); unfit rows have node null."""
    rows = df.select(col(id_col).alias("id"), col(label_col).alias("label"), col(vec_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = rows.withColumn("norm", F.when(F.col("label").isNotNull() & ~bad, norm)).withColumn(
        "fit", F.coalesce(F.col("norm") > 0, F.lit(False)))
    rows = written(rows, "graph-rows")
    nodes = (rows.where("fit").groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("norm").alias("norm"))
             .select("label", "v", "copies", "least", F.size("v").alias("dim"),
                     F.transform("v", lambda x: x.cast("double") / F.col("norm")).alias("unit"),
                     F.xxhash64("label", "v").alias("h"))
             .withColumn("node", F.concat_ws(":", F.hex("h"), F.hex(F.xxhash64(F.lit("node"), "v", "label")))))
    return rows, written(nodes, "graph-nodes")


NODE_DDL = "node string, copies long, unit array<double>, cells array<int>, label string, dim int"


def link_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str, least: float = MIN_COSINE,
                 shard_rows: int = SHARD_ROWS, overlap: int = OVERLAP, most_rows: int = MOST_ROWS,
                 degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row."""
    ship(df.sparkSession)
    rows, nodes = _nodes(df, id_col, vec_col, label_col)
    found, stars = _search(nodes, least, shard_rows, overlap, most_rows, degree, beam)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = written(connected_components(stars), "graph-roots")
    classes = (nodes.select("node", "label", "v", "copies", "least").join(links, "node", "left").join(roots, "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    classes = written(classes, "graph-classes")
    ids = classes.groupBy("root").agg(F.min("least").alias("component"))
    classes = classes.join(ids, "root").select(
        F.col("label").alias("nl"), F.col("v").alias("nv"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component")
    key = lambda c: F.when(F.col("fit"), F.col(c))
    out = rows.join(classes, (key("label") == F.col("nl")) & (key("v") == F.col("nv")), "left")
    component = F.when(F.col("fit"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _search(nodes: DataFrame, least: float, shard_rows: int, overlap: int, most_rows: int, degree: int,
            beam: int) -> tuple[DataFrame, DataFrame]:
    """``(node, links)`` parts to be summed, and the edges ``(a, b)`` of stars."""
    centres = label_centres(nodes, shard_rows, overlap, least)
    fields = nodes.select("node", "copies", "unit", "label", "dim")
    placed = written(with_clusters(fields, centres, overlap).withColumn("label", F.col("label").cast("string"))
                     .select("node", "copies", "unit", "cells", "label", "dim"), "graph-placed")
    member = placed.withColumn("cell", F.explode("cells"))
    sizes = member.groupBy("label", "dim", "cell").count().withColumn("parts", F.ceil(F.col("count") / most_rows).cast("int"))
    member = member.join(sizes.drop("count"), ["label", "dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    group = ["label", "dim", "cell", "part"]

    def build(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        graph, _ = build_graph(_matrix(t.column("unit")).astype(np.float32), degree, beam)
        names = np.array(t.column("node").to_pylist(), dtype=object)
        return pa.table({"node": pa.array(names, pa.string()),
                         "near": pa.array([names[g[g >= 0]].tolist() for g in graph], pa.list_(pa.string()))})

    lists = member.groupBy(*group).applyInArrow(build, "node string, near array<string>")
    united = written(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph-lists")
    members = member.join(united, "node")
    # graph rows go to their part, searches to every part of the cluster
    kind = F.when(F.col("to") == F.col("part"), F.lit(0)).otherwise(F.lit(1))
    sent = (members.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("guest", kind).withColumn("near", F.when(F.col("to") == F.col("part"), F.col("near")))
            .drop("part").withColumnRenamed("to", "part"))

    def search(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("guest", "ascending"), ("node", "ascending")])
        names = np.array(t.column("node").to_pylist(), dtype=object)
        unit = _matrix(t.column("unit"))
        own = t.column("guest").to_numpy() == 0
        n, cell = int(own.sum()), key[2].as_py()
        if not n:
            return pa.table({"node": pa.array([], pa.string()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.string())})
        place = {x: i for i, x in enumerate(names[:n])}
        near = [[place[y] for y in x if y in place] for x in t.column("near").to_pylist()[:n]]
        graph = np.full((n, max(1, max(map(len, near)))), -1, dtype=np.int64)
        for i, x in enumerate(near):
            graph[i, :len(x)] = x
        x = unit[:n].astype(np.float32)
        medoid = int((x @ x.mean(axis=0)).argmax())
        copies = t.column("copies").to_numpy()
        cells = t.column("cells").to_pylist()
        first = _cell_table(cells)
        links, root = np.zeros(len(names), np.int64), np.arange(len(names))
        pairs_a, pairs_b = [], []
        for i in range(0, len(names), 256):
            q = slice(i, min(i + 256, len(names)))
            hit = range_search(x, graph, medoid, unit[q].astype(np.float32), least, beam=beam)
            a, b = np.nonzero(hit)
            ok = (a + i != b) & (np.einsum("nd,nd->n", unit[a + i], unit[b]) >= least)
            a, b = a[ok] + i, b[ok]
            mine = _first_shared(first, a, b) == cell
            np.add.at(links, a[mine], copies[b[mine]])
            pairs_a.append(a)
            pairs_b.append(b)
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        while len(a):
            low = root.copy()
            np.minimum.at(low, a, root[b])
            low = low[low]
            if (low == root).all():
                break
            root = low
        keep = (links > 0) | (root != np.arange(len(names)))
        return pa.table({"node": pa.array(names[keep], pa.string()), "links": pa.array(links[keep]),
                         "root": pa.array(names[root[keep]], pa.string())})

    found = written(sent.groupBy(*group).applyInArrow(search, "node string, links long, root string"), "graph-found")
    return found.select("node", "links"), found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def _cell_table(cells: list[list[int]]) -> np.ndarray:
    out = np.full((len(cells), max(map(len, cells))), -1, dtype=np.int64)
    for i, c in enumerate(cells):
        out[i, :len(c)] = c
    return out


def _first_shared(cells: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, y = cells[a], cells[b]
    shared = (x[:, :, None] == y[:, None, :]).any(axis=2) & (x >= 0)
    return np.where(shared, x, np.iinfo(np.int64).max).min(axis=1)


def audit(df: DataFrame, id_col: str, vec_col: str, label_col: str, linked: DataFrame, least: float = MIN_COSINE,
          sample: int = AUDIT_NODES) -> dict[str, float]:
    """Recall of ``linked`` on at most ``sample`` distinct vectors (by hash) against all rows of their
    labels, in blocks: links counted by the graph over links there are. Vectors are sent to every
    task, the rows are not moved."""
    ship(df.sparkSession)
    rows, nodes = _nodes(df, id_col, vec_col, label_col)
    picked = nodes.orderBy("node").limit(sample).select("node", "label", "dim", "unit", "least").collect()
    if not picked:
        return {"links": 0.0, "found": 0.0, "recall": 1.0}
    by: dict[tuple, list[int]] = {}
    for i, r in enumerate(picked):
        by.setdefault((r["label"], r["dim"]), []).append(i)
    vectors = {k: (at, np.array([picked[i]["unit"] for i in at])) for k, at in by.items()}

    def count(batches):
        total = np.zeros(len(picked), np.int64)
        for t in batches:
            labels, dims, copies = (t.column(c).to_pylist() for c in ("label", "dim", "copies"))
            units = t.column("unit").to_pylist()
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(labels, dims, strict=True)):
                if key in vectors:
                    groups.setdefault(key, []).append(i)
            for key, at in groups.items():
                mine, q = vectors[key]
                hit = q @ np.array([units[i] for i in at]).T >= least
                total[mine] += hit @ np.array([copies[i] for i in at])
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(picked)), "n": total})

    there = {r["i"]: r["n"] - 1 for r in nodes.select("label", "dim", "copies", "unit").mapInArrow(count, "i long, n long")
             .groupBy("i").agg(F.sum("n").alias("n")).collect()}
    ids = {r["least"]: i for i, r in enumerate(picked)}
    got = linked.where(col(id_col).isin([k for k in ids if k is not None])).collect()
    links = sum(there[ids[r[id_col]]] for r in got)
    found = sum(r["n_links"] for r in got)
    return {"links": float(links), "found": float(found), "recall": found / links if links else 1.0}


#: Exact links: what the graph finds where its recall is 1, as on tables of a cluster a label.
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = list_count(embedding) AND isfinite(list_sum(embedding))
    AND list_inner_product(embedding, embedding) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT a AS vec_id, (SELECT count(*) FROM l WHERE l.a = reach.a) AS n_links, min(b) AS component_id, a = min(b) AS kept
FROM reach GROUP BY a
"""


def op1_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
