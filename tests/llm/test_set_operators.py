"""Flat graph, mixing, substring dedup, spot signatures, URL filter and the pipeline."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prospect.llm import anchors, common, flat_graph, mixing, registry, spotsigs, url_filter

WORD = re.compile("[^\x20\x09-\x0D]+")


# ---- connected components ----

@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)],
    [(i, i + 1) for i in range(0, 100, 2)] + [(5, 5), (0, 1)], [(i, (i * 7) % 31) for i in range(31)]])
def test_components(spark, edges):
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    for _ in edges:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node for r in got} == linked and len(got) == len(linked)
    by = defaultdict(set)
    for r in got:
        by[r.root].add(r.node)
    assert sorted(map(sorted, by.values())) == sorted(
        sorted(x for x in linked if root[x] == m) for m in {root[x] for x in linked})


# ---- embeddings ----

def plain_links(rows, least=0.98):
    fit = [(i, np.array(v, float), l) for i, v, l in rows
           if v is not None and l is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    links, root = Counter(), {}
    for i, v, l in fit:
        root[i] = i
    for n, (i, v, l) in enumerate(fit):
        for j, w, m in fit[:n]:
            if l == m and len(v) == len(w) and v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= least:
                links[i] += 1
                links[j] += 1
    for _ in fit:
        changed = False
        for n, (i, v, l) in enumerate(fit):
            for j, w, m in fit[:n]:
                if l == m and len(v) == len(w) and root[i] != root[j] and v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) >= least:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
        if not changed:
            break
    return links, root


def test_flat_graph_against_brute_force(spark, small_dir):
    t = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    got = {r.vec_id: r for r in registry.QUERIES["op1_flat_graph"](spark, small_dir).collect()}
    links, root = plain_links([(r.vec_id, r.embedding, r.label) for r in t.collect()])
    assert {i: r.n_links for i, r in got.items()} == {i: links[i] for i in got}
    assert {i: r.component_id for i, r in got.items()} == root
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    a = flat_graph.audit(t, "vec_id", "embedding", "label", registry.QUERIES["op1_flat_graph"](spark, small_dir))
    assert a["recall"] == 1.0


def test_flat_graph_hot_group_and_small_clusters(spark):
    """A dense group of a third of all rows, copies, and clusters cut into parts."""
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(240, 16))
    x[:80] = x[0] + 0.03 * rnd.normal(size=(80, 16))
    x[200:240] = x[200]
    rows = [(i, [float(y) for y in v], 0 if i < 180 else 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label int")
    links, root = plain_links(rows)
    for shard, most in ((1000, 4000), (1000, 50), (60, 25)):
        got = {r.vec_id: r for r in flat_graph.link_vectors(df, "vec_id", "v", "label", shard_rows=shard, most_rows=most).collect()}
        found = sum(r.n_links for r in got.values())
        assert all(r.n_links <= links[i] for i, r in got.items())
        assert found >= 0.98 * sum(links.values())
        assert {i: r.component_id for i, r in got.items()} == root


def near_copies(n, group, noise=0.01, dims=64):
    """``n`` unit vectors, the first ``group`` of them distinct near copies (cosine about 0.99)."""
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(n, dims))
    x[0] /= np.linalg.norm(x[0])
    x[:group] = x[0] + noise * rnd.normal(size=(group, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_flat_graph_large_group_keeps_common_clusters(spark):
    """10,000 distinct near copies among 30,000 vectors of a label: linked nodes share a cluster."""
    x = near_copies(30_000, 10_000)
    nodes = spark.createDataFrame([(f"{i * 2654435761 % 2**32:08x}:{i}", "a", 64, v.tolist()) for i, v in enumerate(x)],
                                  "node string, label string, dim int, unit array<double>")
    centres = flat_graph.label_centres(nodes, flat_graph.SHARD_ROWS, flat_graph.OVERLAP)
    cells = {int(r.node.split(":")[1]): set(r.cells) for r in
             flat_graph.with_clusters(nodes, centres, flat_graph.OVERLAP).select("node", "cells").collect()}
    a, b = np.random.default_rng(2).choice(10_000, (2, 20_000))
    linked = [(i, j) for i, j in zip(a, b) if i != j and x[i] @ x[j] >= 0.98]
    assert len(linked) > 10_000
    assert sum(bool(cells[i] & cells[j]) for i, j in linked) >= 0.999 * len(linked)
    assert len(centres.first()["centres"]) / 64 > 20  # the other vectors are still parted


def test_flat_graph_audit_over_many_clusters(spark):
    """A label of many clusters with groups of four near copies and a dense group: recall by the audit."""
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(6000, 32))
    x[1:5200:4], x[2:5200:4], x[3:5200:4] = (x[0:5200:4] + 0.05 * rnd.normal(size=(1300, 32)) for _ in range(3))
    x[5400:6000] = x[5400] + 0.04 * rnd.normal(size=(600, 32))
    df = spark.createDataFrame([(i, v.tolist(), "a" if i % 50 else "b") for i, v in enumerate(x)], "vec_id long, v array<double>, label string")
    got = flat_graph.link_vectors(df, "vec_id", "v", "label", shard_rows=200)
    a = flat_graph.audit(df, "vec_id", "v", "label", got, sample=1000)
    assert a["links"] > 20_000 and 0.995 <= a["recall"] <= 1.0


@pytest.mark.parametrize("n, dense", [(1, 0), (2, 2), (300, 0), (300, 250)])
def test_range_search_follows_edges(n, dense):
    """What the search marks is what a plain walk over the edges from the beam finds."""
    rnd = np.random.default_rng(n + dense)
    x = rnd.normal(size=(n, 8))
    x[:dense] = x[0] + 0.02 * rnd.normal(size=(dense, 8))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph, medoid = flat_graph.build_graph(x)
    queries = x[::7]
    got = flat_graph.range_search(x, graph, medoid, queries, 0.98)
    for i, q in enumerate(queries):
        open_nodes = [v for v in flat_graph.beam_search(x, graph, medoid, q[None], flat_graph.BEAM)[0] if v >= 0]
        seen, near = set(), set()
        while open_nodes:
            v = open_nodes.pop()
            if v in seen:
                continue
            seen.add(v)
            if float(np.einsum("d,d->", x[v], q)) >= 0.98 - flat_graph.SLACK:
                near.add(v)
                open_nodes += [w for w in graph[v] if w >= 0]
        assert {int(v) for v in near} == set(np.flatnonzero(got[i]).tolist())


def test_flat_graph_dense_group_over_many_clusters(spark):
    """Links of a dense group cut into parts, in a label of many clusters."""
    x = near_copies(2400, 800)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, v array<double>, label int")
    links = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert (links[:800] > 700).all() and not links[800:].any()
    got = {r.vec_id: r for r in flat_graph.link_vectors(df, "vec_id", "v", "label", shard_rows=60, most_rows=240).collect()}
    assert all(r.n_links <= links[i] for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.999 * links.sum()
    assert all(r.component_id == (0 if i < 800 else i) for i, r in got.items())


def test_flat_graph_odd_rows(spark):
    one = [1.0, 0.0]
    rows = [(1, one, 0), (2, [2.0, 0.0], 0), (3, one, None), (4, None, 0), (5, [0.0, 0.0], 0), (6, [float("nan"), 1.0], 0),
            (7, [None, 1.0], 0), (8, [1.0, 0.0, 0.0], 0), (9, one, 1), (None, one, 0), (10, [], 0), (1, one, 0), (11, [float("inf"), 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label int").withColumn("node", F.lit("x")).withColumn("cells", F.lit(1))
    got = defaultdict(list)
    for r in flat_graph.link_vectors(df, "vec_id", "v", "label").collect():
        got[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] * 2 and got[2] == [(3, 1, False)] and got[None] == [(3, 1, False)]
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert got[i] == [(0, i, True)]
    assert flat_graph.link_vectors(df.where("false"), "vec_id", "v", "label").count() == 0


# ---- mixing ----

def test_mix_targets(spark, small_dir):
    d = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = d.select("source", mixing.n_tokens(F.col("text")).alias("tokens"))
    w = {r.source: r for r in mixing.source_weights(rows).collect()}
    own = -sum(r.p * math.log(r.p) for r in w.values())
    aim = own + mixing.TOWARDS_EQUAL * (math.log(len(w)) - own)
    got = -sum(r.weight * math.log(r.weight) for r in w.values())
    assert abs(got - aim) < 1e-6 or max(r.target / r.n for r in w.values()) <= mixing.MOST_COPIES + 1e-6
    taken = Counter()
    biggest = rows.agg(F.max("tokens")).first()[0]
    for r in registry.QUERIES["op4_temperature_mix"](spark, small_dir).collect():
        taken[r.source] += r.tokens * r.copies
    for s, r in w.items():
        assert r.target - biggest <= taken[s] <= r.target


def test_mix_copies_limit(spark):
    rows = [(i, "w " * 50, "big") for i in range(2000)] + [(9000 + i, "w " * 50, "small") for i in range(4)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(d, "doc_id", "text", "source", towards_equal=1.0, most_copies=3.0, block_tokens=500).collect()
    assert max(r.copies for r in out if r.source == "small") == 3
    assert sum(r.copies for r in out if r.source == "small") in (11, 12)
    free = mixing.mix(d, "doc_id", "text", "source", towards_equal=1.0, most_copies=None, block_tokens=500).collect()
    by = Counter()
    for r in free:
        by[r.source] += r.tokens * r.copies
    assert abs(by["small"] - by["big"]) <= 2 * 51
    half = mixing.mix(d, "doc_id", "text", "source", towards_equal=0.0, most_copies=None, budget=51 * 1002, block_tokens=500).collect()
    assert abs(sum(r.copies for r in half) - 1002) <= 2


def test_mix_odd_rows(spark, odd_docs, empty_docs):
    out = mixing.mixing_stage(spark, odd_docs, "")
    assert out.columns == odd_docs.columns
    assert mixing.mixing_stage(spark, empty_docs, "").count() == 0
    all_kept = mixing.mix(odd_docs, "doc_id", "text", "source", towards_equal=0.0)
    assert all_kept.agg(F.sum("copies")).first()[0] == odd_docs.count()


# ---- substring dedup ----

def plain_removed(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def test_anchors_against_brute_force(spark, small_dir):
    d = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in registry.QUERIES["op5_anchor_dedup"](spark, small_dir).collect()}
    assert got == dict(zip([r.doc_id for r in d], plain_removed([r.text for r in d], 35)))
    assert sum(n for _, n, _ in got.values()) > 0


def test_anchors_planted(spark):
    """Exact lengths around a window, overlaps, repeats inside one text, and a very common passage."""
    p = [f"p{i}" for i in range(80)]
    texts = [" ".join(x) for x in (
        ["a", *p[:35], "b"], ["c", *p[:35]], ["d", *p[40:74]], [*p[40:74], "e"], ["f", *p[30:70], "g"],
        ["same"] * 36, ["twice"] * 35, p[:34], [])] + [None, "  \n "]
    texts += [" ".join([f"u{i}", *[f"hot{j}" for j in range(40)], f"v{i}"]) for i in range(150)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    for size in (200, 1 << 20):
        out = anchors.substring_dedup(d, "doc_id", "text", batch_bytes=size, with_text=True).collect()
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out}
        assert got == dict(enumerate(plain_removed(texts, 35)))
    assert {r.doc_id: r.kept for r in out}[0] == "a b"


def test_anchors_odd_rows(spark, odd_docs, empty_docs):
    out = anchors.substring_dedup(odd_docs, "doc_id", "text").collect()
    want = Counter(plain_removed([r.text for r in odd_docs.collect()], 35))
    assert Counter((r.n_words, r.n_removed, r.kept_sha256) for r in out) == want
    assert anchors.substring_dedup(empty_docs, "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        anchors.substring_dedup(odd_docs, "doc_id", "text", window=34)


# ---- spot signatures ----

def test_spots_neighbours(spark, small_dir):
    d = sorted(spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in registry.QUERIES["op7_spot_signatures"](spark, small_dir).collect()}
    assert len(got) == len(d)
    for i, r in enumerate(d):
        after, k = d[(i + 1) % len(d)].text, len(r.text) // 4
        new = r.text[:len(r.text) - k] + after[:k]
        a, b, c = map(spotsigs.signatures, (r.text, new, after))
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(r.text), hashlib.sha256(new.encode()).hexdigest())
        assert (g.near_edited, g.near_next) == (spotsigs.jaccard(a, b), spotsigs.jaccard(a, c))
        assert (g.fingerprint, g.edited_fingerprint) == (spotsigs.fingerprint(a), spotsigs.fingerprint(b))
    assert sum(g.near_edited for g in got.values()) > 0.4 * len(got) > 2 * sum(g.near_next for g in got.values())


def test_pruned_jaccard():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        a, b = (frozenset(rnd.integers(0, 30, rnd.integers(0, 25)).tolist()) for _ in range(2))
        exact = len(a & b) / len(a | b) if a | b else 1.0
        assert spotsigs.jaccard(a, b) == exact
        for t in (0.2, 0.5, 0.8):
            assert spotsigs.jaccard(a, b, t) == (exact if exact >= t else 0.0)


def test_near_sets(spark):
    rnd = np.random.default_rng(2)
    base = ["the w{} x{} y{}".format(*rnd.integers(0, 50, 3)) for _ in range(40)]
    texts = []
    for _ in range(60):
        t = list(base)
        for _ in range(rnd.integers(0, 9)):
            t[rnd.integers(0, 40)] = "the z{} q{} r{}".format(*rnd.integers(0, 50, 3))
        texts.append(" ".join(t))
    texts += texts[:5] + [None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members, pairs = spotsigs.near_sets(d, "doc_id", "text", 0.8)
    of = {r.doc_id: r.set_id for r in members.collect()}
    sets = {of[i]: spotsigs.signatures(t) for i, t in enumerate(texts)}
    ids = [s for s in sets if sets[s]]
    want = {frozenset((a, b)) for n, a in enumerate(ids) for b in ids[:n] if spotsigs.jaccard(sets[a], sets[b]) >= 0.8}
    got = [frozenset((r.a, r.b)) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_spots_odd_rows(spark, odd_docs, empty_docs):
    out = spotsigs.neighbour_likeness(odd_docs, "doc_id", "text").collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    assert by[2].near_next == 1.0 and by[5].near_next == 1.0 and by[2].n_chars == 0
    assert spotsigs.neighbour_likeness(empty_docs, "doc_id", "text").count() == 0
    clashing = odd_docs.withColumn("s", F.lit(1)).withColumn("set_id", F.lit(2)).withColumn("n", F.lit(3)).withColumn("band", F.lit(4))
    members, pairs = spotsigs.near_sets(clashing, "doc_id", "text")
    assert members.columns == ["doc_id", "set_id"] and members.count() == odd_docs.count() and pairs.count() == 0
    assert [x.count() for x in spotsigs.near_sets(empty_docs, "doc_id", "text")] == [0, 0]
    one = odd_docs.where("doc_id = 8")
    assert spotsigs.neighbour_likeness(one, "doc_id", "text").first().near_next == 1.0


# ---- urls ----

@pytest.mark.parametrize("url, host, path, rule", [
    ("http://Foo.COM/en/x?y", "foo.com", "/en/x", "com/"), ("https://a.example.com/en/1#t", "a.example.com", "/en/1", "example.com/en/"),
    ("https://a.www.example.com/en/1", "a.www.example.com", "/en/1", "www.example.com/en/"), ("http://xexample.com/en/", "xexample.com", "/en/", "com/"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/"), ("http://a.net/en", "a.net", "/en", None), ("http://b.com", "b.com", "", None),
    ("http://b.com?x/y", "b.com", "", None), ("no scheme.com/", "", "", None), (None, "", "", None), ("", "", "", None),
    ("x://y://com/", "y:", "//com/", None), ("://com/", "com", "/", "com/")])
def test_url_rules(spark, url, host, path, rule):
    h, p = url_filter.host_and_path(F.col("url"))
    d = spark.createDataFrame([(url,)], "url string").select(h.alias("h"), p.alias("p"))
    r = d.select("h", "p", url_filter.rule_for(F.col("h"), F.col("p"))[0].alias("r")).first()
    assert (r.h, r.p, r.r) == (host, path, rule)


def plain_ratio(train, text):
    k0, lam, floor = url_filter.ORDER, url_filter.WEIGHT, url_filter.FLOOR
    counts = [defaultdict(Counter) for _ in range(2)]
    for s, v in train:
        p = "\x01" * k0 + s + "\x02"
        for i in range(k0, len(p)):
            for k in range(k0 + 1):
                counts[v == "block"][p[i - k:i]][p[i]] += 1
    p, total = "\x01" * k0 + text + "\x02", 0.0
    for i in range(k0, len(p)):
        pr = []
        for c in counts:
            q = 1 / floor
            for k in range(k0 + 1):
                seen = c[p[i - k:i]]
                q = (seen[p[i]] + lam * q) / (sum(seen.values()) + lam)
            pr.append(math.log(q))
        total += pr[0] - pr[1]
    return total / (len(text) + 1)


def test_url_scores_against_plain_model(spark):
    rows = [(f"shop{i}.example/cat/{i}", "allow") for i in range(40)] + [(f"casino{i}.bad/win?{i}", "block") for i in range(30)]
    rows += [("shop77.example/cat", None), ("casino.bad/win", None), ("zz", None)]
    urls = spark.createDataFrame(rows, "s string, verdict string")
    fold = {r.s: r.f for r in urls.select("s", url_filter.kept_out(F.col("s")).alias("f")).collect()}
    scores, threshold = url_filter.url_scores(urls)
    got = {r.s: r.score for r in scores.collect()}
    train = [(s, v) for s, v in rows if v and not fold[s]]
    assert set(got) == {s for s, v in rows if v is None}
    for s, x in got.items():
        assert abs(x - plain_ratio(train, s)) < 1e-9
    assert got["shop77.example/cat"] > threshold > got["casino.bad/win"]


def test_url_query(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    got = registry.QUERIES["op9_url_filter"](spark, small_dir).collect()
    assert len(got) == pages.count()
    for r in got:
        assert r.verdict in ("allow", "block")
        assert r.rule is None or r.verdict == {h + p: v for v, h, p in url_filter.RULES}[r.rule]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "http://a.com/")], "page_id long, url string").withColumn("s", F.lit(1))
    assert Counter((r.page_id, r.verdict) for r in url_filter.filter_urls(odd, "page_id", "url").collect()) == Counter(
        {(1, "allow"): 1, (2, "allow"): 1, (3, "allow"): 2, (None, "allow"): 1})
    assert url_filter.filter_urls(odd.where("false"), "page_id", "url").count() == 0


# ---- pipeline ----

def test_pipeline(spark, small_dir, odd_docs, empty_docs):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    n = docs.count()
    out = corpus_pipeline.run(spark, small_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() <= 4 * n
    for d in (odd_docs, empty_docs):
        cur = d
        for name, f in corpus_pipeline.STAGES:
            cur = common.written(f(spark, cur, small_dir), f"test-{name}")
            if name != "tokens":
                assert cur.columns == d.columns
    assert cur.count() == 0
