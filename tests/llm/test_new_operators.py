"""Packing, whitening and the conversation trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prospect.llm import packing, prefix_trie, registry, whitening
from prospect.llm.byte_ids import tokenizer_path


# ---- packing ----

def check_plan(counts, size=packing.SIZE, least_cut=packing.LEAST_CUT):
    """Every rest of every rank lies whole in the plan, sequences are gapless; the padding is returned."""
    segments, sequences = packing.plan(counts, size, least_cut)
    filled = defaultdict(list)
    for rest, n in counts.items():
        ranks = sorted((s.first, s.last) for s in segments if s.rest == rest)
        assert n == 0 or ranks[0][0] == 0 and ranks[-1][1] == n - 1
        assert all(a[1] + 1 == b[0] for a, b in zip(ranks, ranks[1:], strict=False))
    for s in segments:
        at = 0
        for start, length, _, _ in s.pieces:
            assert start == at and length > 0
            at += length
        assert at == s.rest
        for rank in range(s.first, s.last + 1):
            for _, length, sequence, offset in s.pieces:
                filled[sequence + rank - s.first].append((offset, length))
    assert set(filled) == set(range(sequences))
    padding = 0
    for got in filled.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at
            at += length
        assert at <= size
        padding += size - at
    return padding, len(filled), sum(len(s.pieces) > 1 for s in segments)


@pytest.mark.parametrize("counts", [{}, {5: 1}, {1023: 7}, {600: 1000}, {600: 3}, {513: 999, 1: 1}, {341: 100}, {400: 10, 700: 10, 300: 10}])
def test_plan_on_odd_histograms(counts):
    padding, sequences, _ = check_plan(counts)
    ids = sum(k * n for k, n in counts.items())
    assert sequences <= -(-ids // 1024) + max(1, 0.04 * ids / 1024)


@pytest.mark.parametrize("seed", range(6))
def test_plan_on_random_histograms(seed):
    rnd = random.Random(seed)
    counts = Counter(min(1023, max(1, int(rnd.lognormvariate(rnd.choice([3, 5, 6.2]), 1)))) for _ in range(3000))
    padding, sequences, _ = check_plan(counts)
    assert padding <= 0.02 * sequences * 1024 + 1024
    check_plan(Counter(rnd.randint(1, 63) for _ in range(500)), 64, 4)


def test_whole_pieces_where_they_fit():
    """Nothing is cut where pieces fit without it."""
    assert check_plan({1000: 50, 24: 50, 512: 100, 256: 200})[0::2] == (0, 0)


def test_plan_takes_large_counts():
    """The work depends on lengths, not on documents."""
    rnd = random.Random(3)
    counts = {k: rnd.randint(1, 10 ** 9) for k in range(1, 1024)}
    segments, sequences = packing.plan(counts)
    assert len(segments) < packing.BROADCAST_SEGMENTS
    ids = sum(k * n for k, n in counts.items())
    assert ids <= sequences * 1024 <= 1.005 * ids


def check_pieces(got, texts, size, end=0):
    """``got``: pieces by document; ``texts``: ids by document."""
    tok = Tokenizer.from_file(tokenizer_path())
    filled = defaultdict(list)
    assert set(got) == set(texts)
    for doc, pieces in got.items():
        ids = tok.encode(texts[doc] or "", add_special_tokens=False).ids + [end]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.n_tokens == len(ids)
            part = np.array(ids[at:at + p.length], "<u4").tobytes()
            assert p.ids == part if hasattr(p, "ids") else p.ids_crc32 == zlib.crc32(part)
            at += p.length
            filled[p.sequence_id].append((p.offset, p.length))
        assert at == len(ids)
    padding = 0
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        padding += size - at
    return padding, len(filled)


def test_packing_against_library(spark, small_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = defaultdict(list)
    for r in registry.QUERIES["op11_shortest_pack"](spark, small_dir).withColumnRenamed("doc_tokens", "n_tokens").collect():
        rows[r.doc_id].append(r)
    padding, sequences = check_pieces(rows, docs, 1024)
    assert padding <= 0.01 * sequences * 1024 + 1024


def test_packing_odd_rows(spark, odd_docs, empty_docs):
    docs = odd_docs.withColumn("key", F.monotonically_increasing_id()).withColumn("rank", F.lit("x")).withColumn("ids", F.lit(1))
    texts = {r.key: r.text for r in docs.collect()}
    for size in (64, 1024):
        pieces = packing.pack_documents(docs, "key", "text", tokenizer_path(), size=size, end_id=7, least_cut=8)
        rows = defaultdict(list)
        for r in pieces.collect():
            rows[r.key].append(r)
        check_pieces(rows, texts, size, end=7)
        whole = packing.sequences(pieces, size, pad_id=9).collect()
        assert all(len(r.ids) == size and r.ids[sum(r.lengths):] == [9] * (size - sum(r.lengths)) for r in whole)
        assert Counter(r.sequence_id for r in whole) == Counter({p.sequence_id for x in rows.values() for p in x})
    assert packing.pack_documents(odd_docs, "doc_id", "text", tokenizer_path()).count() >= odd_docs.count()  # repeated and null ids
    assert packing.pack_documents(empty_docs, "doc_id", "text", tokenizer_path()).count() == 0


def test_packing_one_length(spark):
    """A third of all documents, and more, have one length; every task ranks its own."""
    docs = spark.range(4000).selectExpr("id", "repeat('word ', if(id % 3 = 0, 10, 599)) AS text").repartition(7)
    texts = {r.id: r.text for r in docs.collect()}
    rows = defaultdict(list)
    for r in packing.pack_documents(docs, "id", "text", tokenizer_path()).collect():
        rows[r.id].append(r)
    padding, sequences = check_pieces(rows, texts, 1024)
    assert padding <= 0.02 * sequences * 1024 + 1024


# ---- whitening ----

def plain_whitening(vectors):
    """Exact integers by loops over rows."""
    x = [[int(np.floor(64 * np.float64(c))) + 1000000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3) for j in range(d)] for i in range(d)]
    dev = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    return np.array([[float(c) for c in r] for r in cov]), dev, np.array(x, float) - np.array([float(Fraction(v, n)) for v in s])


def check_whitening(got, vectors, most=32):
    """``got``: rows by id of ``vectors``."""
    ids = list(vectors)
    cov, dev, centred = plain_whitening([vectors[i] for i in ids])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:most], basis[:, ::-1][:, :most]
    by = defaultdict(dict)
    for r in got:
        by[r.id][r.component] = r
    assert set(by) == set(ids)
    k = len(values)
    assert all(sorted(v) == list(range(1, k + 1)) for v in by.values())
    assert [by[i][1].deviation for i in ids] == dev
    w = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in ids])
    assert np.allclose([by[ids[0]][c].explained for c in range(1, k + 1)], values / np.trace(cov), rtol=1e-9)
    want = centred @ basis / np.sqrt(values)
    sign = np.sign((w * want).sum(axis=0))
    apart = np.abs(np.diff(values)) > 1e-6 * values[0]
    alone = np.concatenate(([True], apart)) & np.concatenate((apart, [k < len(cov) or True]))
    assert np.allclose(w[:, alone], (want * sign)[:, alone], atol=1e-6)
    assert np.abs(w.T @ w / len(ids) - np.eye(k)).max() < 1e-6


def test_whitening_query(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows if r.embedding is not None and None not in r.embedding and np.isfinite(r.embedding).all()}
    got = registry.QUERIES["op12_bit_sliced_whitening"](spark, small_dir).withColumnRenamed("vec_id", "id").collect()
    check_whitening(got, vectors)
    assert {r.n for r in got} == {len(vectors)} and len({r.identity_error for r in got}) == 1
    assert 0 <= got[0].identity_error < 1e-4


@pytest.mark.parametrize("rows, dims, spread", [(1, 3, 100), (63, 5, 7), (64, 4, 1), (200, 6, 10 ** 6), (130, 3, 2 ** 50), (5, 2, 0)])
def test_block_sums(rows, dims, spread):
    rnd = random.Random(rows)
    f = np.array([[rnd.randint(-spread, spread) for _ in range(dims)] for _ in range(rows)], np.int64)
    s, c = whitening.block_sums(f)
    x = f.astype(object)
    assert (s == x.sum(axis=0)).all() and (c == x.T @ x).all()


@pytest.mark.parametrize("value", [0, 1, -1, 2 ** 30, -2 ** 30, 2 ** 30 - 1, -5 * 2 ** 70 + 3, 2 ** 120])
def test_limbs(value):
    got = whitening.limbs(value)
    assert sum(x << 30 * i for i, x in enumerate(got)) == value and all(abs(x) < 1 << 31 for x in got)


def test_whitening_odd_rows(spark):
    rnd = np.random.default_rng(1)
    good = {i: rnd.normal(size=5).round(3).tolist() for i in range(40)}
    good[3] = good[4] = good[5]  # repeated rows
    good[6] = [30000.0, -2500.0, 0.1, 0.2, 0.3]  # far out: many bit planes
    rows = [(i, v, "x") for i, v in good.items()]
    rows += [(100, None, "x"), (101, [], "x"), (102, [1.0, None, 1.0, 1.0, 1.0], None), (103, [float("nan")] * 5, "x"),
             (104, [1.0, float("inf"), 1.0, 1.0, 1.0], "x"), (105, [1.0, 2.0], "x"), (None, [0.5] * 5, "x")]
    df = spark.createDataFrame(rows, "`my.id` long, v array<double>, component string").repartition(3)
    m = whitening.fit_whitening(df, "v")
    assert m.n == len(good) + 1
    got = whitening.whiten(df, "my.id", "v", m).withColumnRenamed("my.id", "id").collect()
    check_whitening(got, good | {None: [0.5] * 5})
    assert whitening.identity_error(df, "v", m) < 1e-6
    assert whitening.fit_whitening(df.where("false"), "v") is None
    assert whitening.fit_whitening(spark.createDataFrame([(1, [1.0, 2.0])] * 3, "id long, v array<float>"), "v") is None
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])], "id long, v array<double>")
    got = {r.id: r.deviation for r in whitening.whiten(huge, "id", "v", whitening.fit_whitening(huge, "v")).collect()}
    assert got == {1: None, 2: None, 3: (3 * 320 - 512) ** 2}


# ---- conversation trie ----

def plain_trie(convs):
    """``convs``: id -> list of (role, text). Rows by (conv_id, depth)."""
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in members:
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += own
    return {(min(m), len(p)): (min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                               hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def as_rows(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def table_of(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def test_trie_query(spark, small_dir):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{small_dir}/conversations.parquet").orderBy("conv_id", F.col("turn").asc_nulls_first()).collect():
        convs[r.conv_id].append((r.role or "", r.text or ""))
    assert as_rows(registry.QUERIES["op13_conversation_trie"](spark, small_dir)) == plain_trie(rebuilt(convs))


@pytest.mark.parametrize("small", [1, 40])
@pytest.mark.parametrize("shape", ["random", "copies", "chain", "star"])
def test_trie_shapes(spark, shape, small):
    """Few words make many shared prefixes; hot first turns, a long chain, and one node with many children."""
    rnd = random.Random(7)
    turns = [("user", "a"), ("bot", "bé"), ("user", "ccc"), ("bot", "")]
    if shape == "random":
        convs = {i: rnd.choices(turns, k=rnd.randint(1, 7)) for i in rnd.sample(range(1000), 80)}
    elif shape == "copies":
        convs = {i: turns if i % 3 else turns[:2] + [("user", str(i))] for i in range(90)}
    elif shape == "chain":
        convs = {1: [("user", str(i % 5)) for i in range(150)], 2: [("user", str(i % 5)) for i in range(90)], 300: turns}
    else:
        convs = {i: [("user", "start"), ("bot", str(i))] for i in range(120)}
    got = prefix_trie.conversation_trie(table_of(spark, convs), "conv_id", "turn", "role", "text", small=small)
    assert as_rows(got) == plain_trie(convs)


def test_trie_blocks(spark, monkeypatch):
    """Prefix sums and numbers carried over blocks, repeated rows in blocks, chunks of members."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)
    monkeypatch.setattr(prefix_trie, "CHUNK", 48)
    convs = {i: [("u", str(k % 3)) for k in range(30 + i % 2)] for i in range(25)}
    df = table_of(spark, convs).withColumn("turn", F.lit(None).cast("long"))  # one order: by digest
    order = lambda x: hashlib.md5(f"{len(x[0])}:{x[0]}{x[1]}".encode()).digest()
    want = plain_trie({c: sorted(t, key=order) for c, t in convs.items()})
    assert as_rows(prefix_trie.conversation_trie(df, "conv_id", "turn", "role", "text", small=16)) == want


def test_trie_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 1, "user", "x"),
            (100, 5, "user", "long " * 50_000), (101, 1, "user", ""), (101, 2, None, ""), (-5, 1, "a", "b")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "`my.conv` long, turn int, role string, text string, depth int, conv string")
    convs = {1: [("", ""), ("user", "x")], 2: [("user", "x")] * 2, 100: [("user", "long " * 50_000)], 101: [("user", ""), ("", "")], -5: [("a", "b")]}
    assert as_rows(prefix_trie.conversation_trie(df, "my.conv", "turn", "role", "text")) == plain_trie(convs)
    shared = {c: (convs.get(c - c % 100 if c >= 0 else 0, [])[:zlib.crc32(str(c).encode()) % 6] + t[zlib.crc32(str(c).encode()) % 6:])
              for c, t in convs.items()}
    assert as_rows(prefix_trie.conversation_trie(df, "my.conv", "turn", "role", "text", prefix_trie.with_shared_heads)) == plain_trie(shared)
    assert prefix_trie.conversation_trie(df.where("false"), "my.conv", "turn", "role", "text").count() == 0
    named = df.withColumn("my.conv", F.concat(F.lit("c"), F.col("`my.conv`").cast("string")))
    assert prefix_trie.conversation_trie(named, "my.conv", "turn", "role", "text").count() == len(plain_trie(convs))


def test_decompose():
    rnd = random.Random(2)
    for n in (1, 2, 3, 10, 200):
        for parent in ([-1] + [rnd.randrange(i) for i in range(1, n)], list(range(-1, n - 1)), [-1] + [0] * (n - 1)):
            values = [[rnd.randint(-5, 9) for _ in range(n)] for _ in range(2)]
            want = [list(v) for v in values]
            for w in want:
                for v in range(n - 1, 0, -1):
                    w[parent[v]] += w[v]
            assert prefix_trie.decompose(parent, values) == want
