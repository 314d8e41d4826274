"""Every stage of the pipeline against a plain version, on planted documents and on the small table."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from prospect.llm import common, langid, mixing, secret_scan, sentencepiece_codec
from test_text_operators import plain_base, plain_components, plain_fingerprint


def plain_language(rows, dictionaries):
    """``(language, rejected)`` of each row by a loop over all dictionaries and pieces."""
    out = {}
    packs = {lang: zstandard.ZstdCompressor(level=langid.LEVEL, write_content_size=False, write_dict_id=False,
                                            dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
             for lang, d in dictionaries.items()}
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            out[r] = ("und", True)
            continue
        data = " ".join(re.sub("[\x00-@\\[-`{-\x7f]", " ", r.text.lower()).split()).encode()
        sizes = [(sum(len(z.compress(data[i:i + langid.PIECE])) for i in range(0, len(data), langid.PIECE)), k)
                 for k, (lang, z) in enumerate(packs.items())]
        (a, best), (b, _) = sorted(sizes)[:2]
        out[r] = (list(packs)[best], (b - a) / b < langid.MIN_MARGIN)
    return out


def plain_spans(text, enc):
    """Base spans by the plain patterns; other long runs by their characters per token."""
    kinds = secret_scan.KINDS
    spans = [(a, kinds[k], b) for a, k, b in plain_base(text)]
    taken = list(spans)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        run = m.group().rstrip("=")
        if re.fullmatch(r"[0-9_/+=-]+", run) or re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", run):
            continue
        if len(run) in (32, 40, 48, 56, 64, 96, 128) and re.fullmatch("[0-9a-f]+|[0-9A-F]+", run):
            continue
        if any(s <= m.start() and m.end() <= e for s, _, e in taken):
            continue
        if len(run) < 2.0 * len(enc.encode_ordinary(run)):
            spans.append((m.start(), "opaque", m.end()))
    return sorted(spans, key=lambda s: (s[0], kinds.index(s[1])))


def plain_redaction(text, spans):
    """Characters of any span are taken out; each stretch is named after its first span."""
    marks = [None] * len(text)
    last = -1
    for a, kind, b in spans:
        if a >= last:
            name = (a, kind)
        for i in range(a, b):
            marks[i] = marks[i] or name
        last = max(last, b)
    out, i = [], 0
    while i < len(text):
        if marks[i] is None:
            out.append(text[i])
            i += 1
        else:
            j = i
            while j < len(text) and marks[j] == marks[i]:
                j += 1
            out.append(f"[{marks[i][1]}]")
            i = j
    return "".join(out)


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers as p
    lines = open(p.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def planted(spark, small_dir):
    """The small table with secrets and near copies planted, a null and an empty text."""
    rnd = random.Random(9)
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    key = lambda n: "".join(rnd.choices("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789", k=n))
    for i in range(0, 60, 5):
        d, t, *rest = rows[i]
        rows[i] = (d, f"{t[:40]} {key(44)} {t[40:]} AKIA{key(20).upper()} password = {key(12)}", *rest)
    base = max(r[0] for r in rows) + 1
    for i in range(12):
        _, t, *rest = rows[30 + i]
        rows.append((base + i, t + (" end" if i % 2 else ""), *rest))
    rows += [(base + 20, None, "en", "web", None), (base + 21, "", "en", "web", 0), (base + 22, "12 34", None, None, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_against_plain_versions(spark, planted, vocabulary, small_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = common.written(planted, "stage-test-in")
    rows = docs.collect()

    out = common.written(stages["language"](spark, docs, small_dir), "stage-test")
    got = out.collect()
    want = plain_language(rows, langid._learned(docs))
    assert Counter(tuple(r) for r in got) == Counter(
        tuple({**r.asDict(), "lang": lang}.values()) for r, (lang, rejected) in want.items() if not rejected)
    assert len(got) > 0.9 * len(rows)

    docs, rows = out, got
    out = common.written(stages["near_duplicates"](spark, docs, small_dir), "stage-test")
    got = out.collect()
    groups = plain_components({r.doc_id: plain_fingerprint(r.text) for r in rows})
    assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in rows if groups[r.doc_id] == r.doc_id)
    assert len(got) < len(rows) - 5

    docs, rows = out, got
    out = common.written(stages["secrets"](spark, docs, small_dir), "stage-test")
    got = out.collect()
    assert len(got) == len(rows)
    now, kinds = {r.doc_id: r for r in got}, Counter()
    for r in rows:
        spans = plain_spans(r.text, vocabulary)
        kinds.update(k for _, k, _ in spans)
        text = plain_redaction(r.text, spans)
        assert now[r.doc_id].text == text
        assert now[r.doc_id].n_chars == (len(text) if spans else r.n_chars)
    assert min(kinds[k] for k in ("assign", "access", "opaque")) >= 5

    docs, rows = out, got
    out = common.written(stages["mixture"](spark, docs, small_dir), "stage-test")
    got = out.collect()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    copies = {i: n for i, n in con.sql(f"SELECT doc_id, copies FROM ({mixing.ORACLE_SQL})").fetchall()}
    assert Counter(tuple(r) for r in got) == Counter({tuple(r): copies[r.doc_id] for r in rows if r.doc_id in copies})

    docs, rows = out, got
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.model_path())
    want = Counter()
    for r in rows:
        ids = sp.encode(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in stages["tokens"](spark, docs, small_dir).collect()) == want


def test_planted_secrets_in_the_query(spark, planted, vocabulary, tmp_path):
    """All spans of the registered query, the method's included, against the plain versions."""
    from prospect.llm import registry
    planted.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in registry.QUERIES["op10_secret_scan"](spark, str(tmp_path)).collect()}
    found = Counter()
    for r in planted.collect():
        spans = plain_spans(r.text or "", vocabulary)
        found.update(k for _, k, _ in spans)
        assert got[r.doc_id].spans == ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
    assert found["opaque"] >= 10 and found["access"] >= 10


def test_pipeline_equals_its_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for name, f in corpus_pipeline.STAGES:
        docs = common.written(f(spark, docs, small_dir), f"chain-{name}")
    a, b = corpus_pipeline.run(spark, small_dir), docs
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.where(F.col("n_tokens") > 0).count() > 50
