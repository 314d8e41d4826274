"""Secret scans: fixed patterns, and a token-efficiency test for strings no pattern knows.

A byte-pair vocabulary learned on ordinary text writes words in a few long tokens and random
strings in many short ones, so the characters per token of a key or password are low. Every
whole text is read; a candidate is a maximal run of ``[A-Za-z0-9+/=_-]`` of ``MIN_RUN``
characters or more, in one case or mixed. Left out are known digests and identifiers (UUIDs, hex
of digest length, numbers with separators) and runs inside a span that a pattern already found;
names made of words pass the test by their ratio.

Nulls and empty texts have no spans; a very long text is one pass of the patterns over it; rows
are judged one by one, so ties, repeats, empty tables and other columns play no part; a column named like
the result is replaced by it.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, ship, table, temp_name

KINDS = ("assign", "access", "hex", "opaque")
#: Shortest run put to the token-efficiency test, and the characters per token below which it
#: is reported. Random base64 or alphanumerics give 1.2 to 1.7, names made of words 2.5 and up.
MIN_RUN = 20
MAX_RATIO = 2.0

# Fixed patterns of the task; letters of the names match in either case, ASCII only.
_NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                  for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = re.compile(rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("password", "passwd", "secret", "token", "api")

RUN = re.compile(rf"[A-Za-z0-9+/=_-]{{{MIN_RUN},}}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
NUMBER = re.compile(r"[0-9+/=_-]+\Z")
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the fixed patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()  # only a quick look whether a name can occur
    if any(h in low for h in _HINTS):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=_order)


def _order(span: tuple[int, str, int]) -> tuple[int, int]:
    return span[0], KINDS.index(span[1])


def known(run: str) -> bool:
    """Digests, numbers and UUIDs: strings that are opaque by design but no secret."""
    return bool(NUMBER.match(run) or UUID.match(run) or len(run) in DIGEST_LENGTHS and DIGEST.match(run))


def opaque_spans(text: str, enc: tiktoken.Encoding, taken: list[tuple[int, str, int]],
                 max_ratio: float = MAX_RATIO) -> list[tuple[int, str, int]]:
    out = []
    for m in RUN.finditer(text):
        run, a, b = m.group().rstrip("="), m.start(), m.end()
        if known(run) or any(s <= a and b <= e for s, _, e in taken):
            continue
        if len(run) < max_ratio * len(enc.encode_ordinary(run)):
            out.append((a, "opaque", b))
    return out


def join_spans(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def find_secrets(df: DataFrame, text: str, vocabulary: str, out: str = "secrets") -> DataFrame:
    """Add ``out``: struct(n_assign, n_access, n_hex, n_opaque, base, spans, redacted).

    ``base`` and ``spans`` are ``kind:start:end`` by start, comma-joined, in code points;
    ``redacted`` is the text with every span replaced by ``[kind]`` (overlapping spans as one,
    named after the first), or null if nothing was found.
    """
    ship(df.sparkSession)
    kind = ("n_assign long, n_access long, n_hex long, n_opaque long, base string, spans string, "
            "redacted string")

    @F.arrow_udf(kind)
    def scan(texts: pa.Array) -> pa.Array:
        enc = _vocabulary(vocabulary)
        rows = []
        for t in texts:
            t = t.as_py() or ""
            base = base_spans(t)
            more = opaque_spans(t, enc, base)
            spans = sorted(base + more, key=_order) if more else base
            n = [sum(k == kind for _, k, _ in spans) for kind in KINDS]
            rows.append((*n, join_spans(base), join_spans(spans), redact(t, spans) if spans else None))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        types = [pa.int64()] * 4 + [pa.string()] * 3
        names = ["n_assign", "n_access", "n_hex", "n_opaque", "base", "spans", "redacted"]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return df.withColumn(out, scan(col(text)))


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    out, at = [], 0
    for s, kind, e in spans:
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(d, "text", vocabulary_path()).select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        F.sha2("secrets.base", 256).alias("base_sha256"), "secrets.spans", "secrets.n_opaque")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; found spans are replaced in its text, and ``n_chars`` follows."""
    s = temp_name(docs, "secrets")
    found = find_secrets(docs, "text", vocabulary_path(), s)
    new = F.coalesce(F.col(f"{s}.redacted"), F.col("text"))
    return found.select(*[new.alias(c) if c == "text" else
                          F.when(F.col(f"{s}.redacted").isNull(), col(c)).otherwise(
                              F.length(f"{s}.redacted").cast("long")).alias(c) if c == "n_chars" else col(c)
                          for c in docs.columns])
