"""Language ID by compression.

For every language a raw-content zstandard dictionary is filled with sample texts of it. A text
(lower case, ASCII punctuation and digits as blanks) is cut into pieces of ``PIECE`` bytes (all of it, no prefix) and every piece is compressed once
with each dictionary; the language whose dictionary gives the fewest bytes in total is chosen.
Pieces keep the dictionary in play over a long text, whose own repeats would otherwise count for
more than the language.

The margin is the share by which the runner-up is longer; below ``MIN_MARGIN`` the text is
rejected. ``score`` grows with the margin from 1 / languages (a tie) to 1.

Learning reads text and non-null lang of the rows offered: at most ``MOST_LANGS`` languages, the
most frequent ones, ``SAMPLE_DOCS`` documents a language by a hash of id and text, and from each an
equal share of ``DICT_BYTES``, taken at a place that the hash chooses (texts of fewer sampled
documents give more each). This is a bounded sample of labelled rows (its bounds are parameters);
prediction covers every whole text. Only text enters a prediction.

Null texts and texts without a letter are ``und`` with score 0, and rejected. With no language
learned (an empty table) all are ``und``. Ties go to the language that comes first in the order
of learned rows, then by name. Repeated rows get equal answers; other columns play no part, and one
named like the result is replaced by it.
"""

from __future__ import annotations

import regex
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prospect.llm.common import col, ship, table, temp_name

SAMPLE_DOCS = 400
MOST_LANGS = 256
DICT_BYTES = 64 * 1024
PIECE = 4096
LEVEL = 6
MIN_MARGIN = 0.002
UND = "und"

LETTER = regex.compile(r"\p{L}")
#: ASCII bytes that are no letters; they would cost bytes in any language.
BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def learn_dictionaries(df: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS,
                       dict_bytes: int = DICT_BYTES, most_langs: int = MOST_LANGS) -> dict[str, bytes]:
    """Language -> sample text, most frequent language first.

    A hash threshold from the language's row count lets some four times the sample through where
    rows are read, so no task sees more than that of a hot language; the smallest hashes are taken.
    The driver receives at most ``most_langs`` counts and ``dict_bytes`` a language.
    """
    rows = df.select(col(id_col).alias("id"), col(text_col).alias("text"), col(lang_col).alias("lang")).where(
        "text is not null and lang is not null")
    counts = [(r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(most_langs).collect()]
    if not counts:
        return {}
    share = [(k, max(1, dict_bytes // min(n, sample_docs)), min(1.0, 4 * sample_docs / n)) for k, n in counts]
    langs = F.broadcast(df.sparkSession.createDataFrame(share, "lang string, chars int, part double"))
    h = F.xxhash64(F.col("id"), F.xxhash64("text"))
    place = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - F.col("chars"), F.lit(0)) + 1).cast("int")
    picked = (rows.withColumn("h", h).join(langs, "lang")
              .where(F.shiftrightunsigned("h", 11) < F.col("part") * F.lit(2.0 ** 53))
              .select("lang", "h", F.substring(F.col("text"), place + 1, F.col("chars")).alias("text"))
              .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
              .where(F.col("r") <= sample_docs))
    texts: dict[str, list[str]] = {}
    for r in picked.groupBy("lang").agg(F.sort_array(F.collect_set(F.struct("h", "text"))).alias("s")).collect():
        texts[r["lang"]] = list(dict.fromkeys(x["text"] for x in r["s"]))
    return {k: _fill(texts.get(k, []), dict_bytes) for k, _ in counts}


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(BLANK).split())


def _fill(texts: list[str], most: int) -> bytes:
    return b" ".join(map(plain, texts))[:most]


class Compressors:
    """Per process: one compressor for each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs = list(dictionaries)
        self.by = []
        for data in dictionaries.values():
            d = zstandard.ZstdCompressionDict(data or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.by.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                                    write_content_size=False, write_dict_id=False))

    def sizes(self, data: bytes) -> list[int]:
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.by]


def judge(text: str | None, comp: Compressors, min_margin: float = MIN_MARGIN) -> tuple[str, float, float, bool]:
    """``(lang, score, margin, rejected)``."""
    if not text or not comp.langs or not LETTER.search(text):
        return UND, 0.0, 0.0, True
    if len(comp.langs) == 1:
        return comp.langs[0], 1.0, 1.0, False
    sizes = comp.sizes(plain(text))
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    second = min(s for i, s in enumerate(sizes) if i != best)
    margin = (second - sizes[best]) / max(1, second)
    score = 0.5 + 0.5 * min(1.0, margin / (8 * min_margin)) if margin > 0 else 1 / len(sizes)
    return comp.langs[best], score, margin, margin < min_margin


def predict_language(df: DataFrame, text_col: str, dictionaries: dict[str, bytes], out: str = "language",
                     min_margin: float = MIN_MARGIN, level: int = LEVEL) -> DataFrame:
    """Add ``out``: struct(lang string, score double, margin double, rejected boolean).

    The function is marked as non-deterministic so that the optimizer doesn't copy it into a filter
    and a projection on its fields, which would compress every text twice."""
    ship(df.sparkSession)
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(dictionaries)  # DICT_BYTES a language

    @F.arrow_udf("lang string, score double, margin double, rejected boolean")
    def predict(texts: pa.Array) -> pa.Array:
        comp = Compressors(shared.value, level)
        rows = [judge(t.as_py(), comp, min_margin) for t in texts]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        types = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          ["lang", "score", "margin", "rejected"])

    return df.withColumn(out, predict.asNondeterministic()(col(text_col)))


def _held_out(id_col: str):
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _learned(docs: DataFrame) -> dict[str, bytes]:
    return learn_dictionaries(docs.where(~_held_out("doc_id")), "doc_id", "text", "lang")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predict_language(d, "text", _learned(d))
    return out.select("doc_id", _held_out("doc_id").alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      "language.score", "language.margin", "language.rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others ``lang`` is the predicted language."""
    name = temp_name(docs, "language")
    out = predict_language(docs, "text", _learned(docs), name)
    return out.where(~F.col(f"{name}.rejected")).select(
        *[F.col(f"{name}.lang").alias(c) if c == "lang" else col(c) for c in docs.columns])
