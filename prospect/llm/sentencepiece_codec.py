"""SentencePiece encoding (merge type) by a prefix table, and decoding.

The merge model joins the best adjacent pair until none is left. Merges inside a token never look
beyond it, so tokens t1..tn are the encoding of their text exactly if every adjacent pair is: if
joining ti and ti+1 and encoding the result gives (ti, ti+1) again. It follows that each prefix of
a text has one encoding, hence one last token: the token t ending there for which the last token
of the prefix before t and t are such a pair. The table is filled from left to right: an
Aho-Corasick automaton over the vocabulary names the tokens that end at a position, a pair test
picks the one that fits, and the ids are read off backwards from the end.

Characters without a piece stand for themselves, never merge, and come out as their UTF-8 byte
pieces. No piece has a blank mark after another character, so no merge crosses the start of a word:
words are encoded apart and remembered per process (bounded in bytes). Nulls count as empty; empty texts have
no ids; very long texts are one walk over their words; rows are independent of each other, so repeated
rows get equal results and an empty table none. Other columns play no part; a column named like the
result is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain
from sys import getsizeof

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.llm.common import col, ship, table

MARK = "▁"
#: Bytes of words, and pairs, remembered per process. Words stand in two halves: when the newer is
#: full it becomes the older one, whose words are found again if they still occur.
WORD_BYTES = 112 << 20
MOST_PAIRS = 300_000
START, NO_PIECE = 65535, 65534
RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Memory(dict):
    """Ids of words, found when first asked for; two generations of at most half of ``most`` bytes."""

    def __init__(self, find, most: int = WORD_BYTES):
        super().__init__()
        self.find, self.half = find, most // 2
        self.older: dict = {}
        self.used = 0

    def __missing__(self, word: str) -> tuple[int, ...]:
        got = self.older.get(word)
        if got is None:
            got = self.find(word)
        self.used += getsizeof(word) + getsizeof(got) + 64  # 64: its share of the table
        if self.used > self.half:
            self.older = dict(self)
            self.clear()
            self.used = 0
        self[word] = got
        return got


class PrefixTable:
    def __init__(self, path: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unk = sp.unk_id()
        self.fallback = all(sp.is_byte(i) for i in self.byte_ids)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses the start of a word; this model needs whole-text encoding")
        if n > NO_PIECE:
            raise ValueError("pairs are kept as two 16-bit ids")
        self.piece = dict(map(reversed, self.ids.items()))
        self.trie = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.trie.add_word(p, (i, len(p)))
        self.trie.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.numbers = list(range(n))  # one object an id, shared by all remembered words
        self.names = list(map(str, self.numbers))
        self.runs = Memory(self.encode_word, WORD_BYTES // 8)
        self.words = Memory(lambda w: self.encode_word(MARK + w))

    def merge(self, text: str) -> list[str]:
        """The defining procedure, for the short texts of pair tests."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, pair: int) -> bool:
        """Whether two pieces (or one, after START) are the encoding of their joined text."""
        a, b = divmod(pair, 65536)
        two = [self.piece[x] for x in (a, b) if x < NO_PIECE]  # none joins what has no piece
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[pair] = self.merge("".join(two)) == two
        return known

    def last_pieces(self, word: str) -> list[int]:
        """The table: at i, the last piece of the encoding of ``word[:i]``."""
        last = [NO_PIECE] * (len(word) + 1)
        last[0] = START
        pairs = self.pairs.get
        for end, (piece, size) in self.trie.iter(word):
            end += 1
            if last[end] == NO_PIECE:
                pair = last[end - size] << 16 | piece
                ok = pairs(pair)
                if ok or ok is None and self.fits(pair):
                    last[end] = piece
        return last

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids recovered backwards; a character without a piece gives its bytes."""
        last, at, out = self.last_pieces(word), len(word), []
        while at:
            piece = last[at]
            if piece == NO_PIECE:
                out += [self.byte_ids[b] for b in reversed(word[at - 1].encode())] if self.fallback else [self.unk]
                at -= 1
            else:
                out.append(piece)
                at -= len(self.piece[piece])
        return tuple(map(self.numbers.__getitem__, reversed(out)))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        words = text.split(" ")
        if MARK in text or "" in words:
            return list(chain.from_iterable(map(self.runs.__getitem__, RUNS.findall(self.sp.normalize(text)))))
        return list(chain.from_iterable(map(self.words.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


@lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    return PrefixTable(path)


def encode(df: DataFrame, text: str, model: str, out: str = "ids") -> DataFrame:
    """Add ``out``: array<int> with the ids of the whole text."""
    ship(df.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        t = prefix_table(model)
        return pa.array([t.encode(x.as_py()) for x in texts], pa.list_(pa.int32()))

    return df.withColumn(out, ids(col(text)))


def decode(df: DataFrame, ids: str, model: str, out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of an id array (null: empty)."""
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def texts(rows: pa.Array) -> pa.Array:
        t = prefix_table(model)
        return pa.array([t.decode(x.as_py() or []) for x in rows], pa.string())

    return df.withColumn(out, texts(col(ids)))


def round_trip(df: DataFrame, text: str, model: str, out: str = "round_trip") -> DataFrame:
    """Add ``out``: struct(n_tokens, ids_sha256, decoded_sha256), without moving ids or texts back."""
    ship(df.sparkSession)

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pa.Array) -> pa.Array:
        t = prefix_table(model)
        n, a, b = [], [], []
        for x in texts:
            ids = t.encode(x.as_py())
            n.append(len(ids))
            a.append(hashlib.sha256(",".join(map(t.names.__getitem__, ids)).encode()).hexdigest())
            b.append(hashlib.sha256(t.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                          ["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.withColumn(out, digest(col(text)))


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of ``docs`` is encoded and decoded; one row out for each row in."""
    rows = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    return round_trip(rows, "text", model_path()).select("doc_id", "round_trip.*")
