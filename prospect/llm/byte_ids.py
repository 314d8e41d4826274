"""Ids of a byte-level BPE tokenizer file, exactly as the tokenizers library gives them, by batches.

A batch of texts is cut into words by Arrow (no pre-token reaches over a space that a non-space
follows), its words are dictionary-encoded, each distinct word is merged once, all in one call, and
the ids of all words are gathered at once. Texts whose white space makes such cuts inexact (runs,
tabs, rarer blanks) are cut one by one, and texts that hold a special token's string, as well as words
beyond Latin letters (whose classes differ between Unicode versions), go to the tokenizers library as
they are. Nothing is kept between batches; ``SLICE`` bounds the text that is cut at a time (one text
at least).

Merging words one by one costs the library a Python call and several objects a word, so tiktoken's
core does it over the file's own vocabulary. It joins the pair whose token has the lowest id, the
library the pair whose merge comes first. These agree if merges come in the order of ids and every
token's own bytes are encoded as that token: two tokens that could be joined otherwise would stay
apart in the library's encoding of their joined bytes. Both are checked when the file is loaded. Tokens
that their own bytes don't give are never made by the library and are left out; a file with another
order of merges is left to the library alone.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from tokenizers import Tokenizer

#: Bytes of text that are cut at a time.
SLICE = 4 << 20

PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: The same for words, where white space is one blank in front; words are joined by line ends.
IN_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+| |\n"""
CUT = re.compile(r" (?=\S|[\x1c-\x1f])")
SPACE = re.compile(r"\s")
MARK, LINE = "\x1f", "\x1e"
#: RE2: runs of white space, white space other than blank and line end, and the two marks.
ODD = r"[ \n][ \n]|[\t\r\f\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: RE2 and Python: characters beyond Latin letters.
RARE, FIRST_RARE = r"[^\x00-\x{24f}]", "ɐ"
#: The byte-level alphabet: printable Latin-1 stands for itself, the rest from U+0100 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = {b: b for b in _PLAIN} | {b: 256 + n for n, b in enumerate(x for x in range(256) if x not in _PLAIN)}


def merge_core(tok: Tokenizer) -> tiktoken.Encoding | None:
    """tiktoken's merges over the vocabulary of ``tok``, or None where they could differ."""
    model = json.loads(tok.to_str())["model"]
    vocab = model["vocab"]
    back = {chr(c): b for b, c in ALPHABET.items()}
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(set(made)) or model.get("dropout") or not set(back) <= set(vocab):
        return None
    if made and made[0] <= max(vocab[c] for c in back):
        return None
    made = set(made)
    ranks = {bytes(map(back.__getitem__, t)): i for t, i in vocab.items()
             if (i in made or t in back) and [x.id for x in tok.model.tokenize(t)] == [i]}
    return tiktoken.Encoding("own", pat_str=IN_WORDS, mergeable_ranks=ranks, special_tokens={})


class ByteIds:
    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.core = merge_core(self.tok)
        self.line = self.tok.encode("\n", add_special_tokens=False).ids[0]

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(bounds, ids)`` of words without white space but for one blank in front; ``LINE`` is a
        line end."""
        rare = np.flatnonzero(pc.match_substring_regex(words, RARE).to_numpy(zero_copy_only=False))
        plain = words
        if len(rare):
            plain = pc.if_else(pa.array(np.isin(np.arange(len(words)), rare)), pa.scalar("", words.type), words)
        one = pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain)
        joined = pc.binary_join(one, pa.scalar("\n", plain.type))[0].as_py() + "\n" * (len(words) > 0)
        ids = self.core.encode_to_numpy(joined, disallowed_special=()).astype("<u4")
        breaks = np.flatnonzero(ids == self.line)
        ids = np.delete(ids, breaks)
        bounds = np.concatenate(([0], breaks - np.arange(len(breaks))))
        ids[bounds[:-1][pc.equal(words, LINE).to_numpy(zero_copy_only=False)]] = self.line
        if len(rare):
            got = [self.library(w) for w in words.take(pa.array(rare)).to_pylist()]
            sizes = [len(x) for x in got]
            ids = np.insert(ids, np.repeat(bounds[rare], sizes), np.concatenate(got))
            more = np.zeros(len(bounds), np.int64)
            more[rare + 1] = sizes
            bounds = bounds + np.cumsum(more)
        return bounds, ids

    def _odd(self, text: str) -> bytes:
        if self.core is None or any(s in text for s in self.special):
            return self.library(text).tobytes()
        first, *rest = CUT.split(text)
        words = [first, *[" " + w for w in rest]]
        plain = [i for i, w in enumerate(words) if w and not SPACE.search(w, w[0] == " ")]
        bounds, ids = self.words(pa.array([words[i] for i in plain], pa.large_string()))
        got: list = [b""] * len(words)
        for i, a, b in zip(plain, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            got[i] = ids[a:b].tobytes()
        for i in set(range(len(words))).difference(plain):
            got[i] = self._run(words[i])
        return b"".join(got)

    def _run(self, word: str) -> bytes:
        """A word that holds other white space, pre-token by pre-token."""
        if not word.isascii() and max(word) >= FIRST_RARE:
            return self.library(word).tobytes()
        mapped = [p.encode().decode("latin-1").translate(ALPHABET) for p in PIECES.findall(word)]
        return np.array([t.id for p in mapped for t in self.tok.model.tokenize(p)], dtype="<u4").tobytes()

    def encode(self, texts: pa.Array, end: bytes = b"") -> list[bytes]:
        """Of every text (null: empty) the ids as little-endian uint32 bytes, ``end`` after them."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))))
        out: list[bytes] = []
        while len(out) < len(texts):
            a = len(out)
            b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + SLICE, side="right")) - 1)
            out += self._slice(texts.slice(a, b - a), end)
        return out

    def _slice(self, texts: pa.Array, end: bytes) -> list[bytes]:
        odd = pc.match_substring_regex(texts, ODD) if self.core else pa.array([True] * len(texts))
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        odd = odd.to_numpy(zero_copy_only=False)
        out: list = [b""] * len(texts)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._odd(texts[i].as_py()) + end
        at = np.flatnonzero(~odd)
        if not len(at):
            return out
        plain = pc.replace_substring(texts.take(pa.array(at)), " ", MARK + " ")
        plain = pc.replace_substring(plain, "\n", MARK + LINE + MARK)
        lists = pc.split_pattern(plain, MARK)
        words = lists.flatten().dictionary_encode()
        bounds, ids = self.words(words.dictionary)
        flat = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(ids)).take(words.indices)
        ends = flat.offsets.to_numpy()[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        data = flat.values.to_numpy().astype("<u4", copy=False)
        for i, x, y in zip(at.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = data[x:y].tobytes() + end
        return out


@lru_cache(maxsize=2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
