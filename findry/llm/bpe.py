"""Exact byte-pair encoding in linear time, and decoding, for vocabularies with word ends.

A word is encoded by backtracking.  An Aho-Corasick automaton over the vocabulary finds all tokens
in the word in one scan; at each place the longest is tried first.  Two tokens may stand side by
side only if merging their joined characters gives back exactly these two, and a row of tokens is
the merge result exactly if all its neighbours may.  So a token that fails against the one before it
gives way to the next shorter one, and where none is left the encoder steps back a token and marks the
place as closed, which bounds the work by the length of the word.

The pair table answers by the merges that build the inner edges of both tokens: the two tokens are incompatible if
some merge across the border comes before the merges that bury its two sides.  Answers
are remembered.

Decoding gathers the strings of the ids from one block of bytes by a table of offsets.

Null texts count as empty: no ids, an empty decoded text.  Null ids decode to an empty text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from findry.llm.tokens import public_path

WORD_VOCABULARY = "word_bpe_49k.json"
# Distinct strings and pairs remembered by one worker.
REMEMBERED = 300_000
ROWS = 1_000
# The last character of a word is a symbol of its own; it is written this far above the plain one.
_LAST = 0x4000
_NEVER = 1 << 60
_BLANKS = regex.compile(r"\p{White_Space}+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary files (fixed values)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


def _class(split, c: str) -> str:
    """A plain character of the class ``c`` has to a pre-tokenizer: letter, number or neither."""
    if len(split("a" + c)) == 1:
        return "a"
    return "\u2400" if len(split("!" + c)) == 1 else "1"


def _ranges(points: list[int]) -> str:
    """A pattern for one of these code points."""
    starts = [c for c, before in zip(points, [-2, *points]) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -2]) if after != c + 1]
    return "[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends)) + "]"


class Vocabulary:
    """A tokenizer file of the kind: word pattern, byte-level symbols, merges, word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, self.suffix = model["vocab"], model["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_in_text = regex.compile(
            "(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.symbol = byte_characters()
        by_name = {**ids, **self.special}
        names = [b""] * (max(by_name.values()) + 1)
        for name, i in by_name.items():
            names[i] = name.encode()
        self.block = b"".join(names)
        self.offsets = np.r_[0, np.cumsum([len(n) for n in names])].tolist()
        self.piece = [self.block[a:b] for a, b in zip(self.offsets, self.offsets[1:])]
        size = len(names)
        self.length = [0] * size
        self.automaton = ahocorasick.Automaton()
        for name, i in ids.items():
            symbols = self._symbols(name)
            self.length[i] = len(symbols)
            self.automaton.add_word(symbols, i)
        self.automaton.make_automaton()
        self.rank, self.left, self.right = [-1] * size, list(range(size)), list(range(size))
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            a, b, whole = ids[a], ids[b], ids[a + b]
            self.merges[a, b] = rank
            self.rank[whole], self.left[whole], self.right[whole] = rank, a, b
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}
        # Characters that Python's tables lack: the tokenizers library says whether they are letters or
        # numbers to it, and brings texts that hold any into its own normal form.
        library = Tokenizer.from_file(path)
        self.normal_form = library.normalizer.normalize_str
        newer = regex.findall(r"\P{Cn}", "".join(
            c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn"))
        self.newer = {ord(c): _class(library.pre_tokenizer.pre_tokenize_str, c) for c in newer}
        self.has_newer = re.compile(_ranges(sorted(self.newer))).search

    def _symbols(self, name: str) -> str:
        if name.endswith(self.suffix):
            name = name[:-len(self.suffix)]
            return name[:-1] + chr(ord(name[-1]) + _LAST)
        return name

    def _edge(self, token: int, side: list[int]) -> list[int]:
        """Parts of a token that reach its left or right edge, from one symbol to the whole."""
        out = [token]
        while side[token] != token:
            token = side[token]
            out.append(token)
        return out[::-1]

    def may_meet(self, a: int, b: int) -> bool:
        """Whether merging the characters of both tokens gives back these two tokens."""
        known = self.compatible.get((a, b))
        if known is not None:
            return known
        lefts, rights = self._edge(a, self.right), self._edge(b, self.left)
        ranks, merges = self.rank, self.merges
        i = j = 0
        fits = True
        while True:
            # The merges that will bury the two sides of the border as it is now.
            buries_left = ranks[lefts[i + 1]] if i + 1 < len(lefts) else _NEVER
            buries_right = ranks[rights[j + 1]] if j + 1 < len(rights) else _NEVER
            across = merges.get((lefts[i], rights[j]), _NEVER)
            # Of equal merges the leftmost goes first.
            if across < buries_left and across <= buries_right and across != _NEVER:
                fits = False
                break
            if buries_left == buries_right == _NEVER:
                break
            if buries_left <= buries_right:
                i += 1
            else:
                j += 1
        if len(self.compatible) >= REMEMBERED:
            self.compatible.clear()
        self.compatible[a, b] = fits
        return fits

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        symbols = [self.symbol[b] for b in word.encode()]
        symbols[-1] = chr(ord(symbols[-1]) + _LAST)
        n = len(symbols)
        starting: list[list[int]] = [[] for _ in range(n)]
        for end, token in self.automaton.iter("".join(symbols)):
            starting[end + 1 - self.length[token]].append(token)
        closed = bytearray(n + 1)
        out: list[int] = []
        choice: list[int] = []  # place in `starting` of every token in `out`
        at, pick = 0, len(starting[0]) - 1
        while at < n:
            options = starting[at]
            while pick >= 0:
                token = options[pick]
                if not closed[at + self.length[token]] and (
                        not out or self.may_meet(out[-1], token)):
                    break
                pick -= 1
            if pick >= 0:
                out.append(token)
                choice.append(pick)
                at += self.length[token]
                pick = len(starting[at]) - 1 if at < n else 0
            else:
                closed[at] = 1
                at -= self.length[out.pop()]
                pick = choice.pop() - 1
        return out

    def _word(self, word: str) -> bytes:
        data = np.array(self.encode_word(word), "<u4").tobytes()
        if len(self.known_words) >= REMEMBERED:
            self.known_words.clear()
        if len(word) <= 64:
            self.known_words[word] = data
        return data

    def _chunk(self, chunk: str) -> bytes:
        """Ids of text without white space."""
        seen = chunk if chunk.isascii() else chunk.translate(self.newer)
        if seen == chunk:
            words = self.words.findall(chunk)
        else:
            words = [chunk[m.start():m.end()] for m in self.words.finditer(seen)]
        data = b"".join([self.known_words.get(w) or self._word(w) for w in words])
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(chunk) <= 64:
            self.known[chunk] = data
        return data

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and self.has_newer(text):
            text = self.normal_form(text)
        elif not text.isascii():
            # Lower case goes character by character, so a sigma at the end of a word is no special one.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        # No word of the pattern holds white space, so text between white space is encoded alone.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python, not to the pattern
            chunks = _BLANKS.split(text.lower())
        else:
            chunks = text.lower().split()
        known = self.known.get
        return b"".join([known(c) or self._chunk(c) for c in chunks])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        if not text:
            return b""
        if "<|" not in text:
            return self._plain(text)
        out = []
        for part in self.special_in_text.split(text):
            special = self.special.get(part)
            out.append(self._plain(part) if special is None else special.to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """The strings of the ids with spaces between, which is how a file without decoder decodes."""
        piece = self.piece
        return b" ".join([piece[i] for i in np.frombuffer(ids or b"", "<u4").tolist()]).decode()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _mapped(frame: DataFrame, source: str, target: str, kind: T.DataType, convert) -> DataFrame:
    """``frame`` with a column computed from another in batches of bounded size."""
    frame = frame.drop(target)
    place = frame.columns.index(source)
    schema = T.StructType([*frame.schema.fields, T.StructField(target, kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def run(batches):
        function = convert()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                values = pa.array([function(v) for v in part.column(place).to_pylist()], arrow)
                yield pa.RecordBatch.from_arrays([*part.columns, values],
                                                 [*part.schema.names, target])

    return frame.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the tokens of ``text`` as little-endian 32-bit numbers."""
    return _mapped(docs, "text", "ids", T.BinaryType(),
                   lambda: vocabulary(path or public_path(WORD_VOCABULARY)).encode)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``."""
    return _mapped(encoded, "ids", "decoded", T.StringType(),
                   lambda: vocabulary(path or public_path(WORD_VOCABULARY)).decode)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of every row; one pass, no shuffle."""
    return decode(encode(docs.select(F.col("doc_id").cast("long"), "text"), path).drop("text"), path)
