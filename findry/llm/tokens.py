"""Byte-level token ids inside tasks, equal to what the tokenizers library gives.

The rank file of the same vocabulary runs several times faster than the JSON form; tests
compare the two, special tokens in a text included.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

BYTE_RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT = "<|endoftext|>"
SEPARATOR = 1
# The characters the tokenizer's pattern takes as white space (Unicode White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern gives up on runs of about a million; runs this long are cut out before it sees them.
_LONG_RUN = re.compile(f"[{WHITE}]{{10000,}}")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteEncoder:
    """The encoder of a rank file."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.core = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={END_OF_TEXT: len(ranks)})
        self.end = np.array([len(ranks)], np.uint32)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text as 32-bit numbers; null counts as empty."""
        if not text:
            return np.zeros(0, np.uint32)
        if END_OF_TEXT not in text:
            return self.encode_plain(text)
        parts = []
        for part in text.split(END_OF_TEXT):
            parts += [self.end, self.encode_plain(part)]
        return np.concatenate(parts[1:])

    def encode_plain(self, text: str) -> np.ndarray:
        """As :meth:`encode`, with special strings as plain text.

        A long run of white space is one word to the pattern, but for its last character if other text
        follows; so it can be cut out and encoded by itself.
        """
        run = _LONG_RUN.search(text) if len(text) >= 10_000 else None
        if run is None:
            return self.core.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        parts, at = [], 0
        while run:
            start, stop = run.span()
            stop -= stop < len(text)
            parts += [self.core.encode_to_numpy(text[at:start], disallowed_special=()),
                      np.array(self.core._encode_single_piece(text[start:stop]), np.uint32)]
            at = stop
            run = _LONG_RUN.search(text, stop + 1)
        parts.append(self.core.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate(parts)


@lru_cache(2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@lru_cache(2)
def boundaries(path: str) -> tuple[np.ndarray, np.ndarray]:
    """By id: whether a sentence may end with the token, and whether the token starts with a space."""
    own = encoder(path).core
    ends, spaces = np.zeros(own.n_vocab, bool), np.zeros(own.n_vocab, bool)
    for i in range(own.n_vocab):
        data = own.decode_single_token_bytes(i)
        ends[i] = data.rstrip(b"\"')]* ").endswith((b".", b"!", b"?")) or b"\n" in data
        spaces[i] = data[:1].isspace()
    return ends, spaces
