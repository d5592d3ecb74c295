"""Token ids of whole texts by a public byte-level BPE vocabulary.

The ids are those of ``tokenizers`` with the same vocabulary.  A text is cut at
single spaces between two visible characters, where the vocabulary's
pre-tokenisation always starts a new piece, so each part is encoded by itself
and frequent parts are remembered (at most ``KEPT`` short ones per worker).
"""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np

KEPT = 500_000
SPECIAL = "<|endoftext|>"
SPLIT = re.compile(r"(?<=\S) (?=\S)")
_made: dict[str, "Encoder"] = {}


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to ids as little-endian uint32 bytes."""

    def __init__(self, ranks: str, reference: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self._encode, self._letters = own.encode_ordinary, own._encode_single_piece
        self._marks = {c: self._ids(c) for c in ".,;:!?"}
        self._reference = reference
        self._full = None
        self._parts: dict[str, bytes] = {}

    @classmethod
    def of(cls, ranks: str | None = None, reference: str | None = None) -> "Encoder":
        """The worker's encoder; the vocabulary paths default to the public 50k byte-level BPE."""
        ranks = ranks or vocabulary("byte_bpe_50k.tiktoken")
        if ranks not in _made:
            _made[ranks] = cls(ranks, reference or vocabulary("byte_bpe_50k.json"))
        return _made[ranks]

    def _ids(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def _word(self, p: str) -> bytes:
        """Ids of a blank and a part that has no white space at its ends; short parts are remembered."""
        if p.isalpha():  # one piece of the pre-tokenisation
            ids = array("I", self._letters((" " + p).encode())).tobytes()
        elif p[-1] in self._marks and p[:-1].isalpha():  # two pieces
            ids = (self._parts.get(p[:-1]) or self._word(p[:-1])) + self._marks[p[-1]]
        else:
            ids = self._ids(" " + p)
        if len(p) <= 24 and "\n" not in p:
            if len(self._parts) >= KEPT:
                self._parts.clear()
            self._parts[p] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:  # one id of its own there, so leave it to the reference encoder
            if self._full is None:
                from tokenizers import Tokenizer

                self._full = Tokenizer.from_file(self._reference)
            return np.array(self._full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        parts = text.split(" ")
        known, out = self._parts, [self._ids(parts[0])]
        for p in parts[1:]:
            ids = known.get(p)
            if ids is None:
                if not p or p[0].isspace() or p[-1].isspace():
                    parts = SPLIT.split(text)
                    return self._ids(parts[0]) + b"".join([known.get(p) or self._ids(" " + p) for p in parts[1:]])
                ids = self._word(p)
            out.append(ids)
        return b"".join(out)
