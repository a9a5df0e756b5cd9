"""Token ids of whole texts by the ``tokenizers`` library, faster by a cache of pieces.

A byte-level BPE never merges across the start of white space, so a text is the
sequence of its pieces " word" and white space runs; nor does it merge a letter with
a stop. Each distinct piece is encoded by the library once and its ids are looked up
after that.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

END_OF_PACKED = 1
END_OF_DOCUMENT = 2

#: White space of the tokenizer's pattern (Unicode's property, without U+001C to U+001F).
_SPACE = "\t-\r \x85\xa0  -     　"
#: Latin letters: letters in every version of Unicode.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: A word ends before a stop, and both where white space begins.
_PIECE = re.compile(
    f" ?(?:[{_LATIN}]++(?=[.,;:!?|])|[^{_SPACE}]+)|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_WORD = re.compile(f" ?[{_LATIN}]+")

#: Most pieces in each of the cache's two generations.
CACHED = 500_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it
    prints, else the next one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """Texts to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.tokenize = self.tokenizer.model.tokenize
        self.bytes = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        split = [_PIECE.findall(text) if text else [] for text in texts]
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        self._learn(set().union(*split).difference(self.young))
        known = self.young.__getitem__
        return [b"".join(map(known, pieces)) for pieces in split]

    def _learn(self, pieces: set[str]) -> None:
        new = []
        for piece in pieces:
            held = self.old.get(piece)
            if held is None:
                new.append(piece)
            else:
                self.young[piece] = held
        words = [piece for piece in new if _WORD.fullmatch(piece)]
        for word in words:
            # One letter run is one unit of the tokenizer's pattern: straight to its model.
            parts = self.tokenize(word.encode().decode("latin-1").translate(self.bytes))
            self.young[word] = struct.pack(f"<{len(parts)}I", *[part.id for part in parts])
        new = [piece for piece in new if piece not in self.young]
        for first in range(0, len(new), 4096):
            part = new[first : first + 4096]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            ends = 4 * np.searchsorted(found.word_ids, np.arange(1, len(part) + 1))
            start = 0
            for piece, end in zip(part, ends.tolist()):
                self.young[piece] = ids[start:end]
                start = end


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """Loaded once in each Python worker."""
    return PieceEncoder(path)
