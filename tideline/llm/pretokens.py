"""Token ids by pre-token: each distinct pre-token is given to the tokenizer's model once and remembered.

The tokenizers here split a text by a pattern and encode the parts one by one, so the ids of a text are those of its
parts in a row. Texts with characters or strings for which the pattern below is not exactly the tokenizer's own are
encoded by the tokenizer whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    own = set(plain)
    return [chr(b if b in own else next(rest)) for b in range(256)]


_LETTERS = {b: c for b, c in enumerate(byte_letters())}
#: Letters and numbers below U+0250.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
_S = "\\t-\\r \x85\xa0"
#: The pattern of the byte-level vocabularies, over characters below U+0250.
BYTE_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: That of the lower-case vocabulary with word ends, over characters below U+0100.
WORD_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_NOT_BYTE = re.compile("[\x1c-\x1fɐ-\U0010ffff]|<\\|")
_NOT_WORD = re.compile("[\x1c-\x1fĀ-\U0010ffff]|<\\|")


class PretokenIds(dict):
    """Ids, as little-endian uint32 bytes, of pre-tokens; forgets all at `limit` pre-tokens, so its memory is bounded."""

    def __init__(self, path: str, lower: bool, limit: int = 400_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.limit, self.lower = self.tokenizer.model, limit, lower
        self.pattern, self.other = (WORD_PATTERN, _NOT_WORD) if lower else (BYTE_PATTERN, _NOT_BYTE)

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        word = part if part.isascii() and part.isalpha() else part.encode().decode("latin-1").translate(_LETTERS)
        ids = self[part] = np.array([t.id for t in self.model.tokenize(word)], dtype="<u4").tobytes()
        return ids

    def of(self, text: str) -> bytes:
        if self.other.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.__getitem__, self.pattern.findall(text.lower() if self.lower else text)))


@lru_cache(maxsize=1)
def pretoken_ids(path: str, lower: bool) -> PretokenIds:
    """One for each Python worker, which goes on to the next task with it."""
    return PretokenIds(path, lower)
