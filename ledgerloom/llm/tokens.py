"""Token ids of whole texts under a byte-level BPE tokenizer file.

The vocabulary of the file is run by the faster of two libraries that give the same
ids; a text that one cannot take goes to ``tokenizers``, which defines them.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"

# What the byte-level pre-tokenizer splits by (fixed value).
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_character() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others take characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TextEncoder:
    """Encodes texts as ``tokenizers`` does with one byte-level BPE file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken

        self._path = path
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        of = _byte_of_character()
        ranks = {
            bytes(of[c] for c in token): rank
            for token, rank in content["model"]["vocab"].items()
            if token not in special
        }
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._fast = tiktoken.Encoding(
            "file", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @cached_property
    def _defining(self) -> Tokenizer:
        """The library's own tokenizer, read when a text first needs it: few do, and it is large."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._path)

    def ids(self, text: str) -> np.ndarray:
        """Ids of one text as unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, "<u4")
        if not (self._special and self._special.search(text)):
            try:
                return np.array(array("I", self._fast.encode_ordinary(text)), "<u4")
            except ValueError:  # a run too long for its pattern matcher
                pass
        return np.array(self._defining.encode(text, add_special_tokens=False).ids, "<u4")

    def counts(self, texts: Sequence[str]) -> list[int]:
        return [len(self.ids(text)) for text in texts]


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def tokenizer_path() -> str:
    """The default tokenizer file, where the public vocabularies are installed."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


# A place after which encoding starts afresh: a blank or line feed that follows no
# white space. The pre-tokenizer always splits there, and nothing merges across.
_HARD_CUT = re.compile(r"(?<![\s\x1c-\x1f])(?=[ \n])")


def hard_cuts(text: str) -> Iterator[int]:
    """Places inside a text where its ids are the ids of both sides put together."""
    return (m.start() for m in _HARD_CUT.finditer(text) if m.start())
