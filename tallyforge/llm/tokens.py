"""Token ids of texts under a byte-level BPE vocabulary, with a bounded cache of words.

The split into words and the merges within a word are those of the tokenizer file. Words are encoded
once and looked up afterwards; the merges of new words are done from the rank table of the same
vocabulary, which gives the same ids several times faster. A text that contains one of the
tokenizer's added tokens is encoded by the tokenizer itself.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from functools import cached_property

import numpy as np
import regex

#: Words kept in the cache of a Python worker, and the longest that is kept.
CACHED_WORDS = 150_000
CACHED_LETTERS = 40

# The white space of Unicode, and the split pattern of the vocabulary with it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: A word that has been split off already is one piece.
SPLIT_ALL = r"(?s:.+)"


class Words(dict):
    """Ids of words as little-endian bytes, encoded when first asked for."""

    def __init__(self, ranks_path: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.encoder = tiktoken.Encoding("ranks", pat_str=SPLIT_ALL, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encoder.encode_ordinary(word), "<u4").tobytes()
        if len(word) <= CACHED_LETTERS and len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """``ids(text)``: the ids as little-endian unsigned 32-bit integers.

    ``added`` are the tokenizer's added tokens; the tokenizer itself is loaded when one is met.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, added: Sequence[str]):
        self.tokenizer_path, self.added = tokenizer_path, list(added)
        self.words = Words(ranks_path)
        self.split = regex.compile(SPLIT)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.tokenizer_path)

    def ids(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, self.split.findall(text)))

    def close(self) -> None:
        """Free the cache; a Python worker lives on when its task has ended."""
        self.words.clear()


def added_tokens(tokenizer_path: str) -> list[str]:
    """The tokenizer's added tokens; a tokenizer that splits words by other rules than these is refused."""
    with open(tokenizer_path, encoding="utf-8") as file:
        settings = json.load(file)
    split = settings.get("pre_tokenizer") or {}
    same = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    if not same or settings.get("normalizer") or settings["model"].get("type") != "BPE":
        raise ValueError(f"{tokenizer_path} is not a byte-level BPE tokenizer with the usual split into words")
    return [t["content"] for t in settings["added_tokens"]]
