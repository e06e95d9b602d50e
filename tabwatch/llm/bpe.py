"""Token ids of the byte-level BPE vocabulary.

Whole texts are encoded by the rank file of the vocabulary, which is faster than
the JSON tokenizer and gives the same ids (tested against it on whole texts).
Strings of special tokens inside a text become their ids, as is the JSON
tokenizer's default, unless they are asked to be plain text.  A text with a
very long run of white space goes to the JSON tokenizer: the rank file's
splitting needs a stack as deep as the run.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np

from tabwatch.llm.common import tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: A run of white space of this length is long.
LONG_RUN = 20_000

_long_run = re.compile(r"\s{%d}" % LONG_RUN)
_loaded: dict = {}


class Encoder:
    """Encoder of one vocabulary, given as JSON and as ranks."""

    def __init__(self, vocabulary: str, ranks: str):
        import public_tokenizers
        import tiktoken
        with open(ranks, "rb") as f:
            self.table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.merge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.table, special_tokens={})
        self.vocabulary, self.json = vocabulary, None
        with open(vocabulary, encoding="utf-8") as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.any_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def plain(self, text: str) -> list[int]:
        """The ids of a text whose special strings are plain text."""
        if len(text) >= LONG_RUN and _long_run.search(text):
            if self.json is None:
                from tokenizers import Tokenizer
                self.json = Tokenizer.from_file(self.vocabulary)
                self.json.encode_special_tokens = True
            return self.json.encode(text, add_special_tokens=False).ids
        return self.merge.encode_ordinary(text)

    def ids(self, text: str | None) -> bytes:
        """The ids of a text, four bytes each, little-endian; none for null."""
        if not text:
            return b""
        if not any(s in text for s in self.special):
            return _bytes(self.plain(text))
        found: list[int] = []
        for part in self.any_special.split(text):
            if part in self.special:
                found.append(self.special[part])
            elif part:
                found += self.plain(part)
        return _bytes(found)

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id; special tokens have those of their string."""
        out = [b""] * (1 + max([*self.table.values(), *self.special.values()]))
        for token, rank in self.table.items():
            out[rank] = token
        for content, rank in self.special.items():
            out[rank] = content.encode()
        return out


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def encoder(vocabulary: str, ranks: str) -> Encoder:
    """The worker's encoder of these files."""
    if (vocabulary, ranks) not in _loaded:
        _loaded[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _loaded[vocabulary, ranks]


def default_files() -> tuple[str, str]:
    return tokenizer_path(VOCABULARY), tokenizer_path(RANKS)
