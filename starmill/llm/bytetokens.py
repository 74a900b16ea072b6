"""Token ids of a byte-level vocabulary by an installed encoder, for operators that start from ids.

The vocabulary file is that of the tokenizers library; ids follow the order of its merges, so
they serve as the ranks by which tiktoken merges, which encodes several times faster.  The one
kind of text that it cannot split, with very long white space, is encoded in linear time by
this package's own encoder.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

from starmill.llm.bpe import byte_letters, vocabulary

WIDE = 50_000  # white space from this length on is not given to tiktoken
_WIDE = re.compile(rf"\s{{{WIDE}}}")


class ByteTokens:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(back.__getitem__, text)): token for text, token in spec["model"]["vocab"].items() if text not in self.special}
        self.encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.size = max(*ranks.values(), *self.special.values(), 0) + 1
        self.spelled = [b""] * self.size  # bytes of each token
        for text, token in ranks.items():
            self.spelled[token] = text
        self.path = path

    def _wide(self, text: str) -> bool:
        return len(text) >= WIDE and _WIDE.search(text) is not None

    def encode(self, text: str) -> np.ndarray:
        """Ids as the tokenizers library gives them; special tokens in the text are found."""
        if self._wide(text):
            return np.frombuffer(vocabulary(self.path).encode(text), np.int32).astype(np.uint32)
        return self.encoding.encode_to_numpy(text, allowed_special="all")

    def encode_plain(self, text: str) -> np.ndarray:
        """Ids of a text in which the strings of special tokens are ordinary text."""
        if self._wide(text):
            return np.frombuffer(vocabulary(self.path)._plain(text), np.int32).astype(np.uint32)
        return self.encoding.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)
