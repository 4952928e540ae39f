"""Token ids of a public byte-level BPE, each text's followed by an end-of-document id."""

from __future__ import annotations

import re
import sys
import zlib

import numpy as np

#: The id that ends each document.
END = 2
VOCABULARY = "byte_bpe_50k.json"


def _cache() -> dict:
    return sys.__dict__.setdefault("_clipwright_tokenizers", {})  # outlives the functions sent to a worker


def tokenizer(path: str):
    """The tokenizers library's own encoder of a vocabulary file."""
    from tokenizers import Tokenizer

    found = _cache().get(path)
    if found is None:
        found = _cache()[path] = Tokenizer.from_file(path)
    return found


def quick(path: str):
    """The same vocabulary as ranks beside the file (name.tiktoken), about four times faster; None if there is none.

    Gives the ids of `tokenizer` for every text without a special token's string.
    """
    import base64
    import os

    import public_tokenizers
    import tiktoken

    ranks = path.removesuffix(".json") + ".tiktoken"
    if ranks not in _cache():
        found = None
        if os.path.exists(ranks):
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            found = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        _cache()[ranks] = found
    return _cache()[ranks]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Runs of this many blanks go to the library's own encoder: the quick one's pattern keeps a state for each character of
#: a run, and has no room for some hundred thousand.
LONG_RUN = 50_000


def long_run(text: str) -> bool:
    return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in re.finditer(r"\s{64}\s*+", text))


def encode(text: str | None, path: str, special: str = "<|endoftext|>") -> np.ndarray:
    """Ids of one text, then END, as little-endian unsigned 32-bit integers; null is the empty text."""
    if not text:
        return np.array([END], "<u4")
    fast = None if special in text or long_run(text) else quick(path)
    ids = fast.encode_ordinary(text) if fast else tokenizer(path).encode(text, add_special_tokens=False).ids
    ids.append(END)
    return np.array(ids, "<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
