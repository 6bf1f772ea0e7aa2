"""Byte-level BPE ids from a ``tokenizers`` JSON file.

The vocabulary file's path is a parameter. Merges of a byte-level BPE file are in
the order of their ids, so its vocabulary serves as the rank table of ``tiktoken``,
which returns the same ids several times faster than ``tokenizers`` (tests compare
both). Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level BPE files use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """(encode, byte length of each id) for the file at ``path``; once per Python worker."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    letters = _byte_letters()
    special = {t["content"] for t in model.get("added_tokens", ())}
    ranks = {
        bytes(letters[c] for c in token): i
        for token, i in model["model"]["vocab"].items()
        if token not in special
    }
    encoding = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return encoding.encode_ordinary, sizes
