"""Token ids of whole texts with the public byte-level BPE vocabulary, in Python workers.

The vocabulary file defines the ids. Its merge ranks also come in a form that a faster encoder reads; the driver checks
that both give the same ids for a probe text, and workers use the vocabulary's own encoder for texts that hold its special
token's string, for those that the fast one refuses, and for all if the probe fails.
"""

from __future__ import annotations

import base64
import functools
import os
from array import array

import numpy as np

PROBE = "Tide  gauges' log: 12,500 größe éèê\n\n\tñ's won't £ 你好 \U0001f30a<|x|>"
SPECIAL = "<|endoftext|>"
END = 0


def vocabulary() -> str:
    """The default vocabulary file; every operator takes another one's path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def _full(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _slow(path: str, text: str) -> np.ndarray:
    return np.array(_full(path).encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=2)
def _quick(path: str):
    """The fast encoder of the vocabulary's ranks; None if there are none."""
    ranks_file = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks_file):
        return None
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def quick_is_equal(path: str) -> bool:
    """Whether the fast encoder is there and gives the vocabulary's ids for the probe; asked once, on the driver, which keeps neither encoder."""
    try:
        return _quick(path) is not None and _quick(path).encode_ordinary(PROBE) == _slow(path, PROBE).tolist()
    finally:
        _quick.cache_clear()
        _full.cache_clear()


def encoder(path: str, quick: bool):
    """A function from a text to its ids (uint32), without special tokens added; its ``count`` gives their number only.

    quick: what quick_is_equal has said of the path.
    """
    encode = _quick(path).encode_ordinary if quick else None

    def plain(text: str):
        """Ids by the fast encoder, or None."""
        if encode is None or SPECIAL in text:
            return None
        try:
            return encode(text)
        except Exception:  # it refuses some very long runs
            return None

    def ids(text: str) -> np.ndarray:
        found = plain(text)
        return _slow(path, text) if found is None else np.frombuffer(array("I", found), np.uint32)

    def count(text: str) -> int:
        found = plain(text)
        return len(_slow(path, text) if found is None else found)

    ids.count = count
    return ids
