"""Token ids of whole texts by a public byte-level vocabulary.

The vocabulary is a ``tokenizers`` file; its path is a parameter. Its tokens are loaded as ranks into
``tiktoken``, which gives the same ids several times faster (tests hold one against the other, odd
white space and the special token's string included). Texts are encoded one at a time, so a task's
memory is that of its longest text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def vocabulary(path: str):
    """An encoder for a vocabulary file, one per worker process."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    special = {x["content"]: x["id"] for x in stored["added_tokens"]}
    letter = _byte_letters()
    ranks = {
        bytes(letter[c] for c in token): rank
        for token, rank in stored["model"]["vocab"].items()
        if token not in special
    }
    import public_tokenizers

    return tiktoken.Encoding(
        "quipu", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def encode(path: str, text: str | None) -> np.ndarray:
    """Ids of a text; a null text has none."""
    if not text:
        return np.zeros(0, np.uint32)
    return np.asarray(vocabulary(path).encode_to_numpy(text, allowed_special="all"), np.uint32)


def encoded(path: str, column: pa.Array) -> Iterator[np.ndarray]:
    """Ids of the texts of a column, one text at a time."""
    for value in column:
        yield encode(path, value.as_py())
