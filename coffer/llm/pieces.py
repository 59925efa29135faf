"""Tokens of texts by way of their distinct chunks.

Byte-pair merges never cross a piece of a tokenizer's splitting pattern, and in both patterns used here a piece never goes
on over a blank that a non-blank follows. So a text's tokens are those of its blank-separated chunks in order, and each
distinct chunk is encoded once by a worker, as long as it is remembered. Texts on which two regular-expression engines could
disagree (rare scripts, control characters, combining marks), texts with runs of blanks where these are tokens, and texts
that hold a special string go through the tokenizer whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Distinct chunks remembered by a worker before it starts afresh, and characters of a chunk that is remembered.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
#: What else than letters, digits and signs of the basic Latin blocks, general punctuation and the euro sign there is.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa0-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, and its byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Memory(dict):
    """chunk -> ``value(chunk)``, filled on demand; long chunks are not kept."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, chunk: str):
        found = self.value(chunk)
        if len(chunk) <= REMEMBERED_CHARS:
            self[chunk] = found
        return found

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


def specials(tokenizer: Tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def unusual(texts: list[str], special: list[str], runs: bool) -> np.ndarray:
    """Marks the texts that the tokenizer must see whole; with ``runs`` also those with runs of blanks, if they are tokens."""
    apart = [*special, "  "] if runs else special
    found = [UNUSUAL.search(t) is not None or any(s in t for s in apart) for t in texts]
    return np.array(found, dtype=bool)


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Chunks between single blanks: codes in text order, chunks per text, the distinct chunks."""
    lists = pc.split_pattern(texts, " ")
    coded = pc.list_flatten(lists).dictionary_encode()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.indices.to_numpy().astype(np.int64), counts, coded.dictionary


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of ``counts`` values."""
    total, ends = np.r_[0, np.cumsum(values)], np.cumsum(counts)
    return total[ends] - total[ends - counts]


def joined(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start:start + length]`` one after another."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + shift]
