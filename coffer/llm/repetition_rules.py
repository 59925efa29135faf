"""Quality rules on repetition within a text, from a suffix array over its characters.

Texts are taken in blocks, each text closed by an end mark. A block's suffixes are sorted first by (text, as many
characters as fit into 63 bits) and then by prefix doubling, so suffixes of one text stand together and texts never match
each other; only suffixes that are not yet alone are sorted again. Adjacent common prefixes come from the kept ranks of
each doubling, largest step first, and last from single characters. The longest repeat that starts at a character is the
longer of the two adjacent prefixes; the union of those of at least ``MIN_CHARS`` characters is what repeats cover. Scripts
without blanks, addresses and encoded data are thus judged like prose. The measures of the base rule count words; their
repeated windows come from the same code with words as letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import documents, map_texts, text_of, words_of

#: Words of a window of the base rule.
WINDOW_WORDS = 5
#: Shortest repeat that counts, in characters.
MIN_CHARS = 40
#: Share of a text's characters that repeats may cover.
MAX_COVERED = 0.2
#: Longest repeat allowed, in characters.
MAX_LONGEST = 1200
#: UTF-8 bytes of text whose suffixes are sorted together; a longer text is sorted by itself.
SORT_BYTES = 1_000_000
#: Words of a text below which the base rule rejects it.
LEAST_WORDS = 10
SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"


def suffix_ranks(keys: np.ndarray, width: int = 1) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... times ``width`` letters, up to where no two are equal.

    ``keys`` orders suffixes by their first ``width`` letters. A rank is the number of suffixes that are smaller; equal
    prefixes share one. Each result has one more element, -1, for the empty suffix.
    """
    n = len(keys)
    order = np.argsort(keys)
    new = np.r_[True, keys[order][1:] != keys[order][:-1]] if n else np.zeros(0, bool)
    rank = np.full(n + 1, -1, dtype=np.int32 if n < 1 << 31 else np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank], width
    active = order[~(new & np.r_[new[1:], True])] if n else order
    while len(active):
        after = rank[np.minimum(active + step, n)].astype(np.int64)
        pair = rank[active] * np.int64(n + 1) + after + 1
        order = np.argsort(pair)
        active, pair, base = active[order], pair[order], rank[active[order]]
        at = np.arange(len(active))
        bucket = np.maximum.accumulate(np.where(np.r_[True, base[1:] != base[:-1]], at, 0))
        first = np.r_[True, pair[1:] != pair[:-1]]
        group = np.maximum.accumulate(np.where(first, at, 0))
        rank = rank.copy()
        rank[active] = base + group - bucket
        levels.append(rank)
        step *= 2
        alone = first & np.r_[first[1:], True]
        active = active[~alone]
    return levels


def longest_repeats(keys: np.ndarray, width: int = 1, letters: np.ndarray | None = None) -> np.ndarray:
    """For each position the number of letters, from there on, that also occur elsewhere; 0 if fewer than ``width``.

    With a ``width`` above 1 ``letters`` holds the single letters behind ``keys``.
    """
    n = len(keys)
    if n < 2:
        return np.zeros(n, np.int64)
    levels = suffix_ranks(keys, width)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1][:-1]] = np.arange(n)
    low, high = suffixes[:-1], suffixes[1:]
    common = np.zeros(n - 1, np.int64)
    pairs = np.flatnonzero(levels[0][low] == levels[0][high])
    for k in range(len(levels) - 1, -1, -1):
        a, b = low[pairs] + common[pairs], high[pairs] + common[pairs]
        inside = (a < n) & (b < n)
        same = inside & (levels[k][np.minimum(a, n)] == levels[k][np.minimum(b, n)])
        common[pairs[same]] += width << k
    for _ in range(width - 1):
        a, b = low[pairs] + common[pairs], high[pairs] + common[pairs]
        inside = (a < n) & (b < n)
        pairs, a, b = pairs[inside], a[inside], b[inside]
        pairs = pairs[letters[a] == letters[b]]
        common[pairs] += 1
    longest = np.zeros(n, np.int64)
    longest[high] = common
    longest[low] = np.maximum(longest[low], common)
    return longest


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Letters of a block of texts, each closed by the end mark 0; sort keys, letters per key, and characters per text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    used = np.zeros(0x110000, bool)
    used[codes] = True
    dense = np.cumsum(used).astype(np.int32)  # letters from 1, in the order of code points
    text_no = np.repeat(np.arange(len(texts)), sizes + 1)
    letters = np.zeros(len(text_no), np.int32)
    real = np.ones(len(text_no), bool)
    real[np.cumsum(sizes + 1) - 1] = False
    letters[real] = dense[codes]
    bits = max(1, int(dense[-1]).bit_length())
    width = max(1, (63 - len(texts).bit_length()) // bits)
    keys = text_no
    for k in range(width):
        keys = keys << bits
        keys[: max(0, len(keys) - k)] |= letters[k:]
    return letters, keys, width, sizes


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Marks the elements inside any repeat of at least ``least`` elements."""
    starts = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    return np.cumsum(change[:-1]) > 0


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_code_points long, covered_chars long, longest_repeat long, spans array<array<int>>"
)


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total, ends = np.r_[0, np.cumsum(values)], np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(1).to_pylist()
    ids, counts, distinct = words_of(batch.column(1))
    sizes = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    words = np.repeat(np.arange(len(texts)), counts) * max(1, len(distinct)) + ids
    in_window = covered(longest_repeats(words), WINDOW_WORDS)

    letters, keys, width, chars = characters(texts)
    longest = longest_repeats(keys, width, letters)
    marked = covered(longest, MIN_CHARS)
    starts = np.cumsum(chars + 1) - chars - 1
    # a repeat never holds an end mark, so no run of marked characters crosses one
    edges = np.flatnonzero(np.diff(np.r_[0, marked.astype(np.int8), 0]))
    owner = np.searchsorted(starts, edges[::2], "right") - 1
    spans: list[list[list[int]]] = [[] for _ in texts]
    for k, a, b in zip(owner.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        spans[k].append([a - int(starts[k]), b - a])
    top = np.maximum.reduceat(np.where(longest >= MIN_CHARS, longest, 0), starts) if len(starts) else starts
    repeated_lines = []
    for t in texts:
        lines = [x for x in t.split("\n") if x.strip(SPACE)]
        repeated_lines.append(len(lines) - len(set(lines)))
    columns = [
        batch.column(0), pa.array(counts), pa.array(_per_text(sizes[ids] if len(ids) else ids, counts)),
        pa.array([sum(map(t.count, SYMBOLS)) for t in texts], pa.int64()), pa.array(repeated_lines, pa.int64()),
        pa.array(_per_text(in_window.astype(np.int64), counts)), pa.array(chars),
        pa.array(_per_text(marked.astype(np.int64), chars + 1)), pa.array(top), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def repetition(docs: DataFrame) -> DataFrame:
    """Measures and verdict per row; ``spans`` lists [first character, characters] of what repeats cover.

    A text fails the base rule with under ``LEAST_WORDS`` words, or when over a fifth of its words lie in 5-word windows
    found twice. The method's verdict limits the share of characters that repeats cover and the longest repeat; characters
    are code points, blanks included. Null and empty texts have no words and fail. Each row is judged by itself, so equal
    rows get equal results.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passed = (F.col("covered_chars") <= MAX_COVERED * F.col("n_code_points")) & (F.col("longest_repeat") <= MAX_LONGEST)
    measured = map_texts(rows, _measure, SCHEMA, block_bytes=SORT_BYTES)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passed)


def op9_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(documents(spark, sf_dir)).drop("spans")
