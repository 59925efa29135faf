"""What the corpus operators share: reading the table, cutting lineage, word patterns, batches of rows."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.session import ensure_checkpoint_dir

#: UTF-8 bytes of text that a task works on at once; a longer text is a block of its own.
BLOCK_BYTES = 8_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared checkpoint folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 when divided by 3. A null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(True))


def examples(docs: DataFrame, labelled: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled rows that are not held out, those with the smallest hash of their id: doc_id, text, label.

    The sample is bounded, so it may be sent to all tasks that read the texts.
    """
    known = labelled.where(F.col(label).isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")


def blocks_of(batch: pa.RecordBatch, text_column: int = 1, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``block_bytes`` of text."""
    sizes = pc.binary_length(batch.column(text_column)).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes, dtype=np.int64) - sizes) // block_bytes
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
    for a, b in zip(starts, [*starts[1:], len(block)], strict=True):
        yield batch.slice(int(a), int(b - a))


def give_back() -> None:
    """Return memory that this worker has freed to the system, where Arrow and the C library would keep it.

    Workers stay from task to task, and what they keep counts beside the executor's heap.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_texts(df: DataFrame, function, schema: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Apply ``function(RecordBatch) -> RecordBatch`` to blocks of rows; the second column holds the texts, not null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch, block_bytes=block_bytes):
                yield function(block)
            give_back()

    return df.mapInArrow(work, schema)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a block of texts, parted by ASCII white space: codes in text order, words per text, the distinct words."""
    lists = pc.ascii_split_whitespace(texts)
    words = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    words, owner = words.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), np.bincount(owner, minlength=len(texts)), coded.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (xor-shift and multiply), so that near values get unrelated results."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
