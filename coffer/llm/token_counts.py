"""Token counts with a whole-token shortcut.

Once per job the driver proves for every vocabulary string that ends a word whether it alone encodes to that one token;
the proven strings (at most as many as the vocabulary has) go to the tasks. There a pre-token that is in the set counts
one, without merging; only the rest is merged by the library's model, each distinct pre-token once as long as the worker
remembers it. What a worker remembers stays from block to block and from task to task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coffer.llm.common import documents, map_texts, text_of, words_of
from coffer.llm.pieces import Memory, byte_letters, specials, sums, unusual

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
WORD_END = "</w>"
#: Fixed value: the splitting pattern that the vocabulary file names.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def whole_tokens(path: str) -> dict[str, int]:
    """Strings that are proven to encode alone as the single token that spells them."""
    tokenizer, letters = Tokenizer.from_file(path), byte_letters()
    spelled = {}
    for entry, token in tokenizer.get_vocab(with_added_tokens=False).items():
        if entry.endswith(WORD_END) and all(c in letters for c in entry[: -len(WORD_END)]):
            try:
                spelled[bytes(letters[c] for c in entry[: -len(WORD_END)]).decode()] = token
            except UnicodeDecodeError:
                continue  # part of a character: no text of its own
    encoded = tokenizer.encode_batch(list(spelled), add_special_tokens=False)
    return {text: 1 for (text, token), e in zip(spelled.items(), encoded, strict=True) if e.ids == [token]}


def piece_merger(tokenizer: Tokenizer):
    """A function from a pre-token in lower case to the number of its tokens.

    Normalising and splitting leave such a piece as it is, so the model alone gives the tokens of the whole tokenizer.
    """
    merge, letters = tokenizer.model.tokenize, {b: c for c, b in byte_letters().items()}
    return lambda piece: len(merge(piece.encode().decode("latin-1").translate(letters)))


def chunk_memory(merged) -> Memory:
    """chunk -> tokens. Pieces are remembered beside the chunks, so a piece in other company is not merged again."""
    split = regex.compile(PATTERN).findall

    def in_chunk(chunk: str) -> int:
        text = chunk.lower()
        pieces = [text] if text.isalpha() else split(text)
        return merged(chunk) if pieces == [chunk] else sum(memory[piece] for piece in pieces)

    memory = Memory(in_chunk)
    return memory


@lru_cache(maxsize=2)
def _counters(path: str) -> tuple[Tokenizer, list[str], Memory]:
    """The tokenizer at ``path``, its special strings and what is known of chunks; a worker makes them once."""
    tokenizer = Tokenizer.from_file(path)
    return tokenizer, specials(tokenizer), chunk_memory(piece_merger(tokenizer))


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row; null and empty texts have none. Any row is counted by itself."""
    path = path or public_tokenizers.path(VOCABULARY)
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer, special, memory = _counters(path)
        if not memory:
            memory.update(proven.value)
        texts = batch.column(1).to_pylist()
        codes, counts, distinct = words_of(pc.ascii_lower(batch.column(1)))
        used = np.zeros(len(distinct), bool)
        rare = unusual(texts, special, runs=False)
        used[codes[~np.repeat(rare, counts)]] = True
        values, at = np.zeros(len(distinct), np.int64), np.flatnonzero(used)
        values[at] = [memory[c] for c in distinct.take(pa.array(at)).to_pylist()]
        tokens = sums(values[codes], counts)
        for k in np.flatnonzero(rare):
            tokens[k] = len(tokenizer.encode(texts[k], add_special_tokens=False).ids)
        memory.trim()
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"]
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
    )
    counted = map_texts(rows, count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
