"""Lexical retrieval packing: documents fill a window next to their BM25 neighbours.

Documents become token ids and are dealt into shards by content; the number of shards grows with the bytes of the table, so
a shard has about ``SHARD_BYTES`` of text whatever the size or source. The key of a document is a row of minwise terms, where
a term's chance to be drawn is in proportion to its idf, so two documents draw the same with the probability that their
idf-weighted sets overlap. Documents in the order of their keys are cut into shards: equal ones stand together, and a group
too large for a shard is parted by its further terms, at last by a hash. A seed's neighbours in other shards are not found.

A shard's task builds a BM25 inverted index over its documents, with token ids as terms and the idf of the whole table, and
packs it: the document that begins a window is its seed, the index ranks the unused documents of the shard by all terms of
the seed, and these follow in that order until the window is full. The last one is cut there and its rest is the seed of
the next window. Where the seed has no neighbour left, the document last placed is the seed; without a neighbour of that
the next unused document follows.

Only the end of a shard does not fill a window. It is cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from coffer.llm.common import cut, documents, give_back, map_texts, mix64, text_of
from coffer.llm.pieces import byte_letters, chunks_of, joined, specials, sums, unusual

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 2048
#: Follows the ids of every document.
END_ID = 1
SHARD_BYTES = 4_000_000
K1, B = 1.2, 0.75
#: Minwise terms of a document's key, and documents looked at per shard to find where shards begin.
KEY_TERMS, SAMPLED = 8, 24
IDS = 1 << 16
#: A term in one of so many documents of a shard, or more, has a weight for each document instead of a posting list.
FREQUENT = 16
#: Distinct chunks encoded in one go.
CHUNKS_AT_ONCE = 20_000
#: Distinct chunks whose ids a worker keeps from one block to the next.
REMEMBERED_CHUNKS = 100_000
#: UTF-8 bytes of text whose tokens a task finds at once.
TOKENISED_BYTES = 2_000_000
#: Fixed value: the splitting pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def chunk_encoder(path: str, tokenizer: Tokenizer):
    """A function from chunks, each with a blank before it, to their ids one after another and how many each has.

    Where the vocabulary numbers its tokens in the order of its merges, its bytes are a rank table, and the faster encoder
    for those gives the same ids; else the tokenizer itself is used. The rank table encodes all chunks in one go: only the
    blanks between them begin a token with a blank, unless a chunk begins or ends with white space or is empty. Those, and
    the ones that the text has no blank before, are encoded each by itself.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in pairs]
    letters = byte_letters()

    def by_tokenizer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        flat = np.concatenate([np.zeros(0, np.uint16), *(np.array(x, np.uint16) for x in ids)])
        return flat, np.array([len(x) for x in ids], np.int64)

    if merged != sorted(merged) or len(model["vocab"]) != len(merged) + len(letters):
        return lambda chunks, first: by_tokenizer([c if first else " " + c for c in chunks.to_pylist()])
    ranks = {bytes(letters[c] for c in entry): token for entry, token in model["vocab"].items()}
    encode = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    blank = np.zeros(IDS, bool)
    blank[[token for entry, token in ranks.items() if entry.startswith(b" ")]] = True

    def by_ranks(chunks: pa.Array, first: bool) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.and_(pc.equal(chunks, pc.utf8_trim_whitespace(chunks)), pc.greater(pc.binary_length(chunks), 0))
        plain = plain.to_numpy(zero_copy_only=False).astype(bool) & (not first)
        parts, lengths, at = [np.zeros(0, np.uint16)], np.zeros(len(chunks), np.int64), np.flatnonzero(plain)
        for start in range(0, len(at), CHUNKS_AT_ONCE):
            part = at[start:start + CHUNKS_AT_ONCE]
            line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), chunks.take(pa.array(part))), " ")
            ids = np.array(encode(" " + line[0].as_py()), np.uint16)
            lengths[part] = np.diff(np.r_[np.flatnonzero(blank[ids]), len(ids)])
            parts.append(ids)
        single = np.flatnonzero(~plain)
        for k, chunk in zip(single, chunks.take(pa.array(single)).to_pylist(), strict=True):
            parts.append(np.array(encode(chunk if first else " " + chunk), np.uint16))
            lengths[k] = len(parts[-1])
        order = np.r_[at, single]
        starts = np.empty(len(chunks), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return joined(np.concatenate(parts), starts, lengths), lengths

    return by_ranks


class RememberedChunks:
    """``encode`` of chunks with a blank before them; the ids of the first ``REMEMBERED_CHUNKS`` distinct ones are kept."""

    def __init__(self, encode):
        self.encode = encode
        self.known, self.flat, self.lengths = pa.array([], pa.string()), np.zeros(0, np.uint16), np.zeros(0, np.int64)

    def __call__(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        place = pc.index_in(chunks, value_set=self.known)
        new = pc.is_null(place).to_numpy(zero_copy_only=False)
        fresh = chunks.filter(pa.array(new))
        flat, lengths = self.encode(fresh, False)
        code = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        code[new] = len(self.known) + np.arange(len(fresh))
        all_flat, all_lengths = np.concatenate([self.flat, flat]), np.concatenate([self.lengths, lengths])
        starts = np.cumsum(all_lengths) - all_lengths
        room = max(0, REMEMBERED_CHUNKS - len(self.known))
        if room and len(fresh):
            kept = lengths[:room]
            self.known = pa.concat_arrays([self.known, fresh[:room].cast(pa.string())])
            self.flat, self.lengths = np.concatenate([self.flat, flat[:kept.sum()]]), np.concatenate([self.lengths, kept])
        return joined(all_flat, starts[code], all_lengths[code]), all_lengths[code]


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The tokenizer at ``path``, its special strings, and its encoders of chunks with and without memory; a worker makes them once."""
    tokenizer = Tokenizer.from_file(path)
    if tokenizer.get_vocab_size() > IDS:
        raise ValueError(f"ids of {path} do not fit in 16 bits")
    encode = chunk_encoder(path, tokenizer)
    return tokenizer, specials(tokenizer), encode, RememberedChunks(encode)


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, tag (hash of the text), and the ids of each row as little-endian 16-bit numbers without the end id."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer, special, encoded, remembered = _encoders(path)
        texts = batch.column(1).to_pylist()
        codes, counts, distinct = chunks_of(batch.column(1))
        begins = np.cumsum(counts) - counts
        rare = unusual(texts, special, runs=True)
        used = np.zeros(len(distinct), bool)
        after = ~np.repeat(rare, counts)
        after[begins] = False  # the first chunk has no blank before it
        used[codes[after]] = True
        at = np.flatnonzero(used)
        place = np.zeros(len(distinct), np.int64)
        place[at] = np.arange(len(at))
        flat, lengths = remembered(distinct.take(pa.array(at)))
        firsts = distinct.take(pa.array(np.where(rare, codes[begins[0]], codes[begins]))) if len(texts) else distinct
        first_flat, first_lengths = encoded(firsts, True)
        whole = [np.array(tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint16) for k in np.flatnonzero(rare)]
        # an unusual text is one entry, at the place of its first chunk
        code = np.where(after, place[codes], -1)
        code[begins] = len(at) + np.arange(len(texts))
        code[begins[rare]] = len(at) + len(texts) + np.arange(len(whole))
        lengths = np.r_[lengths, first_lengths, np.array([len(x) for x in whole], np.int64)]
        starts = np.cumsum(lengths) - lengths
        taken = code >= 0
        n = np.where(taken, lengths[code], 0)
        flat = joined(np.concatenate([flat, first_flat, *whole]), np.where(taken, starts[code], 0), n)
        ends = np.r_[0, np.cumsum(sums(n, counts))]
        packed = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(packed, pa.binary())], names=["doc_id", "tag", "ids"]
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("tag"))
    return map_texts(rows, encode, "doc_id long, tag long, ids binary", TOKENISED_BYTES)


class Corpus(NamedTuple):
    """Documents of the table, their mean length, and in how many of them each id occurs."""

    n: int
    mean: float
    df: np.ndarray

    @property
    def idf(self) -> np.ndarray:
        return np.log1p((self.n - self.df + 0.5) / (self.df + 0.5))


def corpus_of(rows: DataFrame, end_id: int) -> Corpus:
    """Counts over all ``ids``, each with the end id behind it; one number per id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(IDS, np.int64), 0, 0
        for batch in batches:
            for x in batch.column(0).to_pylist():
                ids = np.sort(np.append(np.frombuffer(x, "<u2"), np.uint16(end_id)), kind="stable")
                df[ids[np.r_[True, ids[1:] != ids[:-1]]]] += 1
                n, total = n + 1, total + len(ids)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-2, -1, term], pa.int64()), pa.array(np.r_[n, total, df[term]], pa.int64())], names=["term", "n"]
        )

    sums_of = rows.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in sums_of}
    n, total = found.pop(-2, 0), found.pop(-1, 0)
    df = np.zeros(IDS, np.int64)
    df[list(found)] = list(found.values())
    return Corpus(n, total / max(1, n), df)


def term_orders(corpus: Corpus) -> np.ndarray:
    """For each of ``KEY_TERMS`` draws the place of every id; the first place in a document is drawn.

    Places follow exponential values divided by the idf. Ids of a single document come last: nothing shares them.
    """
    weight = np.where(corpus.df > 1, corpus.idf, 0)
    places = np.empty((KEY_TERMS, IDS), np.uint16)
    numbers = np.arange(IDS, dtype=np.uint64)
    for k in range(KEY_TERMS):
        uniform = ((mix64(mix64(numbers + np.uint64(k * IDS + 1))) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
        with np.errstate(divide="ignore"):
            order = np.argsort(-np.log(uniform) / weight, kind="stable")
        places[k, order] = np.arange(IDS)
    return places


def content_keys(ids: list[bytes], hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A sortable key per document: the places of its drawn terms, then a hash. Documents without ids come last."""
    sizes = np.array([len(x) // 2 for x in ids], np.int64)
    full = np.flatnonzero(sizes)
    drawn = np.full((len(ids), KEY_TERMS), IDS - 1, ">u2")
    if len(full):
        flat = np.frombuffer(b"".join(ids), "<u2")
        starts = (np.cumsum(sizes) - sizes)[full]
        for k in range(KEY_TERMS):
            drawn[full, k] = np.minimum.reduceat(places[k][flat], starts)
    tail = hashes.astype(">i8").view(np.uint8).reshape(-1, 8)
    raw = np.ascontiguousarray(np.hstack([drawn.view(np.uint8).reshape(len(ids), -1), tail]))
    return raw.view(f"S{raw.shape[1]}").reshape(-1)


def dealt(rows: DataFrame, n_shards: int, corpus: Corpus) -> DataFrame:
    """``rows`` (doc_id, tag, ids, ...) with their shard. Shards begin at keys of a sample that a hash selects."""
    if n_shards == 1:
        return rows.withColumn("shard", F.lit(0).cast("long"))
    places = term_orders(corpus)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            made = content_keys(ids, batch.column(1).to_numpy(), places)
            raw = [made[k:k + 1].tobytes() for k in range(len(made))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw, pa.binary()), pa.array([len(x) + 2 for x in ids], pa.int64())], names=["key", "size"]
            )

    share = min(1.0, SAMPLED * n_shards / max(1, corpus.n))
    few = rows.select("ids", F.xxhash64("doc_id", "tag").alias("hash")).where(F.pmod(F.xxhash64("hash"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = sorted((bytes(r["key"]), r["size"]) for r in few.mapInArrow(keys, "key binary, size long").collect())
    weight = np.cumsum([size for _, size in sample])
    wanted = np.arange(1, n_shards) * (weight[-1] / n_shards) if len(sample) else []
    begins = [sample[k][0] for k in np.searchsorted(weight, wanted)]
    terms = [key[:2 * KEY_TERMS] for key in begins]
    # a shard begins with all documents of its first terms, unless those fill more than a shard
    begins = [b if t == last else t for b, t, last in zip(begins, terms, [None, *terms], strict=False)]
    bounds = np.array(begins, f"S{2 * KEY_TERMS + 8}")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = content_keys(batch.column("ids").to_pylist(), batch.column("hash").to_numpy(), places)
            shard = np.searchsorted(bounds, made, side="right").astype(np.int64)
            kept = batch.drop_columns(["hash"])
            yield kept.append_column("shard", pa.array(shard))

    out = StructType([*rows.schema.fields, StructField("shard", LongType())])
    return rows.withColumn("hash", F.xxhash64("doc_id", "tag")).mapInArrow(place, out)


class ShardIndex:
    """BM25 postings of a shard: for each term the documents and their weights. Without ``corpus`` the shard is all there is.

    Frequent terms have a row of weights, zero where a document lacks the term, which is added without a list of documents.
    """

    def __init__(self, tokens: list[np.ndarray], corpus: Corpus | None = None):
        n = len(tokens)
        sizes = np.array([len(t) for t in tokens], np.int64)
        flat = np.concatenate(tokens).astype(np.int64) if n else np.zeros(0, np.int64)
        width = int(flat.max()) + 1 if len(flat) else 1
        keys, times = np.unique(flat * n + np.repeat(np.arange(n), sizes), return_counts=True)
        term, doc = keys // max(1, n), keys % max(1, n)
        df = np.bincount(term, minlength=width)
        kept = df[term] > 1  # nothing shares the others
        term, doc, times = term[kept], doc[kept], times[kept]
        corpus = corpus or Corpus(n, sizes.mean() if n else 1.0, df)
        idf = corpus.idf
        length = 1 - B + B * sizes[doc] / max(1.0, corpus.mean)
        weight = idf[term] * times * (K1 + 1) / (times + K1 * length)
        by = np.argsort(doc, kind="stable")
        self.own_terms, self.own_start = term[by], np.searchsorted(doc[by], np.arange(n + 1))
        frequent = np.flatnonzero(FREQUENT * df >= max(2, n))
        frequent = frequent[df[frequent] > 1]
        self.row = np.full(width, -1)
        self.row[frequent] = np.arange(len(frequent))
        row = self.row[term]
        self.rows = np.zeros((len(frequent), n))
        self.rows[row[row >= 0], doc[row >= 0]] = weight[row >= 0]
        rare = row < 0
        self.doc, self.weight = doc[rare], weight[rare]
        self.term_start = np.searchsorted(term[rare], np.arange(width + 1))
        self.live = np.arange(n)  # the documents that lists and rows stand for

    def _leave_out_used(self, unused: np.ndarray) -> None:
        left = unused[self.live]
        kept = left[self.doc]
        self.term_start = np.r_[0, np.cumsum(kept)][self.term_start]
        self.doc, self.weight = (np.cumsum(left) - 1)[self.doc[kept]], self.weight[kept]
        self.rows, self.live = self.rows[:, left], self.live[left]

    def neighbours(self, seed: int, unused: np.ndarray, most: int) -> np.ndarray:
        """Unused documents by falling score for all terms of the seed; at most ``most``.

        Only the postings of the seed's terms are read. When half of the documents in them are used, all lists are shortened.
        """
        if 2 * int(np.count_nonzero(unused)) < len(self.live):
            self._leave_out_used(unused)
        terms = self.own_terms[self.own_start[seed]:self.own_start[seed + 1]]
        if not len(terms):
            return terms
        row = self.row[terms]
        score = np.zeros(len(self.live))
        for k in row[row >= 0].tolist():
            score += self.rows[k]
        terms = terms[row < 0]
        lists = [slice(a, b) for a, b in zip(self.term_start[terms].tolist(), self.term_start[terms + 1].tolist(), strict=True) if b > a]
        if lists:
            docs, weights = np.concatenate([self.doc[x] for x in lists]), np.concatenate([self.weight[x] for x in lists])
            score += np.bincount(docs, weights, minlength=len(score))
        at = np.flatnonzero((score > 0) & unused[self.live])
        return self.live[at[np.argsort(-score[at], kind="stable")[:most]]]


def pack_shard(tokens: list[np.ndarray], window: int, corpus: Corpus | None = None) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard's documents, which are not empty."""
    index = ShardIndex(tokens, corpus)
    unused = np.ones(len(tokens), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, offset, following, seed, placed = 0, 0, 0, -1, -1
    queue: list[int] = []
    while True:
        while queue and not unused[queue[0]]:
            queue.pop(0)
        if not queue and seed >= 0:
            queue = index.neighbours(seed, unused, window).tolist()
            seed, placed = -1, placed if placed != seed else -1  # asked once
        if not queue and placed >= 0:
            seed, placed = placed, -1
            continue
        if not queue:
            while following < len(tokens) and not unused[following]:
                following += 1
            if following == len(tokens):
                break
            queue = [following]
        doc = queue.pop(0)
        unused[doc] = False
        placed = doc
        if offset == 0:
            seed, queue = doc, []
        start = 0
        while start < len(tokens[doc]):
            length = min(window - offset, len(tokens[doc]) - start)
            pieces.append((doc, start, length, sequence, offset))
            start, offset = start + length, offset + length
            if offset == window:
                sequence, offset = sequence + 1, 0
                # the rest of the document, if any, begins the next window
                seed, queue = (doc, []) if start < len(tokens[doc]) else (-1, [])
                placed = seed
    return _last_in_powers(pieces, sequence, offset)


def _last_in_powers(pieces: list, sequence: int, total: int) -> list:
    """The pieces with the unfinished last window cut into sequences whose lengths are powers of two."""
    whole = [p for p in pieces if p[3] < sequence]
    room = [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    at, left = 0, room[0] if room else 0
    for doc, start, length, _, _ in [p for p in pieces if p[3] == sequence]:
        while length:
            part = min(length, left)
            whole.append((doc, start, part, sequence + at, room[at] - left))
            start, length, left = start + part, length - part, left - part
            if not left and at + 1 < len(room):
                at, left = at + 1, room[at + 1]
    return whole


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, slot long"


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
         order: DataFrame | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves.

    ``order`` (doc_id, tag, slot; once each) says in which order seeds are taken. Pieces then have the column ``slot`` too,
    the slot of the document that begins their sequence; read by it, sequences follow the order.
    Null and empty texts are one token, the end id. Every row is packed by itself, also if rows repeat an id and text.
    Sequence ids are unique, not gapless: the shard in the upper, the number in the shard in the lower 32 bits. An empty
    table gives no pieces.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    total = docs.agg(F.sum(F.octet_length(text_of()) + 4)).first()[0] or 0
    n_shards = max(1, math.ceil(total / shard_bytes))
    coded = cut(tokenised(docs, path))
    corpus = corpus_of(coded, end_id)

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["slot", "no_id", "doc_id", "tag"], kind="stable")
        tokens = [np.append(np.frombuffer(x, "<u2"), np.uint16(end_id)) for x in pdf["ids"]]
        pieces = pack_shard(tokens, window, corpus)
        give_back()
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
        cuts = [tokens[d][a:a + n].astype("<u4").tobytes() for d, a, n, _, _ in pieces]
        ids = pd.array(pdf["doc_id"].to_numpy()[doc], dtype="Int64")
        ids[pdf["no_id"].to_numpy()[doc]] = pd.NA
        first = dict(zip(sequence[offset == 0], pdf["slot"].to_numpy()[doc[offset == 0]], strict=True))
        return pd.DataFrame({
            "doc_id": ids, "start": start, "length": length, "ids_crc32": [zlib.crc32(c) for c in cuts],
            "doc_tokens": np.array([len(t) for t in tokens])[doc], "sequence_id": (int(key[0]) << 32) + sequence,
            "offset": offset, "ids": cuts, "slot": [first[k] for k in sequence],
        })

    rows = coded.withColumn("slot", F.lit(0).cast("long"))
    if order is not None:
        slots = order.select(F.col("doc_id").alias("key_id"), F.col("tag").alias("key_tag"), F.col("slot").alias("key_slot"))
        same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("tag") == F.col("key_tag"))
        rows = rows.join(slots, same, "left").withColumn("slot", F.coalesce("key_slot", F.lit((1 << 63) - 1)))
    rows = rows.select("doc_id", "tag", "ids", "slot")
    rows = dealt(rows, n_shards, corpus).select(
        "shard", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "tag", "ids", "slot"
    )
    packed = rows.groupBy("shard").applyInPandas(fill, SCHEMA)
    return packed if order is not None else packed.drop("slot")


def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).drop("ids")
