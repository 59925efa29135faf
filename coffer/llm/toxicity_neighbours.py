"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, from a block-max inverted index.

Terms are lower-case words without outer punctuation, and their first four and five letters. The vocabulary holds the terms
whose document frequencies differ most between toxic and other examples (chi-square); a text's vector has
``(1 + log tf) * idf`` for each of them. Examples are the labelled rows, at most ``MAX_EXAMPLES``, those with the smallest
hash of their id; this bound, and ``MAX_TERMS``, are what keep the index small enough to be sent to every task.

Examples are sorted so that like vectors stand together and cut into blocks; the index keeps postings by term and
block, and the largest weight of each. A query adds up the largest weights into a bound per block, opens blocks in falling
order of it, a few at a time, and leaves those that cannot reach the worst of the neighbours found: they are exact. Ties go
to the example that stands first.

Votes count by closeness, together with a small prior, so a score is the calibrated share of toxic votes; the
neighbours are its evidence. A text without a term of the vocabulary has no neighbours and gets the rate of such examples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import blocks_of, cut, documents, examples, give_back, held_out, labels, map_texts, text_of, words_of
from coffer.llm.pieces import joined

MAX_EXAMPLES = 20_000
MAX_TERMS = 2_000
#: Chi-square of a term, and examples that must hold it.
LEAST_CHI, LEAST_EXAMPLES = 40.0, 4
NEIGHBOURS = 5
#: Examples of a block of the index.
BLOCK = 128
#: UTF-8 bytes of text judged at once where whole rows are kept.
KEPT_BYTES = 4_000_000
#: Blocks opened before the bound is first put to use.
FIRST_BLOCKS = 8
#: Votes that the overall rate is worth beside the neighbours'; distance at which a vote has half its weight at none.
PRIOR_VOTES, HALF_DISTANCE = 0.5, 0.1
REJECT = 0.7
OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def terms_of(word: str) -> list[str]:
    """Terms of a lower-case word."""
    word = word.strip(OUTER)
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)] if word else []


def vectors(texts: pa.Array, known: dict[str, int] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Term counts of a block: text number, term number, times; sorted. Terms come from ``known``, or are numbered anew."""
    codes, counts, distinct = words_of(pc.utf8_lower(texts))
    names: dict[str, int] = dict(known or {})
    word_no, term_no = [], []
    for k, word in enumerate(distinct.to_pylist()):
        for term in terms_of(word):
            at = names.get(term) if known is not None else names.setdefault(term, len(names))
            if at is not None:
                word_no.append(k)
                term_no.append(at)
    width = max(1, len(names))
    used = np.unique(np.array(word_no, np.int64))
    hit = np.isin(codes, used) if len(used) else np.zeros(len(codes), bool)
    owner = np.repeat(np.arange(len(texts)), counts)[hit]
    pairs, times = np.unique(owner * max(1, len(distinct)) + codes[hit], return_counts=True)
    of_text, of_word = pairs // max(1, len(distinct)), pairs % max(1, len(distinct))
    word_no, term_no = np.array(word_no, np.int64), np.array(term_no, np.int64)  # by word
    low, high = np.searchsorted(word_no, of_word), np.searchsorted(word_no, of_word, side="right")
    n = high - low
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    keys, inverse = np.unique(np.repeat(of_text, n) * width + term_no[at], return_inverse=True)
    total = np.bincount(inverse, weights=np.repeat(times, n), minlength=len(keys))
    return keys // width, keys % width, total, list(names)


def vocabulary(sample: DataFrame) -> dict[str, float]:
    """Chosen terms and their idf. Document frequencies are counted by the tasks; the chosen terms come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch):
                text_no, term_no, _, names = vectors(block.column(1), None)
                label = block.column(2).to_numpy(zero_copy_only=False)[text_no]
                toxic = np.bincount(term_no, weights=label == 1, minlength=len(names)).astype(np.int64)
                other = np.bincount(term_no, weights=label != 1, minlength=len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(toxic), pa.array(other)], names=["term", "toxic", "other"]
                )

    frequencies = (
        sample.mapInArrow(count, "term string, toxic long, other long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic = sizes.get(1, 0)
    n = sum(sizes.values())
    if not 0 < n_toxic < n:
        return {}
    df = F.col("toxic") + F.col("other")
    expected = df * (n_toxic / n)
    chi = (F.col("toxic") - expected) ** 2 * (1 / expected + 1 / (df - expected))
    chosen = (
        frequencies.where(df >= LEAST_EXAMPLES).withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "term").limit(MAX_TERMS).select("term", df.alias("df")).collect()
    )
    return {r["term"]: float(np.log((1 + n) / r["df"])) for r in sorted(chosen)}


def weighted(texts: pa.Array, known: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors of a block: where each begins, term numbers, weights."""
    text_no, term_no, times, _ = vectors(texts, known)
    weight = (1 + np.log(times)) * idf[term_no]
    norm = np.sqrt(np.bincount(text_no, weights=weight**2, minlength=len(texts)))
    return np.searchsorted(text_no, np.arange(len(texts) + 1)), term_no, weight / norm[text_no]


class BlockMaxIndex:
    """Postings of the examples by term and block, with the largest weight of each block."""

    def __init__(self, rows: list[tuple[int, int, list[int], list[float]]], n_terms: int):
        main = [(max(zip(w, t, strict=True))[1] if t else -1) for _, _, t, w in rows]
        order = sorted(range(len(rows)), key=lambda i: (main[i], rows[i][2], rows[i][0]))
        rows = [rows[i] for i in order if rows[i][2]]
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], float)
        self.n_blocks = -(-len(rows) // BLOCK)
        example = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        term = np.array([t for r in rows for t in r[2]], np.int64)
        weight = np.array([w for r in rows for w in r[3]], float)
        by = np.lexsort((example, term))
        self.example, self.weight = example[by], weight[by]
        self.all_postings = np.arange(len(by))
        key = term[by] * max(1, self.n_blocks) + self.example // BLOCK
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.piece_start = np.r_[start, len(key)]
        self.piece_block = key[start] % max(1, self.n_blocks)
        self.piece_max = np.maximum.reduceat(self.weight, start) if len(key) else self.weight
        self.term_start = np.searchsorted(key[start] // max(1, self.n_blocks), np.arange(n_terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest cosine over zero, and the cosines."""
        pieces = [np.arange(self.term_start[t], self.term_start[t + 1]) for t in terms]
        piece = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        share = np.repeat(weights, [len(p) for p in pieces])
        bound = np.bincount(self.piece_block[piece], weights=self.piece_max[piece] * share, minlength=self.n_blocks)
        blocks = self.piece_block[piece]
        order = np.argsort(-bound, kind="stable")[: int((bound > 0).sum())]
        found, cosines, opened = np.zeros(0, np.int64), np.zeros(0), 0
        for upto in (FIRST_BLOCKS, 4 * FIRST_BLOCKS, len(order)):
            least = cosines[-1] - 1e-12 if len(found) >= k else 0.0
            opening = order[opened:upto][bound[order[opened:upto]] >= least]
            opened = max(opened, upto)
            if not len(opening):
                continue
            wanted = np.zeros(self.n_blocks, bool)
            wanted[opening] = True
            chosen = wanted[blocks]
            begin = self.piece_start[piece[chosen]]
            length = self.piece_start[piece[chosen] + 1] - begin
            at = joined(self.all_postings, begin, length)
            exact = np.bincount(self.example[at], weights=self.weight[at] * np.repeat(share[chosen], length), minlength=len(self.ids))
            hit = np.flatnonzero(exact > 0)
            found, cosines = np.r_[found, hit], np.round(np.r_[cosines, exact[hit]], 12)
            if len(found) > k:
                worst = np.partition(cosines, len(cosines) - k)[len(cosines) - k]
                near = cosines >= worst
                found, cosines = found[near], cosines[near]
            best = np.lexsort((found, -cosines))[:k]
            found, cosines = found[best], cosines[best]
        return found, cosines


def learn(docs: DataFrame, labelled: DataFrame, max_examples: int = MAX_EXAMPLES) -> dict:
    """The index over a bounded sample of labelled rows that are not held out."""
    sample = cut(examples(docs, labelled, "toxic", max_examples))
    idf = vocabulary(sample)
    known, weights = {t: i for i, t in enumerate(idf)}, np.array(list(idf.values()))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        start, term, weight = weighted(batch.column(1), known, weights)
        offsets = pa.array(start.astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(weight))], names=["doc_id", "label", "terms", "weights"],
        )

    rows = map_texts(sample, encode, "doc_id long, label int, terms array<int>, weights array<double>").collect()
    rows = [(r["doc_id"], r["label"], list(r["terms"]), list(r["weights"])) for r in rows]
    bare = [r[1] for r in rows if not r[2]]
    rate = sum(r[1] for r in rows) / len(rows) if rows else 0.0
    return {
        "known": known, "idf": weights, "index": BlockMaxIndex(rows, len(known)), "rate": rate,
        "bare_rate": (sum(bare) + rate) / (len(bare) + 1),
    }


SCHEMA = "doc_id long, held_out boolean, score double, evidence_ids array<long>, evidence_cosines array<double>"


def judged(texts: pa.Array, model: dict) -> tuple[list[float], list[list[int]], list[list[float]]]:
    """Scores of a block of texts, the nearest examples, and their cosines."""
    index = model["index"]
    start, term, weight = weighted(texts, model["known"], model["idf"])
    seen: dict[bytes, tuple] = {}
    scores, ids, cosines = [], [], []
    for a, b in zip(start[:-1], start[1:], strict=True):
        key = term[a:b].tobytes() + weight[a:b].tobytes()
        if key not in seen:
            near, cosine = index.nearest(term[a:b], weight[a:b], NEIGHBOURS)
            vote = HALF_DISTANCE / (HALF_DISTANCE + np.maximum(0, 1 - cosine))
            if len(near):
                prior = PRIOR_VOTES * vote.max()
                value = (vote @ index.labels[near] + prior * model["rate"]) / (vote.sum() + prior)
            else:
                value = model["bare_rate"]
            seen[key] = (float(value), index.ids[near].tolist(), cosine.tolist())
        for out, x in zip((scores, ids, cosines), seen[key], strict=True):
            out.append(x)
    return scores, ids, cosines


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted, and the neighbours with their cosines as evidence, per row.

    Null and empty texts, and all texts where nothing could be learnt, get the rate of examples without terms and no
    evidence. Equal texts get equal scores. A null id counts as held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, ids, cosines = judged(batch.column(1), shared.value)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(scores, pa.float64()), pa.array(ids, pa.list_(pa.int64())),
             pa.array(cosines, pa.list_(pa.float64()))],
            names=["doc_id", "held_out", "score", "evidence_ids", "evidence_cosines"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), held_out().alias("held_out"))
    return map_texts(rows, rate, SCHEMA).withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def without_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``REJECT``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([*batch.columns, pc.fill_null(batch.column(at), "")], names=[*docs_columns, "_text"])
            for block in blocks_of(whole, len(docs_columns), KEPT_BYTES):
                scores, _, _ = judged(block.column(len(docs_columns)), shared.value)
                ok = pa.array(np.array(scores) < REJECT)
                yield block.select(list(range(len(docs_columns)))).filter(ok)
            give_back()

    docs_columns = docs.columns
    return docs.mapInArrow(keep, docs.schema)


def op6_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, learn(docs, labels(spark, sf_dir)))
