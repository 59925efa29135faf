import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from coffer.llm import retrieval_packing as op
from tokenizers import Tokenizer

from .conftest import prose


def check(docs, window=2048, **more):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))
    want = sorted(
        [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.select("text").collect()
    )
    rows = op.pack(docs, window=window, **more).collect()
    used, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        used[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    got = []
    for parts in by_doc.values():  # rows that repeat an id: every text is whole
        begun = defaultdict(list)
        for start, total, ids in sorted(parts):
            begun[start].append((total, ids))
        while begun.get(0):
            total, ids = begun[0].pop()
            while len(ids) < total:
                k = next(k for k, (t, _) in enumerate(begun[len(ids)]) if t == total)
                ids = ids + begun[len(ids)].pop(k)[1]
            got.append(ids)
    assert sorted(got) == want
    return rows


def test_every_id_once_in_full_windows(make_docs):
    docs = make_docs([(i, prose(i % 40, 5 + i * 7 % 300)) for i in range(200)])
    check(docs)
    check(docs, 128, shard_bytes=20_000)


def test_chunks_encoded_together_equal_the_tokenizer(make_docs, monkeypatch):
    monkeypatch.setattr(op, "CHUNKS_AT_ONCE", 3)
    path = public_tokenizers.path(op.VOCABULARY)
    tokenizer = Tokenizer.from_file(path)
    chunks = ["word", "", "\nline", "line\n", "a\nb", "\t", "\xa0x", "don't", "€9,50", "zzqxv" * 40, "é", "…“q”", "last"]
    encode = op.chunk_encoder(path, tokenizer)
    for first in (False, True):
        flat, lengths = encode(pa.array(chunks), first)
        got = [x.tolist() for x in np.split(flat, np.cumsum(lengths)[:-1])]
        assert got == [tokenizer.encode(c if first else " " + c, add_special_tokens=False).ids for c in chunks]
    assert len(encode(pa.array([], pa.string()), False)[0]) == 0
    texts = ["a\n \nb", " lead", "trail ", "two  blanks", "\n", " ", "x \n y", " ".join(chunks), "tab\t \tx", "\u4e2d\u6587 text"]
    check(make_docs(list(enumerate(texts * 3))))


def test_awkward_rows(awkward, no_docs):
    check(awkward)
    assert op.pack(no_docs).count() == 0


def test_neighbours_share_rare_terms():
    rng = np.random.default_rng(1)
    tokens = [rng.integers(0, 40, 60) for _ in range(60)]
    for k in (3, 17, 42):
        tokens[k] = np.r_[tokens[k], [900, 901, 902]]
    index = op.ShardIndex([t.astype(np.uint16) for t in tokens])
    unused = np.ones(60, bool)
    assert set(index.neighbours(3, unused, 60)[:3]) == {3, 17, 42}
    unused[17] = False
    assert 17 not in index.neighbours(3, unused, 60)


def test_bm25_scores_against_the_formula():
    tokens = [np.array(x, np.uint16) for x in ([1, 1, 2, 3], [1, 4, 5], [2, 2, 2, 6], *[[7 + k, 8 + k] for k in range(40)])]
    index, n = op.ShardIndex(tokens), len(tokens)
    mean = np.mean([len(t) for t in tokens])
    term, doc = 2, 2
    idf = np.log1p((n - 2 + 0.5) / (2 + 0.5))
    want = idf * 3 * (op.K1 + 1) / (3 + op.K1 * (1 - op.B + op.B * 4 / mean))
    at = slice(index.term_start[term], index.term_start[term + 1])
    assert dict(zip(index.doc[at], index.weight[at], strict=True))[doc] == want


def test_seeds_follow_the_given_order(spark, make_docs):
    docs = make_docs([(i, prose(i, 60)) for i in range(80)], clashing=False)
    tags = docs.selectExpr("doc_id", "xxhash64(text) tag", "100 - doc_id AS slot")
    rows = op.pack(docs, window=128, order=tags).collect()
    assert {r.doc_id for r in rows} == set(range(80))
    begins = {r.sequence_id: 100 - r.doc_id for r in rows if r.offset == 0}
    assert all(r.slot == begins[r.sequence_id] for r in rows)
    first = min(rows, key=lambda r: (r.sequence_id, r.offset))
    assert first.doc_id == 79


def test_related_documents_meet_in_one_of_many_shards(make_docs):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(150):  # twins under other ids, one of them with a tenth of its words changed
        words = prose(k, 60).split(" ")
        twin = [prose(9000 + k * 60 + i, 1) if rng.random() < 0.1 else w for i, w in enumerate(words)]
        rows += [(k, " ".join(words)), (1000 + k, " ".join(words)), (2000 + k, " ".join(twin))]
    shards = {r.doc_id: r.sequence_id >> 32 for r in check(make_docs(rows), 128, shard_bytes=6000)}
    assert len(set(shards.values())) > 15
    assert np.mean([shards[k] == shards[1000 + k] for k in range(150)]) > 0.9
    assert np.mean([shards[k] == shards[2000 + k] for k in range(150)]) > 0.5


def test_hot_group_is_parted(make_docs):
    docs = make_docs([(i, prose(1, 60)) for i in range(300)])
    rows = check(docs, 128, shard_bytes=10_000)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.sequence_id >> 32] += r.length
    assert len(sizes) > 5 and max(sizes.values()) < 4 * sum(sizes.values()) / len(sizes)


def test_neighbours_by_all_terms_against_brute_force():
    rng = np.random.default_rng(7)
    words = np.arange(100, 130)  # a family of a third of the documents, beside noise that any may share
    tokens = [np.r_[rng.integers(0, 90, 40), rng.choice(words, 20) if k % 3 == 0 else rng.integers(200, 900, 20)] for k in range(90)]
    tokens = [t.astype(np.uint16) for t in tokens]
    n, mean = len(tokens), np.mean([len(t) for t in tokens])
    df = np.bincount(np.concatenate([np.unique(t) for t in tokens]))

    def score(seed, doc):
        total = 0.0
        for t in set(tokens[seed].tolist()) & set(tokens[doc].tolist()):
            times = int((tokens[doc] == t).sum())
            total += np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * times * (op.K1 + 1) / (times + op.K1 * (1 - op.B + op.B * len(tokens[doc]) / mean))
        return total

    index, unused = op.ShardIndex(tokens), np.ones(n, bool)
    for seed in range(n):  # ever fewer are unused
        unused[seed] = False
        got = index.neighbours(seed, unused, n).tolist()
        left = [d for d in range(n) if unused[d] and score(seed, d) > 0]
        assert sorted(got) == left
        scores = [score(seed, d) for d in got]
        assert all(a >= b - 1e-9 for a, b in zip(scores, scores[1:], strict=False))


def test_last_placed_document_is_the_next_seed():
    tokens = [np.array(t, np.uint16) for t in ([1, 2], [50, 51], [2, 3], [60, 61], [3, 4], [4, 5])]
    pieces = op.pack_shard(tokens, 12)
    assert [p[0] for p in sorted(pieces, key=lambda p: (p[3], p[4]))] == [0, 2, 4, 5, 1, 3]


def test_a_worker_encodes_a_chunk_once(monkeypatch):
    monkeypatch.setattr(op, "REMEMBERED_CHUNKS", 6)
    path = public_tokenizers.path(op.VOCABULARY)
    encode, seen = op.chunk_encoder(path, Tokenizer.from_file(path)), []
    remembered = op.RememberedChunks(lambda chunks, first: (seen.extend(chunks.to_pylist()), encode(chunks, first))[1])
    blocks = [["one", "two", "", "three\n"], ["two", "four", "one", "five", "six"], [], ["six", "five", "two", "tokenisation"]]
    for block in blocks:
        flat, lengths = remembered(pa.array(block, pa.string()))
        want, of_each = encode(pa.array(block, pa.string()), False)
        assert flat.tolist() == want.tolist() and lengths.tolist() == of_each.tolist()
    assert seen == ["one", "two", "", "three\n", "four", "five", "six", "six", "tokenisation"]


def test_frequent_terms_have_rows_instead_of_lists(monkeypatch):
    rng = np.random.default_rng(4)
    tokens = [rng.zipf(1.3, rng.integers(1, 200)).clip(1, 3000).astype(np.uint16) for _ in range(120)]
    index, pieces = op.ShardIndex(tokens), op.pack_shard(tokens, 256)
    assert len(index.rows) and op.FREQUENT * max(np.diff(index.term_start)) < len(tokens)
    monkeypatch.setattr(op, "FREQUENT", 0)
    lists = op.ShardIndex(tokens)
    assert not len(lists.rows) and len(lists.doc) > 2 * len(index.doc)
    unused = np.ones(len(tokens), bool)
    for seed in range(0, 120, 7):
        unused[seed] = False
        assert set(index.neighbours(seed, unused, 5000)) == set(lists.neighbours(seed, unused, 5000))
    assert op.pack_shard(tokens, 256) == pieces
