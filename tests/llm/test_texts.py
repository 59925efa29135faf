"""Operators that judge or count each text by itself."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from coffer.llm import quality_ranking, repetition_rules, token_counts, toxicity_neighbours
from coffer.llm.common import map_texts
from coffer.llm.pieces import unusual
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .conftest import prose


def repeat_words(words, n=5):
    places, inside = {}, set()
    for i in range(len(words) - n + 1):
        places.setdefault(tuple(words[i:i + n]), []).append(i)
    for at in places.values():
        if len(at) > 1:
            inside.update(k for i in at for k in range(i, i + n))
    return len(inside)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_longest_repeats_against_brute_force(keys):
    text, found = tuple(keys), repetition_rules.longest_repeats(np.array(keys, np.int64))
    for i in range(len(text)):
        want = 0
        for j in range(len(text)):
            k = 0
            while i != j and max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            want = max(want, k)
        assert found[i] == want


def repeat_chars(text, least):
    """Characters in repeats of at least ``least`` characters, as runs, and the longest repeat, place by place."""
    seen, inside, longest = {}, [False] * len(text), 0
    for i in range(len(text) - least + 1):
        seen.setdefault(text[i:i + least], []).append(i)
    for at in seen.values():
        for i in at if len(at) > 1 else ():
            inside[i:i + least] = [True] * least
            for j in at:
                k = least
                while i != j and max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                    k += 1
                longest = max(longest, k if i != j else 0)
    runs, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and inside[j]:
            j += 1
        if j > i:
            runs.append([i, j - i])
        i = max(j, i + 1)
    return runs, longest


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \u65e5\U0001f600", max_size=40), max_size=6), st.integers(0, 2))
def test_character_repeats_against_brute_force(texts, copies):
    texts = [t * (copies + 1) for t in texts]
    letters, keys, width, sizes = repetition_rules.characters(texts)
    assert width > 3 and sizes.tolist() == list(map(len, texts))
    found, at = repetition_rules.longest_repeats(keys, width, letters), 0
    for t in texts:
        for i in range(len(t)):
            want = 0
            for j in range(len(t)):
                k = 0
                while i != j and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                    k += 1
                want = max(want, k)
            assert found[at + i] == (want if want >= width else 0)
        assert found[at + len(t)] == 0
        at += len(t) + 1


def test_repetition_measures(awkward, make_docs, no_docs):
    rng = random.Random(9)
    unspaced = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(300))
    lines = "\n".join(unspaced[k:k + 20] for k in range(0, 300, 20))
    encoded = [" ".join("".join(rng.choice("0123456789abcdef") for _ in range(64)) for _ in range(12)) for _ in range(2)]
    texts = [
        "a b c d e f a b c d e", "w " * 300, "x # * $\ny <> |\ny <> |\n \n", prose(5, 400), prose(5, 60) + "\n" + prose(5, 60),
        lines, lines + "\n" + lines[:100] + "\u3042" + lines[100:], encoded[0], " ".join(f"{k}{w}" for k, w in enumerate(encoded[1].split()) for _ in "ab"),
    ]
    docs = make_docs([(100 + k, t) for k, t in enumerate(texts)]).unionByName(awkward)
    rows = repetition_rules.repetition(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for r in docs.where("doc_id is not null").collect():
        t, got = r.text or "", by_id[r.doc_id]
        words = t.encode().split()
        lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        n_repeat = repeat_words(words)
        want = (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), n_repeat)
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == want
        assert got.base_failed == (len(words) < 10 or 100 * n_repeat > 20 * len(words))
        runs, longest = repeat_chars(t, repetition_rules.MIN_CHARS)
        covered = sum(n for _, n in runs)
        assert (got.spans, got.covered_chars, got.longest_repeat, got.n_code_points) == (runs, covered, longest, len(t))
        passed = covered <= repetition_rules.MAX_COVERED * len(t) and longest <= repetition_rules.MAX_LONGEST
        assert got.kept == (passed and not got.base_failed)
    assert by_id[103].kept and not by_id[104].kept and by_id[104].longest_repeat == len(prose(5, 60))
    # lines without blanks, and words of which only the inside repeats: no window of five words is found twice
    assert by_id[105].kept and by_id[107].kept
    assert not by_id[108].base_failed and not by_id[108].kept and not by_id[106].kept
    assert repetition_rules.repetition(no_docs).count() == 0


def test_token_counts_equal_the_library(awkward, make_docs, no_docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    odd = ["it's  don't 'street !'s", "a\x1cb\x85c", "İstanbul ŉ ½³²", "é é", "<|startoftext|>", "tab\tnl\n\n x", "…“q” — x€ 12 345", "Q" * 3000]
    docs = make_docs([(200 + k, t) for k, t in enumerate(odd)]).unionByName(awkward)
    rows = token_counts.token_counts(docs).collect()
    want = sorted((len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
    assert token_counts.token_counts(no_docs).count() == 0


def test_whole_tokens_are_proven():
    path = public_tokenizers.path(token_counts.VOCABULARY)
    proven, tokenizer = token_counts.whole_tokens(path), Tokenizer.from_file(path)
    assert len(proven) > 30_000
    for text in random.Random(3).sample(sorted(proven), 500):
        assert len(tokenizer.encode(text, add_special_tokens=False).ids) == 1


def test_a_piece_is_merged_once_whatever_stands_next_to_it():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    one_by_one, calls = token_counts.piece_merger(tokenizer), []
    memory = token_counts.chunk_memory(lambda piece: calls.append(piece) or one_by_one(piece))
    chunks = ["qzxvkorst", "qzxvkorst,", "Qzxvkorst.", "(QZXVKORST)", "don'tqzxvkorst", "qzxvkorst" * 9, "\xa0Ünqzx\xa0"] * 2
    assert [memory[c] for c in chunks] == [len(tokenizer.encode(c, add_special_tokens=False).ids) for c in chunks]
    assert calls.count("qzxvkorst") == 1 and calls.count("ünqzx") == 1
    # a long chunk is counted, not kept
    assert "qzxvkorst" * 9 not in memory and len(memory) < len(set(chunks)) + len(set(calls))
    # nor does a task begin anew in a worker that knows the vocabulary
    path = public_tokenizers.path(token_counts.VOCABULARY)
    assert token_counts._counters(path)[2] is token_counts._counters(path)[2]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(
    st.sampled_from("'streldm!?.,-_19\xa0İŉÉß"), st.characters(min_codepoint=0xA0, max_codepoint=0x24F),
    st.characters(min_codepoint=0x2010, max_codepoint=0x2027), st.characters(min_codepoint=0x2030, max_codepoint=0x205E),
), max_size=30))
def test_chunks_are_counted_like_the_library(chunk):
    tokenizer, special, memory = token_counts._counters(public_tokenizers.path(token_counts.VOCABULARY))
    assert not unusual([chunk], special, runs=False).any()
    assert memory[chunk] == len(tokenizer.encode(chunk, add_special_tokens=False).ids)


def labelled(spark, make_docs, texts, column):
    docs = make_docs([(i, t) for i, (t, _) in enumerate(texts)])
    rows = [(i, y if column == "quality" else None, y if column == "toxic" else None) for i, (_, y) in enumerate(texts)]
    return docs, spark.createDataFrame([*rows, (None, 1, 1), (10**9, 0, 0)], "doc_id long, quality int, toxic int")


def test_quality_ranks_held_out_texts(spark, make_docs, awkward, no_docs):
    good = [(prose(k, 80) + ".\n" + prose(k + 1, 30) + ".", 1) for k in range(200)]
    bad = [(prose(k, 60).upper().replace(" ", "!! "), 0) for k in range(60)] + [("word " * (50 + k), 0) for k in range(60)]
    docs, labels = labelled(spark, make_docs, good + bad, "quality")
    model = quality_ranking.learn(docs, labels)
    rows = quality_ranking.score(docs, model).where("held_out").collect()
    truth = dict(enumerate(y for _, y in good + bad))
    assert len(rows) > 80 and np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.97
    again = quality_ranking.learn(docs.repartition(7), labels)
    assert np.allclose(model["weights"], again["weights"])
    found = quality_ranking.score(awkward, model).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert quality_ranking.score(no_docs, model).count() == 0
    assert quality_ranking.learn(docs, labels.where("quality = 1")) is None
    assert {r.score for r in quality_ranking.score(awkward, None).collect()} == {0.5}


def test_toxicity_of_held_out_texts_with_evidence(spark, make_docs, awkward, no_docs):
    rng = random.Random(2)
    bad_words = ["vile", "rotten", "nasty"]
    texts = []
    for k in range(400):
        words = prose(k, 60).split()
        if k % 4 == 0:
            for w in rng.sample(bad_words, 2):
                words.insert(rng.randrange(60), w + rng.choice(["", ",", "!"]))
        texts.append((" ".join(words), int(k % 4 == 0)))
    docs, labels = labelled(spark, make_docs, texts, "toxic")
    model = toxicity_neighbours.learn(docs, labels)
    rows = toxicity_neighbours.score(docs, model).collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == texts[r.doc_id][1] for r in held]) > 0.97
    assert all(len(r.evidence_ids) == len(r.evidence_cosines) and (not r.predicted or r.evidence_ids) for r in rows)
    kept = toxicity_neighbours.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}
    assert toxicity_neighbours.score(awkward, model).count() == awkward.count() == toxicity_neighbours.without_toxic(awkward, model).count()
    assert toxicity_neighbours.score(no_docs, model).count() == 0
    bare = toxicity_neighbours.learn(no_docs, labels)
    assert {r.predicted for r in toxicity_neighbours.score(awkward, bare).collect()} == {0}


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        terms = np.sort(rng.choice(30, rng.integers(0, 6), replace=False))
        w = rng.random(len(terms))
        rows.append((i, i % 2, terms.tolist(), (w / np.sqrt((w**2).sum()) if len(w) else w).tolist()))
    index = toxicity_neighbours.BlockMaxIndex(rows, 30)
    dense = {i: dict(zip(t, w, strict=True)) for i, _, t, w in rows}
    for _ in range(50):
        terms = np.sort(rng.choice(30, 4, replace=False))
        weights = rng.random(4)
        near, cosines = index.nearest(terms, weights, 7)
        all_cosines = sorted((sum(dense[i].get(t, 0) * w for t, w in zip(terms, weights, strict=True)) for i in dense), reverse=True)
        assert np.allclose(cosines, all_cosines[:7]) and len(set(near)) == 7
        assert np.allclose([sum(dense[i].get(t, 0) * w for t, w in zip(terms, weights, strict=True)) for i in index.ids[near]], cosines)


def test_terms_of_a_word():
    assert toxicity_neighbours.terms_of("rotten!") == ["rotten", "rott*", "rotte*"]
    assert toxicity_neighbours.terms_of("--") == []
    start, term, weight = toxicity_neighbours.weighted(pa.array(["", "bad bad word", "x"]), {"bad": 0, "word": 1}, np.array([1.0, 2.0]))
    assert start.tolist() == [0, 0, 2, 2] and term.tolist() == [0, 1] and np.isclose((weight**2).sum(), 1)


def test_workers_return_what_they_freed(spark):
    kept = []

    def held(batch):
        with open("/proc/self/smaps_rollup") as file:
            mb = next(int(line.split()[1]) for line in file if line.startswith("Anonymous:")) // 1024
        arrays = [np.ones(8_000) for _ in range(1_500)]  # 96 MB, each array below the size that is mapped by itself
        kept.append(arrays[-1])
        return pa.RecordBatch.from_arrays([pa.array([mb], pa.int64())], names=["mb"])

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "1")
    try:
        rows = map_texts(spark.range(0, 2, 1, 1).selectExpr("id", "'a' text"), held, "mb long").collect()
    finally:
        spark.conf.set(size, before)
    assert rows[1].mb - rows[0].mb < 40
