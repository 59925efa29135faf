import random
from itertools import combinations

import pyarrow as pa
from coffer.llm import components as cc
from coffer.llm import near_dedup as op

from .conftest import prose


def shingle_set(text, n=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n=4):
    sets = [shingle_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [m for m in members[find(i)] if m is not None]
        first = min(known) if known else None
        out.append((doc, len(sets[i]), first, doc == first))
    return sorted(out, key=str)


def check(docs, n=4):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = op.near_duplicates(docs, n).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, n)


def variants(base, count, edits, seed):
    rng, words, out = random.Random(seed), base.split(), []
    for k in range(count):
        copy = list(words)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"edit{k}x{rng.randrange(1000)}"
        out.append(" ".join(copy))
    return out


def test_awkward_rows(awkward, no_docs):
    check(awkward)
    check(awkward, 5)
    check(no_docs)


def test_groups_around_the_threshold_and_hot_group(make_docs):
    rows, i = [], 0
    for g in range(12):  # clusters whose members lie on both sides of the threshold
        for t in variants(prose(100 + g, 120), 7, 6, g):
            rows.append((i, t))
            i += 1
    for t in variants(prose(7, 100), 260, 4, 99):  # a group larger than a leaf
        rows.append((i, t))
        i += 1
    shared = prose(8, 60)  # a passage that otherwise different texts share
    for k in range(200):
        rows.append((i, shared + " " + prose(1000 + k, 60)))
        i += 1
    check(make_docs(rows))


def test_sets_do_not_depend_on_the_block():
    texts = [prose(k, 3 + k) for k in range(30)] + ["", "a", "a b", "A B", "a b c"]
    together, sizes = op.shingles(pa.array(texts), 4)
    at = 0
    for text, n in zip(texts, sizes, strict=True):
        alone, _ = op.shingles(pa.array([text]), 4)
        assert n == len(shingle_set(text)) and (together[at:at + n] == alone).all()
        at += n


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(70)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5)]
    found = {r.node: r.component for r in cc.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {**{i: 0 for i in range(71)}, **{k: 1000 for k in range(1000, 1100)}}


def test_one_of_each_keeps_one_document_per_group(awkward):
    kept = op.one_of_each(awkward, 5)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect() if r.doc_id is not None)
    assert [i for i, _ in ids] == [-5, 1, 3, 4, 5, 6, 8, 10, 11]


def test_chance_of_a_miss_at_any_depth():
    assert len(op.SECOND) == op.LEVELS
    assert all(op.missed(k) < 0.0002 for k in range(op.LEVELS + 1))


def test_small_leaves_against_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(op, "LEAF", 12)  # nodes are compared whole, in chunks, and after branching
    rows = [(i, t) for i, t in enumerate(variants(prose(7, 100), 60, 4, 99))]
    shared = prose(8, 80)
    for k in range(60):  # a template family below the threshold, each with a pair above it
        own = shared + " " + prose(1000 + k, 25)
        rows += [(1000 + k, own), (2000 + k, own.rsplit(" ", 1)[0] + " end")]
    check(make_docs(rows))


def test_components_in_a_block_and_in_rounds(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(80)] + [(i, i + 1) for i in range(200, 230)]
    links = spark.createDataFrame(edges, "src long, dst long")

    def found(group):
        spark.sparkContext.setJobGroup(group, group)
        rows = sorted(map(tuple, cc.components(links).collect()))
        return rows, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    rows, jobs = found("block")
    monkeypatch.setattr(cc, "BLOCK_LINKS", 0)
    in_rounds, more = found("rounds")
    spark.sparkContext.setJobGroup("other", "other")
    assert rows == in_rounds and jobs < 12 < more


def test_a_sketch_keeps_half_a_byte_of_each_fine_token():
    texts = variants(prose(5, 300), 12, 40, 3) + [prose(900 + k, 300) for k in range(8)]
    batch = pa.record_batch([pa.array(range(20)), pa.array(texts), pa.array(range(20))], names=["doc_id", "text", "tag"])
    sketch = op._sketch(batch, 4).column("sketch")
    assert {len(x) for x in sketch.to_pylist()} == {2 * 128 + 384 // 2}
    pairs = list(combinations(range(20), 2))
    sets = [shingle_set(t) for t in texts]
    share = [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in pairs]
    i, j = (op.np.array(x) for x in zip(*pairs, strict=True))
    ok = op.similar(op._matrix(sketch), i, op._matrix(sketch), j)
    assert all(o for o, s in zip(ok, share, strict=True) if s >= 0.8) and not any(o for o, s in zip(ok, share, strict=True) if s < 0.6)


def test_pairs_below_the_threshold_are_not_made_rows(make_docs, monkeypatch):
    texts = variants(prose(7, 400), 150, 0, 1)
    rng = random.Random(11)
    for k, t in enumerate(texts):  # one family: any two share about three quarters of their shingles
        words = t.split()
        for at in rng.sample(range(0, 400, 4), 7):
            words[at] = f"own{k}x{at}"
        texts[k] = " ".join(words)
    texts += [t.rsplit(" ", 1)[0] + " end" for t in texts[::10]]  # and some links
    found, across = [], op.across_components
    monkeypatch.setattr(op, "across_components", lambda *a: found.append(across(*a)) or found[0])
    check(make_docs(list(enumerate(texts))))
    sets = [shingle_set(t) for t in texts]
    close = sum(len(a & b) >= 0.74 * len(a | b) for a, b in combinations(sets, 2))
    assert close > 3 * len(op.ROOTS) * len(texts)
    assert 0 < found[0].count() <= len(op.ROOTS) * len(texts)


def test_groups_are_confirmed_whole_wherever_batches_part_them():
    texts = [prose(5, 100), prose(5, 100) + " a", prose(5, 99), prose(6, 100), prose(6, 100) + " b"]
    values, sizes = op.shingles(pa.array(texts), 4)
    ends = sizes.cumsum()
    items = [values[e - n:e].tobytes() for e, n in zip(ends, sizes, strict=True)]
    partners = [[11, 12, 13], [12], [], [10, 14], []]  # 11 and 12 have been joined by way of 10
    rows = []
    for path, chunk in [(1, 0), (1, 1), (7, 0)]:
        rows += [(path, chunk, 10 + k, 10 + k, partners[k], items[k]) for k in range(5)]
    names = ["path", "chunk", "node", "component", "partners", "items"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    for size in (1, 2, 4, 5, 7, 15):
        batches = [whole.slice(a, size) for a in range(0, 15, size)]
        got = pa.Table.from_batches(list(op._confirm_groups(iter(batches)))).to_pylist()
        assert [(r["src"], r["dst"]) for r in got] == [(11, 10), (12, 10), (14, 13)] * 3
    assert list(op._confirm_groups(iter([whole.slice(0, 0)]))) == []
