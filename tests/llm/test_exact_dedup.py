import hashlib
import re

import numpy as np
from coffer.llm import exact_dedup as op
from pyspark.sql import functions as F


def test_hash_is_minimal_perfect_and_rejects_others():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(3000)), np.uint8).reshape(-1, 32)
    members, others = digests[:2000], digests[2000:]
    sizes, bits, order = op.build_hash(members)
    assert bits.sum() == 2000
    slots = op.slots_of(members, sizes, bits, 2000)
    assert sorted(slots) == list(range(2000))
    assert (members[order][slots] == members).all()
    probed = op.slots_of(others, sizes, bits, 2000)
    hit = probed >= 0
    assert not (members[order][probed[hit]] == others[hit]).all(axis=1).any()


def brute(rows):
    groups = {}
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(key, []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[key], key=lambda g: g[:3])[3]
        out.append((i, best, len(groups[key]), i == best, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs, history):
    rows = op.keyed(docs)
    found = op.dedup(rows.where(history), rows.where(~history))
    got = sorted((tuple(r)[:5] for r in found.collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    return found


def test_any_split_gives_the_same_groups(awkward):
    for history in (F.lit(True), F.lit(False), F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)), F.coalesce(F.col("doc_id") < 5, F.lit(True))):
        check(awkward, history)


def test_known_marks_digests_of_history(make_docs):
    docs = make_docs([(1, "a b"), (2, "ab"), (3, "c"), (4, "a  b"), (5, "d")])
    known = {r.doc_id: r.known for r in check(docs, F.col("doc_id") <= 2).collect()}
    assert known == {1: True, 2: True, 4: True, 3: False, 5: False}


def test_a_hot_group_and_an_empty_table(make_docs, no_docs):
    check(make_docs([(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(900)]), F.col("doc_id") < 400)
    check(no_docs, F.lit(True))
