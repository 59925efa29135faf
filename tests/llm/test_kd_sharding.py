import zlib
from collections import defaultdict

from coffer.llm import kd_sharding as op

from .conftest import prose


def check(docs, shards):
    rows = op.shard(docs, shards).collect()
    texts = [(r.text or "").encode() for r in docs.select("text").collect()]
    assert sorted((r["size"], r.text_crc32) for r in rows) == sorted((len(t) + 16, zlib.crc32(t)) for t in texts)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_sizes_are_near_equal_with_a_hot_source(make_docs):
    docs = make_docs([(i, prose(i, 5 + i % 40), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(2000)])
    sizes = check(docs, 40)
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and max(sizes.values()) < 1.15 * mean and min(sizes.values()) > 0.85 * mean


def test_shard_numbers_that_are_no_power_of_two(make_docs):
    docs = make_docs([(i, "x" * 100) for i in range(700)])
    sizes = check(docs, 7)
    assert max(sizes.values()) - min(sizes.values()) <= 4 * 116


def test_awkward_rows(awkward, no_docs, make_docs):
    check(awkward, 40)
    check(awkward, 1)
    assert op.shard(no_docs, 40).count() == 0
    check(make_docs([(7, "same")] * 50), 40)
    check(make_docs([(i, "a") for i in range(3)]).drop("source", "lang"), 40)


def test_target_bytes_give_the_number_of_shards(make_docs):
    assert op.shards_for(op.metadata(make_docs([(i, "x" * 84) for i in range(100)])), 1000) == 10
