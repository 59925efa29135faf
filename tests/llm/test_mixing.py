from collections import Counter, defaultdict

from coffer.llm import source_mixing as op

from .conftest import prose


def test_schedule_deviates_by_less_than_a_block():
    slots = op.slots_per_period({"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05, "e": 1e-9}, 1000)
    assert sum(slots.values()) == 1000 and slots["e"] == 1
    had = Counter()
    plan = op.schedule(slots)
    assert [s for _, _, s in plan] == list(range(1000))
    for k, j, slot in plan:
        assert j == had[k] and j * 1000 // slots[k] <= slot < -(-(j + 1) * 1000 // slots[k])
        had[k] += 1
        assert all(abs(had[s] - slots[s] * (slot + 1) / 1000) < 1 for s in slots)
    assert op.slots_per_period({"a": 0.0}) == {} and op.schedule({}) == []


def test_mix_holds_the_weights_on_documents(make_docs):
    docs = make_docs([(i, prose(i, 30), "en", "hot" if i % 3 else f"s{i % 2}") for i in range(3000)])
    weights = {"hot": 2, "s0": 1, "s1": 1}
    rows = op.mix(docs, weights, block_bytes=2000, period=64).collect()
    assert len(rows) == 3000 and len({r.doc_id for r in rows}) == 3000
    taken = {(r.source, r.block): r.slot for r in rows if r.in_mix}
    assert len(set(taken.values())) == len(taken) == max(taken.values()) + 1
    by_slot, had = {slot: s for (s, _), slot in taken.items()}, Counter()
    for slot in range(len(taken)):
        had[by_slot[slot]] += 1
        assert all(abs(had[s] - w / 4 * (slot + 1)) < 1 for s, w in weights.items())
    left = defaultdict(int)
    for r in rows:
        left[r.source] += not r.in_mix
    assert min(left.values()) == 0 < max(left.values())


def test_awkward_rows(awkward, no_docs):
    rows = op.mix(awkward, block_bytes=500).collect()
    assert len(rows) == awkward.count() and None in {r.source for r in rows}
    some = op.mix(awkward, {"a": 1, None: 1, "absent": 3}, block_bytes=500).collect()
    assert {r.source for r in some if r.slot is not None} == {"a", None}
    assert not any(r.in_mix for r in some if r.source in ("b", "c"))
    assert op.mix(no_docs).count() == 0
    assert not any(r.slot is not None for r in op.mix(awkward, {"absent": 1}).collect())


def test_slots_of_a_period():
    assert op.slots_per_period({"a": 2, "b": 1, "c": 1}, 64) == {"a": 32, "b": 16, "c": 16}
    many = op.slots_per_period({"a": 1.0, **{f"s{k}": 1e-9 for k in range(100)}}, 1000)
    assert many["a"] == 900 and sum(many.values()) == 1000
    crowd = op.slots_per_period({k: 1 + k % 2 for k in range(3000)}, 1000)
    assert sum(crowd.values()) == 3000 and min(crowd.values()) == 1


def test_thousands_of_sources_leave_the_targets_as_they_are(make_docs, monkeypatch):
    monkeypatch.setattr(op, "UNITS", 64)
    monkeypatch.setattr(op, "GROUP", 50)
    docs = make_docs([(i, "x" * 84, "en", "hot" if i < 1500 else "warm" if i < 2000 else f"site{i % 1000}") for i in range(6000)])
    weights = {"hot": 0.25, "warm": 0.1, **{f"site{k}": 0.65 / 1000 for k in range(1000)}}
    rows = op.mix(docs, weights, block_bytes=100, period=512).collect()
    slot_of = {(r.source, r.block): r.slot for r in rows}
    assert len(rows) == 6000 == len(slot_of) == len(set(slot_of.values()))
    by_slot = {slot: s for (s, _), slot in slot_of.items()}
    end = next(k for k in range(len(by_slot) + 1) if k not in by_slot)
    assert end > 2000 and all(r.in_mix == (r.slot < end) for r in rows)
    had, sites = Counter(), 0
    for slot in range(end):
        had[by_slot[slot]] += 1
        sites += by_slot[slot].startswith("site")
        # shares of 512 slots are whole for none of them: half a slot of rounding per period beside the block
        drift = 1 + (slot // 512 + 1) / 2
        assert abs(had["hot"] - 0.25 * (slot + 1)) < drift and abs(had["warm"] - 0.1 * (slot + 1)) < drift
    # every group deals its turns evenly: no site is two blocks ahead of its share of all slots
    assert sites == sum(had[f"site{k}"] for k in range(1000))
    assert all(abs(had[f"site{k}"] - 0.65 / 1000 * end) < 2 for k in range(1000))


def test_stage_keeps_every_document_when_a_source_runs_dry(make_docs):
    # one block of "typo", three larger sources over many periods
    docs = make_docs([(-1, "one small text", "en", "typo")] + [
        (i, prose(i, 30), "en", "hot" if i % 3 else f"s{i % 2}") for i in range(3000)
    ])
    options = {"block_bytes": 2000, "period": 16}
    rows = op.mix(docs, **options).collect()
    slot = {r.doc_id: r.slot for r in rows}
    assert max(slot.values()) > 10 * 16 and sum(r.in_mix for r in rows) < 1000
    got = [r.doc_id for r in op.in_order(docs, **options).collect()]
    assert sorted(got) == sorted(slot) and [slot[i] for i in got] == sorted(slot.values())
    # brute force: each period again, block by block, without the blocks that a source does not have
    blocks = {k: max(r.block for r in rows if r.source == k) + 1 for k in ("typo", "hot", "s0", "s1")}
    sizes = {k: sum(len(prose(i, 30).encode()) + op.ROW_BYTES for i in range(3000) if ("hot" if i % 3 else f"s{i % 2}") == k) for k in blocks}
    sizes["typo"] = len("one small text") + op.ROW_BYTES
    slots = op.slots_per_period({k: n ** op.TEMPERATURE for k, n in sizes.items()}, 16)
    plan, had, want = op.schedule(slots), Counter(), {}
    for turn in range(max(blocks.values()) + 1):
        for k, _, at in plan:
            if had[k] < blocks[k]:
                want[k, had[k]] = turn * 16 + at
            had[k] += 1
    assert {(r.source, r.block): r.slot for r in rows} == want
    # once "typo" is dry, those that are left are within two blocks each of their renormalised weights
    dry = sorted((s, k) for (k, _), s in want.items())
    dry = dry[[k for _, k in dry].index("typo") + 1:]
    end = min(max(s for s, k in dry if k == one) for one in ("hot", "s0", "s1"))
    left, total, seen = sum(slots.values()) - slots["typo"], 0, Counter()
    for s, k in dry:
        if s > end:
            break
        seen[k], total = seen[k] + 1, total + 1
        assert all(abs(seen[one] - slots[one] / left * total) < 4 for one in ("hot", "s0", "s1"))


def test_in_order_on_awkward_rows(awkward, no_docs):
    assert sorted(map(str, op.in_order(awkward, block_bytes=500).collect())) == sorted(map(str, awkward.collect()))
    assert op.in_order(no_docs).count() == 0


def test_the_schedule_needs_no_python_worker(spark, make_docs):
    placed = op.blocks(make_docs([(i, prose(i, 9), "en", f"s{i % 3}") for i in range(60)]), 500)
    timed = op.block_slots(spark, placed, op.weighed(placed, None, 1.0), 64)
    plan = timed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation [unit#") == 2
