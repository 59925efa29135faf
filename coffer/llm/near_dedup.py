"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Documents of equal sets are one node. A node has ``COORDINATES`` minwise tokens; a
tree branches its members by selected ones: the root selects one or two coordinates, every member goes to the
child of its token there, and children branch again as their own path selects. 5 / 4 coordinates are selected on
average, so a pair at the threshold of 0.8 meets in one child per branching as a mean, and pairs below it die out.
``TREES`` independent trees make up for those that part: a pair at the threshold misses each other in all of them with a
probability of less than 0.0001 after three branchings. Nodes that branch further select more coordinates (``SECOND``), which
keeps it under 0.0002 after any number of branchings up to ``LEVELS``; ``missed`` computes it.

Members of a tree node are compared as follows, so that a hot group never means all pairs:

1. All members of a root child are compared with two of them, drawn anew in each child. What is linked is confirmed on
   the full sets and joined to components.
2. A node all of whose members are in one component is settled. One of few members is compared exhaustively, across
   components. One in which all but a few members are in one component is compared in chunks: each chunk holds part of
   that component and all the others. Any other node branches again.

Comparison is by the minwise tokens and then by ``FINE`` further ones, with a margin of four standard deviations; what passes
is confirmed on the full sets, for which only the texts of those nodes are read again. A family of texts just below the
threshold has as many such pairs as the square of its size, so the pairs found in 2 are not made rows: a member goes with its
set, and a list of its partners, to each group where it has any, and the group is confirmed there as a whole.
A pair that meets in several trees is passed on by the first root child only in which it was compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import blocks_of, cut, documents, give_back, mix64, text_of, words_of
from coffer.llm.components import components

SHINGLE_WORDS = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
COORDINATES, TREES = 128, 10
#: Further tokens, half a byte each, that only tell close pairs apart.
FINE, FINE_VALUES = 384, 16
SKETCH_BYTES = 2 * COORDINATES + FINE // 2
#: Members of a tree node that are compared exhaustively by one task: what a row costs there at most.
LEAF = 1024
#: Pairs whose sketches are compared at once.
PAIR_BLOCK = 32_768
#: Branchings after which what is left is compared in pairs of blocks.
LEVELS = 10
#: Share of nodes that select a second coordinate, in quarters, at each branching.
SECOND = (1, 1, 1, 4, 4, 4, 2, 2, 2, 2)
#: Nodes whose sets are sought by sending their keys to all tasks; beyond it by a shuffle.
SENT_KEYS = 200_000
#: Texts hashed together; a shingle keeps 52 bits beside the number of its text.
GROUP_TEXTS, HASH_BITS = 4096, 52
#: UTF-8 bytes of text hashed together, at most, unless one text has more.
SKETCHED_BYTES = 2_000_000

_DRAW = np.random.default_rng(20_240_229)
MULTIPLIERS = _DRAW.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FINE_MULTIPLIERS = _DRAW.integers(0, 1 << 31, FINE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
#: (tree, coordinate) selected at the roots: one each, and a second one in every fourth tree.
ROOTS = [(t, t) for t in range(TREES)] + [(t, TREES + t) for t in range(0, TREES, 4)]


def missed(branchings: int, similarity: float = PERCENT / 100) -> float:
    """Probability that a pair meets in no child of any tree after so many branchings."""
    apart = 0.0
    for quarters in reversed(SECOND[:branchings]):
        one = 1 - similarity + similarity * apart
        apart = (1 - quarters / 4) * one + quarters / 4 * one * one
    return (1 - similarity + similarity * apart) ** len(ROOTS)


def shingles(texts: pa.Array, words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of at most ``GROUP_TEXTS`` texts, one text after another, and how many each has."""
    codes, counts, distinct = words_of(pc.ascii_lower(texts))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    word = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    text_no = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(len(word))  # words from here to the text's end
    parts = []
    for n in range(1, words_each + 1):
        # a text of n words has one shingle of n words, unless n is the full length
        at = np.flatnonzero(left >= n) if n == words_each else np.flatnonzero((left == n) & (np.repeat(counts, counts) == n))
        value = np.full(len(at), n, np.uint64)
        for k in range(n):
            value = mix64(value ^ word[at + k])
        parts.append((text_no[at].astype(np.uint64) << np.uint64(HASH_BITS)) | (value >> np.uint64(64 - HASH_BITS)))
    keys = np.sort(np.concatenate(parts))
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
    per_text = np.bincount((keys >> np.uint64(HASH_BITS)).astype(np.int64), minlength=len(texts))
    return keys & np.uint64((1 << HASH_BITS) - 1), per_text


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks_of(batch, block_bytes=SKETCHED_BYTES):
            for start in range(0, block.num_rows, GROUP_TEXTS):
                yield block.slice(start, GROUP_TEXTS)
        give_back()


SKETCH_SCHEMA = "doc_id long, tag long, n_shingles long, set_a long, set_b long, paths array<long>, sketch binary"


def _sketch(batch: pa.RecordBatch, words_each: int) -> pa.RecordBatch:
    values, sizes = shingles(batch.column(1), words_each)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    n = batch.num_rows
    mixed = mix64(values)
    set_a, set_b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    tokens = np.zeros((n, COORDINATES), np.uint64)
    if len(full):
        set_a[full] = np.add.reduceat(mix64(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
        set_b[full] = np.add.reduceat(mix64(values ^ np.uint64(0x14057B7EF767814F)), starts)
        for k, multiplier in enumerate(MULTIPLIERS):
            tokens[full, k] = np.minimum.reduceat(mixed * multiplier, starts)
    paths = np.column_stack([mix64(mix64(tokens[:, c]) + np.uint64(t * COORDINATES + c + 1)) for t, c in ROOTS])
    width = len(ROOTS)
    fine = np.zeros((n, FINE), np.uint8)
    if len(full):
        half = (mixed >> np.uint64(32)).astype(np.uint32)
        for k, multiplier in enumerate(FINE_MULTIPLIERS):
            fine[full, k] = (np.minimum.reduceat(half * multiplier, starts) >> np.uint32(5)) % np.uint32(FINE_VALUES)
    coarse = ((tokens >> np.uint64(9)) & np.uint64(0xFFFF)).astype("<u2")
    sketch = np.hstack([coarse.view(np.uint8), fine[:, ::2] | (fine[:, 1::2] << 4)])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(2), pa.array(sizes.astype(np.int64)), pa.array(set_a.view(np.int64)),
         pa.array(set_b.view(np.int64)),
         pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), pa.array(paths.reshape(-1).view(np.int64))),
         pa.array([row.tobytes() for row in sketch], pa.binary())],
        names=[c.split()[0] for c in SKETCH_SCHEMA.split(", ")],
    )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("tag"))


def sketches(docs: DataFrame, words_each: int) -> DataFrame:
    return _rows(docs).mapInArrow(lambda batches: (_sketch(b, words_each) for b in _grouped(batches)), SKETCH_SCHEMA)


def _least(coordinates: int, fine: int = 0) -> float:
    """Equal tokens below which a pair is let go: four standard deviations less than the threshold has on average.

    Of the fine tokens that differ, one in ``FINE_VALUES`` is equal by chance.
    """
    share = PERCENT / 100
    by_half = share + (1 - share) / FINE_VALUES
    spread = math.sqrt(coordinates * share * (1 - share) + fine * by_half * (1 - by_half))
    return coordinates * share + fine * by_half - 4 * spread


Sketches = tuple[np.ndarray, np.ndarray]


def similar(one: Sketches, i: np.ndarray, other: Sketches, j: np.ndarray) -> np.ndarray:
    """Marks the pairs of rows i and j that may reach the threshold; misses one at it with a chance of about 6e-5.

    The fine tokens are looked at only where the others agree enough.
    """
    equal = (one[0][i] == other[0][j]).sum(axis=1)
    ok = equal >= _least(COORDINATES)
    at = np.flatnonzero(ok)
    differ = one[1][i[at]] ^ other[1][j[at]]
    fine = ((differ & 15) == 0).sum(axis=1) + (differ < 16).sum(axis=1)
    ok[at] = equal[at] + fine >= _least(COORDINATES, FINE)
    return ok


def _matrix(column: pa.Array) -> Sketches:
    """16-bit tokens and fine tokens, two a byte, of each row."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH_BYTES)
    return np.ascontiguousarray(raw[:, : 2 * COORDINATES]).view("<u2"), raw[:, 2 * COORDINATES :]


PAIRS = "src long, dst long"


def _pair_batch(src: np.ndarray, dst: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])


def _sketched(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose sketches may reach the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.arange(batch.num_rows)
            ok = similar(_matrix(batch.column(2)), rows, _matrix(batch.column(3)), rows)
            yield _pair_batch(batch.column(0).to_numpy()[ok], batch.column(1).to_numpy()[ok])

    one = nodes.select(F.col("node").alias("src"), F.col("sketch").alias("sketch_a"))
    other = nodes.select(F.col("node").alias("dst"), F.col("sketch").alias("sketch_b"))
    return pairs.join(one, "src").join(other, "dst").select("src", "dst", "sketch_a", "sketch_b").mapInArrow(keep, PAIRS)


ROOT_COORDINATES = np.array([c for _, c in ROOTS])
GROUP_COLUMNS = ("path", "chunk", "node", "component", "sketch", "root", "compared", "spread")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition sorted by (path, chunk), its first two columns, in batches that part no group."""
    held: list[pa.RecordBatch] = []  # a group may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        last = (batch.column(0)[-1], batch.column(1)[-1])
        path, chunk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        other = np.flatnonzero((path != last[0].as_py()) | (chunk != last[1].as_py()))
        whole = int(other[-1]) + 1 if len(other) else 0
        if whole:
            yield pa.concat_batches([*held, batch.slice(0, whole)])
            held = []
        elif held and (held[-1].column(0)[-1], held[-1].column(1)[-1]) != last:
            yield pa.concat_batches(held)
            held = []
        held.append(batch.slice(whole))
    if held:
        yield pa.concat_batches(held)


def _groups_in(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of sorted rows start, and their sizes."""
    path, chunk = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    start = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (chunk[1:] != chunk[:-1])])
    return start, np.diff(np.r_[start, len(path)])


PARTNERS = "path long, chunk int, node long, component long, partners array<long>"


def _exhaustive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of the groups (path, chunk) of a sorted partition that have similar ones in another component.

    Each such pair is listed once, among the ``partners`` of one of its two.
    ``root`` is the number of the root child a group comes from, ``compared`` has a bit for each root child of the row whose
    members were compared; a pair with the same token at an earlier one of those has been seen there. ``spread`` marks rows
    that stand in one chunk only; two that stand in all chunks are compared in the first.
    """
    for rows in _whole_groups(batches):
        chunk, node, comp = (rows.column(i).to_numpy() for i in (1, 2, 3))
        sketch = _matrix(rows.column(4))
        earlier = rows.column(6).to_numpy() & ((np.int64(1) << rows.column(5).to_numpy().astype(np.int64)) - 1)
        spread = rows.column(7).to_numpy(zero_copy_only=False)
        seen_at = (earlier[:, None] >> np.arange(len(ROOTS))) & 1 == 1
        tokens = sketch[0][:, ROOT_COORDINATES]
        start, size = _groups_in(rows)
        end = np.repeat(start + size, size)
        later = end - np.arange(len(node)) - 1
        src, dst, step = [], [], max(1, PAIR_BLOCK // int(size.max()))
        for a in range(0, len(node), step):  # each row with the later rows of its group
            n = later[a:a + step]
            i = np.repeat(np.arange(a, a + len(n)), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            across = (comp[i] != comp[j]) & (spread[i] | spread[j] | (chunk[i] == 0))
            i, j = i[across], j[across]
            ok = similar(sketch, i, sketch, j)
            i, j = i[ok], j[ok]
            fresh = ~((tokens[i] == tokens[j]) & seen_at[i]).any(axis=1)
            src.append(i[fresh])
            dst.append(j[fresh])
        src, dst = np.concatenate(src), np.concatenate(dst)  # src ascends
        at = np.unique(np.r_[src, dst])
        ends = np.cumsum(np.bincount(src, minlength=len(node))[at])
        partners = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(node[dst], pa.int64()))
        columns = [rows.column(k).take(pa.array(at, pa.int64())) for k in range(4)]
        yield pa.RecordBatch.from_arrays([*columns, partners], names=["path", "chunk", "node", "component", "partners"])


def _compared(groups: DataFrame) -> DataFrame:
    """``groups`` has the columns ``GROUP_COLUMNS``; no group has more than a few times ``LEAF`` rows."""
    dealt = groups.select(*GROUP_COLUMNS).repartition("path", "chunk")
    return dealt.sortWithinPartitions("path", "chunk").mapInArrow(_exhaustive, PARTNERS)


def _branch(batches: Iterator[pa.RecordBatch], quarters: int) -> Iterator[pa.RecordBatch]:
    """Children of each row's tree node: one, or in so many quarters of the nodes two, coordinates that the path selects."""
    for batch in batches:
        path = batch.column(0).to_numpy().view(np.uint64)
        sketch, _ = _matrix(batch.column(3))
        chosen = mix64(path + np.uint64(0x2545F4914F6CDD1D))
        for turn in range(2):
            at = np.flatnonzero((chosen >> np.uint64(40)) % np.uint64(4) < quarters) if turn else np.arange(len(path))
            coordinate = (chosen[at] >> np.uint64(16 * turn)) % np.uint64(COORDINATES)
            token = sketch[at, coordinate.astype(np.int64)].astype(np.uint64)
            child = mix64(path[at] ^ mix64((coordinate << np.uint64(16)) + token + np.uint64(1)))
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), *rows.columns[1:]],
                names=["path", "node", "component", "sketch", "compared"],
            )


MEMBERS = "path long, node long, component long, sketch binary, compared long"


def _unsettled(members: DataFrame) -> DataFrame:
    """Tree nodes with several components: their size, largest component, and in how many chunks to compare them.

    ``chunks`` is null where the node has to branch.
    """
    sizes = members.groupBy("path", "component").agg(F.count("*").alias("n")).groupBy("path").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top")
    )
    chunks = F.when(F.col("n") <= LEAF, 1).when(F.col("n") - F.col("top.n") <= LEAF, F.ceil(F.col("top.n") / LEAF))
    return sizes.where("n > top.n").select("path", "n", F.col("top.component").alias("top"), chunks.cast("int").alias("chunks"))


def across_components(placed: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Similar pairs between components, as ``PARTNERS``; ``placed`` has the members of the root children: path, root, node, component.

    None where every root child is settled. Nodes that are settled are left out before anything is joined to a sketch.
    """
    unsettled = cut(_unsettled(placed))
    found, members = None, placed
    for level in range(LEVELS + 1):
        open_paths, small_paths = unsettled.agg(F.count(F.when(F.col("chunks").isNull(), 1)), F.count("chunks")).first()
        if not open_paths + small_paths:
            break
        rows = members.join(unsettled, "path")
        if level == 0:
            bit = F.when(F.col("chunks").isNotNull(), F.expr("shiftleft(1L, root)")).otherwise(F.lit(0))
            seen = rows.groupBy("node").agg(F.bit_or(bit).alias("compared"))
            rows = rows.join(seen, "node").join(nodes.select("node", "sketch"), "node")
        open_nodes = cut(rows)
        leaves = open_nodes.where("chunks is not null")
        spread = (F.col("component") == F.col("top")) | (F.col("chunks") == 1)
        own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
        place = F.when(spread, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
        pairs = [_compared(leaves.withColumn("spread", spread).withColumn("chunk", F.explode(place)))] if small_paths else []
        rest = open_nodes.where("chunks is null")
        if open_paths and level == LEVELS:
            n_blocks = F.ceil(F.col("n") / LEAF).cast("int")
            block = F.pmod(F.xxhash64("node"), n_blocks).cast("int")
            pair = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda j: F.least(j, block) * n_blocks + F.greatest(j, block))
            pairs.append(_compared(rest.withColumn("spread", F.lit(True)).withColumn("chunk", F.explode(pair))))
        for pair in pairs:
            found = pair if found is None else found.unionByName(pair)
        if not open_paths or level == LEVELS:
            break
        members = rest.select("path", "node", "component", "sketch", "compared").mapInArrow(
            partial(_branch, quarters=SECOND[level]), MEMBERS
        )
        members = cut(members.withColumn("root", F.lit(len(ROOTS))))
        unsettled = cut(_unsettled(members))
    return None if found is None else cut(found)


def _sets(batch: pa.RecordBatch, words_each: int) -> pa.RecordBatch:
    values, sizes = shingles(batch.column(1), words_each)
    ends = np.cumsum(sizes)
    parts = [values[e - n:e].tobytes() for e, n in zip(ends, sizes, strict=True)]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["node", "items"])


def _stored_sets(column: pa.Array) -> list[np.ndarray]:
    """The sets of a binary column, as views of its buffer."""
    _, ends, data = column.buffers()
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(ends, width)[column.offset:column.offset + len(column) + 1].tolist()
    raw = np.frombuffer(data or b"", np.uint8)
    return [raw[a:b].view(np.uint64) for a, b in zip(at[:-1], at[1:], strict=True)]


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [_linked(a, b) for a, b in zip(_stored_sets(batch.column(2)), _stored_sets(batch.column(3)), strict=True)]
        ok = np.array(ok, dtype=bool)
        yield _pair_batch(batch.column(0).to_numpy()[ok], batch.column(1).to_numpy()[ok])
        pa.default_memory_pool().release_unused()


def _sets_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, words_each: int) -> DataFrame:
    """node, items: the full sets of the nodes ``wanted``, made again from the texts of these nodes only."""
    keys = cut(nodes.join(wanted, "node").select("node", F.col("doc_id").alias("key_id"), F.col("tag").alias("key_tag")))
    near = F.broadcast(keys) if keys.count() <= SENT_KEYS else keys
    match = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("tag") == F.col("key_tag"))
    texts = _rows(docs).join(near, match).select("node", "text")
    sets = texts.mapInArrow(lambda batches: (_sets(b, words_each) for b in _grouped(batches)), "node long, items binary")
    return cut(sets.groupBy("node").agg(F.first("items").alias("items")))  # rows may repeat id and text


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words_each: int) -> DataFrame:
    """The pairs that are links on their full sets."""
    wanted = pairs.select(F.col("src").alias("node")).distinct().unionByName(pairs.select(F.col("dst").alias("node")).distinct()).distinct()
    sets = _sets_of(wanted, nodes, docs, words_each)
    one = sets.select(F.col("node").alias("src"), F.col("items").alias("items_a"))
    other = sets.select(F.col("node").alias("dst"), F.col("items").alias("items_b"))
    both = pairs.join(one, "src").join(other, "dst").select("src", "dst", "items_a", "items_b")
    return cut(both.mapInArrow(_confirm, PAIRS))


def _confirm_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the groups of a sorted partition, with ``PARTNERS`` and the sets; none between what others of it join."""
    for rows in _whole_groups(batches):
        node, comp = rows.column(2).to_numpy(), rows.column(3).to_pylist()
        partners, sets = rows.column(4), _stored_sets(rows.column(5))
        src, dst = [], []
        for a, n in zip(*(x.tolist() for x in _groups_in(rows)), strict=True):
            row_of = dict(zip(node[a:a + n].tolist(), range(a, a + n), strict=True))
            into: dict[int, int] = {}

            def component(c: int, into: dict[int, int] = into) -> int:
                while c in into:
                    c = into[c]
                return c

            for i in range(a, a + n):
                for j in map(row_of.__getitem__, partners[i].as_py()):
                    one, other = component(comp[i]), component(comp[j])
                    if one != other and _linked(sets[i], sets[j]):
                        into[max(one, other)] = min(one, other)
                        src.append(max(node[i], node[j]))
                        dst.append(min(node[i], node[j]))
        yield _pair_batch(np.array(src, np.int64), np.array(dst, np.int64))
        pa.default_memory_pool().release_unused()


def confirmed_in_groups(groups: DataFrame, nodes: DataFrame, docs: DataFrame, words_each: int) -> DataFrame:
    """Links on the full sets that join the components that the pairs of ``groups``, with ``PARTNERS``, join.

    A set is sent once to each group in which it has a partner, however many pairs there are.
    """
    sets = _sets_of(groups.select("node").distinct(), nodes, docs, words_each)
    dealt = groups.join(sets, "node").select("path", "chunk", "node", "component", "partners", "items").repartition("path", "chunk")
    return cut(dealt.sortWithinPartitions("path", "chunk").mapInArrow(_confirm_groups, PAIRS))


def _shared(nodes: DataFrame) -> DataFrame:
    """Members of root children with two nodes or more: path, root, node, the child's size ``n`` and two members drawn from it."""
    placed = nodes.select(F.posexplode("paths").alias("root", "path"), "node")
    order = F.xxhash64("path", "node")  # another pair in each child, so a large group is tied together by many of its members
    sizes = placed.groupBy("path").agg(
        F.count("*").alias("n"), F.min_by("node", order).alias("low"), F.max_by("node", order).alias("high")
    ).where("n > 1")
    return cut(placed.join(sizes, "path"))


def _tied(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of a member and a drawn one whose sketches may reach the threshold."""
    stars = shared.select("node", F.explode(F.array("low", "high")).alias("dst")).where("node <> dst")
    return _sketched(stars.select(F.greatest("node", "dst").alias("src"), F.least("node", "dst").alias("dst")).distinct(), nodes)


def _joined(nodes: DataFrame, known: DataFrame, links: DataFrame) -> DataFrame:
    """Components of the nodes after further links: only the components that a link meets are joined anew."""
    of = lambda end, name: known.select(F.col("node").alias(end), F.col("component").alias(name))
    between = links.join(of("src", "one"), "src", "left").join(of("dst", "other"), "dst", "left").select(
        F.coalesce("one", "src").alias("src"), F.coalesce("other", "dst").alias("dst")
    )
    merged = cut(components(between)).withColumnRenamed("component", "into")
    named = nodes.select("node").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return named.join(merged.withColumnRenamed("node", "component"), "component", "left").select(
        "node", F.coalesce("into", "component").alias("component")
    )


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, tag (hash of the text), n_shingles, component_id and kept of every row.

    Null, empty and blank texts have an empty set, are linked with nothing and stand for themselves. Rows that repeat id and
    text are linked and share a component; ``kept`` is then true for each. A null id is never the smallest: rows without id
    belong to the component of their text, with null only if no member has an id, and are kept only then.
    """
    rows = cut(sketches(docs, words_each))
    worded = rows.where("n_shingles > 0")
    of_set = ["n_shingles", "set_a", "set_b"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tag")).alias("first")
    nodes = cut(
        worded.groupBy(*of_set).agg(first, F.first("paths").alias("paths"), F.first("sketch").alias("sketch"))
        .select("*", F.col("first.doc_id").alias("doc_id"), F.col("first.tag").alias("tag"), F.monotonically_increasing_id().alias("node"))
        .drop("first")
    )
    shared = _shared(nodes)
    links = confirmed(cut(_tied(shared, nodes)), nodes, docs, words_each)
    known = cut(components(links))
    members = shared.where("n > 2").select("path", "root", "node").join(known, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    groups = across_components(members, nodes)
    if groups is not None:
        known = _joined(nodes, known, confirmed_in_groups(groups, nodes, docs, words_each))
    grouped = nodes.select("node", "doc_id", *of_set).join(known, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = cut(grouped.join(least, "component").select(*of_set, "component_id"))
    linked = worded.select("doc_id", "tag", *of_set).join(named, of_set)
    alone = rows.where("n_shingles = 0").select("doc_id", "tag", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "tag", "n_shingles", "component_id").unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, words_each: int) -> DataFrame:
    """The rows of ``docs`` that stay: of every group of near duplicates the document with the smallest id, once."""
    kept = cut(near_duplicates(docs, words_each).where("kept").groupBy("doc_id", "tag").agg(F.count("*").alias("n")))
    keys = kept.select(F.col("doc_id").alias("_key_id"), F.col("tag").alias("_key_tag"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_key_id")) & (F.xxhash64(text_of()) == F.col("_key_tag"))
    stay = docs.join(keys, same, "left_semi")
    return stay if kept.where("n > 1").isEmpty() else stay.dropDuplicates(["doc_id", "text"])


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("tag")
