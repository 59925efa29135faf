"""Operators on embeddings against plain numpy."""

import hashlib

import numpy as np
import pytest
from coffer.llm import bidiagonal, code_compression, embedding_whitening, vectors
from hypothesis import given, settings
from hypothesis import strategies as st

SCHEMA = "vec_id long, embedding array<float>, label int, x string, codes string, distances int, error string, part int, n int, whitened int"


@pytest.fixture(scope="module")
def make(spark):
    def rows(items):
        return spark.createDataFrame([(*r, "y", "y", 1, "y", 1, 1, 1) for r in items], SCHEMA)

    return rows


def sample(seed, n, width=32):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(v) for v in rng.normal(0, 0.2, width)], int(rng.integers(5))) for k in rng.permutation(n)]


AWKWARD = [
    (900, None, 1), (901, [None] + [0.5] * 31, 1), (902, [float("nan")] + [0.5] * 31, 1), (903, [float("inf")] * 32, 2), (904, [], 1),
    (None, [0.25] * 32, None), (None, [-0.0] * 32, None), (905, [0.25] * 32, None), (905, [0.25] * 32, 3), (-7, [-1.003] * 32, 3),
]


def scaled(rows):
    return [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v], label) for i, v, label in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]


def lloyd(rows, parts, entries, rounds):
    """Full scans in every round."""
    kept = sorted(scaled(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([r[1] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        codes, best = far.argmin(2), far.min(2)
        for p in range(parts if k < rounds else 0):
            for e in range(books.shape[1]):
                if (codes[:, p] == e).any():
                    books[p, e] = x[codes[:, p] == e, p].sum(0) // (codes[:, p] == e).sum()
    return sorted((str(r[0]), str(r[2]), bytes(c.tolist()).hex(), int(b.sum())) for r, c, b in zip(kept, codes, best)), books


def coded(rows, *args):
    found, books = code_compression.compress(rows, *args)
    return sorted((str(r.vec_id), str(r.label), bytes(r.codes).hex(), r.error) for r in found.collect()), books


@pytest.mark.parametrize("parts, entries, rounds", [(16, 64, 2), (4, 7, 5), (32, 3, 0), (1, 200, 1)])
def test_codes_against_full_scans(make, parts, entries, rounds):
    rows = sample(3, 300) + AWKWARD
    got, books = coded(make(rows), parts, entries, rounds)
    want, want_books = lloyd(rows, parts, entries, rounds)
    assert got == want and (books == want_books).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3), st.booleans(), st.integers(-1, 1)), min_size=1, max_size=8))
def test_active_entries_give_the_codes_of_a_full_scan(points, entries):
    x, books = np.array(points, np.int64), np.array([e[:2] for e in entries], np.int64)
    codes, far = code_compression._nearest(x, books)
    new = books + np.array([[e[3], -e[3]] if e[2] else [0, 0] for e in entries], np.int64)
    moved = (new != books).any(1)
    got = code_compression.reassign(x, new, moved, codes, far)
    want = code_compression._nearest(x, new)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_codebooks_of_ties_few_rows_and_none(make):
    rows = [(k, [0.5] * 16, 1) for k in range(5)]
    got, books = coded(make(rows), 4, 64, 2)
    assert {r[2] for r in got} == {"00000000"} and books.shape == (4, 5, 4) and {r[3] for r in got} == {0}
    found, books = code_compression.compress(make(AWKWARD[:5]))
    assert found.count() == 0 and books.size == 0
    assert code_compression.digest(np.array([[[1, -2]], [[3, 4]]])) == hashlib.sha256(b"1,-2,3,4").hexdigest()
    for bad in ([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], [(1, [0.5] * 15, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(Exception, match="components|exactly"):
            code_compression.compress(make(bad))[0].collect()


def test_query_columns(make, spark, tmp_path):
    make(sample(5, 80) + AWKWARD).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = code_compression.op12_code_compression(spark, str(tmp_path)).collect()
    want, books = lloyd(sample(5, 80) + AWKWARD, 16, 64, 2)
    total = {}
    for _, label, _, error in want:
        total[label] = total.get(label, 0) + error
    assert {r.codebooks_sha256 for r in rows} == {code_compression.digest(books)}
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in rows)
    assert got == sorted((i, c, e, total[label]) for i, label, c, e in want)


def check_whitening(spark, tmp_path, make, rows, components=4):
    make(rows).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    got = embedding_whitening.op13_embedding_whitening(spark, str(tmp_path)).collect()
    kept = scaled(rows)
    fit = np.array(sorted({tuple(r[1]) for r in kept}), float)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1][:components], vectors[:, ::-1][:, :components]
    k = int((e > 1e-9 * max(e[0], 1e-300)).sum()) if n > 1 else 0
    assert len(got) == len(kept) * k
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    signs = [None] * k
    for i, x, _ in kept:
        x = np.array(x, float)
        deviation = sum((n * int(v) - int(s)) ** 2 for v, s in zip(x, sums))
        for c in range(k):
            want = (x - sums / n) @ vectors[:, c] / np.sqrt(e[c])
            for r in by_id[i, deviation][c + 1]:
                if signs[c] is None and abs(want) > 1e-3:
                    signs[c] = np.sign(want * r.whitened)
                assert any(abs(y.whitened * (signs[c] or 1) - want) < 1e-7 for y in by_id[i, deviation][c + 1])
                assert r.n == n and abs(r.explained * np.trace(centred.T @ centred / n) / e[c] - 1) < 1e-9 and r.identity_error < 1e-9
    return got


def test_whitening_against_eigh(spark, tmp_path, make):
    scale = np.linspace(3, 0.5, 32)
    rows = [(i, [float(a) for a in np.array(v) * scale], label) for i, v, label in sample(11, 200)]
    check_whitening(spark, tmp_path, make, rows + AWKWARD + [(5000 + k, rows[0][1], 0) for k in range(100)])


def test_whitening_of_few_dimensions(spark, tmp_path, make):
    rng = np.random.default_rng(2)
    line = [(k, [float(v) for v in np.outer(rng.normal(size=1), np.arange(8) * 32 / 256)[0].round(2)], 1) for k in range(1)]
    check_whitening(spark, tmp_path, make, line * 30)  # a single distinct vector: no components, no rows
    plane = [(k, [k % 7 / 256, k % 5 / 128, 1.0, 0.0], 1) for k in range(35)]
    check_whitening(spark, tmp_path, make, plane)
    assert check_whitening(spark, tmp_path, make, [(1, [0.5], 1), (2, [0.25], 1)])
    make([]).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    assert embedding_whitening.op13_embedding_whitening(spark, str(tmp_path)).count() == 0


def test_blocks_are_merged_in_levels(spark, make):
    rows = make([(i, v, label) for i, v, label in sample(4, 500, 6)])
    fit = embedding_whitening.distinct_vectors(vectors.whole_vectors(rows)).repartition(40).checkpoint()
    found = embedding_whitening.learn(fit)
    x = np.array([r.x for r in fit.collect()], float)
    e = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.allclose(found.eigenvalues, e[:4], rtol=1e-12) and np.isclose(found.trace, e.sum()) and found.n == len(x)


def test_deviations_beyond_64_bits(spark, make):
    big = embedding_whitening.Whitening(2**40, np.array([2**44, 7], object), 1.0, np.ones(1), np.ones((2, 1)))
    rows = vectors.whole_vectors(make([(1, [40.0, -40.0], 1), (2, [16 / 256, 0.0], 1)]))
    got = {r.vec_id: r.deviation for r in embedding_whitening.whitened(rows, big).collect()}
    assert got == {1: None, 2: 49}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 24), st.integers(0, 5), st.integers(0, 10**6))
def test_bidiagonal_solver_against_svd(n, kind, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, n))
    if kind == 1:
        a = np.triu(rng.integers(-1, 2, (n, n))).astype(float)
    if kind == 2:
        a = np.outer(a[0], a[-1])
    if kind == 3:
        a = np.triu(a) * np.logspace(0, -25, n)
    if kind == 4:
        a = np.diag(np.repeat([3.0, 2.0], [n // 2, n - n // 2]))
    if kind == 5:
        a = np.linalg.qr(a)[0] * np.repeat([3.0, 2.0], [n // 2, n - n // 2]) @ np.linalg.qr(rng.normal(size=(n, n)))[0]
    values, vectors_ = bidiagonal.leading(a, 4)
    want = np.linalg.svd(a)[1][:4] ** 2
    k = len(values)
    scale = max(want[0], 1e-300)
    assert np.allclose(values / scale, want[:k] / scale, atol=1e-13) and (want[k:] <= 1e-25 * scale).all()
    assert np.allclose(vectors_.T @ vectors_, np.eye(k), atol=1e-12)
    assert np.allclose(a.T @ (a @ vectors_) / scale, vectors_ * (values / scale), atol=1e-12)


def test_squared_singular_values_are_accurate_each():
    """dqds keeps the relative accuracy of the least value of a graded bidiagonal, as the product of all shows."""
    diagonal, above = np.logspace(0, -12, 13), np.logspace(-1, -12, 12)
    found = bidiagonal.squared_singular_values(diagonal, above)
    assert len(found) == 13 and abs(np.log(found).sum() - 2 * np.log(diagonal).sum()) < 1e-10
