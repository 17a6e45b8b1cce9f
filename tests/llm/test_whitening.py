"""Whitening against a dense eigensolver, and exact whole-number parts against Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from olapflow.llm import whitening
from olapflow.llm.queries import op12

FOLDER = "/root/testdata/sf0.001"


def dense(vectors, steps=256):
    """Distinct whole-number vectors, their mean, eigenvalues and eigenvectors by fall."""
    x = np.unique(np.floor(steps * np.array(vectors, np.float64)).astype(np.int64), axis=0)
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    return x, x.mean(axis=0), values[::-1], turn[:, ::-1]


def check(out, vectors_by_id, components):
    x, mean, values, turn = dense(list(vectors_by_id.values()))
    sums, n = [int(s) for s in x.sum(axis=0)], len(x)
    signs = {}
    for r in out:
        own = [math.floor(256 * float(np.float64(c))) for c in vectors_by_id[r.vec_id]]
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(own, sums, strict=True))
        k = r.component - 1
        want = float((np.array(own) - mean) @ turn[:, k]) / math.sqrt(values[k])
        if abs(want) > 1e-3:
            sign = signs.setdefault(k, np.sign(want) * np.sign(r.whitened))
            assert abs(r.whitened - sign * want) < 1e-8 * max(1, abs(want))
        assert abs(r.explained / (values[k] / values.sum()) - 1) < 1e-9
        assert r.identity_error < 1e-9
    assert len(out) == len(vectors_by_id) * components


def test_query_equals_dense_solver(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    check(op12(spark, FOLDER).collect(), {r.vec_id: r.embedding for r in rows}, 4)


def test_filter_converges_on_a_dense_spectrum(spark):
    rng = np.random.default_rng(5)
    scale = np.linspace(1.0, 1.3, 40)
    data = rng.standard_normal((600, 40)) * scale
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(data)], "vec_id long, embedding array<double>")
    fitted, table = whitening.fit(frame, "embedding", block=10, degree=6)
    _, _, values, turn = dense(data)
    assert fitted.passes > 6 and fitted.residuals.max() <= whitening.CERTIFIED
    assert np.abs(fitted.values / values[:4] - 1).max() < 1e-12
    assert np.abs(np.abs((fitted.vectors * turn[:, :4]).sum(axis=0)) - 1).max() < 1e-10
    assert whitening.identity_error(fitted, table) < 1e-10


def test_repeats_nulls_and_bad_entries(spark):
    good = {1: [0.5, -0.25, 1.0], 2: [0.1, 0.7, -3.0], 3: [2.0, 0.0, -0.0], 4: [-1.5, 0.3, 0.2], 5: [0.5, 0.9, 0.4]}
    rows = [(i, v, 1) for i, v in good.items()] + [(6, good[1], 2), (6, good[1], 2)]
    bad = [(7, None, 0), (8, [1.0, None, 2.0], 0), (9, [float("nan")] * 3, 0), (10, [float("inf"), 1.0, 2.0], 0), (11, [-float("inf"), 1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, n int")
    out = whitening.whiten(frame)
    assert out.columns == ["vec_id", "embedding", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    assert len(got) == 7 * 3 and {r.vec_id for r in got} == {1, 2, 3, 4, 5, 6}
    check([r for r in got if r.vec_id < 6], good, 3)
    one, six = ({r.component: r.whitened for r in got if r.vec_id == i} for i in (1, 6))
    assert one == six


def test_no_variance_and_few_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    single = whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in single] == [(1, 0, None, None, None)] * 4
    line = whitening.whiten(make([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line)
    assert abs(next(r.explained for r in line if r.component == 1) - 1) < 1e-12
    for empty in ([], [(1, None)], [(1, [])]):
        assert whitening.whiten(make(empty)).collect() == []


def test_short_vectors_are_filled_up(spark):
    vectors = {1: [1.0], 2: [0.5, 2.0], 3: [], 4: [3.0, -1.0]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    check(whitening.whiten(frame).collect(), {k: v + [0.0] * (2 - len(v)) for k, v in vectors.items()}, 2)


@pytest.mark.parametrize("huge", [1e5, 1e12, 1e17, 1e30])
def test_entries_of_any_size(spark, huge):
    vectors = {1: [huge, 1.0], 2: [-huge, 2.0], 3: [0.0, 3.0]}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    for r in whitening.whiten(frame).collect():
        whole = {k: [min(max(math.floor(256 * c), -int(whitening._LIMIT)), int(whitening._LIMIT)) for c in v] for k, v in vectors.items()}
        exact = sum((3 * a - sum(v[i] for v in whole.values())) ** 2 for i, a in enumerate(whole[r.vec_id]))
        assert r.deviation == (exact if exact < 1 << 63 else None)
        assert r.component == 2 or abs(r.whitened) < 2


def test_blocks_hold_every_distinct_vector_once(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_BLOCK_BYTES", 48)
    frame = spark.range(200).select(F.array((F.col("id") % 50).cast("double"), F.lit(1e6), F.when(F.col("id") % 50 < 3, 1e12).otherwise(0.0)).alias("v"))
    table = whitening.fit_table(frame, "v", 3)
    rows = [tuple(x) for r in table.collect() for x in np.frombuffer(r.data, whitening._KINDS[r.width]).reshape(-1, 3).tolist()]
    assert len(rows) == len(set(rows)) == 50
    n, sums = whitening._exact_sums(table, 3)
    assert n == 50 and sums == [sum(r[i] for r in rows) for i in range(3)]
