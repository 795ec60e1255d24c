"""Whitening: the bidiagonal solver against dense eigenvectors, the query against a covariance in whole numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollspark.llm import qd, queries, whitening


def matrices():
    draw = np.random.default_rng(3)
    left, right = (np.linalg.qr(draw.standard_normal((24, 24)))[0] for _ in range(2))
    deficient = draw.standard_normal((24, 24))
    deficient[:, 12:] = deficient[:, :12]
    return {"one": np.array([[3.0]]), "random": draw.standard_normal((40, 40)), "identity": np.eye(9), "zero": np.zeros((4, 4)),
            "graded": draw.standard_normal((24, 24)) * 10.0 ** -np.linspace(0, 12, 24), "orthogonal": left * 3,
            "clusters": left @ np.diag(np.r_[np.full(8, 5), np.full(8, 5 * (1 + 1e-9)), np.ones(8)]) @ right,
            "deficient": deficient, "bidiagonal": np.diag(np.abs(np.arange(21) - 10.0) + 1e-3) + np.diag(np.ones(20), 1)}


@pytest.mark.parametrize("name", list(matrices()))
def test_solver(name):
    matrix = matrices()[name]
    values, vectors = qd.right_singular(matrix)
    wanted = np.linalg.svd(matrix, compute_uv=False)
    assert np.abs(np.sqrt(values) - wanted).max() <= 1e-13 * max(wanted[0], 1)
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-9
    assert np.abs(matrix.T @ (matrix @ vectors) - vectors * values).max() <= 1e-9 * max(wanted[0] ** 2, 1)


def test_small_values_are_accurate_relatively():
    diagonal, above = 10.0 ** -np.arange(0, 40, 4), np.full(9, 1e-45)
    assert np.allclose(qd.dqds(diagonal, above), diagonal ** 2, rtol=1e-13)


def brute(vectors, components=32):
    """x - S/n on the leading eigenvectors of the covariance, with the exact deviations in Python's whole numbers."""
    x = np.array([[int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v] for v in vectors])
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1][:components], found[:, ::-1][:, :components]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    return centred @ found / np.sqrt(values), deviation, values / (centred ** 2).sum() * n


def test_query_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    wanted, deviation, share = brute([row.embedding for row in table])
    got = queries.op12_whitening(spark, sf_dir).collect()
    place = {row.vec_id: i for i, row in enumerate(table)}
    assert len(got) == 32 * len(table)
    found = np.zeros_like(wanted)
    for row in got:
        found[place[row.vec_id], row.component - 1] = row.whitened
        assert row.deviation == deviation[place[row.vec_id]] and row.n == len(table)
        assert abs(row.explained / share[row.component - 1] - 1) < 1e-9 and row.identity_error < 1e-9
    for k in range(32):
        assert min(np.abs(found[:, k] - wanted[:, k]).max(), np.abs(found[:, k] + wanted[:, k]).max()) < 1e-6


def test_odd_vectors(spark, monkeypatch):
    draw = np.random.default_rng(5)
    good = [[float(v) for v in row] + [0.5] for row in draw.standard_normal((60, 3))]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (100, None), (101, []), (102, [1.0, None, 2.0, 0.5]), (103, [1.0, float("nan"), 2.0, 0.5]), (104, [float("-inf"), 0.0, 0.0, 0.5]),
        (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0, 0.5]), (7, good[7]), (None, good[8])]
    schema = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame(rows, schema).withColumn("component", F.lit("clash")).repartition(10)
    monkeypatch.setattr(whitening, "_STACK", 3)
    model = whitening.fit(frame)
    got = whitening.apply(frame, model, ["vec_id"]).collect()
    assert len(got) == 62 * 3 and {row.component for row in got} == {1, 2, 3} and model.identity_error < 1e-9
    assert sum(row.vec_id == 7 for row in got) == 6 and sum(row.vec_id is None for row in got) == 3
    wanted, deviation, _ = brute([[*v[:3]] for v in [*good, good[7], good[8]]])
    assert sorted(row.deviation for row in got if row.component == 1) == sorted(deviation)
    for few in (frame.limit(0), frame.where("vec_id = 100"), frame.where("vec_id = 5")):
        assert whitening.apply(few, whitening.fit(few), ["vec_id"]).count() == 0
    twins = spark.createDataFrame([(i, [1e9 * (i % 2), 2e9 * (i % 2)]) for i in range(9)], schema)
    big = whitening.apply(twins, whitening.fit(twins), ["vec_id"]).collect()
    assert len(big) == 9 and big[0].deviation is None and big[0].identity_error < 1e-9
