import math
import random

import duckdb
import numpy as np
import pytest
from helpers import plain_components, table

from stillhouse.llm import vectors
from stillhouse.llm.queries import op13_near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain_rows(rows, least=0.98):
    """Every pair of a label compared."""
    units = {}
    for i, (_, x, label) in enumerate(rows):
        if label is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x):
            v = np.array(x, np.float32).astype(float)
            units[i] = v / np.abs(v).max()
            units[i] /= np.linalg.norm(units[i])
    pairs = [(a, b) for a in units for b in units if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1])]
    linked = [(a, b) for a, b in pairs if units[a] @ units[b] >= least]
    count = [0] * len(rows)
    for a, b in linked:
        count[a] += 1
        count[b] += 1
    roots = plain_components(len(rows), linked)
    lowest = {}
    for i, r in enumerate(roots):
        lowest[r] = min((x for x in (lowest.get(r), rows[i][0]) if x is not None), default=None)
    return sorted(((r[0], n, lowest[t], r[0] is not None and r[0] == lowest[t]) for r, n, t in zip(rows, count, roots)), key=repr)


def got(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def near(rng, x, cosine):
    """A vector at the given cosine from x."""
    y = rng.normal(size=len(x))
    y -= (y @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine * cosine) * y / np.linalg.norm(y)


def planted(groups, rng, size=64):
    rows = []
    for members, label in groups:
        centre = rng.normal(size=size)
        rows += [(near(rng, centre, rng.uniform(0.985, 0.9999)), label) for _ in range(members)]
    rows = [(v.tolist(), label) for v, label in rows]
    random.Random(1).shuffle(rows)
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


def test_given_table_equals_brute_force(spark):
    rows = duckdb.sql("SELECT vec_id, embedding, label FROM '/root/testdata/sf0.01/embeddings.parquet'").fetchall()
    assert got(op13_near_vectors(spark, "/root/testdata/sf0.01")) == plain_rows(rows)


def test_planted_groups_equal_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = planted([(1, 1)] * 300 + [(2, 1)] * 20 + [(7, 2)] * 12 + [(40, 3)] * 3, rng)
    rows += [(10_000 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(60)]
    assert got(op13_near_vectors(spark, table(spark, tmp_path, rows, "embeddings", SCHEMA))) == plain_rows(rows)


def test_blocks_of_a_large_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = planted([(150, 1), (30, 1)], np.random.default_rng(6))
    assert got(op13_near_vectors(spark, table(spark, tmp_path, rows, "embeddings", SCHEMA))) == plain_rows(rows)


def test_awkward_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=9).tolist()
    rows = [
        (1, x, 1), (2, x, 2), (3, [2 * v for v in x], 1), (4, None, 1), (5, [], 1), (6, [0.0] * 9, 1), (7, [*x[:8], None], 1),
        (8, [*x[:8], float("nan")], 1), (9, [*x[:8], float("inf")], 1), (10, x, None), (None, x, 1), (11, x[:8], 1), (3, [2 * v for v in x], 1),
        (12, [1.0], 1), (13, [3.0], 1), (14, [-3.0], 1), (15, [1e38] * 9, 4), (16, [3e38] * 9, 4), (17, [1e-40] * 9, 4), (None, [5.0] * 3, 7),
        (20, [0.0, 1.0], 5), (21, [-0.0, 1.0], 5),
    ]
    assert got(op13_near_vectors(spark, table(spark, tmp_path, rows, "embeddings", SCHEMA))) == plain_rows(rows)


def test_empty_table_and_other_columns(spark, tmp_path):
    assert op13_near_vectors(spark, table(spark, tmp_path, [], "embeddings", SCHEMA)).collect() == []
    more = [(1, [1.0, 0.0], 1, "a", 5), (2, [1.0, 0.01], 1, None, None)]
    frame = spark.createDataFrame(more, SCHEMA + ", component_id string, n_links int")
    assert got(vectors.near_vectors(frame)) == [(1, 1, 1, True), (2, 1, 1, False)]


@pytest.mark.parametrize("size", [3, 64, 100])
def test_estimates_are_unbiased_and_bounds_hold(size):
    rng = np.random.default_rng(8)
    x = rng.normal(size=size)
    errors = []
    for cosine in [0.98, 0.99, 0.999]:
        pair = vectors.unit_rows(np.array([x, near(rng, x, cosine)]))
        for turn in range(200):
            a, b = vectors.rotated(pair, turn)
            code, factor = a > 0, np.abs(a).sum() / math.sqrt(len(a))
            assert vectors.doubtful(code[None], np.array([factor]), b[None], cosine).all()
            errors.append(np.where(code, 1, -1) @ b / (math.sqrt(len(a)) * factor) - cosine)
    assert abs(np.mean(errors)) < 4 * np.std(errors) / math.sqrt(len(errors)) + 1e-6


def test_keys_meet_as_planned():
    rng = np.random.default_rng(9)
    width, tables = vectors.plan_of(50_000)
    x = vectors.unit_rows(rng.normal(size=(2000, 64)))
    y = vectors.unit_rows(np.array([near(rng, v, 0.98) for v in x]))
    a, b = (vectors.keys_of(vectors.coded(v, width * tables)[0], width, tables) for v in (x, y))
    assert (a == b).any(axis=1).mean() > 0.999
