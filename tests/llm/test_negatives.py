import math

import duckdb
import numpy as np
import pytest
from helpers import table

from stillhouse.llm import negatives
from stillhouse.llm.queries import op11_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"
LONG = (1 << 63) - 1


def plain_rows(rows):
    """Every anchor with every row, in whole numbers."""
    part = []
    for i, (vec_id, x, label) in enumerate(rows):
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        part.append((i, vec_id, [math.floor(256 * float(np.float32(v))) for v in x], label))
    out = []
    for i, anchor, x, label in part:
        if anchor is None or anchor % 100:
            continue
        scored = [
            (max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(x, y)))), vec_id, other) for j, vec_id, y, other in part if j != i and len(x) == len(y)
        ]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p][:5]
            out += [(anchor, positive, rank, s[1], p, s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out, key=repr)


def got(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_given_table_equals_brute_force(spark):
    rows = duckdb.sql("SELECT vec_id, embedding, label FROM '/root/testdata/sf0.01/embeddings.parquet'").fetchall()
    assert got(op11_hard_negatives(spark, "/root/testdata/sf0.01")) == plain_rows(rows)


def clustered(n, anchors, size=16, seed=2):
    """Few centres, so that the tree's edges are short and bounds decide."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, size))
    ids = [100 * i for i in range(anchors)] + [100 * i + 1 for i in range(n)]
    return [(v, (centres[v % 5] + 0.05 * rng.normal(size=size)).tolist(), int(rng.integers(0, 4))) for v in ids]


def test_clusters_equal_brute_force_in_several_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives.hard_negatives, "__defaults__", ("vec_id", "embedding", "label", 100, 5, 80, 7))
    rows = clustered(400, 20)
    assert got(op11_hard_negatives(spark, table(spark, tmp_path, rows, "embeddings", SCHEMA))) == plain_rows(rows)


def test_bounds_spare_scores_and_lose_nothing():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 32))
    x = negatives.whole(np.concatenate([c + 0.02 * rng.normal(size=(500, 32)) for c in centres]))
    labels, ids = rng.integers(0, 3, len(x)), np.arange(len(x))
    mine = np.arange(0, len(x), 50)
    chunk = negatives.Chunk(ids[mine], ids[mine], labels[mine], x[mine])
    states = chunk.states(5)
    taken = sum(chunk.walk(x[a:a + 250], labels[a:a + 250], ids[a:a + 250], ids[a:a + 250], states, 80) for a in range(0, len(x), 250))
    assert taken < 0.5 * len(x) * len(mine)
    for i, (state,) in zip(mine, states):
        score = x @ x[i]
        best = sorted((-score[j], j) for j in ids if labels[j] == labels[i] and j != i)[:5]
        assert list(zip((-state.score).tolist(), state.id.tolist())) == best


def test_the_tree_is_a_minimum_spanning_tree():
    points = np.random.default_rng(4).integers(0, 50, (60, 3)).astype(float)
    tree = negatives.spanning_tree(points)
    seen = set()
    for node, parent, length in tree:
        assert (parent == -1 and not seen) or (parent in seen and length == pytest.approx(np.linalg.norm(points[node] - points[parent])))
        seen.add(node)
    edges, root, total = sorted((np.linalg.norm(points[a] - points[b]), a, b) for a in range(60) for b in range(a)), list(range(60)), 0.0
    for length, a, b in edges:
        if root[a] != root[b]:
            total += length
            old = root[b]
            root = [root[a] if r == old else r for r in root]
    assert len(seen) == 60 and sum(t[2] for t in tree if t[1] >= 0) == pytest.approx(total)


def test_awkward_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=6).tolist()
    rows = [
        (0, x, 1), (100, x, 1), (100, x, 1), (1, x, 1), (2, x, 2), (2, x, 2), (3, None, 2), (4, [*x[:5], None], 2), (5, [*x[:5], float("nan")], 2),
        (6, [*x[:5], float("inf")], 2), (8, x, None), (None, x, 2), (None, x, 1), (9, x[:5], 2), (200, x[:5], 1), (10, x[:5], 1), (11, [], 3), (300, [], 3),
        (12, [], 4), (400, [-v for v in x], 5), (13, [v * 0.9 for v in x], 3), (14, x, 0), (500, [3e38] * 6, 6), (15, [2e38] * 6, 6), (16, [1e30] * 6, 7), (17, [1e-40] * 6, 7),
        (600, [1e12] * 6, 6), (18, [0.95e12] * 6, 7), (19, [1e12] * 6, 7),
    ]
    assert got(op11_hard_negatives(spark, table(spark, tmp_path, rows, "embeddings", SCHEMA))) == plain_rows(rows)


def test_empty_table_and_other_columns(spark, tmp_path):
    assert op11_hard_negatives(spark, table(spark, tmp_path, [], "embeddings", SCHEMA)).collect() == []
    more = [(0, [1.0, 0.0], 1, "a", 5), (1, [1.0, 0.0], 1, None, None), (2, [0.9, 0.0], 2, None, 1)]
    frame = spark.createDataFrame(more, SCHEMA + ", row string, score int")
    assert got(negatives.hard_negatives(frame)) == [(0, 1, 1, 2, 65536, 58880)]
