import duckdb
import pytest
from helpers import AWKWARD, SCHEMA, frame, table, words

from stillhouse.llm import mixing
from stillhouse.llm.queries import ORACLES, op1_source_mix


def plain_targets(sizes, most=3, weights=(1, 2, 3)):
    """{source: size} -> {source: target}, by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(w for s, w in weight.items() if s not in full)
        now = {s: most * sizes[s] if s in full else rest * weight[s] / open_weight for s in sizes}
        above = {s for s in sizes if s not in full and now[s] >= most * sizes[s]}
        if not above or len(full | above) == len(sizes):
            return {s: min(t, most * sizes[s]) for s, t in now.items()}
        full |= above


def check(rows, sources):
    sizes = {}
    for r in rows:
        sizes[sources[r.doc_id]] = sizes.get(sources[r.doc_id], 0) + r.size
    want = plain_targets(sizes)
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        rate = want[s] / sizes[s] if sizes[s] else 0
        if r.size:
            assert r.taken % r.size == 0 and r.taken // r.size in (int(rate + 1e-12), int(rate + 1e-12) + 1) and r.taken <= 3 * r.size


def test_query_equals_plain_sharing_and_sql(spark, small, docs):
    rows = op1_source_mix(spark, small).collect()
    assert {r.doc_id: r.size for r in rows} == {d[0]: len(words(d[1])) for d in docs}
    check(rows, {d[0]: d[3] for d in docs})
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    found = db.sql(ORACLES["op1_source_mix"])
    assert sorted(map(tuple, (r[c] for c in found.columns) if False else ([r[c] for c in found.columns] for r in rows))) == sorted(found.fetchall())


def test_caps_cascade(spark):
    rows = [(i, "w " * n, None, s, None) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 100), ("d", 400), ("e", 5), ("f", 90)])]
    got = mixing.planned(frame(spark, rows)).collect()
    want = plain_targets({r[3]: len(r[1].split()) for r in rows})
    assert {r.source: round(r.target, 6) for r in got} == {s: round(t, 6) for s, t in want.items()}
    assert sum(r.target for r in got) == pytest.approx(1605)


def test_taken_words_come_near_the_target(spark):
    rows = [(i, "w " * (1 + i % 50), None, "abcd"[i % 7 % 4], None) for i in range(8000)]
    got = mixing.planned(frame(spark, rows)).groupBy("source").agg({"target": "max", "*": "count"}).collect()
    taken = mixing.planned(frame(spark, rows)).selectExpr("source", "size * copies AS t").groupBy("source").sum("t").collect()
    target = {r.source: r["max(target)"] for r in got}
    assert all(abs(r["sum(t)"] - target[r.source]) < 0.05 * target[r.source] for r in taken)


def test_mix_repeats_rows_with_their_own_columns(spark):
    rows = [(*r, 1.5, "c") for r in AWKWARD]
    docs = frame(spark, rows, SCHEMA + ", rate double, copies string")
    plan = {(r.doc_id): r["copies"] for r in mixing.planned(docs.drop("copies")).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {k: v * (2 if k == 6 else 1) for k, v in plan.items() if v}
    again = sorted(str(r) for r in mixing.mix(docs.repartition(7)).collect())
    assert again == sorted(str(r) for r in mixed.collect())


def test_awkward_rows(spark, tmp_path):
    rows = op1_source_mix(spark, table(spark, tmp_path, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    check(rows, {r[0]: r[3] for r in AWKWARD})
    assert op1_source_mix(spark, table(spark, tmp_path / "none", [])).collect() == []
    blank = op1_source_mix(spark, table(spark, tmp_path / "blank", [(1, None, None, "a", 0), (2, " ", None, None, 1)])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
