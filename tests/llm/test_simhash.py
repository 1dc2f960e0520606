import random
from itertools import combinations

import pytest
from helpers import AWKWARD, SCHEMA, frame, plain_groups, plain_simhash, table

from stillhouse.llm import simhash
from stillhouse.llm.components import components
from stillhouse.llm.queries import op8_simhash_groups


def test_query_equals_brute_force(spark, small, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash_groups(spark, small).collect()}
    prints = [plain_simhash(d[1]) for d in docs]
    roots = plain_groups(prints, 2)
    assert got == {d[0]: (f"{p:016x}", docs[r][0]) for d, p, r in zip(docs, prints, roots)}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in combinations(range(64), radius):
        change = sum(1 << b for b in bits)
        assert any(m & change == 0 for m in masks)


def test_links_connect_dense_clusters_and_chains(spark):
    random.seed(5)
    base = random.getrandbits(64)
    values = {base ^ (1 << a) ^ (1 << b) for a, b in combinations(range(24), 2)}
    chain = random.getrandbits(64)
    for i in range(0, 60, 2):
        chain ^= 3 << i
        values.add(chain)
    values |= {random.getrandbits(64) for _ in range(200)} | {0, 3, (1 << 63) | 1}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")), "a", "b").collect()
    want = plain_groups(values, 2)
    label = {r.node: r.root for r in found}
    mine = [label.get(v, v) for v in signed]
    assert len(set(want)) == len(set(mine))
    assert len(set(zip(want, mine))) == len(set(want))


def test_awkward_rows(spark, tmp_path):
    rows = op8_simhash_groups(spark, table(spark, tmp_path, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {1: 1, 2: 1, 3: 1}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_empty_table(spark, tmp_path):
    assert op8_simhash_groups(spark, table(spark, tmp_path, [])).collect() == []
    assert simhash.one_of_each(frame(spark, [])).collect() == []


def test_one_of_each_keeps_columns_and_the_smallest_id(spark):
    rows = [(*r, "x", 1) for r in AWKWARD]
    left = simhash.one_of_each(frame(spark, rows, SCHEMA + ", component_id string, fp int"))
    assert left.columns[-2:] == ["component_id", "fp"]
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 7, 8] and ids.count(None) == 1


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1500)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + star + [(7, 7)], "a int, b int"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1500)}}
