import hashlib
import random
import zlib

import numpy as np
from helpers import AWKWARD, frame, table, words
from hypothesis import given, settings, strategies as st

from stillhouse.llm import periods
from stillhouse.llm.queries import op12_periodic_runs


def plain_runs(found):
    """Every stretch that keeps a period, tried one period after the other."""
    n, out = len(found), []
    names = {w: i for i, w in enumerate(dict.fromkeys(found))}
    as_numbers = np.array([names[w] for w in found], np.int64)
    for q in range(1, n // 4 + 1):
        again = np.concatenate([[False], as_numbers[:-q] == as_numbers[q:], [False]])
        edges = np.flatnonzero(again[1:] != again[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j + q - i < max(6, 4 * q):
                continue
            part = found[i:j + q]
            if next(p for p in range(1, len(part) + 1) if part[p:] == part[:-p]) == q:
                out.append((i, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_lyndon(ranks):
    def smaller(i, j):
        return ranks[i:] < ranks[j:]

    n = len(ranks)
    return [next((j for j in range(i + 1, n) if smaller(j, i)), n) - i for i in range(n)]


def plain_row(doc_id, text):
    w = words(text)
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_contexts_are_lyndon_lengths(ranks):
    assert periods.lyndon_lengths(ranks) == plain_lyndon(ranks)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=25))
def test_runs_equal_brute_force(head, cycle, times, tail):
    found = head + cycle * times + cycle[:len(cycle) // 2] + tail
    assert periods.runs_of(np.array(found, np.int64)) == plain_runs(found)


def test_parts_hold_every_run_of_many_texts():
    random.seed(7)
    texts = []
    for i in range(400):
        body = [random.randrange(random.choice([2, 5, 40])) for _ in range(random.randrange(120))]
        for _ in range(random.randrange(3)):
            at, q = random.randrange(len(body) + 1), random.randrange(1, 20)
            body[at:at] = [random.randrange(6) for _ in range(q)] * random.randrange(2, 8)
        texts.append([b"%d" % x for x in body])
    for text, (runs, _) in zip(texts, periods._judged(texts)):
        assert runs == plain_runs(text)


def test_query_equals_brute_force(spark, small, docs):
    assert rows_of(op12_periodic_runs(spark, small)) == sorted((plain_row(d[0], d[1]) for d in docs), key=repr)


def test_planted_runs_in_long_texts(spark, tmp_path):
    random.seed(3)
    many = " ".join(random.choice("abcdefgh") + str(random.randrange(400)) for _ in range(50_000))
    cycle = " ".join(f"c{i}" for i in range(3000))
    rows = [(3, f"{many} {' '.join([cycle] * 5)} {many}", "en", "a", 1), (4, "x " * 40_000, "en", "a", 1), (5, "a b " * 30_000, "en", "a", 1)]
    got = {r.doc_id: r for r in op12_periodic_runs(spark, table(spark, tmp_path, rows)).collect()}
    assert (got[3].n_runs, got[3].start, got[3].length, got[3].period, got[3].exponent_milli) == (1, 50_000, 15_000, 3000, 5000)
    assert (got[4].length, got[4].period) == (40_000, 1) and (got[5].length, got[5].period) == (60_000, 2)


def test_awkward_rows(spark, tmp_path):
    rows = [*AWKWARD, (30, "go go go go go go", None, None, None), (31, "a b " * 6, None, None, None), (32, "go go go go go", None, None, None)]
    assert rows_of(op12_periodic_runs(spark, table(spark, tmp_path, rows))) == sorted((plain_row(r[0], r[1]) for r in rows), key=repr)


def test_ties_go_to_the_first_run(spark, tmp_path):
    rows = [(1, "a b " * 4 + "z " + "c d " * 4, None, None, None), (2, "p q r " * 4 + "k l " * 4, None, None, None)]
    got = {r.doc_id: (r.n_runs, r.start, r.period) for r in op12_periodic_runs(spark, table(spark, tmp_path, rows)).collect()}
    assert got == {1: (2, 0, 2), 2: (2, 0, 3)}


def test_empty_table_and_other_columns(spark, tmp_path):
    assert op12_periodic_runs(spark, table(spark, tmp_path, [])).collect() == []
    rows = frame(spark, [(*AWKWARD[0], "x", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint, runs string, collapsed int")
    found = periods.with_runs(rows)
    assert found.columns == ["doc_id", "runs", "collapsed"] and [tuple(r) for r in found.collect()] == [(1, [], "")]
