import hashlib
import random
from itertools import combinations

from helpers import AWKWARD, SCHEMA, frame, plain_components, table

from stillhouse.llm import linededup
from stillhouse.llm.queries import op4_line_dedup


def plain_removals(docs, least=0.8):
    """{(doc_id, pos)} removed: all pairs of distinct lines with a word compared, by shingles or, below 8 characters, as wholes. Ids are unique."""
    where = {}
    for i, text in docs:
        for pos, line in enumerate((text or "").split("\n")):
            whole = b" ".join(line.encode().lower().split()).decode()
            if whole:
                where.setdefault(whole, []).append((i is None, i, pos))
    lines = sorted(where)
    sets = [{x[i:i + 8] for i in range(len(x) - 7)} for x in lines]
    order = sorted((k for k in range(len(lines)) if sets[k]), key=lambda k: len(sets[k]))
    linked = []
    for at, a in enumerate(order):
        for b in order[at + 1:]:
            if len(sets[a]) < least * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if both >= least * (len(sets[a]) + len(sets[b]) - both):
                linked.append((a, b))
    groups = {}
    for k, root in enumerate(plain_components(len(lines), linked)):
        groups.setdefault(root, []).extend(where[lines[k]])
    return {(p[1], p[2]) for places in groups.values() for p in places if p != min(places)}


def removed(rows):
    return {(r.doc_id, int(p)) for r in rows for p in r.removed_lines.split(",") if p}


def rest(text, gone):
    return None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def test_query_equals_brute_force(spark, small, docs):
    rows = op4_line_dedup(spark, small).collect()
    want, got = plain_removals([(d[0], d[1]) for d in docs]), removed(rows)
    # Banding finds at least 98.5 % of the pairs at the threshold.
    assert got <= want and len(want - got) <= 0.01 * len(want) and want
    texts = {d[0]: d[1] for d in docs}
    for r in rows:
        gone = {p for i, p in got if i == r.doc_id}
        assert r.n_removed == len(gone) and r.text_sha256 == hashlib.sha256(rest(texts[r.doc_id], gone).encode()).hexdigest()


def test_variants_of_a_line_without_their_original(spark):
    random.seed(9)
    words = [f"term{i:03d}" for i in range(60)]
    lines = []
    for i in range(700):  # more than a block; one or two changes each
        changed = list(words)
        for _ in range(1 + i % 3):
            changed[random.randrange(60)] = f"else{random.randrange(10**6)}"
        lines.append(" ".join(changed))
    docs = [(i, line, None, None, None) for i, line in enumerate(lines)]
    left = linededup.dedup_lines(frame(spark, docs)).collect()
    want = plain_removals([(d[0], d[1]) for d in docs])
    assert sum(r.text == "" for r in left) == len(want)


def test_unlinked_lines_of_a_bucket_are_compared_with_all_others(spark):
    def line(i):
        return f"shared text number {i} " * 3

    texts = spark.createDataFrame([(i, line(i // 2)) for i in range(600)], "mark bigint, line string")
    members = texts.selectExpr("1L AS key", "mark")
    found = linededup._rest_of_buckets(members, members, texts).collect()
    groups = plain_components(600, [(r.a, r.b) for r in found])
    sets = [linededup.shingles(line(i // 2)) for i in range(600)]
    want = plain_components(600, [(a, b) for a, b in combinations(range(600), 2) if linededup.alike(sets[a], sets[b])])
    assert groups == want


def test_band_keys_do_not_depend_on_the_batch():
    lines = [f"some line number {i} with text {'x' * (i % 40)}" for i in range(300)]
    whole = linededup.band_keys(lines)
    assert whole.shape == (300, linededup.BANDS) and (whole == [linededup.band_keys([x])[0] for x in lines]).all()
    assert linededup.band_keys([]).shape == (0, linededup.BANDS)


def test_awkward_rows(spark, tmp_path):
    same = "one line that is long enough\nShort one\nOne  line that is LONG enough\n\nShort one"
    rows = [*AWKWARD, (20, same, None, None, None), (21, same, None, None, None)]
    got = {}
    for r in op4_line_dedup(spark, table(spark, tmp_path, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [r.removed_lines for r in got[20]] == ["2,4"] and [r.removed_lines for r in got[21]] == ["0,1,2,4"]
    assert [r.removed_lines for r in got[6]] == ["0", "0"] and got[1][0].text_sha256 is None
    assert op4_line_dedup(spark, table(spark, tmp_path / "none", [])).collect() == []


def test_columns_stay(spark):
    rows = [(*r, "m", 5) for r in AWKWARD]
    docs = frame(spark, rows, SCHEMA + ", mark string, removed int")
    left = linededup.dedup_lines(docs)
    assert left.columns == docs.columns and {r.mark for r in left.collect()} == {"m"}
    assert all(r.n_chars == len(r.text) for r in left.collect() if r.text is not None)


def test_lines_are_compared_once_and_never_alone(spark, monkeypatch):
    alone = spark.createDataFrame([(1, "the only line beside a pivot"), (2, "first of two lines"), (3, "other line of the two")], "mark bigint, line string")
    members = spark.createDataFrame([(7, 1), (8, 2), (8, 3)], "key bigint, mark bigint")
    read, real = [], linededup.shingles
    monkeypatch.setattr(linededup, "shingles", lambda line, form: read.append(line) or real(line, form))
    assert linededup.links({2: "first of two lines", 3: "other line of the two"}, {2: "first of two lines", 3: "other line of the two"}) == []
    assert sorted(read) == ["first of two lines", "other line of the two"]
    monkeypatch.undo()
    assert linededup._rest_of_buckets(members, members, alone).collect() == []


def test_shingles_by_numbers_equal_those_by_text():
    random.seed(4)
    for letters in ("ab", "aé\xff\x00 ", "a網я\x00"):
        lines = ["".join(random.choices(letters, k=random.randint(8, 40))) for _ in range(60)]
        form = linededup.form_of(lines)
        assert form == (linededup.WIDE if "я" in letters else linededup.NARROW)
        cut = [linededup.shingles(x, form) for x in lines]
        sets = [{x[i:i + 8] for i in range(len(x) - 7)} for x in lines]
        assert [len(c) for c in cut] == [len(s) for s in sets]
        for c, s in zip(cut, sets):
            both = [len(s & t) for t in sets]
            for least in (0.2, 0.8):
                assert linededup.alike_to(c, cut, least).tolist() == [n >= least * (len(s) + len(t) - n) for n, t in zip(both, sets)]
