import hashlib
import struct

import xxhash
from helpers import AWKWARD, SCHEMA, frame, table, words
from pyspark.sql import functions as F

from stillhouse.llm import fingerprints
from stillhouse.llm.queries import op7_one_permutation_minhash


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def shingle_set(text):
    found = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words((text or "").lower())]
    return {chained(found[i:i + 5]) for i in range(len(found) - 4)} or ({chained(found)} if found else set())


def plain_fingerprint(text):
    least = {}
    for h in shingle_set(text):
        b = h >> 57
        if b not in least or h < least[b]:
            least[b] = h
    if not least:
        return ""
    def signed(v):
        return v - (1 << 64) if v >> 63 else v

    full = [least[b] if b in least else least[min(least, key=lambda j: signed(chained([b, j])))] for b in range(128)]
    return "".join(f"{v & 15:x}" for v in full)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    equal = sum(x == y for x, y in zip(a, b)) / 128 if a and b else 0.0
    return max(0.0, (equal - 1 / 16) / (15 / 16))


def plain_rows(docs):
    """docs: [(doc_id, text)] with unique ids, in order."""
    prints = [plain_fingerprint(t) for _, t in docs]
    out = {}
    for at, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(at + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, changed = prints[at], plain_fingerprint(edited)
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, plain_likeness(own, changed),
                       plain_likeness(own, prints[(at + 1) % len(docs)]))
    return out


def flat(r):
    return (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)


def same(got, want):
    return got[:4] == want[:4] and all(abs(a - b) < 1e-12 for a, b in zip(got[4:], want[4:]))


def test_query_equals_brute_force(spark, small, docs):
    want = plain_rows([(d[0], d[1]) for d in docs])
    rows = op7_one_permutation_minhash(spark, small).collect()
    assert len(rows) == len(docs)
    assert all(same(flat(r), want[r.doc_id]) for r in rows)


def test_likeness_estimates_the_jaccard_similarity(spark):
    pairs = []
    for i in range(60):
        a = [f"w{i}x{k}" for k in range(400)]
        b = a[:400 - 6 * i] + [f"v{i}x{k}" for k in range(6 * i)]
        x, y = shingle_set(" ".join(a)), shingle_set(" ".join(b))
        pairs.append((" ".join(a), " ".join(b), len(x & y) / len(x | y)))
    rows = spark.createDataFrame(pairs, "a string, b string, truth double")
    rows = fingerprints.with_fingerprint(fingerprints.with_fingerprint(rows, F.col("a"), "p"), F.col("b"), "q")
    errors = [r.e for r in rows.select((fingerprints.likeness(F.col("p"), F.col("q")) - F.col("truth")).alias("e")).collect()]
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.17


def test_awkward_rows(spark, tmp_path):
    rows = op7_one_permutation_minhash(spark, table(spark, tmp_path, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    want = plain_rows([(1, None), (2, ""), (3, " \n\t "), *[(r[0], r[1]) for r in AWKWARD if (r[0] or 0) > 3 and r[0] != 6], (6, AWKWARD[6][1]), (None, AWKWARD[3][1])])
    order = {k: v for k, v in plain_rows(sorted({(r[0], r[1]) for r in AWKWARD}, key=lambda r: (r[0] is None, r[0] or 0))).items()}
    assert set(order) == set(want)
    assert all(same(flat(r), order[r.doc_id]) for r in rows)
    assert op7_one_permutation_minhash(spark, table(spark, tmp_path / "none", [])).collect() == []
    one = op7_one_permutation_minhash(spark, table(spark, tmp_path / "one", [(5, "abcdef", None, None, 6)])).collect()
    assert [(r.edited_sha256, r.near_next) for r in one] == [(hashlib.sha256(b"abcabc").hexdigest(), 1.0)]


def test_no_python_in_the_plan_and_columns_stay(spark):
    docs = frame(spark, [(*r, "f", 1) for r in AWKWARD], SCHEMA + ", words string, least int")
    made = fingerprints.with_fingerprint(docs, F.col("text"))
    assert made.columns == [*docs.columns, "fingerprint"] and {r.words for r in made.collect()} == {"f"}
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
