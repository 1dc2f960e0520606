import re

import duckdb
from helpers import AWKWARD, SCHEMA, frame, table

from stillhouse.llm import licenses
from stillhouse.llm.queries import ORACLES, op3_license_scan


def cut(text):
    found = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    return [tuple(found[i:i + 5]) for i in range(len(found) - 4)] or ([tuple(found)] if found else [])


def plain_scan(docs, templates=licenses.TEMPLATES, least=0.8):
    out = []
    for i, text in docs:
        own = cut(text)
        for name, wording in templates.items():
            known = set(cut(wording))
            at = [k for k, s in enumerate(own) if s in known]
            if known and len({own[k] for k in at}) / len(known) >= least:
                out.append((i, name, len({own[k] for k in at}) / len(known), at[0], at[-1] + 4))
    return sorted(out, key=str)


def flat(rows):
    return sorted(map(tuple, rows), key=str)


def test_query_equals_brute_force_and_sql(spark, small, docs):
    rows = op3_license_scan(spark, small).collect()
    assert flat(rows) == plain_scan([(d[0], d[1]) for d in docs]) and rows
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    found = db.sql(ORACLES["op3_license_scan"])
    assert flat([[r[c] for c in found.columns] for r in rows]) == flat(found.fetchall())


def test_whole_changed_and_partial_texts(spark):
    mit, apache = licenses.TEMPLATES["MIT"].split(), licenses.TEMPLATES["Apache-2.0"].split()
    prose = "some unrelated prose of no licence whatsoever goes on and on here ".split()
    changed = list(mit)
    for i in (20, 60):
        changed[i] = "altered"
    texts = [" ".join(prose * k + mit + prose) for k in range(12)] + [" ".join(prose * 3 + changed), " ".join(mit[:40]), " ".join(prose * 2 + apache).upper(),
             " ".join(mit + prose + mit), " ".join(w for k, w in enumerate(mit) if k % 4), "released UNDER the -- MIT license!"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = flat(licenses.scan(frame(spark, rows)).collect())
    assert got == plain_scan([(r[0], r[1]) for r in rows])
    assert sum(r[1] == "MIT" for r in got) == 14


def test_own_templates_and_awkward_rows(spark, tmp_path):
    own = spark.createDataFrame([("short", "x"), ("none", ""), ("null", None), ("twice", "same text twice over same")], "license string, text string")
    got = licenses.scan(frame(spark, [(*r, "k", 1) for r in AWKWARD], SCHEMA + ", license string, __row int"), own).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(5, "twice"), (6, "twice"), (6, "twice"), (8, "short")]
    assert licenses.scan(frame(spark, []), own).collect() == [] and licenses.scan(frame(spark), own.limit(0)).collect() == []
    assert op3_license_scan(spark, table(spark, tmp_path, AWKWARD)).collect() == []


def test_no_python_in_the_plan(spark, small):
    assert "Python" not in op3_license_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
