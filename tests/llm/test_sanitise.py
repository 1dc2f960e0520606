import hashlib
import math
import random
import time

from helpers import AWKWARD, SCHEMA, frame, plain_base_spans, table

from stillhouse.llm import sanitise
from stillhouse.llm.queries import op2_sanitised_terms

ODD = [
    "a@b.c@d.e", "x@y @z.w q.@r.s-t.u.", "..a@b..c", "a@b", "me@x.y@", "é@b.co aé@b.co", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "0001.2.3.4 0300.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "+1 (743) 555-3824", "+12", "++49 30 1234567", "+1 2345678 +44 20 7946 0958)", "+1(((((((((9", "mail+tag@h.org,+1 234 567 8901x",
    "00000000000000", "1 2-3 4-5 6-7 8-9 0-1 2-3 4", "𝒳 a@b.cd 𝒳",
]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_forms_equal_the_plain_patterns(docs):
    for text in [*ODD, *(d[1] for d in docs), " ".join(ODD), "".join(ODD)]:
        assert sanitise.base_spans(text) == plain_base_spans(text), text


def test_forms_are_searched_in_linear_time():
    started = time.time()
    for text in ("a" * 300_000 + " @", "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "+1" + " " * 300_000, "+1 " * 100_000, "a.b@c" * 60_000):
        sanitise.base_spans(text)
    assert time.time() - started < 10


def test_query_keeps_base_spans(spark, small, docs):
    rows = {r.doc_id: r for r in op2_sanitised_terms(spark, small).collect()}
    assert set(rows) == {d[0] for d in docs}
    for doc_id, text, *_ in docs:
        spans, r = plain_base_spans(text), rows[doc_id]
        assert r.base_sha256 == digest(spans) and r.n_email == sum(k == "email" for k, *_ in spans) and r.n_phone == sum(k == "phone" for k, *_ in spans)
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == [f"{k}:{a}:{b}" for k, a, b in spans]


def revealing():
    rows = [(i, f"filler{i} words here ask Zebulon at zeb@corp.example about{i} the matter today", "en", "s", None) for i in range(6)]
    rows += [(100 + i, f"filler other text{i} ask about the matter and words here at noon today", "en", "s", None) for i in range(60)]
    rows += [(200, "Nobody but zebulon knows it", "en", "s", None), (201, "a single Quixote one@two.example", "en", "s", None)]
    return rows


def test_terms_that_reveal_an_entity_are_found_everywhere(spark):
    got = {r.doc_id: r for r in sanitise.found(frame(spark, revealing()), ["doc_id"]).collect()}
    assert [s.value for s in got[0].terms] == ["zebulon"] and got[0].terms[0].kind == "term_removed"
    text = revealing()[-2][1]
    assert [(text[s.start:s.stop]) for s in got[200].terms] == ["zebulon"]
    assert not got[201].terms and not any(got[i].terms for i in range(100, 160))


def plain_disclosing(rows):
    """{term: disclosure}: pointwise mutual information over the entity's information, for all terms and entities, by document."""
    holders, holding, beside = {}, {}, {}
    for row, (_, text, *_) in enumerate(rows):
        spans = plain_base_spans(text)
        outside, inside = sanitise.document_terms(text or "", spans)
        entities = {sanitise.entity(k, text[a:b]) for k, a, b in spans}
        for term in [*outside, *inside]:
            holding.setdefault(term, set()).add(row)
        for name in entities:
            holders.setdefault(name, set()).add(row)
            for term in outside:
                beside.setdefault((name, term), set()).add(text)
    total, out = len(rows), {}
    wanted = {term for (_, term), texts in beside.items() if len(texts) >= sanitise.SUPPORT}
    for (name, term), texts in beside.items():
        n, both = len(holders[name]), len(holders[name] & holding[term])
        if term in wanted and texts and n < total:
            strength = math.log(both * total / (n * len(holding[term]))) / math.log(total / n)
            out[term] = max(out.get(term, -9.0), strength)
    return {t: s for t, s in out.items() if s >= sanitise.GENERALISE_AT}


def test_disclosing_terms_equal_plain_counts_over_all_documents(spark):
    random.seed(8)
    common, rare = [f"word{'abcdefghij'[i]}" for i in range(10)], [f"name{'abcdefgh'[i]}" for i in range(8)]
    mails = [f"m{i}@corp{i}.example" for i in range(6)]
    rows = []
    for i in range(300):
        said = random.choices(common, k=8)
        if i % 3 == 0:
            k = random.randrange(6)
            said += [mails[k], *random.sample(rare, 1), rare[k] if random.random() < 0.9 else ""]
        if i % 11 == 0:
            said.append(random.choice(rare))
        random.shuffle(said)
        rows.append((i, " ".join(said), "en", "s", None))
    rows += [(1000 + i, rows[3 * i][1], "en", "s", None) for i in range(40)]
    want = plain_disclosing(rows)
    got = {}
    for r in sanitise.found(frame(spark, rows), ["doc_id"]).collect():
        for s in r.terms:
            got.setdefault(s.value.lower(), set()).add(s.kind)
    assert set(got) == set(want) and not set(got) & set(common) and len(got) > 2
    assert all(kinds == {"term_removed" if want[t] >= sanitise.REMOVE_AT else "term_general"} for t, kinds in got.items())


def test_copies_do_not_count_as_support(spark):
    rows = [(i, "ask Zebulon at zeb@corp.example", "en", "s", None) for i in range(50)] + [(99, "other words", "en", "s", None)]
    assert not any(r.terms for r in sanitise.found(frame(spark, rows), ["doc_id"]).collect())


def test_sanitised_texts(spark):
    docs = frame(spark, [(*r, 1, "k") for r in revealing()], SCHEMA + ", base int, terms string")
    left = sanitise.sanitised(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[0] == "filler0 words here ask  at [EMAIL] about0 the matter today" and texts[200] == "Nobody but  knows it"
    assert texts[100] == revealing()[6][1]


def test_awkward_rows(spark, tmp_path):
    rows = op2_sanitised_terms(spark, table(spark, tmp_path, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD) and all(r.base_sha256 == digest([]) and r.spans == "" for r in rows)
    assert op2_sanitised_terms(spark, table(spark, tmp_path / "none", [])).collect() == []
