from helpers import frame

from stillhouse.llm import sanitise


def test_terms_of_any_length_and_distance_are_counted_over_whole_documents(spark):
    between = "one two three four five six seven eight nine"
    rows = [(i, f"Li {between} me{i} zeb@corp.example and Quixotic {between}", "en", "s", None) for i in range(4)]
    rows += [(10 + i, f"{between} and other{i} me", "en", "s", None) for i in range(60)]
    rows += [(100, "only li and quixotic", "en", "s", None)]
    got = {r.doc_id: r for r in sanitise.found(frame(spark, rows), ["doc_id"]).collect()}
    # 'quixotic' is beside the address, 'li' is ten words away; both occur once without it.
    assert [s.value for s in got[0].terms] == ["li", "quixotic"] and [s.value for s in got[100].terms] == ["li", "quixotic"]
    assert not any(got[10 + i].terms for i in range(60))


def test_counts_are_of_documents_and_support_of_texts(spark):
    rows = [(i, f"Zeb and zeb@corp.example number{i // 2}", "en", "s", None) for i in range(6)]
    rows += [(50, "zeb@corp.example alone", "en", "s", None)] + [(60 + i, f"and words of number{i}", "en", "s", None) for i in range(30)]
    docs = frame(spark, rows)
    texts = sanitise._texts(sanitise._based(docs, [], "text"))
    pairs = {(r.entity, r.term): (r.both, r.texts) for r in sanitise._together(texts).collect()}
    name = "email:zeb@corp.example"
    # Copies are documents of one text; in row 50 the word is only inside the address.
    assert pairs[name, "zeb"] == (7, 3) and pairs[name, "and"] == (6, 3) and pairs[name, "corp"] == (7, 0)


def test_the_map_admits_what_is_wanted_and_little_else(spark):
    admits = sanitise._admits(sanitise._admitted(spark.range(50_000).selectExpr("concat('término', id) AS term")))
    assert all(admits(f"término{i}") for i in range(50_000))
    assert sum(admits(f"other{i}") for i in range(50_000)) < 50
    assert not sanitise._admits(sanitise._admitted(spark.createDataFrame([], "term string")))("other1")


def test_terms_of_too_many_documents_make_no_pairs(spark, monkeypatch):
    rows = [(i, f"common words ask Zebulon at zeb@corp.example about{i}", "en", "s", None) for i in range(6)]
    rows += [(100 + i, f"common words of text{i}", "en", "s", None) for i in range(94)]
    paired, real = [], sanitise._together
    monkeypatch.setattr(sanitise, "_together", lambda *a, **b: paired.append(real(*a, **b)) or paired[-1])
    got = {s.value for r in sanitise.found(frame(spark, rows), ["doc_id"]).collect() for s in r.terms}
    assert got == {"ask", "zebulon", "at", "about"}
    assert {r.term for r in paired[-1].collect()} == {"ask", "zebulon", "at", "about"}
    texts = sanitise._texts(sanitise._based(frame(spark, rows), [], "text"))
    assert 13 < sanitise._most_documents(texts, 100) < 14 and sanitise._most_documents(texts, 6) == 0
