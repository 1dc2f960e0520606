import pytest
from helpers import AWKWARD, LONG, frame, lang_held_out, table

from stillhouse.llm import languages
from stillhouse.llm.queries import op5_language_backoff


def test_held_out_accuracy(spark, small, docs):
    rows = {r.doc_id: r for r in op5_language_backoff(spark, small).collect()}
    assert {i: r.held_out for i, r in rows.items()} == {d[0]: lang_held_out(d[0]) for d in docs}
    tested = [d for d in docs if lang_held_out(d[0])]
    right = sum(rows[d[0]].lang_pred == d[2] for d in tested)
    assert right / len(tested) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_words_score_first_and_unseen_words_back_off():
    counts = [(0, "the", "en", 50), (0, "der", "de", 40), (4, "tion", "en", 9), (4, "nder", "de", 9), (2, "ch", "de", 20), (2, "ti", "en", 5), (1, "x", "de", 3)]
    model = languages.Model.of_counts(["de", "en"], counts)
    assert model.score("the THE")[0] == "en" and model.score("der")[0] == "de"
    assert model.score("nation")[0] == "en"          # by its 4-gram
    assert model.score("ich")[0] == "de"             # by a 2-gram
    assert model.backoff("tion") == pytest.approx(model.logs[4][0])  # no other position is known
    assert model.score("zzz") == ("de", 0.5)         # nothing known: equal, first in order
    assert model.score("12 !?") == ("und", 0.0) and model.score(None) == ("und", 0.0)


def test_the_id_and_the_source_do_not_matter(spark):
    rows = [(i, "the cat sat on the mat" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", None, None) for i in range(40)]
    model = languages.train(frame(spark, rows))
    again = [(r[0] + 1000, r[1], None, "elsewhere", None) for r in rows]
    got = {(r.text, r.lang_pred, r.score) for r in languages.predicted(frame(spark, rows), model).collect()}
    assert got == {(r.text, r.lang_pred, r.score) for r in languages.predicted(frame(spark, again), model).collect()} and len(got) == 2


def test_the_sample_is_bounded(spark):
    rows = [(i, "".join(chr(97 + i // 26**k % 26) for k in range(3)) + " more", "en", None, None) for i in range(4000)]
    model = languages.train(frame(spark, rows), per_language=200, max_words=50)
    assert len(model.terms[0]) == 50


def test_awkward_rows(spark, tmp_path):
    rows = op5_language_backoff(spark, table(spark, tmp_path, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by_id[4].lang_pred in ("en", "de", "fr")
    assert not by_id[None].held_out and len(LONG) > 100_000
    assert op5_language_backoff(spark, table(spark, tmp_path / "none", [])).collect() == []
    unlabelled = op5_language_backoff(spark, table(spark, tmp_path / "un", [(1, "some text", None, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
