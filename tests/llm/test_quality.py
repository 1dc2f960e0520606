from helpers import AWKWARD, LONG, SCHEMA, frame, plain_quality, table

from stillhouse.llm import quality
from stillhouse.llm.queries import op9_quality_rules


def plain_kept(docs, min_docs=10, share=0.05, min_words=20, min_left=1 / 3):
    """docs: [(id, text, source)] with unique texts per source."""
    def lines(text):
        found = {}
        for line in (text or "").split("\n"):
            words = line.encode().lower().split()
            if words:
                found[b" ".join(words)] = found.get(b" ".join(words), 0) + len(words)
        return found

    holders, hosts = {}, {}
    for i, text, source in docs:
        hosts.setdefault(source, set()).add(text)
        for line in lines(text):
            holders.setdefault((source, line), {}).setdefault(text, i)
    out = {}
    for i, text, source in docs:
        limit = max(min_docs, share * len(hosts[source]))
        gone = sum(
            n for line, n in lines(text).items()
            if len(h := holders[source, line]) > limit and min(h, key=lambda t: h[t]) != text
        )
        n, *_, repeated = plain_quality(text)
        failed = n < min_words or 100 * repeated > 30 * n
        out[i] = (failed, not failed and (gone == 0 or (n - gone >= min_words and n - gone >= n * min_left)), gone)
    return out


def test_query_equals_brute_force(spark, small, docs):
    want = plain_kept([(d[0], d[1], d[3]) for d in docs])
    got = op9_quality_rules(spark, small).collect()
    assert len(got) == len(docs)
    texts = {d[0]: d[1] for d in docs}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_quality(texts[r.doc_id])
        assert (r.base_failed, r.kept, r.words_removed) == want[r.doc_id]


def shared_line_docs():
    own = [" ".join(f"own{i}word{j}" for j in range(40)) for i in range(60)]
    common = "Subscribe to  our NEWSLETTER for all the news of every single day and night\n"
    rows = [(i, common + own[i], "h") for i in range(40)]
    rows += [(100 + i, common * 12 + " ".join(own[50 + i].split()[:10]), "h") for i in range(3)]
    rows += [(200 + i, own[40], "h") for i in range(30)]  # copies of one text count once
    return [(i, t, "en", s, len(t)) for i, t, s in rows]


def test_lines_above_the_limit_go_and_depleted_documents_are_rejected(spark):
    rows = shared_line_docs()
    got = {r.record: r for r in quality.verdicts(frame(spark, rows)).collect()}
    want = plain_kept([(r[0], r[1], r[3]) for r in rows])
    assert {i: (r.base_failed, r.kept, r.words_removed) for i, r in got.items()} == want
    assert got[0].words_removed == 0 and got[1].words_removed > 0 and got[200].words_removed == 0
    left = {r.doc_id: r for r in quality.clean(frame(spark, rows)).collect()}
    assert set(left) == {i for i, w in want.items() if w[1]} and "NEWSLETTER" in left[0].text
    assert "NEWSLETTER" not in left[1].text and left[1].n_chars == len(left[1].text)


def test_a_host_that_differs_is_counted_apart(spark):
    rows = [(r[0], r[1], "en", f"host{r[0] % 5}", None) for r in shared_line_docs() if r[0] < 40]
    assert all(r.words_removed == 0 for r in quality.verdicts(frame(spark, rows)).collect())


def test_awkward_rows(spark, tmp_path):
    got = [r for r in op9_quality_rules(spark, table(spark, tmp_path, AWKWARD)).collect()]
    assert len(got) == len(AWKWARD)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept
    assert by_id[4].n_words == len(LONG.split()) and by_id[7].word_chars == plain_quality(AWKWARD[8][1])[1]
    assert op9_quality_rules(spark, table(spark, tmp_path / "none", [])).collect() == []


def test_clashing_columns_survive(spark):
    rows = [(*r, "m", 5) for r in shared_line_docs()]
    left = quality.clean(frame(spark, rows, SCHEMA + ", marks string, kept int"))
    assert left.columns == [*(c.split()[0] for c in SCHEMA.split(", ")), "marks", "kept"] and {r.marks for r in left.collect()} == {"m"}
