from helpers import frame

from stillhouse.llm import quality


def test_the_limit_does_not_grow_with_the_host(spark):
    common = "Subscribe to our newsletter for all the news of every single day and night\n"
    rows = [(i, (common if i < 20 else "") + " ".join(f"own{i}word{j}" for j in range(40)), "en", "h", None) for i in range(600)]
    got = {r.record: r for r in quality.verdicts(frame(spark, rows)).collect()}
    assert [i for i in sorted(got) if got[i].words_removed] == list(range(1, 20)) and all(r.kept for r in got.values())
