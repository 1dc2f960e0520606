from helpers import frame
from test_linededup import rest

from stillhouse.llm import linededup


def test_lines_of_few_words_or_none_of_our_blanks_are_compared(spark):
    chinese = "本网站的所有内容均受版权法保护未经许可不得转载或用于商业用途"
    first = ["All rights reserved.", "Ok", chinese, "}", "", "Some line of its own in the first text"]
    second = ["all  rights RESERVED.", "ok", chinese + "。", "}", "", "Off", " \t"]
    docs = [(1, "\n".join(first), None, None, None), (2, "\n".join(second), None, None, None)]
    left = {r.doc_id: r.text for r in linededup.dedup_lines(frame(spark, docs)).collect()}
    assert left == {1: "\n".join(first), 2: rest(docs[1][1], {0, 1, 2, 3})}
