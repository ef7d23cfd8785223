from __future__ import annotations

from postlens.llm import language_id
from tests.llm.test_language_id import corpus, table


def test_a_language_of_few_texts_with_many_copies_is_learned(spark):
    few = [(1000 + i, ["zorv klim wexu", "klim zorv"][i % 2], "dd") for i in range(400)]
    rows = [*corpus(), *few]
    got = language_id.language_id(table(spark, rows), sample_docs=20).filter("doc_id >= 1000 AND held_out").collect()
    assert {r["lang_pred"] for r in got} == {"dd"}


def test_copies_do_not_change_the_model(spark):
    rows = list(corpus())
    hot = next(r for r in rows if r[2] == "aa")
    once, often = (language_id.fit(table(spark, r), sample_docs=25) for r in (rows, [*rows, *[hot] * 500]))
    assert once.languages == often.languages and (once.masks == often.masks).all()
