"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from postlens import operators as op
from postlens.functions import english_stopwords
from tests.conftest import TESTDATA

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    folder = TESTDATA / request.param
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield str(folder), connection
    connection.close()


def rows_of(names, rows, ordered=False):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(round(row[i], 9) if isinstance(row[i], float) else row[i] for i in order) for row in rows]
    return plain if ordered else sorted(plain, key=repr)


def is_ranking(sql):
    """Whether the rows have an order: the last clause of the statement says one."""
    return re.search(r"ORDER BY [^()]*$", sql) is not None


SPARK_TYPES = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "INTEGER": "int",
    "VARCHAR": "string",
}


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLE])
def test_query_equals_oracle(spark, scale, name):
    folder, connection = scale
    df = QUERIES[name](spark, folder)
    ordered = is_ranking(ORACLE[name])
    result = rows_of(df.columns, [tuple(row) for row in df.collect()], ordered)
    cursor = connection.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    expected = rows_of(columns, cursor.fetchall(), ordered)
    described = connection.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert dict(df.dtypes) == {row[0]: SPARK_TYPES[row[1]] for row in described}
    assert len(result) == len(expected)
    assert result == expected
    if "sf0.01" in folder and not folder.endswith("sf0.001"):
        assert result


def test_rankings_are_compared_in_order():
    ranked = {name for name, sql in ORACLE.items() if is_ranking(sql)}
    names = "preview sink_csv most_lexicon least_lexicon top_groups active_actors phrase_trend word_count_topk"
    assert ranked == set(names.split())


def test_every_query_has_an_oracle():
    """The queries of the llm package that SQL cannot express have tests of their own."""
    llm = {} if registry.llm is None else {**registry.llm.queries(), "pipeline": None}
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(llm) == set(ORACLE) - set(llm)


def test_oracle_stopwords_are_the_default_list(spark):
    assert registry.STOPWORDS == english_stopwords()


def test_entry_returns_ranked_sources(spark):
    rows = registry.entry(spark).collect()
    rates = [row["avg_hits"] for row in rows]
    assert len(rows) == 10
    assert rates == sorted(rates, reverse=True)
    assert all(not math.isnan(rate) for rate in rates)


def wrong_queries(spark, folder):
    """Queries with a filter, limit or direction taken out; their checks must notice."""
    cleaned = registry.cleaned_documents(spark, folder, *registry.SIZE_GROUP)
    documents = registry.documents(spark, folder)
    rates = registry.lexicon_rate_by_group(spark, folder)
    every = op.hit_rate_by_group(cleaned, registry.LEXICON, group=registry.SIZE_GROUP, min_rows=0)
    group = registry.SIZE_GROUP
    return {
        "lexicon_rate_by_group": [every],
        "most_lexicon": [
            op.rank_by_rate(every, group=group),
            op.rank_by_rate(rates, group=group, least=True),
            op.rank_by_rate(rates, group=group, k=None),
            op.rank_by_rate(rates, group=group).orderBy("avg_hits"),
        ],
        "least_lexicon": [op.rank_by_rate(every, group=group, least=True), op.rank_by_rate(rates, group=group)],
        "top_groups": [
            op.top_groups(documents, ["source", "lang"], k=None),
            op.top_groups(documents, ["source", "lang"]).orderBy("count"),
        ],
        "active_actors": [op.top_groups(registry.table(spark, folder, "events"), "user_id")],
        "phrase_trend": [
            op.phrase_trend(documents, "text", "", "source"),
            op.phrase_trend(documents, "text", registry.PHRASE, "source", k=None),
        ],
        "word_count_topk": [
            op.top_words(documents, "text", min_length=4),
            op.top_words(documents, "text", k=16),
        ],
        "preview": [op.preview(documents, 10, order_by="text"), op.preview(documents, 9, order_by="doc_id")],
    }


def test_checks_notice_what_is_taken_out(spark):
    folder = str(TESTDATA / "sf0.01")
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name, wrong in wrong_queries(spark, folder).items():
        cursor = connection.execute(ORACLE[name])
        columns = [column[0] for column in cursor.description]
        ordered = is_ranking(ORACLE[name])
        expected = rows_of(columns, cursor.fetchall(), ordered)
        for df in wrong:
            assert rows_of(df.columns, [tuple(r) for r in df.collect()], ordered) != expected, name
    suite, report = dict(registry.REPORT_SUITE.__dict__), dict(registry.LEXICON_REPORT.__dict__)
    for name, setting, changes in (
        ("report_suite", suite, [{"k": 11}, {"k_words": 16}, {"topic": "en-2"}, {"deleted_actor": ""}, {"phrase": "a"}]),
        ("lexicon_report", report, [{"min_rows": 0}, {"k": 3}, {"most_name": "least_swearing", "least_name": "most_swearing"}]),
    ):
        cursor = connection.execute(ORACLE[name])
        expected = rows_of([c[0] for c in cursor.description], cursor.fetchall())
        for change in changes:
            changed = {**setting, **change}
            constant = "REPORT_SUITE" if name == "report_suite" else "LEXICON_REPORT"
            before = getattr(registry, constant)
            setattr(registry, constant, type(before)(**changed))
            try:
                df = QUERIES[name](spark, folder)
                assert rows_of(df.columns, [tuple(r) for r in df.collect()]) != expected, change
            finally:
                setattr(registry, constant, before)
