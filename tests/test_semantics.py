"""Edge behaviour of the operators on toy rows."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Row
from pyspark.sql import functions as F

from postlens import operators as op
from postlens.functions import english_stopwords


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def column(df, name):
    return [row[name] for row in df.orderBy("id").collect()]


# Cleaning


def test_all_null_rows_go_and_blank_rows_stay(spark):
    df = spark.createDataFrame([(None, None), ("", None), (" ", 1)], "a string, n int")
    assert sorted(row["a"] for row in op.drop_all_null(df).collect()) == ["", " "]


def test_empty_rows_are_dropped_before_trimming(spark):
    cleaned = op.clean_posts(texts(spark, "   "), text="text")
    assert cleaned.select("text", "content_tokens").collect() == [Row(text="", content_tokens=[""])]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("  a b  ", "a b"), ("\t a \n", "\t a \n"), ("\u00a0a ", "\u00a0a"), (None, None)],
)
def test_trim_removes_spaces_only(spark, raw, expected):
    assert column(op.trim_strings(texts(spark, raw)), "text") == [expected]


def test_trim_takes_string_columns_only_and_keeps_their_order(spark):
    df = spark.createDataFrame([(1, " a ", [" b "], " c ")], "n int, `x.y` string, l array<string>, z string")
    trimmed = op.trim_strings(df)
    assert trimmed.columns == df.columns
    assert trimmed.collect()[0] == (1, "a", [" b "], "c")


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("\n A  b\tc ", ["", "a", "b", "c", ""]),
        ("", [""]),
        (None, None),
        ("one", ["one"]),
        ("a\u00a0b", ["a\u00a0b"]),
    ],
)
def test_tokenize(spark, raw, expected):
    assert column(op.tokenize(texts(spark, raw), "text", out="t"), "t") == [expected]


def test_default_stopwords(spark):
    words = english_stopwords()
    assert len(words) == 181
    assert sum("'" in word for word in words) == 50


def test_stopwords_ignore_case_and_null(spark):
    df = spark.createDataFrame([(0, ["The", "cat", None, "IT'S"]), (1, None)], "id int, t array<string>")
    assert column(op.remove_stopwords(df, "t"), "t") == [["cat", None], None]
    assert column(op.remove_stopwords(df, "t", out="kept", stopwords=["CAT"]), "kept") == [
        ["The", None, "IT'S"],
        None,
    ]


def test_stopwords_equal_the_ml_transformer(spark, sf_dir):
    tokens = spark.read.parquet(f"{sf_dir}/documents.parquet").transform(
        op.tokenize, "text", out="tokens"
    )
    transformer = StopWordsRemover(inputCol="tokens", outputCol="expected")
    both = transformer.transform(op.remove_stopwords(tokens, "tokens", out="kept"))
    assert both.filter(~F.col("kept").eqNullSafe(F.col("expected"))).count() == 0


def test_normalize_keeps_emptied_tokens(spark):
    df = spark.createDataFrame(
        [(0, ["It's,", "---", "été", "A1_b", "İx"])], "id int, t array<string>"
    )
    assert column(op.normalize_tokens(df, "t"), "t") == [["its", "", "t", "a1b", "x"]]
    assert column(op.normalize_tokens(df, "t", drop_empty=True), "t") == [["its", "t", "a1b", "x"]]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("I'm THE cat's  it's, The --- !? été", ["cats", "its", "", "", "t"]),
        ("it's", []),
        (" \t ", ["", ""]),
        (None, None),
    ],
)
def test_clean_removes_stopwords_before_punctuation(spark, raw, expected):
    cleaned = op.clean_posts(texts(spark, raw), text="text")
    assert column(cleaned, "content_tokens") == [expected]


def test_clean_keeps_columns_and_adds_tokens(spark):
    cleaned = op.clean_posts(texts(spark, "a b"), text="text")
    assert cleaned.columns == ["id", "text", "content_tokens"]


WHITESPACE = re.compile(r"[ \t\n\x0b\f\r]+")


def cleaned_by_hand(text, stopwords):
    tokens = WHITESPACE.split(text.strip(" ").lower())
    return [re.sub("[^a-z0-9]", "", token) for token in tokens if token not in stopwords]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(alphabet="aThe it'sX9_-., \t\n\x0b\u00a0é\u2019", max_size=40),
        min_size=1,
        max_size=60,
    )
)
def test_clean_equals_a_plain_python_version(spark, values):
    stopwords = set(english_stopwords())
    result = column(op.clean_posts(texts(spark, *values), text="text"), "content_tokens")
    assert result == [cleaned_by_hand(value, stopwords) for value in values]


# Lexicon


def token_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, g, t) for i, (g, t) in enumerate(rows)],
        "id int, grp string, content_tokens array<string>",
    )


TOKEN_ROWS = [
    ("x", ["a", "a", "b", ""]),
    ("x", ["a", "c", "c"]),
    ("x", None),
    ("y", []),
    ("y", ["q", None]),
    ("z", None),
    (None, ["c"]),
]
HITS = [2, 2, None, 0, 0, None, 1]
RATES = {"x": (2.0, 3), "y": (0.0, 2), "z": (None, 1), None: (1.0, 1)}


def test_hits_are_distinct(spark):
    df = token_rows(spark, *TOKEN_ROWS)
    hits = op.lexicon_hits(df, ["a", "", "c", "never matches"])
    assert column(hits, "hits") == HITS
    assert dict(hits.dtypes)["hits"] == "int"
    assert column(op.lexicon_hits(df, []), "hits") == [0, 0, None, 0, 0, None, 0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_hits_of_null_tokens_are_null_in_both_ansi_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        hits = op.lexicon_hits(token_rows(spark, *TOKEN_ROWS), ["a", "", "c"])
        assert column(hits, "hits") == HITS
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


JOIN_FORMS = {
    "broadcast": {"broadcast": True},
    "merge": {},
    "merge, some frequent": {"frequent": {"a": True, "b": False, "": True}},
    "merge, all frequent": {
        "frequent": {"a": True, "b": False, "": True, "c": True, "q": False}
    },
    "merge, unlisted frequent": {"frequent": {"q": False}},
}


@pytest.mark.parametrize("form", list(JOIN_FORMS))
def test_joined_hits_equal_listed_hits(spark, form):
    lexicon = spark.createDataFrame([("a",), ("",), ("c",), ("c",), (None,)], "word string")
    df = token_rows(spark, *TOKEN_ROWS)
    joined = op.lexicon_hits_joined(df, lexicon, key="id", **JOIN_FORMS[form])
    assert column(joined, "hits") == HITS
    assert dict(joined.dtypes)["hits"] == "int"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.none() | st.lists(st.sampled_from(["a", "b", "c", "", "d"]), max_size=6), max_size=40),
    st.sets(st.sampled_from(["a", "b", "", "z"])),
)
def test_all_lexicon_forms_equal_python_sets(spark, posts, terms):
    df = token_rows(spark, *[("g", tokens) for tokens in posts])
    lexicon = spark.createDataFrame([(term,) for term in terms], "term string")
    expected = [None if tokens is None else len(set(tokens) & terms) for tokens in posts]
    assert column(op.lexicon_hits(df, terms), "hits") == expected
    frequent = {term: term in terms for term in "ab"}
    for form in ({"broadcast": True}, {}, {"frequent": frequent}):
        joined = op.lexicon_hits_joined(df, lexicon, key="id", **form)
        assert column(joined, "hits") == expected


def as_rates(df):
    return {row["grp"]: (row["avg_hits"], row["post_count"]) for row in df.collect()}


@pytest.mark.parametrize("form", ["list", "broadcast", "merge"])
def test_rates_count_unscored_rows_but_do_not_average_them(spark, form):
    df = token_rows(spark, *TOKEN_ROWS)
    lexicon = spark.createDataFrame([("a",), ("",), ("c",), (None,)], "word string")
    for min_rows in (0, 1, 2):
        if form == "list":
            rates = op.hit_rate_by_group(df, ["a", "", "c"], group="grp", min_rows=min_rows)
        else:
            rates = op.hit_rate_by_group_joined(
                df, lexicon, group="grp", min_rows=min_rows, **JOIN_FORMS[form]
            )
        expected = {g: v for g, v in RATES.items() if v[1] > min_rows}
        assert as_rates(rates) == expected


def test_min_rows_is_strict(spark):
    df = token_rows(spark, ("x", ["a"]), ("x", ["b"]), ("y", ["a"]))
    rates = op.hit_rate_by_group(df, ["a"], group="grp", min_rows=1)
    assert as_rates(rates) == {"x": (0.5, 2)}


def test_rank_breaks_ties_by_group(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 1.0), ("d", 2.0), ("c", 0.5), ("e", 0.5)], "grp string, avg_hits double"
    )
    most = op.rank_by_rate(df, group="grp", k=2).collect()
    least = op.rank_by_rate(df, group="grp", k=2, least=True).collect()
    assert [row["grp"] for row in most] == ["d", "a"]
    assert [row["grp"] for row in least] == ["c", "e"]


# Ranking and words


def test_ties_at_the_kth_place_keep_the_lower_key(spark):
    df = spark.createDataFrame([(g,) for g in "ccbbaade"], "g string")
    assert [tuple(row) for row in op.top_groups(df, "g", k=2).collect()] == [("a", 2), ("b", 2)]


def test_sentinel_filter_drops_null_actors(spark):
    df = spark.createDataFrame([("x",), ("[deleted]",), (None,), ("x",), ("y",)], "author string")
    result = op.active_actors(df, "author").collect()
    assert [tuple(row) for row in result] == [("x", 2), ("y", 1)]


def test_phrases_match_inside_words_and_ignore_null(spark):
    df = texts(spark, "I NEED HELPers", "nothing", None, "please help")
    result = op.phrase_trend(df.withColumn("g", F.lit("g")), "text", "(?i)(need help|please help)", "g")
    assert result.columns == ["g", "help_post_count"]
    assert [tuple(row) for row in result.collect()] == [("g", 2)]


def test_words_split_on_non_ascii_letters_and_keep_long_ones(spark):
    df = texts(spark, "Wörlds apple's APPLE apples2apples abcd", None, "", "12345 \u212aelvin")
    result = {row["word"]: row["count"] for row in op.top_words(df, "text").collect()}
    assert result == {"apple": 2, "apples": 2, "kelvin": 1}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="abcDEF \n'9éİ", max_size=60), min_size=1, max_size=40))
def test_words_equal_split_and_filter(spark, values):
    df = texts(spark, *values)
    expected = (
        df.select(F.explode(F.split(F.lower("text"), "[^a-zA-Z]+")).alias("word"))
        .filter(F.length("word") > 4)
        .groupBy("word")
        .count()
    )
    result = op.top_words(df, "text", k=None)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, expected.collect()))


# Topics

FLAGS = {"a": r"(?i)\b(t1)\b", "b": r"(?i)\b(lo)\b"}


def topic_rows(spark):
    values = ["T1_x", "t1.", "élo", "LO t1", None, "none", "t1"]
    return texts(spark, *values).withColumn(
        "n", F.when(F.col("id") != 6, F.col("id") + F.lit(2))
    )


def test_mean_outside_the_integer_range_is_an_error(spark):
    df = spark.createDataFrame([("x", 2**40)], "text string, n bigint")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        op.mention_crosstab(df, "text", "n", FLAGS).collect()


def test_one_row_may_match_both_flags_and_regexes_are_the_callers(spark):
    df = texts(spark, "nerf and buffs", "NERFS", "unnerfed")
    flags = {"a": r"(?i)\bnerf\b|\bnerfs\b", "b": r"(?i)\bbuff\b|\bbuffs\b"}
    rows = op.mention_crosstab(df.withColumn("n", F.lit(1)), "text", "n", flags).collect()
    assert [tuple(row)[:3] for row in rows] == [
        (False, False, 1),
        (True, False, 1),
        (True, True, 1),
    ]


def test_slice_excludes_null_groups(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "g string")
    assert op.topic_slice(df, "g", "a").collect() == [Row(g="a")]


def test_crosstab_has_a_third_flag_value_and_truncates_the_mean(spark):
    result = [tuple(row) for row in op.mention_crosstab(topic_rows(spark), "text", "n", FLAGS).collect()]
    assert result == [
        (False, False, 3, 4),  # (2 + 4 + 7) / 3
        (True, False, 2, 3),  # NULL length counts as a row only
        (None, None, 1, 6),
        (True, True, 1, 5),
    ]


def test_negative_means_truncate_toward_zero(spark):
    df = spark.createDataFrame([("x", -3), ("x", -4)], "text string, n int")
    assert op.mention_crosstab(df, "text", "n", FLAGS).collect()[0]["avg_post_length"] == -3


def test_categories_take_the_first_match_and_null_is_other(spark):
    labelled = op.categorize(topic_rows(spark), "text", ("A", FLAGS["a"]), ("B", FLAGS["b"]))
    assert labelled.columns == ["id", "text", "n", "discussion_type"]
    other = "General / Other"
    assert column(labelled, "discussion_type") == [other, "A", other, "Both", other, other, "A"]


def test_category_counts(spark):
    df = spark.createDataFrame([(c,) for c in "bbaac"], "discussion_type string")
    assert [tuple(row) for row in op.category_counts(df).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_topic_summary_yields_both_reports(spark):
    df = topic_rows(spark)
    rules = (("A", FLAGS["a"]), ("B", FLAGS["b"]))
    summary = op.topic_summary(df, "text", "n", FLAGS, *rules)
    crosstab = op.mention_crosstab_from_summary(summary, FLAGS)
    direct = op.mention_crosstab(df, "text", "n", FLAGS)
    assert crosstab.dtypes == direct.dtypes
    assert crosstab.collect() == direct.collect()
    counts = op.category_counts_from_summary(summary)
    expected = op.category_counts(op.categorize(df, "text", *rules))
    assert counts.dtypes == expected.dtypes
    assert counts.collect() == expected.collect()


# Profiling


def test_describe_has_the_values_of_dataframe_describe(spark):
    df = spark.createDataFrame(
        [(1, 2.5, "7", None), (None, 3.5, "b", None), (4, None, "9", None)],
        "i bigint, d double, s string, n string",
    )
    long = {row["column_name"]: row for row in op.describe_columns(df).collect()}
    for wide in df.describe().collect():
        for name in df.columns:
            value = long[name][wide["summary"]]
            assert (None if value is None else str(value)) == wide[name]
    assert (long["i"]["min_number"], long["s"]["min_number"]) == (1.0, None)


def test_describe_skips_other_types(spark):
    df = spark.sql("SELECT 1 AS i, true AS b, current_date() AS d")
    assert [row["column_name"] for row in op.describe_columns(df).collect()] == ["i"]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, `b.c` string")
    assert tuple(op.null_counts(df).collect()[0]) == (1, 2)


def test_row_count(spark):
    assert op.row_count(spark.range(7)).collect() == [Row(count=7)]


def test_preview_orders_and_truncates(spark):
    df = spark.createDataFrame([(3, "x" * 20), (1, "y" * 21), (2, None)], "id int, text string")
    rows = op.preview(df, 3, order_by="id", truncate=20).collect()
    assert [tuple(row) for row in rows] == [(1, "y" * 17 + "..."), (2, None), (3, "x" * 20)]
    assert op.preview(df, 2).count() == 2


def test_preview_cuts_without_dots_below_four(spark):
    df = spark.createDataFrame([("abcdef",)], "text string")
    cut = {n: op.preview(df, 1, truncate=n).first()["text"] for n in (1, 3, 4, 6)}
    assert cut == {1: "a", 3: "abc", 4: "a...", 6: "abcdef"}


def test_describe_without_such_columns_has_no_rows(spark):
    described = op.describe_columns(spark.sql("SELECT true AS b, current_date() AS d"))
    assert described.collect() == []
    assert described.dtypes == op.describe_columns(spark.range(1)).dtypes


def test_categorize_keeps_the_callers_columns(spark):
    df = spark.createDataFrame([("x y", 1, 2, 3)], "t string, _first int, _second int, _flags int")
    labelled = op.categorize(df, "t", ("A", "x"), ("B", "y"))
    assert labelled.columns == ["t", "_first", "_second", "_flags", "discussion_type"]
    assert tuple(labelled.first()) == ("x y", 1, 2, 3, "Both")


def test_names_may_hold_dots(spark):
    df = spark.createDataFrame([("The cat need help", "g", 5)], "`a.b` string, `g.h` string, `n.m` int")
    tokens = df.transform(op.tokenize, "a.b", out="t.u")
    assert tokens.first()["t.u"] == ["the", "cat", "need", "help"]
    assert tokens.transform(op.remove_stopwords, "t.u").first()["t.u"] == ["cat", "need", "help"]
    assert tokens.transform(op.normalize_tokens, "t.u").first()["t.u"][0] == "the"
    assert op.clean_posts(df, text="a.b").first()["content_tokens"] == ["cat", "need", "help"]
    assert op.lexicon_hits(tokens, ["cat"], tokens="t.u").first()["hits"] == 1
    lexicon = spark.createDataFrame([("cat",)], "term string")
    rates = [op.hit_rate_by_group(tokens, ["cat"], group="g.h", min_rows=0, tokens="t.u")]
    rates += [
        op.hit_rate_by_group_joined(tokens, lexicon, group="g.h", min_rows=0, tokens="t.u", broadcast=b)
        for b in (True, False)
    ]
    for df_rates in rates:
        assert df_rates.columns == ["g.h", "avg_hits", "post_count"]
        assert tuple(op.rank_by_rate(df_rates, group="g.h").first()) == ("g", 1.0, 1)
    hits = op.lexicon_hits_joined(tokens, lexicon, key="g.h", tokens="t.u")
    assert hits.columns == ["g.h", "hits"] and tuple(hits.first()) == ("g", 1)
    assert tuple(op.top_groups(df, "g.h").first()) == ("g", 1)
    assert tuple(op.active_actors(df, "g.h").first()) == ("g", 1)
    assert tuple(op.phrase_trend(df, "a.b", "help", "g.h").first()) == ("g", 1)
    assert op.top_words(df, "a.b", min_length=4, k=1).first()["word"] == "help"
    assert op.topic_slice(df, "g.h", "g").count() == 1
    assert op.mention_crosstab(df, "a.b", "n.m", {"f.x": "cat"}).first()["avg_post_length"] == 5
    assert op.categorize(df, "a.b", ("A", "cat"), ("B", "dog")).first()["discussion_type"] == "A"
    assert op.preview(df, 1, order_by="n.m", truncate=3).first()["a.b"] == "The"


def test_struct_fields_still_serve_as_names(spark):
    df = spark.sql("SELECT named_struct('t', 'a b') AS s")
    assert op.tokenize(df, "s.t").first()["content_tokens"] == ["a", "b"]
