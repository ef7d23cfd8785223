"""Scans, sinks, lexicon files and the scratch folder."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postlens import sources as src
from postlens.operators import clean_posts, drop_all_null
from postlens.presets import POST_SCHEMA


def write_lines(folder: Path, *lines: str) -> str:
    path = folder / "in.txt"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_json_scan_is_permissive(spark, tmp_path):
    path = write_lines(
        tmp_path,
        "{bad json",
        '{"a":"y","n":"7"}',
        '{"A":"x"}',
        "",
        '{"a":5,"n":1.5}',
        '{"a":{"k":[1]},"n":3000000000}',
        "[]",
        '{"a":"ok","n":2}',
    )
    rows = [tuple(row) for row in src.read_json(spark, path, "a string, n int").collect()]
    assert rows == [
        (None, None),
        ("y", None),
        (None, None),
        ("5", None),
        ('{"k":[1]}', None),
        ("ok", 2),
    ]
    assert drop_all_null(src.read_json(spark, path, "a string, n int")).count() == 4


def test_json_scan_takes_the_post_schema(spark, tmp_path):
    path = write_lines(tmp_path, '{"author":"x","content_len":3,"unknown":1}')
    posts = src.read_json(spark, path, POST_SCHEMA)
    assert len(posts.columns) == 10
    assert posts.select("author", "content_len").collect()[0] == ("x", 3)


def test_csv_scan_infers_or_takes_a_schema(spark, tmp_path):
    path = write_lines(tmp_path, "a,b,c", "1,x,1.5", "2,,2.5")
    inferred = src.read_csv(spark, path)
    assert inferred.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert [tuple(row) for row in inferred.collect()] == [(1, "x", 1.5), (2, None, 2.5)]
    given = src.read_csv(spark, path, "a bigint, b string, c string")
    assert [tuple(row) for row in given.collect()] == [(1, "x", "1.5"), (2, None, "2.5")]


def test_lexicon_lines_are_stripped_and_blank_ones_dropped(spark, tmp_path):
    path = write_lines(
        tmp_path, "# comment", "  word ", "", "\t\u00a0", "two words", "Hy-phen", "word", "\u3000x\x1f"
    )
    plain = [row[0] for row in src.load_lexicon(spark, path).collect()]
    assert plain == ["# comment", "word", "two words", "Hy-phen", "word", "x"]
    cleaned = src.load_lexicon(spark, path, comment="#", distinct=True, normalize=True)
    assert sorted(row[0] for row in cleaned.collect()) == ["hyphen", "twowords", "word", "x"]


def test_lexicon_size_checks(spark):
    lexicon = spark.range(50).select(F.col("id").cast("string").alias("term"))
    assert len(src.terms_if_few(lexicon, src.LexiconLimits(plan_terms=50))) == 50
    assert src.terms_if_few(lexicon, src.LexiconLimits(plan_terms=49)) is None
    # 90 digits and 16 bytes per term
    assert src.may_broadcast(lexicon, src.LexiconLimits(broadcast_bytes=890))
    assert not src.may_broadcast(lexicon, src.LexiconLimits(broadcast_bytes=889))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_cleaned_table_survives_the_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, " Some, words "), (2, None)], "id int, content string")
    cleaned = clean_posts(df)
    path = str(tmp_path / "out")
    src.write_table(cleaned, path, fmt)
    src.write_table(cleaned, path, fmt)  # overwrites
    back = (
        src.read_parquet(spark, path) if fmt == "parquet" else src.read_json(spark, path, cleaned.schema)
    )
    assert back.orderBy("id").collect() == cleaned.orderBy("id").collect()


def test_csv_refuses_nested_columns_and_unknown_formats(spark, tmp_path):
    nested = spark.sql("SELECT array('a') AS tokens")
    with pytest.raises(ValueError, match="tokens"):
        src.write_table(nested, str(tmp_path / "a"), "csv")
    with pytest.raises(ValueError, match="orc"):
        src.write_table(nested, str(tmp_path / "b"), "orc")


def test_report_is_one_ordered_csv_file_with_a_header(spark, tmp_path):
    path = tmp_path / "report"
    report = spark.range(100).repartition(8).orderBy(F.desc("id"))
    src.write_report(report, str(path))
    files = list(path.glob("part-*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().split()
    assert lines == ["id", *[str(n) for n in range(99, -1, -1)]]


class FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class FakeSession:
    def __init__(self, **values):
        self.conf = FakeConf({key.replace("_", "."): value for key, value in values.items()})


def test_scratch_uses_the_checkpoint_folder():
    session = FakeSession(spark_checkpoint_dir="hdfs://x/shared/", spark_master="yarn")
    first, second = src.scratch_folder(session), src.scratch_folder(session)
    assert first.startswith("hdfs://x/shared/postlens-")
    assert first != second


def test_scratch_takes_a_folder_and_needs_one():
    assert src.scratch_folder(FakeSession(), "s3://b/x/").startswith("s3://b/x/postlens-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        src.scratch_folder(FakeSession(spark_master="local[2]"))


def test_delete_folder(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    spark.range(3).write.parquet(path)
    src.delete_folder(spark, path)
    src.delete_folder(spark, path)
    assert list(tmp_path.iterdir()) == []


TEXTS = [
    None, "", " lead", "tail\t ", "a\nb", "a\r\nb\rc", 'quo"te', '"', "back\\slash\\", "\\", ",", " ", "#x", "é🙂\u2028", "\n",
]


def test_csv_keeps_every_text(spark, tmp_path):
    rows = [(i, text, "x") for i, text in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, text string, last string").coalesce(1)
    src.write_table(df, f"{tmp_path}/t", "csv")
    back = src.read_csv(spark, f"{tmp_path}/t", df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows
    src.write_report(df.orderBy("id"), f"{tmp_path}/r")
    back = src.read_csv(spark, f"{tmp_path}/r", df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_without_line_breaks_needs_no_multi_line(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t is None or not set(t) & {"\n", "\r"}]
    df = spark.createDataFrame(rows, "id int, text string")
    src.write_table(df, f"{tmp_path}/t", "csv")
    assert sorted(map(tuple, src.read_csv(spark, f"{tmp_path}/t", df.schema).collect())) == rows
