"""Command line of the jobs, for spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from postlens import operators as op
from postlens.plans import run_etl, run_lexicon_report, run_report_suite
from postlens.presets import POST_SCHEMA, LexiconReport, ReportSuite
from postlens.sources import FORMATS, TABLE_FORMATS, load_lexicon, read_csv, read_json, read_parquet


def parse(arguments: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postlens")
    jobs = parser.add_subparsers(dest="job", required=True)

    etl = jobs.add_parser("etl", help="clean raw JSON lines into a post table")
    etl.add_argument("--input", required=True)
    etl.add_argument("--output", required=True)
    etl.add_argument("--format", choices=TABLE_FORMATS, default="parquet")
    etl.add_argument("--cluster-by", help="column to sort the table by, at the cost of a shuffle")

    lexicon = jobs.add_parser("lexicon", help="groups that use a lexicon most and least")
    lexicon.add_argument("--input", required=True, help="cleaned Parquet table")
    lexicon.add_argument("--lexicon", required=True, help="text file, one term per line")
    lexicon.add_argument("--comment", help="prefix of lexicon lines to skip")
    lexicon.add_argument("--output", required=True)
    lexicon.add_argument("--group", nargs="+", default=[LexiconReport.group], help="grouping columns")
    lexicon.add_argument("--min-rows", type=int, default=LexiconReport.min_rows)
    lexicon.add_argument("--k", type=int, default=LexiconReport.k)
    lexicon.add_argument("--scratch", help="shared folder for intermediate tables")

    reports = jobs.add_parser("reports", help="activity, phrase, word and topic reports")
    reports.add_argument("--input", required=True, help="cleaned Parquet table")
    reports.add_argument("--output", required=True)
    reports.add_argument("--parameters", help="JSON file with any of the suite's parameters")
    reports.add_argument("--topic", help="group of the topic reports")
    reports.add_argument("--phrase", help="pattern of the phrase report")
    reports.add_argument("--k", type=int, help="length of the rankings")
    reports.add_argument("--scratch", help="shared folder for intermediate tables")

    profile = jobs.add_parser("profile", help="row count, first rows, statistics, NULL counts")
    profile.add_argument("--input", required=True)
    profile.add_argument("--format", choices=FORMATS, default="parquet")
    profile.add_argument("--rows", type=int, default=10)
    return parser.parse_args(arguments)


def read_table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "json":
        return read_json(spark, path, POST_SCHEMA)
    return read_csv(spark, path) if fmt == "csv" else read_parquet(spark, path)


def suite_of(spark: SparkSession, args: argparse.Namespace) -> ReportSuite:
    """The standard suite, changed by the JSON file and then by the single options."""
    suite = ReportSuite()
    if args.parameters:
        lines = spark.read.text(args.parameters, wholetext=True).first()
        suite = ReportSuite.from_json(lines["value"])
    given = {name: getattr(args, name) for name in ("topic", "phrase", "k")}
    return replace(suite, **{name: value for name, value in given.items() if value is not None})


def show_profile(df: DataFrame, rows: int) -> None:
    df.printSchema()
    op.row_count(df).show()
    op.preview(df, rows).show(rows, truncate=False)
    op.describe_columns(df).show(len(df.columns))
    op.null_counts(df).show()


def main(arguments: Sequence[str] | None = None) -> None:
    args = parse(arguments)
    spark = SparkSession.builder.appName(f"postlens-{args.job}").getOrCreate()
    if args.job == "etl":
        run_etl(spark, args.input, args.output, fmt=args.format, cluster_by=args.cluster_by)
    elif args.job == "lexicon":
        terms = load_lexicon(spark, args.lexicon, comment=args.comment)
        group = args.group[0] if len(args.group) == 1 else tuple(args.group)
        report = LexiconReport(group=group, min_rows=args.min_rows, k=args.k)
        posts = read_parquet(spark, args.input)
        run_lexicon_report(spark, posts, terms, args.output, report, scratch=args.scratch)
    elif args.job == "reports":
        posts = read_parquet(spark, args.input)
        run_report_suite(spark, posts, args.output, suite_of(spark, args), scratch=args.scratch)
    else:
        show_profile(read_table(spark, args.input, args.format), args.rows)
