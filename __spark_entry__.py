"""Registered queries: every operator over the given tables, with its DuckDB counterpart."""

from __future__ import annotations

import logging
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import operators as op
from postlens.functions import split_tokens
from postlens.plans import (
    group_rates,
    post_hits,
    run_etl,
    run_lexicon_report,
    run_report_suite,
)
from postlens.presets import POST_SCHEMA, LexiconReport, ReportSuite
from postlens.sources import (
    LexiconLimits,
    load_lexicon,
    read_csv,
    read_json,
    read_parquet,
    scratch_folder,
    write_report,
    write_table,
)

try:
    import corpus_pipeline
    from postlens.llm import queries as llm
except ModuleNotFoundError as missing:
    # The subpackage, its pipeline or a package that they need may be absent; the other queries need none of them.
    logging.getLogger(__name__).warning("training-data queries are left out: %s", missing)
    corpus_pipeline = llm = None

# The test texts are invented words, so the queries use terms that occur in them.
LEXICON = ["thatin", "ononst", "inoran", "tion", "rewh", "orre", "dans", "elle"]
PHRASE = "(?i)(need help|of the|in the)"
FLAGS = {"mentions_a": r"(?i)\b(thatin)\b", "mentions_b": r"(?i)\b(ononst)\b"}
CATEGORY_A = ("A", r"(?i)\b(thatin|inoran)\b")
CATEGORY_B = ("B", r"(?i)\b(ononst|rewh)\b")
DOCUMENT_SCHEMA = "doc_id bigint, lang string, source string, n_chars bigint, text string"

# Limits that make the queries on a lexicon table join it, by broadcast or by merge.
BROADCAST_LIMITS = LexiconLimits(plan_terms=0)
MERGE_LIMITS = LexiconLimits(plan_terms=0, broadcast_bytes=0, frequent_terms=1000)
LIST_LIMITS = LexiconLimits(plan_terms=1_000_000)
# Groups by language and length have sizes of all kinds at any scale: the minimum drops
# some and keeps some, and there are more of them than a ranking shows.
SIZE_GROUP = ("lang", "size_class")
MIN_ROWS = 5
LEXICON_REPORT = LexiconReport(min_rows=MIN_ROWS, k=2)
REPORT_SUITE = ReportSuite(
    deleted_actor="en-src1",
    phrase=PHRASE,
    topic="en-1",
    flags=tuple(FLAGS.items()),
    categories=(CATEGORY_A, CATEGORY_B),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


_local_folders: list[tempfile.TemporaryDirectory] = []


def scratch_parent(spark: SparkSession) -> str:
    """The shared folder; a local session without one gets a temporary folder of this process."""
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if parent or not spark.conf.get("spark.master", "").startswith("local"):
        return parent or ""
    _local_folders.append(tempfile.TemporaryDirectory(prefix="postlens-"))
    return _local_folders[-1].name


def with_checkpoint_folder(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with a checkpoint folder for a local session that has none."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
            if parent := scratch_parent(spark):
                spark.sparkContext.setCheckpointDir(parent)
        return query(spark, sf_dir)

    return run


def new_folder(spark: SparkSession) -> str:
    return scratch_folder(spark, scratch_parent(spark))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in the raw post schema, with padded content and some NULL authors."""
    return documents(spark, sf_dir).select(
        F.when(F.col("lang") != "fr", F.concat_ws("-", "lang", "source")).alias("author"),
        F.col("text").alias("body"),
        F.lower("source").alias("normalizedBody"),
        F.concat(F.lit("  "), "text", F.lit(" ")).alias("content"),
        F.col("n_chars").cast("int").alias("content_len"),
        F.col("text").alias("summary"),
        F.col("n_chars").cast("int").alias("summary_len"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("subreddit"),
        F.concat(F.lit(" "), "source", F.lit("\t")).alias("subreddit_id"),
    )


def write_json_lines(df: DataFrame, broken: Column) -> str:
    """Write rows as JSON lines, those flagged as broken being unreadable; returns the path."""
    path = new_folder(df.sparkSession)
    line = F.to_json(F.struct(*df.columns))
    df.select(F.when(broken, F.concat(F.lit("{bad "), line)).otherwise(line)).write.text(path)
    return path


def token_digest(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """Arrays as size and digest, so that results of any length compare."""
    return df.select(
        *keep,
        F.array_size(tokens).alias("n_tokens"),
        F.md5(F.array_join(tokens, " ")).alias("tokens_md5"),
    )


def cleaned_digest(cleaned: DataFrame) -> DataFrame:
    return token_digest(
        cleaned.withColumn("content_md5", F.md5("content")),
        "content_tokens",
        "id",
        "author",
        "subreddit",
        "subreddit_id",
        "content_len",
        "content_md5",
    )


def document_digest(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).transform(op.tokenize, "text", out="tokens")


def cleaned_documents(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """Cleaned texts with some columns; ``size_class`` counts the length in steps of 500."""
    sized = documents(spark, sf_dir).withColumn("size_class", F.expr("n_chars div 500"))
    return sized.select(*keys, "text").transform(op.clean_posts, text="text")


def sized_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts, grouped by language and length in place of the language."""
    size_class = F.expr("content_len div 500").cast("string")
    return posts(spark, sf_dir).withColumn("subreddit", F.concat_ws("-", "subreddit", size_class))


def benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon that grows with the data: the words of the benchmark passages."""
    return table(spark, sf_dir, "benchmark").select(
        F.explode(split_tokens(F.col("text"))).alias("term")
    )


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    path = write_json_lines(rows, F.col("lang") == "es")
    return document_digest(read_json(spark, path, DOCUMENT_SCHEMA))


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_digest(documents(spark, sf_dir))


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    events = table(spark, sf_dir, "events").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    write_table(events, path, "csv")
    return read_csv(spark, path).withColumns(
        {
            "event_id": F.col("event_id").cast("bigint"),
            "user_id": F.col("user_id").cast("bigint"),
            "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
    )


def lexicon_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    documents(spark, sf_dir).select("text").write.text(path)
    return load_lexicon(spark, path)


def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    write_table(op.clean_posts(posts(spark, sf_dir)), path, "parquet")
    return cleaned_digest(read_parquet(spark, path))


def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    cleaned = op.clean_posts(posts(spark, sf_dir))
    write_table(cleaned, path, "json")
    return cleaned_digest(read_json(spark, path, cleaned.schema))


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    write_report(op.top_groups(documents(spark, sf_dir), ["source", "lang"], k=20), path)
    return read_csv(spark, path).withColumn("count", F.col("count").cast("bigint"))


def csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, outer blanks, empty strings and NULLs through CSV files."""
    path = new_folder(spark)
    padded = documents(spark, sf_dir).withColumns(
        {
            "text": F.concat(F.lit(" \t"), "text", F.lit('\n"quoted", \\ ')),
            "lang": F.when(F.col("lang") != "fr", F.col("lang")),
            "source": F.when(F.col("source") == "src1", F.lit("")).otherwise(F.col("source")),
        }
    )
    write_table(padded, path, "csv")
    return document_digest(read_csv(spark, path, padded.schema, multi_line=True))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.preview(documents(spark, sf_dir), 10, order_by="doc_id")


def drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.col("lang") != "en"
    masked = documents(spark, sf_dir).select(
        F.when(known, F.col("doc_id")).alias("doc_id"),
        F.when(known, F.md5("text")).alias("text_md5"),
        F.when(F.col("source") != "src1", F.col("source")).alias("source"),
    )
    return op.drop_all_null(masked)


def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = documents(spark, sf_dir).withColumns(
        {
            "text": F.concat(F.lit("   "), "text", F.lit("  ")),
            "lang": F.concat(F.lit(" \t "), "lang", F.lit("\u00a0 ")),
        }
    )
    return document_digest(op.trim_strings(padded))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(tokenized(spark, sf_dir), "tokens", "doc_id")


def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = tokenized(spark, sf_dir).transform(op.remove_stopwords, "tokens")
    return token_digest(kept, "tokens", "doc_id")


def normalize_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = tokenized(spark, sf_dir).transform(op.normalize_tokens, "tokens")
    return token_digest(cleaned, "tokens", "doc_id")


def clean_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_digest(op.clean_posts(posts(spark, sf_dir)))


def etl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = write_json_lines(posts(spark, sf_dir), F.col("subreddit") == "es")
    cleaned = new_folder(spark)
    run_etl(spark, raw, cleaned, schema=POST_SCHEMA)
    return cleaned_digest(read_parquet(spark, cleaned))


def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = op.lexicon_hits(cleaned_documents(spark, sf_dir, "doc_id"), LEXICON)
    return hits.select("doc_id", "hits")


def hits_by_table(spark: SparkSession, sf_dir: str, limits: LexiconLimits) -> DataFrame:
    cleaned = cleaned_documents(spark, sf_dir, "doc_id")
    terms, scratch = benchmark_terms(spark, sf_dir), scratch_parent(spark)
    return post_hits(cleaned, terms, key="doc_id", limits=limits, scratch=scratch)


def lexicon_hits_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_by_table(spark, sf_dir, BROADCAST_LIMITS)


def lexicon_hits_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_by_table(spark, sf_dir, MERGE_LIMITS)


def lexicon_hits_any_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits by a key that repeats and is NULL for some rows, in all three forms."""
    masked = F.when(F.col("lang") != "fr", F.col("lang")).alias("lang")
    cleaned = cleaned_documents(spark, sf_dir, "lang").select(masked, "content_tokens")
    terms, scratch = benchmark_terms(spark, sf_dir), scratch_parent(spark)
    united = None
    for form, limits in (("list", LIST_LIMITS), ("broadcast", BROADCAST_LIMITS), ("merge", MERGE_LIMITS)):
        hits = post_hits(cleaned, terms, key="lang", limits=limits, scratch=scratch)
        hits = hits.select(F.lit(form).alias("form"), "lang", "hits")
        united = hits if united is None else united.unionByName(hits)
    return united


def lexicon_rate_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hit_rate_by_group(
        cleaned_documents(spark, sf_dir, *SIZE_GROUP), LEXICON, group=SIZE_GROUP, min_rows=MIN_ROWS
    )


def rate_by_table(spark: SparkSession, sf_dir: str, limits: LexiconLimits) -> DataFrame:
    return group_rates(
        cleaned_documents(spark, sf_dir, *SIZE_GROUP),
        benchmark_terms(spark, sf_dir),
        LexiconReport(group=SIZE_GROUP, min_rows=MIN_ROWS, rate_name="avg_hits"),
        limits=limits,
        scratch=scratch_parent(spark),
    )


def lexicon_rate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_by_table(spark, sf_dir, BROADCAST_LIMITS)


def lexicon_rate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_by_table(spark, sf_dir, MERGE_LIMITS)


def most_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rank_by_rate(lexicon_rate_by_group(spark, sf_dir), group=SIZE_GROUP)


def least_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rank_by_rate(lexicon_rate_by_group(spark, sf_dir), group=SIZE_GROUP, least=True)


def lexicon_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = new_folder(spark)
    cleaned = op.clean_posts(sized_posts(spark, sf_dir))
    scratch = scratch_parent(spark)
    paths = run_lexicon_report(spark, cleaned, LEXICON, output, LEXICON_REPORT, scratch=scratch)
    schema = "subreddit string, avg_swear_words_per_post double, post_count bigint"
    most, least = (
        read_csv(spark, path, schema).withColumn("report", F.lit(name))
        for name, path in paths.items()
    )
    return most.unionByName(least)


def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.top_groups(documents(spark, sf_dir), ["source", "lang"])


def active_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.active_actors(table(spark, sf_dir, "events"), "user_id", sentinel=149)


def phrase_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.phrase_trend(documents(spark, sf_dir), "text", PHRASE, "source")


def word_count_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.top_words(documents(spark, sf_dir), "text")


def topic_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_digest(op.topic_slice(documents(spark, sf_dir), "lang", "en"))


def mention_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.mention_crosstab(documents(spark, sf_dir), "text", "n_chars", FLAGS)


def categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = op.categorize(documents(spark, sf_dir), "text", CATEGORY_A, CATEGORY_B)
    return labelled.select("doc_id", "discussion_type")


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.category_counts(categorize(spark, sf_dir))


def report_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = new_folder(spark)
    sized, scratch = sized_posts(spark, sf_dir), scratch_parent(spark)
    paths = run_report_suite(spark, sized, output, REPORT_SUITE, scratch=scratch)
    rows = []
    for name, path in paths.items():
        report = spark.read.csv(path, header=True)
        has_mean = "avg_post_length" in report.columns
        *keys, count = [c for c in report.columns if c != "avg_post_length"]
        mean = F.col("avg_post_length") if has_mean else F.lit(None)
        rows.append(
            report.select(
                F.lit(name).alias("report"),
                F.concat_ws("/", *keys).alias("label"),
                F.col(count).cast("bigint").alias("n"),
                mean.cast("int").alias("mean_length"),
            )
        )
    united = rows[0]
    for other in rows[1:]:
        united = united.unionByName(other)
    return united


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.row_count(table(spark, sf_dir, "lineitem"))


def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = op.describe_columns(table(spark, sf_dir, "events"))
    return described.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = documents(spark, sf_dir).withColumns(
        {
            "text": F.when(F.col("lang") != "fr", F.col("text")),
            "source": F.when(F.col("source") != "src1", F.col("source")),
            "n_chars": F.when(F.col("n_chars") > 1000, F.col("n_chars")),
        }
    )
    return op.null_counts(masked)


def entry(spark: SparkSession) -> DataFrame:
    """Sources whose documents use the listed words most."""
    cleaned = cleaned_documents(spark, "/root/testdata/sf0.001", "source")
    rates = op.hit_rate_by_group(cleaned, LEXICON, group="source", min_rows=5)
    return op.rank_by_rate(rates, group="source")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator; each callable takes (spark, sf_dir)."""
    more = {} if llm is None else {**llm.queries(), "pipeline": corpus_pipeline.run}
    more = {name: with_checkpoint_folder(query) for name, query in more.items()}
    return {
        "scan_json": scan_json,
        "scan_parquet": scan_parquet,
        "scan_csv": scan_csv,
        "load_lexicon": lexicon_load,
        "sink_parquet": sink_parquet,
        "sink_json": sink_json,
        "sink_csv": sink_csv,
        "csv_text": csv_text,
        "preview": preview,
        "drop_all_null": drop_all_null,
        "trim_strings": trim_strings,
        "tokenize": tokenize,
        "remove_stopwords": remove_stopwords,
        "normalize_tokens": normalize_tokens,
        "clean_posts": clean_posts,
        "etl_roundtrip": etl_roundtrip,
        "lexicon_hits": lexicon_hits,
        "lexicon_hits_table": lexicon_hits_table,
        "lexicon_hits_merge": lexicon_hits_merge,
        "lexicon_hits_any_key": lexicon_hits_any_key,
        "lexicon_rate_by_group": lexicon_rate_by_group,
        "lexicon_rate_table": lexicon_rate_table,
        "lexicon_rate_merge": lexicon_rate_merge,
        "most_lexicon": most_lexicon,
        "least_lexicon": least_lexicon,
        "lexicon_report": lexicon_report,
        "top_groups": top_groups,
        "active_actors": active_actors,
        "phrase_trend": phrase_trend,
        "word_count_topk": word_count_topk,
        "topic_slice": topic_slice,
        "mention_crosstab": mention_crosstab,
        "categorize": categorize,
        "category_counts": category_counts,
        "report_suite": report_suite,
        "row_count": row_count,
        "describe_columns": describe_columns,
        "null_counts": null_counts,
        **more,
    }


# The default English stopword list of Spark ML.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what
which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't
didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + value.replace("'", "''") + "'" for value in values) + "]"


def sql_tokens(text: str) -> str:
    return rf"string_split_regex(lower({text}), '\s+')"


def sql_kept(tokens: str) -> str:
    return f"list_filter({tokens}, lambda x: NOT list_contains({sql_list(STOPWORDS)}, x))"


def sql_normalized(tokens: str) -> str:
    return (
        f"list_transform({tokens}, "
        "lambda x: lower(regexp_replace(x, '[^a-zA-Z0-9]', '', 'g')))"
    )


def sql_mentions(text: str, terms: str) -> str:
    """Word match with Unicode boundaries, as Java has them."""
    bound = r"[^\p{L}\p{Nd}_]"
    return f"regexp_matches({text}, '(?i)(^|{bound})({terms})($|{bound})')"


def oracle_sql() -> dict[str, str]:
    """For each query, SQL that DuckDB can run on the same Parquet tables."""
    document_columns = "doc_id, lang, source, n_chars, md5(text) AS text_md5"
    clean_tokens = sql_normalized(sql_kept(sql_tokens("text")))
    cleaned_select = f"""
        SELECT cast(doc_id AS varchar) AS id,
               CASE WHEN lang <> 'fr' THEN lang || '-' || source END AS author,
               lang AS subreddit, source || chr(9) AS subreddit_id,
               cast(n_chars AS integer) AS content_len, md5(text) AS content_md5,
               cast(len(tokens) AS integer) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5
        FROM (SELECT *, {clean_tokens} AS tokens FROM documents)"""
    hits = f"SELECT *, len(list_intersect({clean_tokens}, {sql_list(LEXICON)})) AS hits"
    size_class = "n_chars // 500"
    rates = f"""
        SELECT lang, {size_class} AS size_class, avg(hits) AS avg_hits, count(*) AS post_count
        FROM ({hits} FROM documents) GROUP BY 1, 2 HAVING count(*) > {MIN_ROWS}"""
    term_pairs = f"""
        SELECT DISTINCT d.doc_id, d.term
        FROM (SELECT doc_id, unnest({clean_tokens}) AS term FROM documents) d
        WHERE d.term IN (SELECT unnest({sql_tokens("text")}) FROM benchmark)"""
    table_hits = f"""
        SELECT doc_id, lang, n_chars, cast(coalesce(n, 0) AS integer) AS hits
        FROM documents
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM ({term_pairs}) GROUP BY doc_id)
        USING (doc_id)"""
    table_rates = f"""
        SELECT lang, {size_class} AS size_class, avg(hits) AS avg_hits, count(*) AS post_count
        FROM ({table_hits}) GROUP BY 1, 2 HAVING count(*) > {MIN_ROWS}"""
    sized = f"lang || '-' || cast({size_class} AS varchar)"
    report_rates = f"""
        SELECT {sized} AS subreddit, avg(hits) AS avg_swear_words_per_post,
               count(*) AS post_count
        FROM ({hits} FROM documents) GROUP BY 1 HAVING count(*) > {MIN_ROWS}"""
    in_a = sql_mentions("text", "thatin")
    in_b = sql_mentions("text", "ononst")
    category = f"""
        CASE WHEN {sql_mentions("text", "thatin|inoran")}
              AND {sql_mentions("text", "ononst|rewh")} THEN 'Both'
             WHEN {sql_mentions("text", "thatin|inoran")} THEN 'A'
             WHEN {sql_mentions("text", "ononst|rewh")} THEN 'B'
             ELSE 'General / Other' END"""
    crosstab = f"""
        SELECT {in_a} AS mentions_a, {in_b} AS mentions_b, count(*) AS total_posts,
               cast(trunc(avg(n_chars)) AS integer) AS avg_post_length"""
    words = r"""
        SELECT word, count(*) AS "count"
        FROM (SELECT unnest(string_split_regex(lower(text), '[^a-zA-Z]+')) AS word
              FROM documents)
        WHERE length(word) > 4 GROUP BY word ORDER BY 2 DESC, 1 LIMIT 15"""
    space = r"[\s\v\x1c-\x1f\x85\p{Z}]"

    def described(column: str, numeric: bool) -> str:
        number = f"cast({column} AS double)" if numeric else f"try_cast({column} AS double)"
        low, high = (f"min({number})", f"max({number})") if numeric else ("NULL", "NULL")
        return f"""
        SELECT '{column}' AS column_name, count({column}) AS "count",
               round(avg({number}), 6) AS mean, round(stddev_samp({number}), 6) AS stddev,
               cast(min({column}) AS varchar) AS "min", cast(max({column}) AS varchar) AS "max",
               cast({low} AS double) AS min_number, cast({high} AS double) AS max_number
        FROM events"""

    more = {} if llm is None else llm.oracle_sql()
    if llm is not None and corpus_pipeline.ORACLE_SQL is not None:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {
        "scan_json": """
            SELECT CASE WHEN lang <> 'es' THEN doc_id END AS doc_id,
                   CASE WHEN lang <> 'es' THEN lang END AS lang,
                   CASE WHEN lang <> 'es' THEN source END AS source,
                   CASE WHEN lang <> 'es' THEN n_chars END AS n_chars,
                   CASE WHEN lang <> 'es' THEN md5(text) END AS text_md5
            FROM documents""",
        "scan_parquet": f"SELECT {document_columns} FROM documents",
        "scan_csv": """
            SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type,
                   "value", props
            FROM events""",
        "load_lexicon": rf"""
            SELECT term
            FROM (SELECT regexp_replace(line, '^{space}+|{space}+$', '', 'g') AS term
                  FROM (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS line
                        FROM documents))
            WHERE length(term) > 0""",
        "sink_parquet": cleaned_select,
        "sink_json": cleaned_select,
        "sink_csv": """
            SELECT source, lang, count(*) AS "count" FROM documents GROUP BY source, lang
            ORDER BY 3 DESC, 1, 2 LIMIT 20""",
        "csv_text": """
            SELECT doc_id, CASE WHEN lang <> 'fr' THEN lang END AS lang,
                   CASE WHEN source = 'src1' THEN '' ELSE source END AS source, n_chars,
                   md5(' ' || chr(9) || text || chr(10) || '"quoted", \\ ') AS text_md5
            FROM documents""",
        "preview": """
            SELECT doc_id, text, lang, source, n_chars FROM documents
            ORDER BY doc_id LIMIT 10""",
        "drop_all_null": """
            SELECT CASE WHEN lang <> 'en' THEN doc_id END AS doc_id,
                   CASE WHEN lang <> 'en' THEN md5(text) END AS text_md5,
                   nullif(source, 'src1') AS source
            FROM documents WHERE lang <> 'en' OR source <> 'src1'""",
        "trim_strings": """
            SELECT doc_id, chr(9) || ' ' || lang || chr(160) AS lang, source, n_chars,
                   md5(trim(text, ' ')) AS text_md5
            FROM documents""",
        "tokenize": f"""
            SELECT doc_id, cast(len(tokens) AS integer) AS n_tokens,
                   md5(array_to_string(tokens, ' ')) AS tokens_md5
            FROM (SELECT doc_id, {sql_tokens("text")} AS tokens FROM documents)""",
        "remove_stopwords": f"""
            SELECT doc_id, cast(len(tokens) AS integer) AS n_tokens,
                   md5(array_to_string(tokens, ' ')) AS tokens_md5
            FROM (SELECT doc_id, {sql_kept(sql_tokens("text"))} AS tokens FROM documents)""",
        "normalize_tokens": f"""
            SELECT doc_id, cast(len(tokens) AS integer) AS n_tokens,
                   md5(array_to_string(tokens, ' ')) AS tokens_md5
            FROM (SELECT doc_id, {sql_normalized(sql_tokens("text"))} AS tokens
                  FROM documents)""",
        "clean_posts": cleaned_select,
        "etl_roundtrip": cleaned_select + " WHERE lang <> 'es'",
        "lexicon_hits": f"""
            SELECT doc_id, cast(hits AS integer) AS hits FROM ({hits} FROM documents)""",
        "lexicon_hits_table": f"SELECT doc_id, hits FROM ({table_hits})",
        "lexicon_hits_merge": f"SELECT doc_id, hits FROM ({table_hits})",
        "lexicon_hits_any_key": f"""
            SELECT form, CASE WHEN lang <> 'fr' THEN lang END AS lang, hits
            FROM ({table_hits}), (VALUES ('list'), ('broadcast'), ('merge')) forms(form)""",
        "lexicon_rate_by_group": rates,
        "lexicon_rate_table": table_rates,
        "lexicon_rate_merge": table_rates,
        "most_lexicon": f"{rates} ORDER BY avg_hits DESC, lang, size_class LIMIT 10",
        "least_lexicon": f"{rates} ORDER BY avg_hits, lang, size_class LIMIT 10",
        "lexicon_report": f"""
            SELECT * FROM (SELECT *, 'most_swearing' AS report FROM ({report_rates})
                           ORDER BY avg_swear_words_per_post DESC, subreddit LIMIT 2)
            UNION ALL
            SELECT * FROM (SELECT *, 'least_swearing' AS report FROM ({report_rates})
                           ORDER BY avg_swear_words_per_post, subreddit LIMIT 2)""",
        "top_groups": """
            SELECT source, lang, count(*) AS "count" FROM documents GROUP BY source, lang
            ORDER BY 3 DESC, 1, 2 LIMIT 10""",
        "active_actors": """
            SELECT user_id, count(*) AS "count" FROM events WHERE user_id <> 149
            GROUP BY user_id ORDER BY 2 DESC, 1 LIMIT 10""",
        "phrase_trend": f"""
            SELECT source, count(*) AS help_post_count FROM documents
            WHERE regexp_matches(text, '{PHRASE}')
            GROUP BY source ORDER BY 2 DESC, 1 LIMIT 10""",
        "word_count_topk": words,
        "topic_slice": f"SELECT {document_columns} FROM documents WHERE lang = 'en'",
        "mention_crosstab": f"{crosstab} FROM documents GROUP BY 1, 2",
        "categorize": f"SELECT doc_id, {category} AS discussion_type FROM documents",
        "category_counts": f"""
            SELECT {category} AS discussion_type, count(*) AS "count"
            FROM documents GROUP BY 1""",
        "report_suite": f"""
            SELECT * FROM (SELECT 'top_subreddits' AS report, {sized} AS label, count(*) AS n,
                                  cast(NULL AS integer) AS mean_length
                           FROM documents GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
            UNION ALL
            SELECT * FROM (SELECT 'active_authors', lang || '-' || source, count(*), NULL
                           FROM documents WHERE lang <> 'fr' AND lang || '-' || source <> 'en-src1'
                           GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
            UNION ALL
            SELECT * FROM (SELECT 'help_requests', {sized}, count(*), NULL FROM documents
                           WHERE regexp_matches(text, '{PHRASE}')
                           GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
            UNION ALL
            SELECT 'top_words', word, "count", NULL FROM ({words})
            UNION ALL
            SELECT 'lol_nerf_vs_buff', mentions_a || '/' || mentions_b, total_posts,
                   avg_post_length
            FROM ({crosstab} FROM documents WHERE {sized} = 'en-1' GROUP BY 1, 2)
            UNION ALL
            SELECT 'lol_esports_vs_casual', {category}, count(*), NULL
            FROM documents WHERE {sized} = 'en-1' GROUP BY 2""",
        "row_count": 'SELECT count(*) AS "count" FROM lineitem',
        "describe_columns": " UNION ALL ".join(
            described(column, numeric)
            for column, numeric in [
                ("event_id", True),
                ("user_id", True),
                ("event_type", False),
                ("value", True),
                ("props", False),
            ]
        ),
        "null_counts": """
            SELECT count(*) FILTER (doc_id IS NULL) AS doc_id,
                   count(*) FILTER (lang = 'fr') AS text,
                   count(*) FILTER (lang IS NULL) AS lang,
                   count(*) FILTER (source = 'src1') AS source,
                   count(*) FILTER (n_chars <= 1000) AS n_chars
            FROM documents""",
        **more,
    }
