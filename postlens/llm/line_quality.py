"""Line-first cleaning: rules for lines, then a rule for what is left of the document.

Built-in expressions only, all within the row: one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import filter_computed, whole_row

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "(?i)(licensed under|released under|all rights reserved|copyright|privacy policy|"
    "terms of (use|service)|cookie|javascript|sign (in|up)|log ?in|subscribe|"
    "click here|read more|share this|powered by)"
)
# Word boundaries as classes, which are the same in all engines.
WHOLE_PHRASES = (
    "(?i)(^|[^a-z0-9_])(licensed under|released under|all rights reserved|copyright|privacy policy|"
    "terms of (use|service)|cookies?|javascript|sign (in|up)|log ?in|subscribe|"
    "click here|read more|share this|powered by)([^a-z0-9_]|$)"
)
# Sentence ends of other scripts: CJK, Indic, Arabic, Urdu, Armenian, Ethiopic, Burmese, Khmer, Tibetan.
STOPS = ".!?…。！？．｡।॥؟۔։።፧፨။៕།"
CLOSERS = r"\"”»)\]’\x27」』】）"
# A line without an end passes if it has a sentence end inside, with 60 characters before or after it.
ENDING = (
    rf"(?:[{STOPS}:;：；{CLOSERS}]|^[^\n]{{60,}}(?:[.!?…][{CLOSERS}]*\x20|[。！？．｡।॥؟۔։።፧፨။៕།])[^\n]*|"
    rf"(?:[.!?…][{CLOSERS}]*\x20|[。！？．｡।॥؟۔։።፧፨။៕།])[^\n]{{60,}})"
)
WINDOW = 5


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document rule; shares are percentages.

    A line goes if it does not end in ``ending``; if more than ``max_symbols`` of its
    characters are symbols, or more than ``max_exclamation`` exclamation marks; if it has
    ``min_separators`` separators or more and they are at least
    ``separators`` of its characters; if it has up to ``boilerplate_chars`` characters and
    matches ``boilerplate``; or if an earlier line equals it. A document goes if more
    than ``max_lost`` of the characters of its lines went.
    """

    ending: str = r"[.!?…:;\"”»)\]]"
    max_symbols: int = 5
    max_exclamation: int = 5
    separators_of: str = "|»›•·"
    min_separators: int = 3
    separators: int = 4
    boilerplate: str = BOILERPLATE
    boilerplate_chars: int = 200
    max_lost: int = 50


# Those of the query, its SQL and the pipeline: sentence ends of all scripts, lines of sentences whose last one has
# no end, and boilerplate only as whole phrases.
CLEANING_RULES = LineRules(ending=ENDING, boilerplate=WHOLE_PHRASES)
RULES = LineRules()  # narrower: a sentence end at the end of a line, boilerplate also within words


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_passes(line: Column, rules: LineRules = RULES) -> Column:
    chars = F.length(line)
    separators = _count(line, rules.separators_of)
    plain = ~F.rlike(line, F.lit(f"[!{SYMBOLS}{rules.separators_of}]"))  # most lines: no need to count
    counted = (
        (100 * _count(line, SYMBOLS) <= rules.max_symbols * chars)
        & (100 * _count(line, "!") <= rules.max_exclamation * chars)
        & ((separators < rules.min_separators) | (100 * separators < rules.separators * chars))
    )
    return (
        F.rlike(line, F.lit(rf"{rules.ending}{SPACE}*\z"))
        & (plain | counted)
        & ((chars > rules.boilerplate_chars) | ~F.rlike(line, F.lit(rules.boilerplate)))
    )


def _total_length(lines: str) -> Column:
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, line: n + F.length(line))


def _hashed_with(left: Column, right: Column, distance: int) -> Column:
    """A hash for each element of ``left`` and the element of ``right`` that far behind its place; at the
    end, where there is none, of the first alone."""
    return F.zip_with(left, F.slice(right, distance + 1, F.size(right)), lambda a, b: F.xxhash64(a, b))


def _measured(rows: DataFrame, rules: LineRules) -> DataFrame:
    """Add all measures of column ``text`` to rows whose other columns are under ``row``."""
    rows = rows.select("row", "text", F.split("text", f"{SPACE}+").alias("split"))
    # White space at the beginning and at the end of a text leaves an empty string there.
    first, last = F.get("split", F.lit(0)) == "", F.element_at("split", -1) == ""
    n = F.greatest(F.size("split") - first.cast("int") - last.cast("int"), F.lit(0))
    lines = F.filter(F.split("text", "\n"), lambda line: F.ltrim(line, F.lit(SPACES)) != "")
    rows = rows.select("row", "text", F.slice("split", first.cast("int") + 1, n).alias("words"), lines.alias("lines"))
    n = F.size("words")
    rows = rows.select(
        "row",
        "lines",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    # Windows are compared by 64-bit hashes, and only within their own text: of two words, of four, of five.
    n, hashes = F.col("n_words").cast("int"), F.col("hashes")
    rows = rows.withColumn("two", F.when(n >= WINDOW, _hashed_with(hashes, hashes, 1)))
    rows = rows.withColumn("four", F.when(n >= WINDOW, _hashed_with(F.col("two"), F.col("two"), 2)))
    five = _hashed_with(F.col("four"), hashes, 4)
    windows = F.when(n >= WINDOW, F.slice(five, 1, n - WINDOW + 1))
    rows = rows.select(
        *("row", "lines", "n_words", "word_chars", "n_symbols"),
        F.coalesce(windows, F.array().cast("array<bigint>")).alias("windows"),
        F.array_distinct("lines").alias("different"),
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    kept = F.filter("different", lambda line: line_passes(line, rules))
    rows = rows.select("*", F.when(repeats, by_hash).alias("by_hash"), kept.alias("kept_lines")).drop("windows")

    def repeated(at: Column, j: Column) -> Column:
        return (F.get("by_hash", j - 1)["h"] == at["h"]) | (F.get("by_hash", j + 1)["h"] == at["h"])

    begins = F.sort_array(F.transform(F.filter("by_hash", lambda at, j: F.coalesce(repeated(at, j), F.lit(False))), lambda at: at["i"]))
    rows = rows.select("*", begins.alias("begins")).drop("by_hash")
    covered = F.aggregate(
        F.transform("begins", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("begins", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"),
        lambda total, length: total + length,
    )
    rows = rows.select(
        *("row", "kept_lines", "n_words", "word_chars", "n_symbols"),
        (F.size("lines") - F.size("different")).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"),
        _total_length("lines").alias("line_chars"),
        _total_length("kept_lines").alias("kept_chars"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    enough = 100 * (F.col("line_chars") - F.col("kept_chars")) <= rules.max_lost * F.col("line_chars")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)


def line_quality(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rules: LineRules = CLEANING_RULES
) -> DataFrame:
    """Per row: id, the base measures, ``base_failed``, ``kept``, and the characters of lines
    before and after cleaning.

    A NULL or blank text has no words and fails. Repeated rows come back as often as
    they occur; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(quoted(id)).alias("row"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    return _measured(rows, rules).select(
        F.col("row").alias(id),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept", "line_chars", "kept_chars"),
    )


def clean_documents(
    docs: DataFrame, text: str = "text", n_chars: str = "n_chars", rules: LineRules = CLEANING_RULES
) -> DataFrame:
    """Documents that pass, without the lines that fail; columns as in ``docs``.

    A length column named ``n_chars`` follows the text.
    """
    rows = docs.select(whole_row(docs), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    kept = filter_computed(_measured(rows, rules), F.col("kept"))
    cleaned = F.array_join("kept_lines", "\n")
    values = {text: cleaned, n_chars: F.length(cleaned).cast(dict(docs.dtypes).get(n_chars, "bigint"))}
    return kept.select(*(values.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def oracle_sql(rules: LineRules = CLEANING_RULES) -> str:
    """The same rows of ``documents`` in DuckDB's SQL."""
    space, quoted = SPACE, rules.boilerplate.replace("'", "''")
    symbols = "[" + SYMBOLS + "]"

    def count(text: str, characters: str) -> str:
        return f"(length({text}) - length(regexp_replace({text}, '{characters}', '', 'g')))"

    separators = count("x", "[" + rules.separators_of + "]")
    passes = rf"""
        regexp_matches(x, '{rules.ending}{space}*\z')
        AND 100 * {count("x", symbols)} <= {rules.max_symbols} * length(x)
        AND 100 * {count("x", "!")} <= {rules.max_exclamation} * length(x)
        AND ({separators} < {rules.min_separators}
             OR 100 * {separators} < {rules.separators} * length(x))
        AND (length(x) > {rules.boilerplate_chars} OR NOT regexp_matches(x, '{quoted}'))"""
    following = ", ".join(f"lead(word, {k}) OVER w" for k in range(1, WINDOW))
    return rf"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        lists AS (
            SELECT *,
                   list_filter(string_split_regex(text, '{space}+'), lambda x: x <> '') AS words,
                   list_filter(string_split(text, chr(10)),
                               lambda x: regexp_matches(x, '{NOT_SPACE}')) AS lines
            FROM texts),
        places AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM lists),
        windows AS (
            SELECT doc_id, i, [word, {following}] AS words FROM places
            WINDOW w AS (PARTITION BY doc_id ORDER BY i)
            QUALIFY lead(word, {WINDOW - 1}) OVER w IS NOT NULL),
        repeated AS (
            SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM (SELECT doc_id, i, unnest(range({WINDOW})) AS k FROM repeated) GROUP BY doc_id),
        measured AS (
            SELECT doc_id, len(words) AS n_words,
                   cast(length(regexp_replace(text, '{space}', '', 'g')) AS bigint) AS word_chars,
                   cast({count("text", symbols)} AS bigint) AS n_symbols,
                   cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words,
                   cast(coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) AS bigint)
                       AS line_chars,
                   cast(coalesce(list_sum(list_transform(
                       list_filter(list_distinct(lines), lambda x: {passes}),
                       lambda x: length(x))), 0) AS bigint) AS kept_chars
            FROM lists LEFT JOIN covered USING (doc_id)),
        base AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
            FROM measured)
        SELECT *, NOT base_failed
                  AND 100 * (line_chars - kept_chars) <= {rules.max_lost} * line_chars AS kept
        FROM base"""
