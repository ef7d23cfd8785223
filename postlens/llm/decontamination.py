"""Benchmark decontamination over a distributed positional inverted index.

The index is a stored table of postings (text key, term, position) of the corpus for the probe terms of the
test items: of each window of an item its rarest terms, after a count of the items' terms in the corpus. Two
searches read it. The phrase search intersects postings shifted by their offsets and compares what is left word by
word; the proximity search finds the probe terms of a window near each other in any order.

Built-in expressions only. Texts are keyed by two 64-bit hashes, so that copies of a
text share postings and rows need no identity of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.names import quoted
from postlens.llm.common import ascii_lower, filter_computed, finished, stored, whole_row

Keep = Callable[[DataFrame, str], DataFrame]  # stores a table, for good or until it is read
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
PROBES = 3
NEAR = 26
BROADCAST_ROWS = 200_000
SALTS = 16
KEY = ["k1", "k2"]


def words_of(text: str) -> Column:
    """Words of a text in lower case; none for NULL."""
    words = F.split(ascii_lower(F.coalesce(F.col(quoted(text)), F.lit(""))), BREAKS)
    return F.filter(words, lambda word: word != "")


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _sized(table: DataFrame, rows: int) -> DataFrame:
    """A hint to broadcast a stored table of up to ``rows`` rows."""
    return F.broadcast(table) if table.count() <= rows else table


def _join_by_term(places: DataFrame, side: DataFrame, broadcast_rows: int) -> DataFrame:
    """``places`` joined with a stored table by ``term``.

    A side that is too large to broadcast is given to ``SALTS`` places for each term, over which the
    rows of ``places`` are dealt by their text, as a term may be in a third of all texts.
    """
    sized = _sized(side, broadcast_rows)
    if sized is not side:
        return places.join(sized, "term")
    salted = side.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = places.withColumn("salt", F.pmod("k1", F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["term", "salt"]).drop("salt")


def build_index(
    docs: DataFrame, terms: DataFrame, text: str = "text", broadcast_rows: int = BROADCAST_ROWS, keep: Keep = stored
) -> DataFrame:
    """Postings (``k1``, ``k2``, ``term``, ``pos``) of the given terms, stored in the shared folder.

    ``terms`` has distinct rows in ``term``. Copies of a text share their postings.
    """
    body = F.col(quoted(text))
    words = docs.select(body.alias("text")).select(*_keys(F.col("text")), F.posexplode(words_of("text")).alias("pos", "term"))
    found = _join_by_term(words, terms, broadcast_rows)
    return keep(found.select(*KEY, "term", "pos").distinct(), "postings")


def term_counts(
    docs: DataFrame, terms: DataFrame, text: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """How often each of the given terms occurs in the corpus: ``term``, ``n``; 0 if never."""
    words = docs.select(F.explode(words_of(text)).alias("term"))
    side = _sized(terms, broadcast_rows)
    if side is terms:  # too many to broadcast: count all words first
        counts = words.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term")
    else:
        counts = words.join(side, "term").groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def _items(benchmark: DataFrame, item: str, text: str, keep: Keep = stored) -> DataFrame:
    """Distinct items that have words, stored: ``ref`` (their number), ``item`` (string),
    ``words``, ``size`` (of a window)."""
    rows = benchmark.select(
        F.coalesce(F.col(quoted(item)).cast("string"), F.lit("")).alias("item"), words_of(text).alias("words")
    )
    rows = rows.filter(F.size("words") > 0).distinct()
    size = F.least(F.size("words"), F.lit(WINDOW)).alias("size")
    return keep(rows.select(F.monotonically_increasing_id().alias("ref"), "item", "words", size), "items")


def _with_probes(items: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``probes``: for each window the offsets of its rarest words, rarest first."""
    places = items.select("ref", F.posexplode("words").alias("at", "term"))
    rarity = F.sort_array(F.collect_list(F.struct("at", "n"))).alias("rarity")
    ranked = places.join(counts, "term").groupBy("ref").agg(rarity)

    def rarest(begin: Column) -> Column:
        window = F.transform(F.slice("rarity", begin + 1, F.col("size")), lambda p: F.struct(p["n"], p["at"]))
        return F.transform(F.slice(F.sort_array(window), 1, PROBES), lambda p: p["at"])

    begins = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    return items.join(ranked, "ref").withColumn("probes", F.transform(begins, rarest))


def candidate_windows(
    postings: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS, keep: Keep = stored
) -> DataFrame:
    """Windows whose probes all occur in a text at their offsets from one beginning.

    One row for each text, item and alignment: the keys, ``ref`` (the item's number), ``shift`` (position of the
    item's first word) and ``windows`` (their offsets in the item). ``items`` is a stored table with probes.
    """
    asked = items.select("ref", "words", F.explode(F.array_distinct(F.flatten("probes"))).alias("at"))
    asked = keep(asked.select("ref", "at", F.get("words", F.col("at")).alias("term")), "asked")
    matches = _join_by_term(postings, asked, broadcast_rows)
    aligned = matches.groupBy(*KEY, "ref", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.collect_set("at").alias("found")
    )
    whole = lambda probes: F.forall(probes, lambda at: F.array_contains("found", at))
    begins = F.sequence(F.lit(0), F.size("probes") - 1)
    windows = F.filter(begins, lambda begin: whole(F.get("probes", begin)))
    joined = aligned.join(_sized(items.select("ref", "probes"), broadcast_rows), "ref")
    joined = joined.select(*KEY, "ref", "shift", windows.alias("windows"))
    return joined.filter(F.size("windows") > 0)


def near_items(
    postings: DataFrame, items: DataFrame, width: int = NEAR, broadcast_rows: int = BROADCAST_ROWS, keep: Keep = stored
) -> DataFrame:
    """The proximity search: (``k1``, ``k2``, ``item``) where all different probe terms of one of the item's
    windows occur within ``width`` words of the text, in any order."""
    terms = F.transform("probes", lambda w: F.sort_array(F.array_distinct(F.transform(w, lambda at: F.get("words", at)))))
    groups = items.select("ref", F.explode(F.array_distinct(terms)).alias("terms"))
    groups = groups.select("ref", F.xxhash64("terms").alias("group"), F.size("terms").alias("n"), F.posexplode("terms").alias("nth", "term"))
    matches = _join_by_term(postings, keep(groups, "near"), broadcast_rows).select(*KEY, "ref", "group", "n", "nth", "pos")
    # Where each term was last seen, kept up from row to row: nothing is collected.
    before = Window.partitionBy(*KEY, "ref", "group").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.coalesce(F.max(F.when(F.col("nth") == k, F.col("pos"))).over(before), F.lit(-width)) for k in range(PROBES)]
    seen = matches.select(*KEY, "ref", "pos", "n", *(place.alias(f"last{k}") for k, place in enumerate(last)))
    earliest = F.least("pos", *(F.when(F.col("n") > k, F.col(f"last{k}")).otherwise(F.col("pos")) for k in range(PROBES)))
    found = seen.filter(F.col("pos") - earliest < width).select(*KEY, "ref").distinct()
    names = _sized(items.select("ref", "item"), broadcast_rows)
    return found.join(names, "ref").select(*KEY, "item").distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
    near: int = 0,
) -> DataFrame:
    """The rows of ``docs`` under ``row``, with ``n_words``, ``n_hit``, ``n_items``, ``items``
    (array of item ids as strings, sorted), ``contaminated``, and with ``near`` words ``near_items`` (likewise).

    A window is any 13 consecutive words of an item, or all words of a shorter one; a
    word of a text is hit if it lies in an occurrence of a window; a text is
    contaminated if a twentieth of its words or more are hit. An item is near if the different ones of the three
    rarest words of one of its windows occur within ``near`` words of the text, in any order. NULL and blank texts
    and items have no words and no hits; a NULL item id counts as the empty string,
    and items of equal id as one. Repeated rows come back as often as they occur.
    """
    with finished(docs.sparkSession) as keep:
        tests = _items(benchmark, item, item_text, keep)
        terms = keep(tests.select(F.explode("words").alias("term")).distinct(), "terms")
        tests = keep(_with_probes(tests, term_counts(docs, terms, text, broadcast_rows)), "probes")
        rare = F.explode(F.array_distinct(F.flatten(F.transform("probes", lambda w: F.transform(w, lambda at: F.get("words", at))))))
        rare = keep(tests.select(rare.alias("term")).distinct(), "terms")
        postings = build_index(docs, rare, text, broadcast_rows, keep)
        windows = candidate_windows(postings, tests, broadcast_rows, keep)
        # The words of an item are joined once for each text that has a candidate of it, not for each alignment.
        found = windows.groupBy(*KEY, "ref").agg(F.collect_list(F.struct("shift", "windows")).alias("places"))
        found = found.join(_sized(tests.select("ref", "item", "words", "size"), broadcast_rows), "ref")
        found = found.groupBy(*KEY).agg(F.collect_list(F.struct("item", "words", "size", "places")).alias("found"))
        if near:
            close = near_items(postings, tests, near, broadcast_rows, keep)
            close = close.groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("near_items"))
            found = found.join(close, KEY, "full")
        # A candidate holds an item's words, so fewer of them make up the same bytes.
        by_text = _sized(stored(found, "candidates"), broadcast_rows // 20)

    # Words are split after the join: an array of them takes several times the text's bytes.
    none = F.array().cast("array<string>")
    extra = [F.coalesce("near_items", none).alias("near_items")] if near else []
    rows = docs.select(whole_row(docs), *_keys(F.col(quoted(text))))
    rows = rows.join(by_text, KEY, "left").select("row", F.col("row")[text].alias("text"), "found", *extra)
    extra = ["near_items"] * bool(near)
    rows = rows.select("row", words_of("text").alias("words"), "found", *extra)

    def occurrences(c: Column) -> Column:
        def at_place(place: Column) -> Column:
            def same(begin: Column) -> Column:  # word by word: a slice would copy all words of the text
                at = place["shift"] + begin
                each = F.sequence(F.lit(0), c["size"] - 1)
                here = F.forall(each, lambda k: F.get("words", at + k) == F.get(c["words"], begin + k))
                return (at >= 0) & (at + c["size"] <= F.size("words")) & here

            return F.transform(
                F.filter(place["windows"], same),
                lambda begin: F.struct(
                    (place["shift"] + begin).alias("start"),
                    (place["shift"] + begin + c["size"]).alias("end"),
                    c["item"].alias("item"),
                ),
            )

        return F.flatten(F.transform(c["places"], at_place))

    hits = F.when(F.col("found").isNotNull(), F.flatten(F.transform("found", occurrences)))
    rows = rows.select("row", F.size("words").cast("bigint").alias("n_words"), hits.alias("hits"), *extra)
    spans = F.sort_array(F.transform("hits", lambda h: F.struct(h["start"], h["end"])))
    items = F.sort_array(F.array_distinct(F.transform("hits", lambda h: h["item"])))
    rows = rows.select("row", "n_words", spans.alias("spans"), F.coalesce(items, none).alias("items"), *extra)
    zero = F.lit(0)
    covered = F.aggregate(
        "spans",
        F.struct(zero.alias("n"), zero.alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(zero, s["end"] - F.greatest(acc["end"], s["start"]))).alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
        lambda acc: acc["n"].cast("bigint"),
    )
    rows = rows.select(
        "row",
        "n_words",
        F.coalesce(covered, zero.cast("bigint")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        "items",
        *extra,
    )
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, with the columns of ``docs``."""
    found = decontaminate(docs, benchmark, **options)
    return filter_computed(found, ~F.col("contaminated")).select("row.*")


def decontamination_digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts and digests per row; of near items too, where they were asked for."""

    def digest(items: str) -> Column:
        return F.sha2(F.array_join(items, ","), 256)

    near = [F.size("near_items").cast("bigint").alias("n_near"), digest("near_items").alias("near_sha256")]
    return found.select(
        F.col("row")[id].alias(id),
        *("n_words", "n_hit", "n_items"),
        digest("items").alias("items_sha256"),
        "contaminated",
        *(near if "near_items" in found.columns else []),
    )


def proximity_matches(
    docs: DataFrame,
    phrases: DataFrame,
    width: int,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Places where all words of a phrase occur within ``width`` words, in any order.

    Returns (``k1``, ``k2``, ``item``, ``start``): the text's hashes, as
    ``xxhash64(text)`` and ``xxhash64(1, text)``, and the first position of each match. Phrases that are no
    benchmark need an index of all of their words, which is built for the search.
    """
    tests = _items(phrases, item, item_text).select("item", F.array_distinct("words").alias("words"))
    tests = stored(tests, "phrases")
    asked = tests.select("item", F.size("words").alias("n"), F.explode("words").alias("term"))
    postings = build_index(docs, stored(asked.select("term").distinct(), "terms"), text)
    near = Window.partitionBy(*KEY, "item").orderBy("pos").rangeBetween(0, width - 1)
    seen = postings.join(asked, "term").withColumn("seen", F.size(F.collect_set("term").over(near)))
    return seen.filter("seen = n").select(*KEY, "item", F.col("pos").alias("start"))


def oracle_sql(near: int = NEAR) -> str:
    """The digest of ``documents`` against ``benchmark`` in DuckDB's SQL."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"list_filter(string_split_regex({lower}, '{BREAKS}'), lambda x: x <> '')"
    return rf"""
        WITH items AS (
            SELECT coalesce(cast(item_id AS varchar), '') AS item, {words} AS words FROM benchmark),
        windows AS (
            SELECT DISTINCT item, words[i:i + least(len(words), {WINDOW}) - 1] AS gram
            FROM (SELECT *, unnest(range(1, len(words) - least(len(words), {WINDOW}) + 2)) AS i
                  FROM items WHERE len(words) > 0)),
        texts AS (SELECT doc_id, {words} AS words FROM documents),
        places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
        starts AS (
            SELECT p.doc_id, p.i, w.item, w.gram
            FROM places p JOIN windows w ON p.word = w.gram[1]
            JOIN places q ON q.doc_id = p.doc_id AND q.i = p.i + len(w.gram) - 1
                         AND q.word = w.gram[-1]),
        hits AS (
            SELECT s.doc_id, s.i, s.item, len(s.gram) AS n
            FROM starts s JOIN texts t ON s.doc_id = t.doc_id
            WHERE t.words[s.i:s.i + len(s.gram) - 1] = s.gram),
        spots AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
        found AS (
            SELECT doc_id, count(DISTINCT item) AS n_items,
                   string_agg(DISTINCT item, ',' ORDER BY item) AS items
            FROM hits GROUP BY doc_id),
        counts AS (SELECT word, count(*) AS n FROM places GROUP BY word),
        offsets AS (
            SELECT *, unnest(range(b, b + least(len(words), {WINDOW}))) AS spot
            FROM (SELECT *, unnest(range(1, len(words) - least(len(words), {WINDOW}) + 2)) AS b
                  FROM (SELECT DISTINCT item, words FROM items WHERE len(words) > 0))),
        ranked AS (
            SELECT item, words, b, words[spot] AS term,
                   row_number() OVER (PARTITION BY item, words, b ORDER BY coalesce(n, 0), spot) AS rarity
            FROM offsets LEFT JOIN counts ON counts.word = words[spot]),
        probes AS (
            SELECT DISTINCT item, list_sort(list(DISTINCT term)) AS terms
            FROM ranked WHERE rarity <= {PROBES} GROUP BY item, words, b),
        matches AS (
            SELECT doc_id, i, item, terms, term
            FROM (SELECT *, unnest(terms) AS term FROM probes) JOIN places ON word = term),
        together AS (
            SELECT doc_id, item, len(terms) AS n, count(DISTINCT term) OVER (
                       PARTITION BY doc_id, item, terms ORDER BY i
                       RANGE BETWEEN CURRENT ROW AND {near - 1} FOLLOWING) AS seen
            FROM matches),
        close AS (
            SELECT doc_id, count(DISTINCT item) AS n_near, string_agg(DISTINCT item, ',' ORDER BY item) AS near_items
            FROM together WHERE seen = n GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated,
               coalesce(n_near, 0) AS n_near, sha256(coalesce(near_items, '')) AS near_sha256
        FROM texts LEFT JOIN spots USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN close USING (doc_id)"""
