"""Column roles and the standard report parameters.

Every operator and job takes these as arguments; the values here are only the
defaults that the jobs use for a corpus of forum posts.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The raw post schema, in file order.
POST_SCHEMA = StructType(
    [
        StructField("author", StringType()),
        StructField("body", StringType()),
        StructField("normalizedBody", StringType()),
        StructField("content", StringType()),
        StructField("content_len", IntegerType()),
        StructField("summary", StringType()),
        StructField("summary_len", IntegerType()),
        StructField("id", StringType()),
        StructField("subreddit", StringType()),
        StructField("subreddit_id", StringType()),
    ]
)


@dataclass(frozen=True)
class LexiconReport:
    """Parameters of the most / least lexicon use report."""

    # Column names, the group size threshold and the report length.
    group: str | tuple[str, ...] = "subreddit"
    tokens: str = "content_tokens"
    rate_name: str = "avg_swear_words_per_post"
    count_name: str = "post_count"
    min_rows: int = 1000
    k: int = 10
    most_name: str = "most_swearing"
    least_name: str = "least_swearing"


@dataclass(frozen=True)
class ReportSuite:
    """Parameters of the six corpus reports."""

    # Columns, sentinel, patterns, labels and report lengths.
    group: str = "subreddit"
    actor: str = "author"
    body: str = "body"
    summary: str = "summary"
    length: str = "content_len"
    deleted_actor: str = "[deleted]"
    k: int = 10
    phrase: str = "(?i)(need help|please help|need advice)"
    phrase_count_name: str = "help_post_count"
    min_word_length: int = 5
    k_words: int = 15
    topic: str = "leagueoflegends"
    flags: tuple[tuple[str, str], ...] = (
        ("mentions_nerf", r"(?i)\bnerf\b|\bnerfs\b"),
        ("mentions_buff", r"(?i)\bbuff\b|\bbuffs\b"),
    )
    crosstab_count_name: str = "total_posts"
    crosstab_mean_name: str = "avg_post_length"
    categories: tuple[tuple[str, str], ...] = (
        ("Esports / Pro Play", r"(?i)\b(lcs|lec|lck|lpl|worlds|msi|faker|t1|fnatic|g2)\b"),
        ("Ranked / Casual Play", r"(?i)\b(soloq|elo|ranked|lp|smurf|climbing)\b"),
    )
    both_label: str = "Both"
    other_label: str = "General / Other"
    category_name: str = "discussion_type"
    top_groups_name: str = "top_subreddits"
    active_actors_name: str = "active_authors"
    phrase_name: str = "help_requests"
    words_name: str = "top_words"
    crosstab_name: str = "lol_nerf_vs_buff"
    categories_name: str = "lol_esports_vs_casual"

    @classmethod
    def from_json(cls, text: str) -> ReportSuite:
        """A suite with some parameters replaced, from a JSON object by their names.

        ``flags`` and ``categories`` are lists of pairs, a name and a pattern.
        """
        values = json.loads(text)
        unknown = set(values) - {field.name for field in fields(cls)}
        if unknown:
            raise ValueError(f"unknown report parameters: {', '.join(sorted(unknown))}")
        for name in ("flags", "categories"):
            if name in values:
                values[name] = tuple((str(label), str(pattern)) for label, pattern in values[name])
        return cls(**values)
