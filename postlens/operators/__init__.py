from postlens.operators.cleaning import (
    clean_posts,
    drop_all_null,
    normalize_tokens,
    remove_stopwords,
    tokenize,
    trim_strings,
)
from postlens.operators.lexicon import (
    frequent_terms,
    hit_rate_by_group,
    hit_rate_by_group_joined,
    lexicon_hits,
    lexicon_hits_joined,
    rank_by_rate,
    vocabulary,
)
from postlens.operators.profiling import describe_columns, null_counts, preview, row_count
from postlens.operators.ranking import active_actors, phrase_trend, top_groups, top_k, top_words
from postlens.operators.topics import (
    categorize,
    category_counts,
    category_counts_from_summary,
    mention_crosstab,
    mention_crosstab_from_summary,
    topic_slice,
    topic_summary,
)

__all__ = [
    "active_actors",
    "categorize",
    "category_counts",
    "category_counts_from_summary",
    "clean_posts",
    "describe_columns",
    "drop_all_null",
    "frequent_terms",
    "hit_rate_by_group",
    "hit_rate_by_group_joined",
    "lexicon_hits",
    "lexicon_hits_joined",
    "mention_crosstab",
    "mention_crosstab_from_summary",
    "normalize_tokens",
    "null_counts",
    "phrase_trend",
    "preview",
    "rank_by_rate",
    "remove_stopwords",
    "row_count",
    "tokenize",
    "top_groups",
    "top_k",
    "top_words",
    "topic_slice",
    "topic_summary",
    "trim_strings",
    "vocabulary",
]
