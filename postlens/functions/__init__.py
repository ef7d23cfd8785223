from postlens.functions.flags import first_label, mentions
from postlens.functions.names import as_list, column_of, columns_of
from postlens.functions.text import (
    alnum_tokens,
    distinct_hits,
    english_stopwords,
    split_tokens,
    strip_whitespace,
    without_stopwords,
    words,
)

__all__ = [
    "alnum_tokens",
    "as_list",
    "column_of",
    "columns_of",
    "distinct_hits",
    "english_stopwords",
    "first_label",
    "mentions",
    "split_tokens",
    "strip_whitespace",
    "without_stopwords",
    "words",
]
