from postlens.sources.lexicon import LexiconLimits, load_lexicon, may_broadcast, terms_if_few
from postlens.sources.readers import read_csv, read_json, read_parquet
from postlens.sources.scratch import delete_folder, scratch_folder
from postlens.sources.writers import FORMATS, TABLE_FORMATS, write_report, write_table

__all__ = [
    "FORMATS",
    "TABLE_FORMATS",
    "LexiconLimits",
    "delete_folder",
    "load_lexicon",
    "may_broadcast",
    "read_csv",
    "read_json",
    "read_parquet",
    "scratch_folder",
    "terms_if_few",
    "write_report",
    "write_table",
]
