from postlens.plans.etl import run_etl
from postlens.plans.lexicon_report import group_rates, post_hits, run_lexicon_report
from postlens.plans.report_suite import run_report_suite

__all__ = ["group_rates", "post_hits", "run_etl", "run_lexicon_report", "run_report_suite"]
