"""Operators: taggers, substring match, profiles, extracts, matching, evaluation, joins."""

from profilekit.operators.evaluate import (
    ablation_compare,
    auc,
    class_report,
    format_reports,
    log_loss,
    read_reports,
    vocabulary,
    write_reports,
)
from profilekit.operators.extract import day_windows, extract_payloads, trailing_range
from profilekit.operators.joins import bounded_broadcast, checked_join, hot_keys, salted_join
from profilekit.operators.matching import id_coverage, mapped_users, match_ids, match_titles
from profilekit.operators.profile import flag_pivot, flag_profile, score_profile
from profilekit.operators.ranking import global_index
from profilekit.operators.substring import first_key_match
from profilekit.operators.tagging import code_tags, dict_tags, last_value_per_key

__all__ = [
    "ablation_compare", "auc", "bounded_broadcast", "checked_join", "class_report", "code_tags",
    "day_windows", "dict_tags", "extract_payloads", "first_key_match", "flag_pivot", "flag_profile",
    "format_reports", "global_index", "hot_keys", "id_coverage", "last_value_per_key", "log_loss",
    "mapped_users", "match_ids", "match_titles", "read_reports", "salted_join", "score_profile",
    "trailing_range", "vocabulary", "write_reports",
]
