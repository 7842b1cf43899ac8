"""Structured Streaming forms of the per-day profiles."""

from profilekit.streaming.daily import closed_day_profiles, refresh_day_profiles
from profilekit.streaming.matching import stream_matched_ids

__all__ = ["closed_day_profiles", "refresh_day_profiles", "stream_matched_ids"]
