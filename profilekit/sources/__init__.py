"""Readers of tables, logs, dictionaries, id lists; publish sinks."""

from profilekit.sources.files import read_id_list, read_pair_dictionary, read_scored_dictionary
from profilekit.sources.publish import publish, read_published, with_partition_schema
from profilekit.sources.tables import event_log, in_days, read_log, table

__all__ = [
    "event_log", "in_days", "publish", "read_id_list", "read_log", "read_pair_dictionary",
    "read_published", "read_scored_dictionary", "table", "with_partition_schema",
]
