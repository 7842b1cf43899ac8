from profilekit.functions.columns import (
    as_day,
    code_list,
    day_string,
    days_ago,
    has_text,
    id_length,
    json_field,
    list_item,
    md5_id,
    valid_tag,
)

__all__ = [
    "as_day",
    "code_list",
    "day_string",
    "days_ago",
    "has_text",
    "id_length",
    "json_field",
    "list_item",
    "md5_id",
    "valid_tag",
]
