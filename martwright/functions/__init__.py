from martwright.functions.dates import (
    first_month,
    month_parts,
    month_spine,
    time_literal,
    to_date_lenient,
)
from martwright.functions.html import decode_references, html_text
from martwright.functions.ladders import (
    flag_label,
    in_set,
    keyword_ladder,
    set_ladder,
    threshold_ladder,
)
from martwright.functions.numbers import pct, split_shares, to_number
from martwright.functions.text import (
    WHITESPACE,
    clip,
    contains_flag,
    extract_code,
    fill,
    has_text,
    join_list,
    list_size,
    strip,
    title_case,
)

__all__ = [
    "WHITESPACE",
    "clip",
    "contains_flag",
    "decode_references",
    "extract_code",
    "fill",
    "first_month",
    "flag_label",
    "has_text",
    "html_text",
    "in_set",
    "join_list",
    "keyword_ladder",
    "list_size",
    "month_parts",
    "month_spine",
    "pct",
    "set_ladder",
    "split_shares",
    "strip",
    "threshold_ladder",
    "time_literal",
    "title_case",
    "to_date_lenient",
    "to_number",
]
