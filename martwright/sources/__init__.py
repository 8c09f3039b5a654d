from martwright.sources.csv_splits import csv_records, read_csv_splits
from martwright.sources.extract import extract_cards, mine_title_lines
from martwright.sources.markup import extract_elements, select_elements
from martwright.sources.readers import (
    list_tables,
    literal_table,
    query,
    read_csv,
    read_optional,
    register_views,
    with_fallback,
)
from martwright.sources.specs import Col, TableSpec
from martwright.sources.writers import (
    append_rows,
    export_all,
    load_table,
    to_json_records,
    write_csv,
)

__all__ = [
    "Col",
    "TableSpec",
    "append_rows",
    "csv_records",
    "export_all",
    "extract_cards",
    "extract_elements",
    "list_tables",
    "literal_table",
    "load_table",
    "mine_title_lines",
    "query",
    "read_csv",
    "read_csv_splits",
    "read_optional",
    "register_views",
    "select_elements",
    "to_json_records",
    "with_fallback",
    "write_csv",
]
