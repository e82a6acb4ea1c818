"""Readers and writers: layouts, delimited and fixed-width text, bookmaps."""

from .bookmaps import bookmap_item_lists, filter_locations, read_bookmaps
from .delimited import read_delimited, read_typed_pair
from .export import (
    copy_dataset,
    export_delimited,
    export_fixed_width,
    export_partitioned,
    extract_line,
    fixed_width_line,
)
from .fixed import read_fixed_width
from .lines import add_import_order, numbered_lines
from .tables import drop_blank_rows, infer_column_types, read_many, read_table_as_text

__all__ = [
    "add_import_order", "bookmap_item_lists", "copy_dataset", "drop_blank_rows", "export_delimited",
    "export_fixed_width", "export_partitioned", "extract_line", "filter_locations", "fixed_width_line",
    "infer_column_types", "numbered_lines", "read_bookmaps", "read_delimited", "read_fixed_width", "read_many",
    "read_table_as_text", "read_typed_pair",
]
