"""Sources and sinks."""

from .config import audience_config, load_audiences, merge_defaults
from .files import (CSV, TSV, footer_counts, footer_extremes, line_numbers, list_files, load, load_report, read_delimited, read_lines,
                    read_parquet_by_name, read_tolerant, row_counts, spread, with_load_ts)
from .tables import save_bucketed, save_table, write_csv, write_table
