from .dedup import dedup, dedup_any, dedup_latest, dedup_messages, keyed_lines, malformed_lines
from .explode import (parallel_explode, region_fanout, region_in_messages, region_in_rows,
                      region_out_messages, region_out_rows)
from .parse import (clean_records, keep_if, project_fields, project_signal, require_width,
                    with_fields)
from .tap import tap_records, tap_text

__all__ = [
    "dedup", "dedup_any", "dedup_latest", "dedup_messages", "keyed_lines", "malformed_lines",
    "parallel_explode", "region_fanout", "region_in_messages", "region_in_rows",
    "region_out_messages", "region_out_rows",
    "clean_records", "keep_if", "project_fields", "project_signal", "require_width", "with_fields",
    "tap_records", "tap_text",
]
