from .split import decode_escapes, quote_literal, split_csv, split_list_cell, split_literal
from .text import composite_key, field, join_fields
from .timefmt import (DEFAULT_PATTERN, TIME_PATTERN, epoch_ms_to_text, ms_to_wallclock,
                      text_to_epoch_ms, wallclock_to_ms, wallclock_to_seconds)

__all__ = [
    "decode_escapes", "quote_literal", "split_csv", "split_list_cell", "split_literal",
    "composite_key", "field", "join_fields",
    "DEFAULT_PATTERN", "TIME_PATTERN", "epoch_ms_to_text", "ms_to_wallclock",
    "text_to_epoch_ms", "wallclock_to_ms", "wallclock_to_seconds",
]
