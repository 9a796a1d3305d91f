"""Building text out of split fields: composite keys and delimited rows.

Inventory: P8 (composite key), P9 (row serialisation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def field(fields, index: int) -> Column:
    """Field ``index`` of a split array. Raises on a short row under ANSI;
    callers put a width guard (``operators.parse.require_width``) in front."""
    return as_col(fields)[index]


def composite_key(fields, indexes: Sequence[int], joiner: str = "_") -> Column:
    """Join the chosen fields with ``joiner`` in the configured order.

    Plain text concatenation, so ``("a_b", "c")`` and ``("a", "b_c")`` give the
    same key; that is the documented behaviour of the dedup job.
    """
    if not indexes:
        raise ValueError("composite key needs at least one field index")
    f = as_col(fields)
    return F.concat_ws(joiner, *[f[int(i)] for i in indexes])


def join_fields(cols: Sequence, sep: str = ",") -> Column:
    """Serialise columns to one delimited line, no trailing separator.

    Inputs are never null here (they come from splits); a null would be
    skipped by ``concat_ws``, so callers coalesce where nulls are possible.
    """
    return F.concat_ws(sep, *[as_col(c) for c in cols])
