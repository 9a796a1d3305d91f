"""Parallel-list explode and the two region row splits.

A wide line holds several ``|``-separated cells that are parallel lists:
element *i* of the driver list pairs with element *i* of each companion.
The driver decides the count; longer companions are cut, a shorter one is
an error (``fail``) or sends the line to quarantine.

Plan shape (one whole-stage-codegen stage, no shuffle): split the line and
each used list cell once in a projection, ``posexplode`` the driver list,
then pick companions with ``get(companion, pos)`` in a projection. The width
and size checks sit inside the generator's input
(``CASE WHEN bad THEN raise_error ELSE driver END``): they cannot be pruned
away under ``count()``, and since the input is not a bare column Catalyst
adds no inferred filter that would re-run the splits. The fan-out explodes
``concat(current_regions, left_regions)`` once and picks the topic by
position, so both topics come from a single pass in the reference's order.

Inventory: E1, E2, E3, K2 (fan-out), P9 (message text).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..conf import (LIST_SEP, REGION_IN_COLUMNS, REGION_OUT_COLUMNS, WIDE_FIELD_SEP,
                    WIDE_LAYOUT, WIDE_MIN_WIDTH, RegionSplitConf)
from ..functions._util import as_col
from ..functions.split import split_csv, split_list_cell
from ..functions.text import join_fields
from .parse import ON_MALFORMED, clean_records, width_error, width_ok

POS, ELEM = "__pos", "__elem"


def _all(conds: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return F.coalesce(out, F.lit(False))


def _sizes_ok(driver: Column, companions: Sequence[Column]) -> Column:
    return _all([F.size(c) >= F.size(driver) for c in companions])


def _short_error(what: str) -> Column:
    return F.raise_error(F.lit(f"companion list shorter than driver list ({what})"))


def parallel_explode(df: DataFrame, driver, companions: Mapping[str, object],
                     keep: Sequence[str] = (), pos: str = "pos", elem: str = "elem",
                     on_short: str = "fail"):
    """One row per driver element with the matching companion elements.

    ``driver`` / ``companions`` are array columns (or names). Output columns:
    ``keep..., pos (0-based), elem, <companion names>...``. With
    ``on_short="quarantine"`` returns ``(rows, bad_input_rows)``.
    """
    if on_short not in ON_MALFORMED:
        raise ValueError(f"on_short must be one of {ON_MALFORMED}")
    names = list(companions)
    comp_cols = [f"__c{k}" for k in range(len(names))]
    staged = df.select(*keep, as_col(driver).alias("__drv"),
                       *[as_col(c).alias(n) for c, n in zip(companions.values(), comp_cols)])
    drv = F.col("__drv")
    ok = _sizes_ok(drv, [F.col(c) for c in comp_cols])
    gen_input = (F.when(ok, drv).otherwise(_short_error(",".join(names))) if on_short == "fail"
                 else F.when(ok, drv))
    g = staged.select(*keep, *comp_cols, F.posexplode(gen_input).alias(pos, elem))
    rows = g.select(*keep, pos, elem,
                    *[F.get(F.col(c), F.col(pos)).alias(n) for c, n in zip(comp_cols, names)])
    if on_short == "fail":
        return rows
    bad = staged.where(~ok).select(*keep, F.size(drv).alias("n_driver"))
    return rows, bad


# ---------------------------------------------------------------- region split

def _f(name: str) -> Column:
    return F.col("fields")[WIDE_LAYOUT[name]]


@dataclass(frozen=True)
class _Side:
    """One list family of the wide line: driver cell, companion cells and
    how an output row is assembled from an element."""
    driver: str
    companions: Mapping[str, str]                    # output name -> list cell name
    values: Callable[[Column, Callable[[str], Column]], list[Column]]

    @property
    def lists(self) -> tuple[str, ...]:
        return (self.driver, *self.companions.values())


def _in_values(x: Column, at: Callable[[str], Column]) -> list[Column]:
    # Output order of a current-region row (fixed by the reference layout).
    return [_f("imsi"), x, _f("timestamp"), _f("city_code"), _f("county_code"),
            _f("usr_prov_code"), _f("usr_city_code"), _f("usr_county_code"), _f("sex"),
            _f("age_level"), _f("arpu_level"), at("in_time"), at("flag")]


def _out_values(x: Column, at: Callable[[str], Column]) -> list[Column]:
    # Output order of a left-region row (fixed by the reference layout).
    return [_f("imsi"), x, _f("timestamp"), at("in_time"), at("out_time"), at("stay"),
            _f("out_city_code"), _f("out_county_code")]


CURRENT = _Side("region_code", {"in_time": "curr_region_intime", "flag": "curr_region_in_out"},
                _in_values)
LEFT = _Side("out_region", {"in_time": "out_region_in_dt", "out_time": "out_region_out_dt",
                            "stay": "out_region_stay"}, _out_values)


def _staged(records: DataFrame, keep: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """Clean, split the line once, split each used list cell once.

    ``get`` keeps a short row from failing here; the width check in the
    generator input decides what happens to it.
    """
    df = clean_records(records).select(*keep, split_csv(F.col("value"), WIDE_FIELD_SEP).alias("fields"))
    cells = [split_list_cell(F.get(F.col("fields"), WIDE_LAYOUT[n]), LIST_SEP).alias(f"__{n}")
             for n in dict.fromkeys(lists)]
    return df.select(*keep, "fields", *cells)


def _explode_sides(records: DataFrame, sides: Sequence[_Side], keep: Sequence[str],
                   on_malformed: str, what: str):
    """Stage, check and posexplode ``concat(driver of each side)``.

    Returns ``(exploded, bad)``; ``bad`` is None under ``fail``. The exploded
    frame keeps ``fields`` and the list arrays for the output projection.
    """
    if on_malformed not in (*ON_MALFORMED, "tag"):
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")
    staged = _staged(records, keep, [n for s in sides for n in s.lists])
    wide = width_ok("fields", WIDE_MIN_WIDTH)
    lists_ok = _all([_sizes_ok(F.col(f"__{s.driver}"), [F.col(f"__{c}") for c in s.companions.values()])
                     for s in sides])
    drivers = [F.col(f"__{s.driver}") for s in sides]
    arr = drivers[0] if len(drivers) == 1 else F.concat(*drivers)
    reason = F.when(~wide, "too few fields").when(~lists_ok, "short companion list")
    n_fields = F.coalesce(F.size("fields"), F.lit(0)).alias("n_fields")
    if on_malformed == "tag":                        # bad lines stay, as one row with a reason
        staged = staged.withColumns({"reason": reason, "n_fields": n_fields})
        gen_input = F.when(F.col("reason").isNull(), arr).otherwise(F.array(F.lit(None).cast("string")))
        return staged.select("*", F.posexplode(gen_input).alias(POS, ELEM)), None
    if on_malformed == "fail":
        gen_input = (F.when(~wide, width_error("fields", WIDE_MIN_WIDTH))
                     .when(~lists_ok, _short_error(what)).otherwise(arr))
        bad = None
    else:
        gen_input = F.when(wide & lists_ok, arr)
        bad = staged.where(~(wide & lists_ok)).select(*keep, n_fields, reason.alias("reason"))
    exploded = staged.select("*", F.posexplode(gen_input).alias(POS, ELEM))
    return exploded, bad


def _side_values(side: _Side, index: Column) -> list[Column]:
    return side.values(F.col(ELEM), lambda name: F.get(F.col(f"__{side.companions[name]}"), index))


def _result(out: DataFrame, bad):
    return out if bad is None else (out, bad)


def _rows(records, side: _Side, columns, keep, on_malformed, what):
    g, bad = _explode_sides(records, [side], keep, on_malformed, what)
    vals = _side_values(side, F.col(POS))
    return _result(g.select(*keep, *[v.alias(n) for n, v in zip(columns, vals)]), bad)


def region_in_rows(records: DataFrame, keep: Sequence[str] = (), on_malformed: str = "fail"):
    """Current-region rows: one per element of ``region_code`` (13 columns)."""
    return _rows(records, CURRENT, REGION_IN_COLUMNS, keep, on_malformed, "current region")


def region_out_rows(records: DataFrame, keep: Sequence[str] = (), on_malformed: str = "fail"):
    """Left-region rows: one per element of ``out_region`` (8 columns)."""
    return _rows(records, LEFT, REGION_OUT_COLUMNS, keep, on_malformed, "left region")


def _messages(records, sides_topics: Sequence[tuple[_Side, str]], keep, on_malformed, what, seq: str | None = None):
    sides = [s for s, _ in sides_topics]
    g, bad = _explode_sides(records, sides, keep, on_malformed, what)
    pos = F.col(POS)
    # Which side an exploded position belongs to, and its index in that side.
    starts, start = [], F.lit(0)
    for s in sides:
        starts.append(start)
        start = start + F.size(F.col(f"__{s.driver}"))
    topic, value = None, None
    for k in reversed(range(len(sides))):
        s, t = sides_topics[k]
        v = join_fields(_side_values(s, pos - starts[k]), WIDE_FIELD_SEP)
        if topic is None:
            topic, value = F.lit(t), v
        else:
            mine = pos < starts[k + 1]
            topic, value = F.when(mine, F.lit(t)).otherwise(topic), F.when(mine, v).otherwise(value)
    placed = [pos.alias(seq)] if seq else []
    if on_malformed == "tag":
        good = F.col("reason").isNull()
        return g.select(*keep, *placed, F.when(good, topic).alias("topic"), F.when(good, F.get("fields", WIDE_LAYOUT["imsi"])).alias("key"),
                        F.when(good, value).alias("value"), "n_fields", "reason")
    out = g.select(*keep, *placed, topic.alias("topic"), _f("imsi").alias("key"), value.alias("value"))
    return _result(out, bad)


def region_in_messages(records: DataFrame, conf: RegionSplitConf = RegionSplitConf(),
                       keep: Sequence[str] = ()):
    """Current-region rows as ``(topic, key=imsi, value=csv)`` messages."""
    return _messages(records, [(CURRENT, conf.topic_in)], keep, conf.on_malformed, "current region")


def region_out_messages(records: DataFrame, conf: RegionSplitConf = RegionSplitConf(),
                        keep: Sequence[str] = ()):
    """Left-region rows as ``(topic, key=imsi, value=csv)`` messages."""
    return _messages(records, [(LEFT, conf.topic_out)], keep, conf.on_malformed, "left region")


def region_fanout(records: DataFrame, conf: RegionSplitConf = RegionSplitConf(),
                  keep: Sequence[str] = (), seq: str | None = None):
    """Both topics in one pass: per line, all current-region messages, then
    all left-region ones, from a single explode. One scan, no cache, no
    union, no shuffle. ``seq`` names a column for a message's place among its
    line's (from 0), which a sink does not keep."""
    return _messages(records, [(CURRENT, conf.topic_in), (LEFT, conf.topic_out)], keep,
                     conf.on_malformed, "region lists", seq)


def region_fanout_tagged(records: DataFrame, conf: RegionSplitConf = RegionSplitConf(),
                         keep: Sequence[str] = (), seq: str | None = None) -> DataFrame:
    """``region_fanout`` with malformed lines in the same frame: one row each,
    with ``reason`` and ``n_fields`` and null message columns. Good messages
    have a null ``reason``. Every line is split once."""
    return _messages(records, [(CURRENT, conf.topic_in), (LEFT, conf.topic_out)], keep, "tag", "region lists", seq)


def region_fanout_two_pass(records: DataFrame, conf: RegionSplitConf = RegionSplitConf()):
    """Benchmark variant: persist the parsed lines, explode each topic
    separately, union. Returns ``(messages, cached)``; unpersist when done."""
    cached = records.select("value").persist()
    a = region_in_messages(cached, conf)
    b = region_out_messages(cached, conf)
    return a.unionByName(b), cached
