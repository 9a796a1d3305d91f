"""Job settings from a Java-style properties file (the format the original
jobs were configured with), so an existing configuration can be reused.

Only the keys the jobs read are mapped; everything else is ignored. The same
key can mean different things per job: the row split reads ``topic_name``
and writes ``topic_name_in`` / ``topic_name_out``, while the dedup job reads
``topic_name_in`` and writes ``topic_name_out``.
"""

from __future__ import annotations

from ..conf import DedupConf, RegionSplitConf, TapConf
from ..functions.split import decode_escapes

# Defaults the original jobs use when a key is missing.
DEFAULT_GROUP_ROW_SPLIT = "default_group_rowformat"
DEFAULT_GROUP_DEDUP = "lte_distinct"
DEFAULT_SEPARATOR = ","
DEFAULT_BATCH_INTERVAL = "60"
DEFAULT_TAP_INTERVAL = "30"
DEFAULT_OFFSET_RESET = "latest"


def parse_properties(text: str) -> dict[str, str]:
    """``key=value`` / ``key: value`` / ``key value`` lines; ``#`` and ``!``
    comments; a trailing backslash continues a line; escapes in keys and
    values are decoded."""
    props: dict[str, str] = {}
    logical, pending = [], ""
    for raw in text.splitlines():
        line = raw.lstrip()
        if not pending and (not line or line[0] in "#!"):
            continue
        trailing = len(line) - len(line.rstrip("\\"))
        if trailing % 2 == 1:
            pending += line[:-1]
            continue
        logical.append(pending + line)
        pending = ""
    if pending:
        logical.append(pending)
    for line in logical:
        key_chars, i = [], 0
        while i < len(line):
            ch = line[i]
            if ch == "\\" and i + 1 < len(line):
                key_chars.append(line[i:i + 2])
                i += 2
                continue
            if ch in "=: \t\f":
                break
            key_chars.append(ch)
            i += 1
        rest = line[i:].lstrip(" \t\f")
        if rest[:1] in ("=", ":"):
            rest = rest[1:].lstrip(" \t\f")
        props[decode_escapes("".join(key_chars))] = decode_escapes(rest)
    return props


def load_properties(path: str) -> dict[str, str]:
    with open(path, encoding="utf-8") as fh:
        return parse_properties(fh.read())


def _bool(v: str | None, default: bool) -> bool:
    return default if v is None else v.strip().lower() == "true"


def job_settings(job: str, props: dict[str, str]) -> dict:
    """Keyword settings for one job from properties: ``conf`` plus the Kafka
    fields (``brokers``, ``topics``, ``starting``, ``group_id``, ``secured``)."""
    interval = int(props.get("batch_interval", DEFAULT_BATCH_INTERVAL))
    common = {"brokers": props.get("broker_list"),
              "starting": props.get("auto.offset.reset", DEFAULT_OFFSET_RESET),
              # Only the dedup job reads the switch; the others are always secured.
              "secured": _bool(props.get("kafka.kerberos.enable"), False) if job == "dedup" else True}
    if job == "region-split":
        conf = RegionSplitConf(topic_in=props.get("topic_name_in", "region_in"),
                               topic_out=props.get("topic_name_out", "region_out"),
                               batch_interval_s=interval)
        return {"conf": conf, "topics": props.get("topic_name"),
                "group_id": props.get("group_id", DEFAULT_GROUP_ROW_SPLIT), **common}
    if job == "dedup":
        keys = props.get("input.field.key.index", "")
        if not keys.strip():
            raise ValueError("input.field.key.index is required for the dedup job")
        by_time = _bool(props.get("distinct.time.enable"), True)
        time_index = props.get("input.field.time.index", "")
        if by_time and not time_index.strip():
            raise ValueError("input.field.time.index is required when distinct.time.enable is true")
        conf = DedupConf(key_index=tuple(int(k) for k in keys.split(",")),
                         time_index=int(time_index) if time_index.strip() else -1,
                         separator=props.get("default_separator", DEFAULT_SEPARATOR),
                         distinct_by_time=by_time,
                         topic_out=props.get("topic_name_out", DedupConf().topic_out),
                         drop_blank=_bool(props.get("drop.blank.enable"), False),
                         batch_interval_s=interval)
        return {"conf": conf, "topics": props.get("topic_name_in"),
                "group_id": props.get("group_id", DEFAULT_GROUP_DEDUP), **common}
    if job == "tap":
        return {"conf": TapConf(batch_interval_s=int(props.get("batch_interval", DEFAULT_TAP_INTERVAL))),
                "topics": props.get("topic_name"), "group_id": props.get("group_id"), **common}
    raise ValueError(f"unknown job {job!r}")
