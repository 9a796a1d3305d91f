"""Job settings as frozen dataclasses, built from arguments (or, through
``plans.properties``, from an existing properties file). Defaults are the
values the reference jobs ship with."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values from the reference jobs: the wide signalling row layout
# (position of each named field), its minimum width, and the separators.
WIDE_FIELD_SEP = ","
LIST_SEP = "|"
WIDE_MIN_WIDTH = 34
WIDE_LAYOUT = {
    "imsi": 0,
    "timestamp": 1,
    "region_code": 9,
    "city_code": 10,
    "county_code": 11,
    "usr_prov_code": 12,
    "usr_city_code": 13,
    "usr_county_code": 14,
    "sex": 15,
    "age_level": 16,
    "arpu_level": 17,
    "out_city_code": 24,
    "out_county_code": 25,
    "curr_region_intime": 28,
    "curr_region_in_out": 29,
    "out_region": 30,
    "out_region_in_dt": 31,
    "out_region_out_dt": 32,
    "out_region_stay": 33,
}
# Output column order of the two row-split message layouts.
REGION_IN_COLUMNS = ("imsi", "region", "timestamp", "city", "county", "usr_prov", "usr_city",
                     "usr_county", "sex", "age_level", "arpu_level", "in_time", "flag")
REGION_OUT_COLUMNS = ("imsi", "region", "timestamp", "in_time", "out_time", "stay",
                      "out_city", "out_county")


@dataclass(frozen=True)
class RegionSplitConf:
    """Row-split job: one wide line -> rows per region, to two topics."""
    topic_in: str = "region_in"
    topic_out: str = "region_out"
    batch_interval_s: int = 60
    on_malformed: str = "fail"          # or "quarantine"

    def __post_init__(self):
        if self.on_malformed not in ("fail", "quarantine"):
            raise ValueError("on_malformed must be 'fail' or 'quarantine'")
        if self.batch_interval_s <= 0:
            raise ValueError("batch_interval_s must be positive")


@dataclass(frozen=True)
class DedupConf:
    """Per-batch dedup job (shipped config: ``IMSI|IMEI|MSISDN|BTIME|LAC|CI``)."""
    # The shipped configuration (key fields, time field,
    # separator, output topic, interval).
    key_index: tuple[int, ...] = (0, 4, 5)
    time_index: int = 3
    separator: str = "|"                # configuration text; escapes are decoded
    distinct_by_time: bool = True       # False = keep any one row per key
    topic_out: str = "lte_distinct"
    batch_interval_s: int = 60
    drop_blank: bool = False            # True drops null/empty lines instead of failing
    on_malformed: str = "fail"          # or "quarantine": short lines are set aside

    def __post_init__(self):
        if self.on_malformed not in ("fail", "quarantine"):
            raise ValueError("on_malformed must be 'fail' or 'quarantine'")
        if self.batch_interval_s <= 0:
            raise ValueError("batch_interval_s must be positive")
        if not self.key_index:
            raise ValueError("key_index must name at least one field")
        if any(int(i) < 0 for i in self.key_index):
            raise ValueError("key_index entries must be >= 0")
        if self.distinct_by_time and (self.time_index is None or int(self.time_index) < 0):
            raise ValueError("time_index is required when distinct_by_time is on")

    @property
    def min_width(self) -> int:
        used = list(self.key_index) + ([self.time_index] if self.distinct_by_time else [])
        return max(int(i) for i in used) + 1


@dataclass(frozen=True)
class TapConf:
    batch_interval_s: int = 30
