"""Quickstart: derive records from the test tables, run the row split and the
dedup, and print their physical plans.

    python examples/quickstart.py [/root/testdata/sf0.001]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sigshape.conf import DedupConf, RegionSplitConf  # noqa: E402
from sigshape.operators import dedup_latest, region_fanout  # noqa: E402
from sigshape.session import local_session  # noqa: E402
from sigshape.sources.testtables import event_records, wide_signal_records  # noqa: E402


def main(sf_dir: str) -> None:
    spark = local_session()
    lines = wide_signal_records(spark, sf_dir)
    messages = region_fanout(lines, RegionSplitConf(topic_in="region_in", topic_out="region_out"))
    messages.show(5, truncate=False)
    messages.explain("formatted")

    newest = dedup_latest(event_records(spark, sf_dir), DedupConf())
    newest.show(5, truncate=False)
    newest.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
