from .progress import ProgressListener, ProgressTable
from .runners import (BatchTimeLogger, DedupBatchWriter, RegionSplitBatchWriter, dedup_writer, finish,
                      landing_writer, records_writer, region_split_writer, run_dedup, run_landed,
                      start, tap_writer)

__all__ = ["BatchTimeLogger", "DedupBatchWriter", "ProgressListener", "ProgressTable",
           "RegionSplitBatchWriter", "dedup_writer", "finish", "landing_writer", "records_writer",
           "region_split_writer", "run_dedup", "run_landed", "start", "tap_writer"]
