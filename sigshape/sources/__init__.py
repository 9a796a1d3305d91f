from .records import (RECORD_COLUMNS, RECORD_SCHEMA, assign_batches, clean_values, kafka_options,
                      read_records, stream_records, subscribe_topics, topic_set)
from .offsets import (offset_bounds, offset_resolve, positions_frame, replay_from_offsets,
                      resolved_positions, start_position, starting_offsets_json)
from .sinks import land_records, producer_options, write_messages

__all__ = [
    "RECORD_COLUMNS", "RECORD_SCHEMA", "assign_batches", "clean_values", "kafka_options",
    "read_records", "stream_records", "subscribe_topics", "topic_set",
    "offset_bounds", "offset_resolve", "positions_frame", "replay_from_offsets",
    "resolved_positions", "start_position", "starting_offsets_json",
    "land_records", "producer_options", "write_messages",
]
