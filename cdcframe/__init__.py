"""Change data capture on tables and streams, with Spark DataFrames."""

from cdcframe.functions.payload import Position, parse_position, payload_json, position_json, record_key
from cdcframe.functions.ranges import number_rows
from cdcframe.functions.text import decode_text, encode_text
from cdcframe.operators.check import SchemaMismatch, check_schema, schema_report
from cdcframe.operators.compact import compact, late_updates
from cdcframe.operators.infer import avro_fields, avro_schema, field_types, infer_schema, nested_schema
from cdcframe.operators.merge import condense, fold, merge, merge_into, merge_stats
from cdcframe.operators.render import Bookkeeping, render, route, route_inserts, route_updates, with_bookkeeping
from cdcframe.operators.shape import classify, collapse_pairs, decode_payload, flatten_records, payload_side, to_records
from cdcframe.plans.apply import apply_batch, apply_by_count, apply_records, apply_to_table, close_pending
from cdcframe.plans.replicate import backfill, change_records, replicate, require_unique, snapshot_records, snapshot_then_changes
from cdcframe.sinks.stage import stage_read, stage_write
from cdcframe.sinks.table import TargetTable, bucket_count
from cdcframe.sources.feed import net_changes
from cdcframe.sources.log import consume, log_after, log_end, log_page, next_consume, number_batches, read_log
from cdcframe.sources.scan import high_watermark, high_watermark_value, key_columns, resume_snapshot, snapshot, snapshot_page
from cdcframe.streaming.stream import (
    LogStream,
    close_stream,
    run_to_end,
    stream_append,
    stream_apply,
    stream_changes,
    stream_consume,
    stream_each,
    stream_log,
)

__all__ = [
    "Bookkeeping",
    "LogStream",
    "Position",
    "SchemaMismatch",
    "TargetTable",
    "apply_batch",
    "apply_by_count",
    "apply_records",
    "apply_to_table",
    "avro_fields",
    "avro_schema",
    "backfill",
    "bucket_count",
    "change_records",
    "check_schema",
    "classify",
    "close_pending",
    "close_stream",
    "collapse_pairs",
    "compact",
    "condense",
    "consume",
    "decode_payload",
    "decode_text",
    "encode_text",
    "field_types",
    "flatten_records",
    "fold",
    "high_watermark",
    "high_watermark_value",
    "infer_schema",
    "key_columns",
    "late_updates",
    "log_after",
    "log_end",
    "log_page",
    "merge",
    "merge_into",
    "merge_stats",
    "nested_schema",
    "net_changes",
    "next_consume",
    "number_batches",
    "number_rows",
    "parse_position",
    "payload_json",
    "payload_side",
    "position_json",
    "read_log",
    "record_key",
    "render",
    "replicate",
    "require_unique",
    "resume_snapshot",
    "route",
    "route_inserts",
    "route_updates",
    "run_to_end",
    "schema_report",
    "snapshot",
    "snapshot_page",
    "snapshot_records",
    "snapshot_then_changes",
    "stage_read",
    "stage_write",
    "stream_append",
    "stream_apply",
    "stream_changes",
    "stream_consume",
    "stream_each",
    "stream_log",
    "to_records",
    "with_bookkeeping",
]
