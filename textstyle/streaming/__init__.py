"""The batch features and models applied to live JSON."""

from textstyle.streaming.live import (
    STREAM_SCHEMA,
    drain,
    quick_local_logs,
    read_json_stream,
    run_for,
    score_stream,
    sub_folders,
    write_json_stream,
    write_micro_batches,
)
from textstyle.streaming.progress import (
    ProgressTable,
    batches,
    follow,
    follow_all,
    missed_batches,
    progress_summary,
)
from textstyle.streaming.recovery import lose_commit, unfinished_batches

__all__ = [
    "STREAM_SCHEMA",
    "ProgressTable",
    "batches",
    "drain",
    "follow",
    "follow_all",
    "lose_commit",
    "missed_batches",
    "progress_summary",
    "quick_local_logs",
    "read_json_stream",
    "run_for",
    "score_stream",
    "sub_folders",
    "unfinished_batches",
    "write_json_stream",
    "write_micro_batches",
]
