from strataflow.streaming.cdc import (
    apply_changes, changes_between, read_as_of, read_current, read_gold, rebuild,
)
from strataflow.streaming.changelog import compact, read_log, release, stage
from strataflow.streaming.dedupe import append_known, append_within, stream_dedupe, stream_dedupe_changes
from strataflow.streaming.sinks import append_stream, read_snapshot, write_snapshot
from strataflow.streaming.sums import SumSpec, kept_sums

__all__ = [
    "apply_changes", "changes_between", "compact", "read_as_of", "read_current", "read_gold", "read_log", "rebuild", "release", "stage",
    "stream_dedupe", "stream_dedupe_changes", "append_known", "append_stream", "append_within", "read_snapshot",
    "write_snapshot", "SumSpec", "kept_sums",
]
