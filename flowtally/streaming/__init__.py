from flowtally.streaming.jobs import (StreamPlan, alerts_stream, alerts_stream_asof, alerts_stream_records,
                                      cumulative_stream, cumulative_stream_marked, end_marker, replay_lateness,
                                      rolling_stream, running_day_mean_stream,
                                      with_end_marker, with_event_time)
from flowtally.streaming.late import LateRows, read_late
from flowtally.streaming.live import endpoint_stream
from flowtally.streaming.records import replay_records
from flowtally.streaming.replay import replay_in_order
from flowtally.streaming.runner import run_to_table, start
from flowtally.streaming.sink import compact, latest_snapshot, read_latest

__all__ = [
    "StreamPlan", "alerts_stream", "alerts_stream_records", "cumulative_stream",
    "rolling_stream", "running_day_mean_stream", "with_event_time", "run_to_table", "start",
    "replay_lateness", "with_end_marker", "end_marker", "read_latest", "compact", "latest_snapshot",
    "LateRows", "alerts_stream_asof", "endpoint_stream", "cumulative_stream_marked", "read_late", "replay_in_order", "replay_records",
]
