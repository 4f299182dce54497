"""Streaming jobs over files of transactions."""

from riskspark.streaming.daily import daily_drift_stream, daily_reports
from riskspark.streaming.jobs import investigate_stream, monitor_stream, score_stream, store_stream
from riskspark.streaming.state import velocity_stream

__all__ = ["daily_drift_stream", "daily_reports", "investigate_stream", "monitor_stream", "score_stream", "store_stream", "velocity_stream"]
