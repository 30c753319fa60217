"""Structured Streaming jobs: incremental refresh of stored daily summaries."""

from kestrel.streaming.summary import compact, read_summary, start_summary_refresh  # noqa: F401
