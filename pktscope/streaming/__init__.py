"""Structured Streaming form of the window aggregation."""

from pktscope.streaming.windows import (  # noqa: F401
    packet_stream, score_window_stream, start_window_stream, stream_windows)
