"""Row-wise features on Structured Streaming."""

from squall.streaming.rows import read_stream, row_features, write_available

__all__ = ["read_stream", "row_features", "write_available"]
