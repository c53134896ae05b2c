from chronoframe.streaming.copy import stream_copy

__all__ = ["stream_copy"]
