from sparsepages.streaming.live import append_stream, filter_requests, stream_responses

__all__ = ["append_stream", "filter_requests", "stream_responses"]
