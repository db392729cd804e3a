from cinesift.streaming.ratings_stream import STREAMED_AGGREGATES, latest, read_ratings_stream, start_aggregate

__all__ = ["STREAMED_AGGREGATES", "latest", "read_ratings_stream", "start_aggregate"]
