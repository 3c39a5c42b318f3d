from tallyloom.streaming.classified import classified_stream, count_batch, counts_so_far, once_each, write_counts_stream
from tallyloom.streaming.hourly import LATENESS, hourly_counts_stream, read_landed

__all__ = [
    "LATENESS", "classified_stream", "count_batch", "counts_so_far", "hourly_counts_stream", "once_each", "read_landed", "write_counts_stream",
]
