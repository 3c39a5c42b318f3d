from tallyloom.sinks.batches import batch_log, commit_batch, is_committed, left_behind, read_batches
from tallyloom.sinks.buckets import BucketedTable, declare, replace_bucketed
from tallyloom.sinks.conserved import Conservation, differences, must_balance, write_conserved
from tallyloom.sinks.tables import append, append_day, conform, must_succeed, overwrite, write_all, write_selected

__all__ = [
    "BucketedTable", "Conservation", "append", "append_day", "batch_log", "commit_batch", "conform", "declare", "differences", "is_committed",
    "left_behind", "must_balance", "must_succeed", "overwrite", "read_batches", "replace_bucketed", "write_all", "write_conserved",
    "write_selected",
]
