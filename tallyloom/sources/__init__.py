from tallyloom.sources.audit import load_audit, observed
from tallyloom.sources.payloads import (
    arrays_to_rows, credits_of_text, flatten_structs, read_json, read_variants, shred, shred_all, variant_path, variant_schema,
)
from tallyloom.sources.refused import Split, read_checked
from tallyloom.sources.tables import Table, by_environment, day_slice, padded_days, process_day, read_csv, run_sql, scan

__all__ = [
    "Split", "Table", "arrays_to_rows", "by_environment", "credits_of_text", "day_slice", "flatten_structs", "load_audit", "observed",
    "padded_days", "process_day", "read_checked", "read_csv", "read_json", "read_variants", "run_sql", "scan", "shred", "shred_all",
    "variant_path", "variant_schema",
]
