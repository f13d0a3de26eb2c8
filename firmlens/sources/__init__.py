"""Readers and writers."""
from firmlens.sources.files import (  # noqa: F401
    compact,
    drop_steps,
    load_csv_groups,
    read_csv,
    read_json,
    read_ndjson,
    read_parquet,
    read_whole_files,
    run_folder,
    shared_folder,
    spread,
    stored,
    unreadable_files,
    write_csv,
    write_json,
    write_parquet,
)
