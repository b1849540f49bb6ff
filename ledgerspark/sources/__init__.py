from ledgerspark.sources.csv_files import (
    CsvFiles,
    ledger_files,
    load_summary,
    look_at_csv,
    merge_raw,
    qualified_root,
    read_csv_by_name,
    read_csv_rejects,
    read_ledger_csv,
    relative_path,
    unreadable_files,
)
from ledgerspark.sources.manifest import (
    changed_files,
    file_manifest,
    file_status,
    ingest_summary,
    line_checksums,
    list_files,
)
from ledgerspark.sources.seeds import read_targets, targets_frame
from ledgerspark.sources.tables import (
    export_all,
    materialize,
    read_table,
    register_views,
    write_table,
)

__all__ = [
    "CsvFiles",
    "changed_files",
    "export_all",
    "file_manifest",
    "file_status",
    "ingest_summary",
    "ledger_files",
    "line_checksums",
    "list_files",
    "load_summary",
    "look_at_csv",
    "materialize",
    "merge_raw",
    "qualified_root",
    "read_csv_by_name",
    "read_csv_rejects",
    "read_ledger_csv",
    "read_table",
    "read_targets",
    "register_views",
    "relative_path",
    "targets_frame",
    "unreadable_files",
    "write_table",
]
