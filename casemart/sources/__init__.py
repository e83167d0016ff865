"""Scans and sinks."""

from casemart.sources.raw import (
    create_loaded_view,
    create_raw_table,
    read_raw_csv,
    read_raw_lines,
)
from casemart.sources.records import read_raw_records
from casemart.sources.publish import AuditFailed, publish
from casemart.sources.tables import (
    copy_file,
    delete_folder,
    export_mart,
    file_version,
    matching,
    replace_table,
    save_mart,
    shared_dir,
    write_and_read,
)

__all__ = [
    "AuditFailed",
    "copy_file",
    "create_loaded_view",
    "create_raw_table",
    "delete_folder",
    "export_mart",
    "file_version",
    "matching",
    "publish",
    "read_raw_csv",
    "read_raw_lines",
    "read_raw_records",
    "replace_table",
    "save_mart",
    "shared_dir",
    "write_and_read",
]
