"""Incremental file ingestion, by name and by content."""

from casemart.streaming.ingest import ingest_new_files, rejected_lines
from casemart.streaming.manifest import ContentTable

__all__ = ["ContentTable", "ingest_new_files", "rejected_lines"]
