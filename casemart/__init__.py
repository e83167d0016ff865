"""casemart: case-surveillance analytics as lazy PySpark DataFrame operators."""

from casemart.schema import RAW_COLUMNS, RAW_SCHEMA, Flavour

__all__ = ["RAW_COLUMNS", "RAW_SCHEMA", "Flavour"]
