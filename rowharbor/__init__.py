"""Data-quality checks and keyed loads for untrusted tabular batches, on PySpark DataFrames."""

from rowharbor.spec import ForeignKey, SpecError, TableSpec

__all__ = ["ForeignKey", "SpecError", "TableSpec"]
