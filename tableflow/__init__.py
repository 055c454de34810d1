"""Config-driven table movement on Spark: scan, clean, filter, place, write."""

from tableflow.spec import ColumnSpec, FuncSpec, JobSpec, PartitionSpec, SpecError

__all__ = ["ColumnSpec", "FuncSpec", "JobSpec", "PartitionSpec", "SpecError"]
