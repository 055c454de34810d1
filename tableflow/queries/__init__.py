"""One runnable query per operator over the test tables, with its SQL counterpart."""

from tableflow.queries import columns, database, files, keyvalue, lake, reports
from tableflow.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "columns", "database", "files", "keyvalue", "lake", "reports"]
