"""Writers: lake tables, files, relational databases, key/value stores, reports."""
