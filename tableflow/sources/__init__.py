"""Readers: tables, SQL text, files, relational databases, key/value files."""
