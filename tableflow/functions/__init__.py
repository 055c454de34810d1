"""Column builders: each returns a ``Column`` that stays inside Catalyst."""
