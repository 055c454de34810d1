"""Declarative job descriptions, checked before any Spark job starts."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class SpecError(ValueError):
    """A job description that cannot be run."""


def quoted(name: str) -> str:
    """Quote one identifier for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Refer to a column whose name may hold dots or back-ticks."""
    return F.col(quoted(name))


# Function names and how many parameters each takes.
FUNCTION_ARITY = {"substr": 2, "pad": 3, "replace": 2, "filter": 2}

# The comparison operators a filter may name.
FILTER_OPERATORS = ("like", "not like", ">", "=", "<", ">=", "!=", "<=")

# One element of a partition spec: anything but commas, except inside quotes.
_SPEC_ELEMENT = re.compile(r"""(?:[^,'"]|'[^']*'|"[^"]*"|['"])+""")


@dataclass(frozen=True)
class PartitionSpec:
    """Ordered ``column = value`` pairs; values are always strings."""

    pairs: tuple[tuple[str, str], ...] = ()

    @classmethod
    def parse(cls, text: str | None) -> PartitionSpec:
        """Read ``k1=v1,k2='v2'``: the first ``=`` splits, one pair of quotes is stripped."""
        pairs = []
        for element in _SPEC_ELEMENT.findall(text or ""):
            if not element.strip():
                continue
            key, equals, value = (part.strip() for part in element.partition("="))
            if not equals or not key:
                raise SpecError(f"partition spec needs key=value, got {element!r}")
            if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
                value = value[1:-1]
            pairs.append((key, value))
        keys = [key for key, _ in pairs]
        if len(set(keys)) != len(keys):
            raise SpecError(f"partition spec names a column twice: {text!r}")
        return cls(tuple(pairs))

    @property
    def keys(self) -> list[str]:
        return [key for key, _ in self.pairs]

    def predicate(self) -> Column:
        """All pairs as one condition, which the scan turns into partition pruning."""
        condition = F.lit(True)
        for key, value in self.pairs:
            condition = condition & (column(key) == F.lit(value))
        return condition

    def sql(self) -> str:
        """The pairs as the inside of a ``PARTITION (...)`` clause."""
        return ", ".join(f"{quoted(k)} = {sql_text(v)}" for k, v in self.pairs)

    def __bool__(self) -> bool:
        return bool(self.pairs)


def sql_text(value: str) -> str:
    """A Spark SQL string literal holding exactly this text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class FuncSpec:
    """One column function with its parameters, all given as text."""

    name: str
    params: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "params", tuple(str(p) for p in self.params))
        if self.name not in FUNCTION_ARITY:
            raise SpecError(f"unknown function {self.name!r}")
        need = FUNCTION_ARITY[self.name]
        if len(self.params) != need:
            raise SpecError(f"{self.name} needs {need} parameters, got {len(self.params)}")
        if self.name == "substr":
            self._whole_number(0), self._whole_number(1)
        elif self.name == "pad":
            if self.params[0].lower() not in ("l", "r"):
                raise SpecError(f"pad flag must be 'L' or 'R', got {self.params[0]!r}")
            self._whole_number(1)
        elif self.name == "filter" and self.operator not in FILTER_OPERATORS:
            raise SpecError(f"filter operator must be one of {FILTER_OPERATORS}, got {self.params[0]!r}")

    def _whole_number(self, index: int) -> int:
        try:
            return int(self.params[index].strip())
        except ValueError:
            raise SpecError(
                f"{self.name} needs a whole number, got {self.params[index]!r}") from None

    @property
    def operator(self) -> str:
        """The comparison of a ``filter``: trimmed, lower-case, single blanks."""
        return " ".join(self.params[0].lower().split())


@dataclass(frozen=True)
class ColumnSpec:
    """A target column: its type, comment, cleaning functions and source type."""

    name: str
    type: str
    comment: str = ""
    funcs: tuple[FuncSpec, ...] = ()
    source_type: str = "string"

    def __post_init__(self):
        if not self.name or not self.type:
            raise SpecError("a column needs a name and a type")
        object.__setattr__(self, "funcs", tuple(self.funcs))

    @classmethod
    def from_dict(cls, data: Mapping) -> ColumnSpec:
        return cls(
            name=data.get("columnName") or "",
            type=data.get("columnType") or "",
            comment=data.get("comment") or "",
            funcs=tuple(FuncSpec(f["funcName"], tuple(f.get("funcParams") or ()))
                        for f in data.get("funcs") or ()),
            source_type=data.get("dataType") or "string",
        )

    @property
    def cleaning(self) -> list[FuncSpec]:
        return [f for f in self.funcs if f.name != "filter"]

    @property
    def filters(self) -> list[FuncSpec]:
        return [f for f in self.funcs if f.name == "filter"]


@dataclass(frozen=True)
class JobSpec:
    """One table movement. Only the parts a job uses need to be set."""

    target_table: str
    source_table: str = ""
    sql: str = ""
    columns: tuple[ColumnSpec, ...] = ()
    add_columns: tuple[ColumnSpec, ...] = ()
    partitions: PartitionSpec = field(default_factory=PartitionSpec)
    primary_key: str = ""
    connection_url: str = ""
    db_user: str = ""
    db_password: str = field(default="", repr=False)
    db_type: str = ""
    cluster: str = ""
    location: str = ""

    def __post_init__(self):
        if not self.target_table:
            raise SpecError("a job needs a target table")
        names = [c.name.lower() for c in dict.fromkeys(self.columns)]
        if len(set(names)) != len(names):
            raise SpecError("a column is declared twice with different settings")

    @classmethod
    def from_dict(cls, data: Mapping) -> JobSpec:
        return cls(
            target_table=data.get("targetTable") or "",
            source_table=data.get("sourceTable") or "",
            sql=data.get("sql") or "",
            columns=tuple(ColumnSpec.from_dict(c) for c in data.get("columns") or ()),
            add_columns=tuple(ColumnSpec.from_dict(c) for c in data.get("addColumns") or ()),
            partitions=PartitionSpec.parse(data.get("partitions")),
            primary_key=data.get("primaryKey") or "",
            connection_url=data.get("connectionUrl") or "",
            db_user=data.get("dbUser") or "",
            db_password=data.get("dbPassword") or "",
            db_type=data.get("dbType") or "",
            cluster=data.get("cluster") or "",
            location=data.get("location") or "",
        )

    @classmethod
    def list_from_json(cls, text: str) -> list[JobSpec]:
        """Read one job object or a list of them; each keeps its own partition."""
        data = json.loads(text)
        return [cls.from_dict(d) for d in (data if isinstance(data, list) else [data])]

    def require(self, *names: str) -> None:
        """Fail before any work when a setting this kind of job needs is empty."""
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise SpecError(f"job for {self.target_table!r} lacks: {', '.join(missing)}")


def secret(spark: SparkSession, text: str) -> str:
    """Resolve ``env:NAME`` or ``conf:key``; any other text is the secret itself."""
    if text.startswith("env:"):
        return os.environ[text[len("env:"):]]
    if text.startswith("conf:"):
        return spark.conf.get(text[len("conf:"):])
    return text
