"""Job spec: one declarative description of a source and the tables made from it.

A spec is plain driver-side data (frozen dataclasses); it is never a table.
``JobSpec.from_dict`` reads the JSON job-spec layout (flat upper-case
connection/date/paging keys, lower-case table keys, ``nested_tables``) and
``validate`` rejects the shapes that would otherwise fail half-way through a
run.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Mapping


_SECRET = re.compile(r"secret|password|passwd|token|credential|api_?key|client_?id|authorization", re.IGNORECASE)


class SpecError(ValueError):
    """The job spec cannot be run as written."""


@dataclass(frozen=True)
class ChildSpec:
    """One child table unnested from the record along ``path``."""

    name: str
    path: tuple[str, ...]
    parent_keys: tuple[tuple[str, str], ...]  # ordered (name, declared type)
    keys: tuple[str, ...]
    schema: tuple[tuple[str, str], ...]  # ordered (name, declared type)

    @property
    def parent_key_names(self) -> list[str]:
        return [k for k, _ in self.parent_keys]

    @property
    def merge_keys(self) -> list[str]:
        """Upsert key: every parent key, then the child's own keys."""
        return self.parent_key_names + [k for k in self.keys if k not in self.parent_key_names]

    @property
    def output_schema(self) -> dict[str, str]:
        """Parent keys with their spec types, then child columns.

        A child column named like a parent key overrides the type but keeps
        the key's position (plain dict update).
        """
        out = dict(self.parent_keys)
        out.update(self.schema)
        return out


@dataclass(frozen=True)
class JobSpec:
    main_table: str
    main_key: tuple[str, ...]
    schema: tuple[tuple[str, str], ...]
    children: tuple[ChildSpec, ...] = ()
    data_key: str = "data"
    pages_key: str = "totalHits"
    page_size: int = 100
    interval_days: int = 7
    start: str | None = None
    end: str | None = None
    raw_table: str = "raw_data"
    bronze_schema: str | None = None
    silver_schema: str | None = None
    full_schema: Any = None  # nested example-shaped declaration, optional
    extra: Mapping[str, Any] = field(default_factory=dict, repr=False)

    @property
    def main_schema(self) -> dict[str, str]:
        return dict(self.schema)

    def child(self, name: str) -> ChildSpec:
        for c in self.children:
            if c.name == name:
                return c
        raise KeyError(name)

    @property
    def table_names(self) -> list[str]:
        return [self.main_table] + [c.name for c in self.children]

    def qualified(self, table: str, layer: str = "silver") -> str:
        db = self.silver_schema if layer == "silver" else self.bronze_schema
        return f"{db}.{table}" if db else table

    # ------------------------------------------------------------------ I/O
    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> "JobSpec":
        """Read the JSON job-spec layout.

        Unknown keys are kept in ``extra`` (not printed), except those that name
        credentials: a spec never holds a secret.
        """
        validate_dict(d)
        key = d["main_table_key"]
        children = []
        for c in d.get("nested_tables", []) or []:
            children.append(
                ChildSpec(
                    name=c["unnested_to_table"],
                    path=tuple(c["unnested_column"]),
                    parent_keys=tuple(c["parent_key"].items()),
                    keys=tuple(c.get("unnested_to_table_key", []) or []),
                    schema=tuple(c.get("data_schema", {}).items()),
                )
            )
        # fixed values: the job-spec layout's own keys
        known = {
            "main_table_name", "main_table_key", "data_schema", "nested_tables", "data",
            "pages", "PAGE_SIZE", "RETRIEVAL_INTERVAL", "START_DATE", "END_DATE",
            "raw_table_name", "bronze_schema", "silver_schema", "full_schema",
        }
        spec = cls(
            main_table=d["main_table_name"],
            main_key=tuple(key) if isinstance(key, (list, tuple)) else (key,),
            schema=tuple(d["data_schema"].items()),
            children=tuple(children),
            data_key=d.get("data", "data"),
            pages_key=d.get("pages", "totalHits"),
            page_size=_int(d.get("PAGE_SIZE"), 100),
            interval_days=_int(d.get("RETRIEVAL_INTERVAL"), 7),
            start=d.get("START_DATE") or None,
            end=d.get("END_DATE") or None,
            raw_table=d.get("raw_table_name", "raw_data"),
            bronze_schema=d.get("bronze_schema"),
            silver_schema=d.get("silver_schema"),
            full_schema=d.get("full_schema"),
            extra={k: v for k, v in d.items()
                   if k not in known and not k.startswith("_comment") and not _SECRET.search(k)},
        )
        validate(spec)
        return spec

    @classmethod
    def from_json(cls, text: str) -> "JobSpec":
        return cls.from_dict(json.loads(text))


def _int(v: Any, default: int) -> int:
    """Integer setting; blank or absent means the default (0 stays 0 and is rejected later)."""
    return default if v is None or (isinstance(v, str) and not v.strip()) else int(v)


def _case_collisions(names) -> list[str]:
    seen: dict[str, str] = {}
    bad = []
    for n in names:
        low = n.lower()
        if low in seen and seen[low] != n:
            bad.append(f"{seen[low]!r}/{n!r}")
        seen.setdefault(low, n)
    return bad


def validate_dict(d: Mapping[str, Any]) -> None:
    """Shape checks on the raw mapping, before any dataclass is built."""
    for k in ("main_table_name", "main_table_key", "data_schema"):
        if k not in d:
            raise SpecError(f"spec is missing {k!r}")
    if not isinstance(d["data_schema"], Mapping):
        raise SpecError("data_schema must be an object of column -> type")
    for i, c in enumerate(d.get("nested_tables", []) or []):
        name = c.get("unnested_to_table", f"nested_tables[{i}]")
        if not isinstance(c.get("unnested_column"), list) or not c["unnested_column"]:
            raise SpecError(f"{name}: unnested_column must be a non-empty list of names")
        if not isinstance(c.get("parent_key"), Mapping):
            raise SpecError(f"{name}: parent_key must be an object of key -> type")
        if not isinstance(c.get("data_schema", {}), Mapping):
            raise SpecError(f"{name}: data_schema must be an object of column -> type")
        keys = c.get("unnested_to_table_key", [])
        if keys is not None and not isinstance(keys, list):
            raise SpecError(f"{name}: unnested_to_table_key must be a list")


def validate(spec: JobSpec) -> None:
    """Reject specs that cannot run: bad interval, duplicate or case-colliding names."""
    if spec.interval_days <= 0:
        raise SpecError("RETRIEVAL_INTERVAL must be > 0 days")
    if spec.page_size <= 0:
        raise SpecError("PAGE_SIZE must be > 0")
    names = spec.table_names
    if len(set(names)) != len(names):
        raise SpecError(f"table names repeat: {names}")
    for k in spec.main_key:
        if k not in spec.main_schema:
            raise SpecError(f"main key {k!r} is not a column of {spec.main_table}")
    bad = _case_collisions(spec.main_schema)
    if bad:
        raise SpecError(f"{spec.main_table}: columns differ only in case: {bad}")
    for c in spec.children:
        bad = _case_collisions(c.output_schema)
        if bad:
            raise SpecError(f"{c.name}: columns differ only in case: {bad}")
        for k in c.keys:
            if k not in c.output_schema:
                raise SpecError(f"{c.name}: key {k!r} is neither a parent key nor a column")
    if spec.start and spec.end and parse_instant(spec.start) > parse_instant(spec.end):
        raise SpecError("START_DATE is after END_DATE")


def parse_instant(text: str) -> datetime:
    """ISO-8601 instant as a naive UTC datetime (``...Z`` or zoneless)."""
    t = text.strip().replace("Z", "+00:00")
    dt = datetime.fromisoformat(t)
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    return dt


def ts_lit(v: "datetime | str"):
    """A TIMESTAMP literal read in the session time zone (never the Python process zone)."""
    from pyspark.sql import functions as F

    dt = parse_instant(v) if isinstance(v, str) else v
    return F.lit(dt.isoformat(sep=" ")).cast("timestamp")


def select_tables(spec: JobSpec, selection: str | None) -> tuple[list[str], list[str]]:
    """Target-table selection: comma list, trimmed, blanks dropped; empty = all.

    Returns ``(kept, unknown)`` with ``kept`` in spec order.
    """
    if selection is None:
        return spec.table_names, []
    wanted = [t.strip() for t in selection.split(",") if t.strip()]
    if not wanted:
        return spec.table_names, []
    known = spec.table_names
    kept = [t for t in known if t in wanted]
    unknown = [t for t in wanted if t not in known]
    return kept, unknown
