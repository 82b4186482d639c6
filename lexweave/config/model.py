"""Configuration objects, and how a config file becomes them.

Everything here runs on the driver and touches field names only, never rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path


class ConfigError(ValueError):
    """A mapping or whitelist that cannot be compiled."""


@dataclass(frozen=True)
class TargetField:
    """One target column: a copied source field, the tenant id, or a null."""

    name: str
    data_type: str
    source: str | None = None
    kind: str = "null"  # data | org | key | null


@dataclass(frozen=True)
class TargetTable:
    name: str
    entity: str | None
    fields: tuple[TargetField, ...]

    def field(self, name: str) -> TargetField:
        for candidate in self.fields:
            if candidate.name.lower() == name.lower():
                return candidate
        raise ConfigError(f"table {self.name} has no target field {name}")

    @property
    def org_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.kind == "org"]

    def without(self, *names: str) -> TargetTable:
        dropped = {n.lower() for n in names}
        return replace(self, fields=tuple(f for f in self.fields if f.name.lower() not in dropped))


@dataclass(frozen=True)
class Mapping:
    org_id: object  # a value, or a column of frames that hold several tenants
    tables: dict[str, TargetTable]

    def table(self, name: str) -> TargetTable:
        try:
            return self.tables[name]
        except KeyError:
            raise ConfigError(f"mapping has no table {name}") from None

    def with_overrides(self, overrides: dict[str, TargetTable]) -> Mapping:
        """Per-customer variant: the given tables replace the common ones."""
        return replace(self, tables={**self.tables, **overrides})


@dataclass(frozen=True)
class Section:
    """Whitelisted fields of one entity; ``fields=None`` takes every declared field."""

    name: str
    fields: tuple[str, ...] | None = None

    def allows(self, name: str) -> bool:
        return self.fields is None or name in self.fields


@dataclass(frozen=True)
class Whitelist:
    org_id: int | str | None = None
    core: dict[str, Section] = field(default_factory=dict)
    project_types: dict[int, dict[str, Section]] = field(default_factory=dict)

    def section(self, name: str, project_type: int | None = None) -> Section:
        """A core entity by name, or a section of one project type (any case)."""
        known = self.core if project_type is None else self.project_types.get(project_type, {})
        for candidate in known.values():
            if candidate.name.lower() == name.lower():
                return candidate
        raise ConfigError(f"no whitelist for {name} (project type {project_type})")


def unique_targets(table: TargetTable) -> TargetTable:
    """Keep one copy of a target listed twice; two different copies are an error."""
    kept: dict[str, TargetField] = {}
    for item in table.fields:
        first = kept.setdefault(item.name.lower(), item)
        if (first.source, first.kind) != (item.source, item.kind):
            raise ConfigError(
                f"{table.name}.{item.name} is mapped from both {first.source} and {item.source}"
            )
    return replace(table, fields=tuple(kept.values()))


def _read(path: str) -> dict:
    text = Path(path).read_text()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:
        raise ConfigError("YAML configs need PyYAML; use a .json config instead") from exc
    return yaml.safe_load(text)


def _target_field(entry: dict) -> TargetField:
    rule = entry.get("transform") or {}
    kind, name = rule.get("type"), entry["name"]
    if kind == "data":
        return TargetField(name, entry["data_type"], rule["source_field"], "data")
    if kind == "org_id" or (kind == "key" and name.lower().endswith("_org_id")):
        return TargetField(name, entry["data_type"], kind="org")
    return TargetField(name, entry["data_type"], kind=kind or "null")


def load_mapping(source: str | dict) -> Mapping:
    """Read ``{org_id, tsm: [{name, fields: [...]}]}`` from a file or a dict."""
    raw = _read(source) if isinstance(source, str) else source
    tables = {}
    for entry in raw["tsm"]:
        names = [
            f["transform"]["source_entity_name"]
            for f in entry["fields"]
            if (f.get("transform") or {}).get("source_entity_name")
        ]
        fields = tuple(_target_field(f) for f in entry["fields"])
        tables[entry["name"]] = unique_targets(
            TargetTable(entry["name"], names[0] if names else None, fields)
        )
    return Mapping(raw.get("org_id"), tables)


def _sections(entries: list[dict]) -> dict[str, Section]:
    return {
        e["name"]: Section(e["name"], tuple(e["fields"]) if e.get("fields") else None)
        for e in entries
    }


def load_whitelist(source: str | dict) -> Whitelist:
    """Read ``{org_id, core: [...], projectTypes: [{id, sections}]}``."""
    raw = _read(source) if isinstance(source, str) else source
    return Whitelist(
        raw.get("org_id"),
        _sections(raw.get("core", [])),
        {p["id"]: _sections(p["sections"]) for p in raw.get("projectTypes", [])},
    )


def load_lead_whitelist(source: str | dict) -> Whitelist:
    """Read the lead-system config: one ``table_*`` list of sections per entity."""
    raw = _read(source) if isinstance(source, str) else source
    entries = [s for key, group in raw.items() if key.startswith("table_") for s in group]
    return Whitelist(raw.get("org_name"), _sections(entries))
