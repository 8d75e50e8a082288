"""Resource and target descriptions, checked on the driver before any job starts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

from objsync.functions.rules import check_name

# Accepted words of a description, the first disposition being the default.
DISPOSITIONS = ("append", "replace", "merge")
OPERATIONS = ("insert", "upsert", "delete", "replace")
REQUIRED = ("name", "object", "primary_key")


@dataclass(frozen=True)
class ResourceConfig:
    """What to extract: an object, its fields, an optional filter and cursor."""

    name: str
    object: str
    primary_key: str | tuple[str, ...]
    fields: tuple[str, ...] = ()
    write_disposition: str = "append"
    replication_key: str | None = None
    query_filter: Any = None
    filter_fields: tuple[str, ...] = ()
    column_types: Mapping[str, str] = field(default_factory=dict)
    limit: int | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.primary_key,) if isinstance(self.primary_key, str) else tuple(self.primary_key)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> ResourceConfig:
        """Build from a plain dict; ``column_types`` also takes ``{"data_type": ...}`` values."""
        types = {
            column: spec["data_type"] if isinstance(spec, Mapping) else spec
            for column, spec in (raw.get("column_types") or {}).items()
        }
        key = raw["primary_key"]
        return cls(
            name=raw["name"],
            object=raw["object"],
            primary_key=key if isinstance(key, str) else tuple(key),
            fields=tuple(raw.get("fields") or ()),
            write_disposition=raw.get("write_disposition", "append"),
            replication_key=raw.get("replication_key"),
            query_filter=raw.get("query_filter"),
            filter_fields=tuple(raw.get("filter_fields") or ()),
            column_types=types,
            limit=raw.get("limit"),
        )


def validate_resources(configs: Iterable[Mapping[str, Any] | ResourceConfig]) -> list[ResourceConfig]:
    """Check every description and return them as ``ResourceConfig``.

    One error lists all faults of all descriptions, each with its position.
    """
    given = list(configs)
    if not given:
        raise ValueError("No resource is described")
    faults = [f"resource {n}: {fault}" for n, config in enumerate(given) for fault in _faults(config)]
    if faults:
        raise ValueError("; ".join(faults))
    return [config if isinstance(config, ResourceConfig) else ResourceConfig.from_dict(config) for config in given]


def _faults(config: Mapping[str, Any] | ResourceConfig) -> Iterator[str]:
    values = vars(config) if isinstance(config, ResourceConfig) else config
    for name in REQUIRED:
        if not values.get(name):
            yield f"no {name}"
    fields, cursor = values.get("fields", ()), values.get("replication_key")
    if not isinstance(fields, (list, tuple)):
        yield "fields is not a list"
    elif fields and cursor and cursor not in fields:
        yield f"cursor {cursor} is not among the fields"
    disposition = values.get("write_disposition", DISPOSITIONS[0])
    if disposition not in DISPOSITIONS:
        yield f"write_disposition {disposition} is not one of {', '.join(DISPOSITIONS)}"


@dataclass(frozen=True)
class TargetConfig:
    """Where to write and how: disposition, operation and key of the target object."""

    name: str
    operation: str
    write_disposition: str = "append"
    primary_key: str | tuple[str, ...] | None = None
    on_duplicate: str = "reject"
    order_by: tuple[str, ...] = ()
    null_policy: str = "overwrite"
    target_unique: bool = False
    evolve: bool = False
    allow_empty: bool = False

    @property
    def keys(self) -> tuple[str, ...]:
        if not self.primary_key:
            return ()
        return (self.primary_key,) if isinstance(self.primary_key, str) else tuple(self.primary_key)

    @property
    def matching_keys(self) -> tuple[str, ...]:
        """The key columns that rows are matched by: all of a merge, else the first; never dotted."""
        if not self.keys:
            raise ValueError(f"Target '{self.name}': {self.operation} needs a key")
        matching = self.keys if self.operation == "merge" else self.keys[:1]
        return tuple(check_name(key, dotted=False) for key in matching)

    @property
    def keyed_by_id(self) -> bool:
        return bool(self.keys) and self.keys[0].lower() == "id"

    @classmethod
    def from_hints(cls, hints: Mapping[str, Any], **options: Any) -> TargetConfig:
        """From table hints: name, disposition, operation, and a key or flagged key columns.

        The dispositions replace and merge fix the operation; append must name one.
        """
        name, disposition, hinted = (hints.get(word) for word in ("name", "write_disposition", "operation"))
        if not name:
            raise ValueError("The target has no name")
        if disposition not in DISPOSITIONS:
            raise ValueError(f"Target '{name}': unknown write_disposition {disposition}")
        if disposition == "append" and hinted not in OPERATIONS:
            raise ValueError(f"Target '{name}': append needs an operation out of {', '.join(OPERATIONS)}, not {hinted}")
        operation = hinted if disposition == "append" else disposition
        return cls(name, operation, disposition, _declared_key(hints) or _flagged_key(hints), **options)


def _declared_key(hints: Mapping[str, Any]) -> str | tuple[str, ...] | None:
    """The key of the table hints, as given."""
    key = hints.get("primary_key")
    return key if not key or isinstance(key, str) else tuple(key)


def _flagged_key(hints: Mapping[str, Any]) -> str | tuple[str, ...] | None:
    """The columns flagged as key: one alone as text, several together."""
    flagged = [column for column, hint in (hints.get("columns") or {}).items() if hint.get("primary_key") is True]
    return tuple(flagged) if len(flagged) > 1 else next(iter(flagged), None)
