"""The rule record."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# Rule type names and the default severity.
UNIQUE = "unique"
CUSTOM_SQL = "custom_sql"
FOREIGN_KEY = "foreign_key"
DATASET_LEVEL = (UNIQUE, CUSTOM_SQL, FOREIGN_KEY)
DEFAULT_SEVERITY = "error"


@dataclass(frozen=True)
class Rule:
    """One declarative check. ``params`` holds every key that is not a field."""

    id: str
    type: str
    column: str | None = None
    severity: str = DEFAULT_SEVERITY
    description: str | None = ""
    params: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def parse(cls, spec: Rule | Mapping[str, Any]) -> Rule:
        """Accept a plain mapping (as found in a config file) or a Rule."""
        if isinstance(spec, Rule):
            return spec
        rest = dict(spec)
        named = {"id": rest.pop("id"), "type": rest.pop("type")}
        for name in ("column", "severity", "description"):
            if name in rest:
                named[name] = rest.pop(name)
        return cls(**named, params=rest)

    @property
    def dataset_level(self) -> bool:
        return self.type in DATASET_LEVEL
