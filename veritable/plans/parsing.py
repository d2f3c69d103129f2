"""Parsing and checking a list of rules before anything is planned."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from veritable.functions.predicates import required_keys
from veritable.operators.foreign_keys import check_reference
from veritable.rules import FOREIGN_KEY, Rule


def parse_rules(specs: Iterable[Rule | Mapping[str, Any]]) -> list[Rule]:
    """Parse a rule list, refusing anything that could not be evaluated.

    The checks run whether or not the dataset has rows, so that a broken rule
    cannot hide behind an empty input.
    """
    rules = [Rule.parse(spec) for spec in specs]
    seen: set[str] = set()
    for rule in rules:
        if not isinstance(rule.id, str) or not rule.id:
            raise ValueError(f"Rule id must be a non-empty string, got {rule.id!r}")
        if rule.id in seen:
            raise ValueError(f"Duplicate rule id {rule.id!r}")
        seen.add(rule.id)
        if not isinstance(rule.severity, str):
            raise ValueError(f"Rule {rule.id!r}: severity must be a string")
        for key in required_keys(rule):
            if key == "column":
                missing = not rule.column
            elif key in ("query", "expression"):
                missing = not rule.params.get(key)
            else:
                missing = key not in rule.params
            if missing:
                raise ValueError(f"{rule.type} rule {rule.id!r} requires a {key!r}")
        if rule.type == FOREIGN_KEY:
            check_reference(rule)
    return rules
