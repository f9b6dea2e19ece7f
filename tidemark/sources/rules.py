"""Anonymization rules: loading, checking and the registry of rule builders."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column

from ..functions.hashing import hash_field
from ..functions.names import truncate_name

# A rule turns a text column and the salt into a column; None drops the field.
RULES: dict[str, Callable[[Column, str], Column] | None] = {
    "hash": hash_field,
    "truncate": lambda value, salt: truncate_name(value),
    "passthrough": lambda value, salt: value,
    "drop": None,
}


def register_rule(name: str, fn: Callable[[Column, str], Column] | None) -> None:
    """Add a rule usable by name in rule sets loaded afterwards."""
    RULES[name] = fn


@dataclass(frozen=True)
class TableRules:
    target_topic: str
    fields: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class RuleSet:
    salt: str
    tables: dict[str, TableRules]


def load_rules(salt: str, rows: Iterable[tuple[str, str, str | None, str | None]]) -> RuleSet:
    """Rules from ``(table, target_topic, field, rule)`` rows; a row without a field only lists the table."""
    tables: dict[str, TableRules] = {}
    for table, target, name, rule in rows:
        entry = tables.setdefault(table, TableRules(target))
        if name is None:
            continue
        if rule not in RULES:
            raise ValueError(f"unknown rule {rule!r} for {table}.{name}")
        entry.fields[name] = rule
    if not tables:
        raise ValueError("the rule set lists no table")
    return RuleSet(salt, tables)


# Target topics and field rules of the analytics feed. The salt is a parameter of the installation.
ANALYTICS_SALT = "analytics-salt"
ANALYTICS_ROWS = [
    ("users", "analytics.users", "email", "hash"),
    ("users", "analytics.users", "phone", "hash"),
    ("users", "analytics.users", "full_name", "truncate"),
    ("users", "analytics.users", "birth_date", "drop"),
    ("orders", "analytics.orders", "notes", "drop"),
    ("events", "analytics.events", "ip_address", "drop"),
    ("events", "analytics.events", "user_agent", "drop"),
]
ANALYTICS_RULES = load_rules(ANALYTICS_SALT, ANALYTICS_ROWS)
