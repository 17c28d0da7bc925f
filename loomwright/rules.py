"""Quality rules: what a configuration may declare, as plain records."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from .functions.identifiers import normalise

TABLE_RULES = ("row_count_min", "row_count_between")
COLUMN_RULES = ("not_null", "unique", "allowed_values", "regex", "min_length", "max_length", "range")


@dataclass(frozen=True)
class Rule:
    """One check. ``columns`` is empty for a rule about the table as a whole and
    holds several names only for ``unique`` over a composite key."""

    kind: str
    columns: tuple[str, ...] = ()
    params: Mapping[str, Any] = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        return ",".join(self.columns) or None

    @property
    def params_json(self) -> str:
        return json.dumps(self.params, sort_keys=True, default=str)


def unique(*columns: str) -> Rule:
    return Rule("unique", tuple(normalise(c) for c in columns))


def column_rule(kind: str, column: str, **params: Any) -> Rule:
    return _checked(kind, (normalise(column),), params)


def table_rule(kind: str, **params: Any) -> Rule:
    return _checked(kind, (), params)


def _checked(kind: str, columns: tuple[str, ...], params: Mapping[str, Any]) -> Rule:
    """The rule with its parameters read and completed; a rule that could not be
    evaluated as meant is an error here, not a silent pass later."""
    known = COLUMN_RULES if columns else TABLE_RULES
    if kind not in known:
        raise ValueError(f"unknown rule {kind!r}; expected one of {', '.join(known)}")
    if kind == "row_count_min":
        params = {"min": int(params.get("min", 1))}
    elif kind in ("row_count_between", "range"):
        params = {k: params[k] for k in ("min", "max") if params.get(k) is not None}
        if not params:
            raise ValueError(f"rule {kind} needs min or max")
        if kind == "row_count_between":
            params = {k: int(v) for k, v in params.items()}
    elif kind == "allowed_values":
        values = list(params.get("values") or [])
        if None in values:
            raise ValueError("allowed_values may not hold null; nulls are never a violation")
        params = {"values": values}
    elif kind == "regex":
        params = {"pattern": str(params.get("pattern") or "")}
    elif kind == "min_length":
        params = {"min": int(params.get("min", 0))}
    elif kind == "max_length":
        if params.get("max") is None:
            raise ValueError("rule max_length needs max")
        params = {"max": int(params["max"])}
    else:
        params = {}
    return Rule(kind, columns, params)


# The parameter that carries the value of the short spelling.
_SHORT_PARAM = {
    "row_count_min": "min",
    "allowed_values": "values",
    "regex": "pattern",
    "min_length": "min",
    "max_length": "max",
}


def _short_spelling(block: Mapping[str, Any], columns: tuple[str, ...]) -> list[Rule]:
    """``{not_null: true, max_length: 5}``."""
    rules = []
    for kind, value in block.items():
        if kind in ("not_null", "unique"):
            if value:
                rules.append(_checked(kind, columns, {}))
        elif kind in ("row_count_between", "range"):
            rules.append(_checked(kind, columns, value))
        else:
            rules.append(_checked(kind, columns, {_SHORT_PARAM.get(kind, kind): value}))
    return rules


def _checks_spelling(checks: Sequence[Mapping[str, Any]] | None, columns: tuple[str, ...]) -> list[Rule]:
    """``checks: [{name: not_null}, {name: max_length, max: 5}]``; of a repeated name the last counts."""
    by_name = {c.get("name"): c for c in checks or []}
    return [_checked(name, columns, {k: v for k, v in c.items() if k != "name"}) for name, c in by_name.items()]


def parse_rules(quality: Mapping[str, Any] | None) -> tuple[Rule, ...]:
    """The rules of a ``quality`` block in either spelling. For the table the
    short spelling wins over ``checks``, for a column ``checks`` wins."""
    quality = quality or {}
    rules: list[Rule] = []

    table = dict(quality.get("table") or {})
    from_checks = {r.kind: r for r in _checks_spelling(table.pop("checks", None), ())}
    rules += {**from_checks, **{r.kind: r for r in _short_spelling(table, ())}}.values()

    for block in quality.get("columns") or []:
        if not block.get("name"):
            raise ValueError("a column entry of the quality block has no name")
        columns = (normalise(block["name"]),)
        if "checks" in block:
            rules += _checks_spelling(block["checks"], columns)
        else:
            rules += _short_spelling({k: v for k, v in block.items() if k not in ("name", "description")}, columns)
    # An empty pattern asks for nothing.
    rules = [r for r in rules if r.kind != "regex" or r.params["pattern"]]
    return tuple({(r.kind, r.columns): r for r in rules}.values())
