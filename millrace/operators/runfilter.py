"""Run filter strings, such as ``metrics.accuracy > 0.9 AND tags.team LIKE 'a%'``, as a Column.

A condition compares ``params.<name>``, ``metrics.<name>``, ``tags.<name>`` or ``attributes.<name>``
with a quoted text, a number or, for IN, a list. ``AND`` binds closer than ``OR``. Params and tags are
texts: against a number they are read as numbers, and a text that is none never fits. A missing
entry fits no condition.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_VALUE = r"""'(?:[^']|'')*'|"[^"]*"|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"""
_CONDITION = re.compile(
    rf"""\s*(?P<kind>params?|metrics?|tags?|attributes?)\.(?P<name>`[^`]+`|"[^"]+"|[\w.\-/]+)\s*
    (?:(?P<op>!=|<=|>=|=|<|>)\s*(?P<value>{_VALUE})|(?P<like>I?LIKE)\s+(?P<pattern>{_VALUE})|(?P<not>NOT\s+)?IN\s*\((?P<list>\s*(?:{_VALUE})(?:\s*,\s*(?:{_VALUE}))*\s*)\))\s*""",
    re.X | re.I,
)
_JOIN = re.compile(r"(AND|OR)\b", re.I)


def _literal(text: str) -> str | float:
    if text[0] == "'":
        return text[1:-1].replace("''", "'")
    return text[1:-1] if text[0] == '"' else float(text)


def _condition(found: re.Match) -> Column:
    kind, name = found["kind"].lower().rstrip("s"), found["name"].strip('`"')
    field = F.col(name) if kind == "attribute" else F.col(f"{kind}s")[name]
    if found["like"]:
        pattern = str(_literal(found["pattern"]))
        return field.ilike(pattern) if found["like"].upper() == "ILIKE" else field.like(pattern)
    if found["list"]:
        inside = field.isin(*[_literal(v) for v in re.findall(_VALUE, found["list"])])
        return ~inside if found["not"] else inside
    value = _literal(found["value"])
    number = kind == "metric" or isinstance(value, float)
    left = (field if kind == "metric" else field.cast("string").try_cast("double")) if number else field
    return _COMPARE[found["op"]](left, F.lit(float(value) if number else value))


def run_filter(text: str) -> Column:
    """The filter as a boolean Column over ``params``, ``metrics`` and ``tags`` maps and plain columns."""
    either: list[list[Column]] = [[]]
    at = 0
    while True:
        found = _CONDITION.match(text, at)
        if not found:
            raise ValueError(f"no condition at {text[at:]!r}")
        either[-1].append(F.coalesce(_condition(found), F.lit(False)))
        at = found.end()
        if at == len(text):
            return reduce(operator.or_, [reduce(operator.and_, both) for both in either])
        joined = _JOIN.match(text, at)
        if not joined:
            raise ValueError(f"AND or OR expected at {text[at:]!r}")
        if joined[1].upper() == "OR":
            either.append([])
        at = joined.end()
