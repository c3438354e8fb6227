"""Run search by filter text.

A filter is a list of comparisons joined by ``AND``:

    status = 'FINISHED' AND metrics.auc > 0.7 AND tags."my key" LIKE 'a%'

The left side is a column of the run table (bare or after ``attributes.``) or an entry of
its ``metrics``, ``params`` or ``tags`` map; a key goes on to the comparator and may hold dots,
or stands in quotes or backticks.  Comparators: ``= != < <= > >= LIKE ILIKE IN (...)
NOT IN (...) IS NULL``, ``IS NOT NULL``.  Numeric sides (metrics, times) take numbers, all
others quoted text.  The text becomes one Column, so Spark optimises it like any other
filter: comparisons of scalar columns reach the Parquet scan.

A missing key or NULL makes a comparison NULL, and the run is not returned, whatever the
comparator but ``IS NULL``; a NaN metric counts as missing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

MAPS = {"metrics": "metrics", "metric": "metrics", "params": "params", "param": "params", "tags": "tags", "tag": "tags"}
ATTRIBUTES = ("attributes", "attribute", "attr", "run")

_QUOTED = r"""'(?:[^']|'')*'|"(?:[^"]|"")*\""""
_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_KEY = rf"`(?:[^`]|``)+`|{_QUOTED}|[\w./-]+"
_SIDE = re.compile(rf"\s*(?:(?P<of>\w+)\s*\.\s*)?(?P<key>{_KEY})")
_COMPARE = re.compile(r"\s*(?P<op>!=|<>|<=|>=|=|<|>|(?:NOT\s+)?I?LIKE\b|(?:NOT\s+)?IN\b|IS\s+(?:NOT\s+)?NULL\b)", re.I)
_VALUE = re.compile(rf"\s*(?:(?P<text>{_QUOTED})|(?P<number>{_NUMBER})(?![\w.]))")
_AND = re.compile(r"\s+AND(?=\s)", re.I)
_ORDER = re.compile(r"\s+(?P<way>ASC|DESC)\s*$", re.I)


class FilterError(ValueError):
    """A filter text that can't be read; ``position`` is the 0-based place of the fault."""

    def __init__(self, what: str, text: str, position: int):
        super().__init__(f"{what} at position {position}: {text[position : position + 30]!r}")
        self.position = position


def _unquoted(token: str) -> str:
    if token[0] in "'\"`":
        return token[1:-1].replace(token[0] * 2, token[0])
    return token


class _Reader:
    """Reads a text from left to right against the columns of ``schema``."""

    def __init__(self, text: str, schema: StructType):
        self.text, self.schema, self.at = text, schema, 0

    def fail(self, what: str, at: int | None = None) -> FilterError:
        at = self.at if at is None else at
        return FilterError(what, self.text, at + len(self.text[at:]) - len(self.text[at:].lstrip()))

    def take(self, pattern: re.Pattern, what: str) -> re.Match:
        m = pattern.match(self.text, self.at)
        if m is None:
            raise self.fail(f"expected {what}")
        self.at = m.end()
        return m

    def side(self) -> tuple[Column, bool]:
        """The left side, and whether it is numeric."""
        start = self.at
        m = self.take(_SIDE, "a column, metrics., params. or tags. and a key")
        of, key = m["of"], m["key"]
        if of is None and key[0] not in "'\"`" and "." in key:
            of, _, key = key.partition(".")
        if of is not None and of.lower() in MAPS and key:
            name = MAPS[of.lower()]
            if name not in self.schema.names:
                raise self.fail(f"no {name} here", start)
            value = F.try_element_at(F.col(name), F.lit(_unquoted(key)))
            return (F.nanvl(value, F.lit(None)), True) if name == "metrics" else (value, False)
        if of is not None and of.lower() not in ATTRIBUTES:
            raise self.fail(f"unknown group {of!r}", start)
        name = _unquoted(key) if key else ""
        if name not in self.schema.names or self.schema[name].dataType.simpleString().startswith(("map", "array", "struct")):
            raise self.fail(f"unknown column {name!r}", start)
        return F.col(f"`{name}`"), isinstance(self.schema[name].dataType, NumericType)

    def value(self, numeric: bool) -> Column:
        start = self.at
        m = self.take(_VALUE, "a number" if numeric else "a quoted text")
        if numeric != (m["number"] is not None):
            raise self.fail("expected a number" if numeric else "expected a quoted text", start)
        if not numeric:
            return F.lit(_unquoted(m["text"]))
        whole = re.fullmatch(r"[+-]?\d{1,18}", m["number"])
        return F.lit(int(m["number"]) if whole else float(m["number"]))

    def comparison(self) -> Column:
        left, numeric = self.side()
        start = self.at
        op = " ".join(self.take(_COMPARE, "a comparator")["op"].upper().split())
        if op in ("IS NULL", "IS NOT NULL"):
            return left.isNull() if op == "IS NULL" else left.isNotNull()
        if op.endswith("IN"):
            self.take(re.compile(r"\s*\("), "'('")
            values = [self.value(numeric)]
            while not (m := self.take(re.compile(r"\s*([,)])"), "',' or ')'"))[1] == ")":
                values.append(self.value(numeric))
            return ~left.isin(*values) if op.startswith("NOT") else left.isin(*values)
        if op.endswith("LIKE"):
            if numeric:
                raise self.fail(f"{op} needs a text column", start)
            pattern = self.value(False)
            found = F.ilike(left, pattern) if op.endswith("ILIKE") else F.like(left, pattern)
            return ~found if op.startswith("NOT") else found
        right = self.value(numeric)
        return {"=": left == right, "!=": left != right, "<>": left != right, "<": left < right,
                "<=": left <= right, ">": left > right, ">=": left >= right}[op]


def run_filter(text: str | None, schema: StructType) -> Column:
    """The condition of a filter text; an empty one holds for every run.  Raises :class:`FilterError`."""
    if not (text or "").strip():
        return F.lit(True)
    reader = _Reader(text, schema)
    cond = reader.comparison()
    while text[reader.at :].strip():
        reader.take(_AND, "AND or the end")
        cond = cond & reader.comparison()
    return cond


def run_order(text: str, schema: StructType) -> Column:
    """One ordering: a left side of a filter, ``ASC`` (default) or ``DESC``; NULLs last."""
    m = _ORDER.search(text)
    reader = _Reader(text[: m.start()] if m else text, schema)
    side, _ = reader.side()
    if reader.text[reader.at :].strip():
        raise reader.fail("expected ASC, DESC or the end")
    return side.desc_nulls_last() if m and m["way"].upper() == "DESC" else side.asc_nulls_last()


def search(runs: DataFrame, filter_text: str | None = None, order_by: list[str] | None = None, max_results: int | None = None) -> DataFrame:
    """Runs that fulfil the filter text, in the order of ``order_by`` texts, then latest start
    and run id; ``max_results`` of them, if given."""
    order = [run_order(o, runs.schema) for o in order_by or []]
    out = runs.where(run_filter(filter_text, runs.schema)).orderBy(*order, F.desc_nulls_last("start_time"), F.asc("run_id"))
    return out if max_results is None else out.limit(max_results)
