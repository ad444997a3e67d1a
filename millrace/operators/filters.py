"""Predicates (FL1-FL18). Everything is a Column that Catalyst can push to the scan."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import QueryError
from millrace.functions.grains import moment, time_bucket
from millrace.functions.text import EMPTY_LABEL, NULL_LABEL
from millrace.functions.timetext import TimeText


@dataclass(frozen=True)
class Filter:
    """One condition of a query; ``col`` is a column name or SQL expression."""

    col: str
    op: str
    val: object = None
    grain: str | None = None


def generic_type(data_type: T.DataType) -> str:
    """NUMERIC, STRING, TEMPORAL or BOOLEAN; nested types count as STRING."""
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN"
    if isinstance(data_type, T.NumericType):
        return "NUMERIC"
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)
    return "TEMPORAL" if isinstance(data_type, temporal) else "STRING"


def request_values(values: Sequence[object], kind: str) -> list[object]:
    """FL8: values of a request as literals for a column of that kind; None where one cannot be read.

    Text is read as the column's kind by pandas; the labels that stand for null and for empty text are turned back
    except for numbers. Numbers given for times are milliseconds since 1970, for truth values zero is false.
    """
    labels = {} if kind == "NUMERIC" else {NULL_LABEL: None, EMPTY_LABEL: ""}
    cells = [v.strip("\t\n") if isinstance(v, str) else v for v in values]
    cells = [labels.get(v, v) if isinstance(v, str) else v for v in cells]
    if kind == "NUMERIC":
        read = [pd.to_numeric(v, errors="coerce") if isinstance(v, str) else v for v in cells]
        read = [v.item() if hasattr(v, "item") else v for v in read]
        return [None if v is None or v != v else v for v in read]
    numbers = [isinstance(v, (int, float)) and not isinstance(v, bool) for v in cells]
    if kind == "TEMPORAL":
        return [pd.Timestamp(v, unit="ms").to_pydatetime() if n else v for v, n in zip(cells, numbers)]
    if kind == "BOOLEAN":
        return [v != 0 if n else v.strip().lower() == "true" if isinstance(v, str) else v for v, n in zip(cells, numbers)]
    return cells


def _literal(value: object) -> Column:
    return moment(value) if isinstance(value, datetime) else F.lit(value)


def between_times(col: Column, since: datetime | None, until: datetime | None) -> Column:
    """FL7: ``[since, until)``; an open side adds nothing."""
    parts = []
    if since is not None:
        parts.append(col >= _literal(since))
    if until is not None:
        parts.append(col < _literal(until))
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


# FL1: comparisons that need a value.
_COMPARE = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
}


def predicate(df: DataFrame, condition: Filter, clock: TimeText | None = None) -> Column:
    """The Column of one filter (FL1-FL9, FL18)."""
    op = condition.op.upper()
    target = F.expr(condition.col) if condition.col not in df.columns else F.col(condition.col)
    kind = generic_type(df.select(target).schema[0].dataType)
    if condition.grain:
        target = time_bucket(target, condition.grain)  # FL9: the bucket is compared
        kind = "TEMPORAL"
    if op == "IS NULL":
        return target.isNull()
    if op == "IS NOT NULL":
        return target.isNotNull()
    if op in ("IS TRUE", "IS FALSE"):
        return target.eqNullSafe(F.lit(op == "IS TRUE"))
    if op == "TEMPORAL_RANGE":
        if isinstance(condition.val, str):
            if clock is None:
                raise QueryError("a time range in words needs a clock")
            return between_times(target, *clock.time_range(condition.val))
        return between_times(target, *condition.val)
    given = condition.val if isinstance(condition.val, (list, tuple)) else [condition.val]
    values = request_values(given, kind)
    value = values[0] if values else None
    if op in ("IN", "NOT IN"):
        if not values:
            raise QueryError("IN needs at least one value")
        known = [v for v in values if v is not None]
        inside = target.isin(*[_literal(v) for v in known]) if known else F.lit(False)
        if len(known) < len(values):
            inside = inside | target.isNull()
        return ~inside if op == "NOT IN" else inside
    if op in _COMPARE:
        if value is None:
            raise QueryError(f"{op} needs a value")
        return _COMPARE[op](target, _literal(value))
    if op == "LIKE":
        return target.like(value)
    if op == "ILIKE":
        return target.ilike(value)
    if op == "REGEX":
        return target.rlike(value)
    raise QueryError(f"unknown filter operator: {condition.op}")


def apply_filters(df: DataFrame, conditions: Sequence[Filter], clock: TimeText | None = None) -> DataFrame:
    for condition in conditions:
        df = df.where(predicate(df, condition, clock))
    return df


def free_clause(df: DataFrame, clause: str | None) -> DataFrame:
    """FL10: an SQL condition over the frame's own columns; sub-queries are refused.

    The condition is parsed, not searched: whatever its spelling, an expression that holds a query is found.
    """
    if not clause:
        return df
    parser = df.sparkSession._jsparkSession.sessionState().sqlParser()
    waiting = [parser.parseExpression(f"({clause})")]
    while waiting:
        node = waiting.pop()
        if re.search("Subquery|Exists$|ListQuery", node.getClass().getSimpleName()):
            raise QueryError("sub-queries are not allowed in a free condition")
        inner = node.children()
        waiting += [inner.apply(i) for i in range(inner.size())]
    return df.where(F.expr(f"({clause})"))


@dataclass(frozen=True)
class RowRule:
    """FL11: an SQL clause for some roles; rules sharing a ``group`` are alternatives."""

    clause: str
    roles: frozenset[str]
    group: str | None = None
    regular: bool = True  # False: the rule binds everybody *except* the listed roles


def row_predicate(rules: Sequence[RowRule], role: str) -> Column | None:
    bound = [r for r in rules if (role in r.roles) == r.regular]
    grouped: dict[str, list[Column]] = {}
    parts = []
    for rule in bound:
        clause = F.expr(f"({rule.clause})")
        if rule.group is None:
            parts.append(clause)
        else:
            grouped.setdefault(rule.group, []).append(clause)
    parts += [reduce(lambda a, b: a | b, options) for options in grouped.values()]
    return reduce(lambda a, b: a & b, parts) if parts else None


def with_row_predicates(df: DataFrame, rules: Sequence[RowRule], role: str) -> DataFrame:
    """FL11: applied right at the scan, so it is pushed down with the other filters."""
    condition = row_predicate(rules, role)
    return df if condition is None else df.where(condition)


def secured_views(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[RowRule]], role: str, prefix: str = ""
) -> None:
    """FL12: publish each table under its name with its rules already applied."""
    for name, df in tables.items():
        with_row_predicates(df, rules.get(name, ()), role).createOrReplaceTempView(prefix + name)


def latest_partition(df: DataFrame, part_cols: Sequence[str], **fixed: object) -> DataFrame:
    """FL13: rows of the newest partition; all but one partition column fixed by equality.

    With no ``fixed`` the newest combination of all the columns is taken. The newest value is
    found by one aggregate over partition columns only, then used as a pruning literal.
    """
    unknown = set(fixed) - set(part_cols)
    if unknown:
        raise QueryError(f"not partition columns: {sorted(unknown)}")
    free = [c for c in part_cols if c not in fixed]
    if fixed and len(free) != 1:
        raise QueryError("fix all partition columns but one")
    for name, value in fixed.items():
        df = df.where(F.col(name) == F.lit(value))
    newest = df.where(F.col(free[0]).isNotNull()).agg(F.max(F.struct(*free)).alias("m")).first()["m"]
    if newest is None:
        return df.limit(0)
    for name in free:
        df = df.where(F.col(name).eqNullSafe(_literal(newest[name])))
    return df


def network_range(text: str | int) -> tuple[int, int]:
    """First and last address of an IPv4 address, CIDR block or integer."""
    network = ipaddress.ip_network(int(text) if str(text).isdigit() else str(text), strict=False)
    return int(network.network_address), int(network.broadcast_address)


def filter_ip(df: DataFrame, col: str, op: str, networks: Sequence[str | int]) -> DataFrame:
    """FL14: integer addresses against networks parsed on the driver.

    NOT IN keeps addresses outside every range.
    """
    try:
        ranges = [network_range(n) for n in networks]
    except ValueError as problem:
        raise QueryError(str(problem)) from problem
    target = F.col(col)
    if op in ("IN", "NOT IN"):
        if not ranges:
            raise QueryError("IN needs at least one value")
        inside = reduce(lambda a, b: a | b, [target.between(lo, hi) for lo, hi in ranges])
        return df.where(inside if op == "IN" else ~inside)
    if len(ranges) != 1:
        raise QueryError(f"{op} takes one network")
    low, high = ranges[0]
    tests = {
        "==": target.between(low, high),
        "!=": ~target.between(low, high),
        ">": target > high,
        ">=": target >= low,
        "<": target < low,
        "<=": target <= high,
    }
    if op not in tests:
        raise QueryError(f"unknown address operator: {op}")
    return df.where(tests[op])


# Service names and their ports.
SERVICE_PORTS = {
    "http": [80],
    "ssh": [22],
    "https": [443],
    "ftp": [20, 21],
    "ftps": [989, 990],
    "telnet": [23],
    "telnets": [992],
    "smtp": [25],
    "submissions": [465],
    "kerberos": [88],
    "kerberos-adm": [749],
    "pop3": [110],
    "pop3s": [995],
    "nntp": [119],
    "nntps": [563],
    "ntp": [123],
    "snmp": [161],
    "ldap": [389],
    "ldaps": [636],
    "imap2": [143],
    "imaps": [993],
}


def ports_of(value: str | int) -> list[int]:
    text = str(value)
    if text.isnumeric():
        if not 1 <= int(text) <= 65535:
            raise QueryError(f"port out of range: {text}")
        return [int(text)]
    if text not in SERVICE_PORTS:
        raise QueryError(f"unknown service: {text}")
    return sorted(SERVICE_PORTS[text])


def filter_port(df: DataFrame, col: str, op: str, ports: Sequence[str | int]) -> DataFrame:
    """FL15: port numbers against service names or numbers."""
    listed = [ports_of(p) for p in ports]
    target = F.col(col)
    if op in ("IN", "NOT IN"):
        inside = target.isin([p for group in listed for p in group])
        return df.where(inside if op == "IN" else ~inside)
    if len(listed) != 1:
        raise QueryError(f"{op} takes one port")
    group = listed[0]
    tests = {
        "==": target.isin(group),
        "!=": ~target.isin(group),
        ">": target > group[0],
        ">=": target >= group[0],
        "<": target < group[-1],
        "<=": target <= group[-1],
    }
    if op not in tests:
        raise QueryError(f"unknown port operator: {op}")
    return df.where(tests[op])


def drop_null_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FL16."""
    return df.dropna(subset=list(cols))


def grain_filter(df: DataFrame, col: str, grain: str, op: str, value: datetime) -> DataFrame:
    """FL9 as a stand-alone operator."""
    return df.where(predicate(df, Filter(col, op, value, grain)))


