"""Search predicates as columns: time ranges, STAC queries, CQL2-JSON, post queries."""

from __future__ import annotations

import calendar
import re
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTIAL = re.compile(r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?$")


def parse_time(text: str | datetime, end: bool = False) -> datetime:
    """UTC without zone; a year, month or day alone is its beginning or, with ``end``, its last microsecond."""
    if isinstance(text, datetime):
        t = text
    elif m := _PARTIAL.match(text.strip()):
        y, mo, d = int(m[1]), m[2] and int(m[2]), m[3] and int(m[3])
        if not end:
            return datetime(y, mo or 1, d or 1)
        last = d or calendar.monthrange(y, mo or 12)[1]
        return datetime(y, mo or 12, last, 23, 59, 59, 999999)
    else:
        t = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    return t.astimezone(timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def parse_range(value) -> tuple[datetime | None, datetime | None]:
    """An instant, ``"a/b"`` or a pair; ``..``, empty and None are open ends."""
    if isinstance(value, str) and "/" in value:
        value = tuple(value.split("/", 1))
    if isinstance(value, (str, datetime)):
        return parse_time(value), parse_time(value, end=True)
    lo, hi = value
    return (None if lo in (None, "", "..") else parse_time(lo)), (None if hi in (None, "", "..") else parse_time(hi, end=True))


def in_range(time: Column, value) -> Column:
    lo, hi = parse_range(value)
    out = time.isNotNull()
    if lo is not None:
        out = out & (time >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        out = out & (time <= F.lit(hi).cast("timestamp_ntz"))
    return out


def split_range(value, days: int | str | None = "auto") -> list[tuple[datetime, datetime]]:
    """The range in chunks of ``days``, the newest first; each begins a microsecond after the one before it ends.

    ``auto`` makes about ten. Date-only ends count whole, so the last day isn't cut off.
    """
    lo, hi = parse_range(value)
    if lo is None or hi is None:
        raise ValueError("an open range can't be split")
    if hi < lo:
        raise ValueError("the range ends before it begins")
    span = (hi - lo).days + 1 if hi.time() != lo.time() else (hi - lo).days
    if days == "auto":
        days = max(1, span // 10)
    if days is None or not isinstance(days, int) or days <= 0:
        raise ValueError(f"days per chunk must be positive, not {days!r}")
    out, begin = [], lo
    while begin <= hi:
        stop = min(begin + timedelta(days=days) - timedelta(microseconds=1), hi)
        out.append((begin, stop))
        begin = stop + timedelta(microseconds=1)
    return out[::-1]


def property_of(df: DataFrame, name: str, sample=None) -> Column:
    """A column of that name, else a member of ``properties``: of its JSON text, or of a VARIANT, which is typed like ``sample``."""
    plain = name.removeprefix("properties.")
    if plain in df.columns:
        return df[plain]
    if "properties" in df.columns:
        if dict(df.dtypes)["properties"] == "variant":
            return F.try_variant_get("properties", f"$['{plain}']", _kind(sample))
        return F.get_json_object("properties", f"$['{plain}']")
    raise ValueError(f"no property {name!r}")


def _kind(value) -> str:
    sample = value[0] if isinstance(value, (list, tuple)) and value else value
    return "boolean" if isinstance(sample, bool) else "double" if isinstance(sample, (int, float)) else "string"


def _typed(c: Column, value) -> Column:
    kind = _kind(value)
    return c if kind == "string" else c.cast(kind)


#: Operators of the public STAC Query extension.
_QUERY = {
    "eq": lambda c, v: c == v,
    "neq": lambda c, v: c != v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "startsWith": lambda c, v: c.startswith(v),
    "endsWith": lambda c, v: c.endswith(v),
    "contains": lambda c, v: c.contains(v),
}


def stac_query(df: DataFrame, query: dict) -> Column:
    """``{"eo:cloud_cover": {"lt": 20}}``; a plain value means equality. All must hold; a missing property fails."""
    parts = [F.lit(True)]
    for name, ops in query.items():
        for op, value in (ops if isinstance(ops, dict) else {"eq": ops}).items():
            if op not in _QUERY:
                raise ValueError(f"unknown query operator {op!r}")
            parts.append(F.coalesce(_QUERY[op](_typed(property_of(df, name, value), value), value), F.lit(False)))
    return reduce(lambda a, b: a & b, parts)


_POST = {
    "lt": lambda c, v: c < v,
    "le": lambda c, v: c <= v,
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "ge": lambda c, v: c >= v,
    "gt": lambda c, v: c > v,
    "contains": lambda c, v: c.contains(v),
    "in": lambda c, v: c == v,
}


def post_query(df: DataFrame, query: dict[str, dict]) -> Column:
    """All properties and operators must hold; a list of values means any of them."""
    parts = [F.lit(True)]
    for name, ops in query.items():
        for op, values in ops.items():
            if op not in _POST:
                raise ValueError(f"unknown operator {op!r}")
            options = list(values) if isinstance(values, (list, tuple, set)) else [values]
            any_of = [F.coalesce(_POST[op](_typed(property_of(df, name, v), v), v), F.lit(False)) for v in options]
            parts.append(reduce(lambda a, b: a | b, any_of, F.lit(False)))
    return reduce(lambda a, b: a & b, parts)


def cql2(df: DataFrame, node) -> Column:
    """CQL2-JSON: and, or, not, comparisons, between, in, like, isNull, and s_/t_ intersects on boxes and ranges."""
    if not isinstance(node, dict):
        return F.lit(node)
    if "property" in node:
        name = node["property"]
        return df["datetime"] if name == "datetime" and "datetime" in df.columns else property_of(df, name)
    for kind in ("timestamp", "date"):
        if kind in node:
            return F.lit(parse_time(node[kind])).cast("timestamp_ntz")
    op, args = node["op"], node.get("args", [])
    if op in ("and", "or"):
        return reduce((lambda a, b: a & b) if op == "and" else (lambda a, b: a | b), [cql2(df, a) for a in args])
    if op == "not":
        return ~cql2(df, args[0])
    if op == "isNull":
        return cql2(df, args[0]).isNull()
    if op == "between":
        lo, hi = args[1:] if len(args) == 3 else args[1]
        c = _typed(cql2(df, args[0]), lo)
        return c.between(cql2(df, lo), cql2(df, hi))
    if op == "in":
        return _typed(cql2(df, args[0]), args[1]).isin(list(args[1]))
    if op == "like":
        return cql2(df, args[0]).like(args[1])
    if op == "s_intersects":
        from .geometry import boxes_meet, parse, total_bounds

        return boxes_meet(df["bbox"], total_bounds(parse(args[1])))
    if op == "t_intersects":
        return in_range(cql2(df, args[0]), tuple(args[1]["interval"]) if isinstance(args[1], dict) and "interval" in args[1] else args[1])
    compare = {"=": "eq", "<>": "neq", "<": "lt", "<=": "lte", ">": "gt", ">=": "gte"}
    if op in compare:
        left = cql2(df, args[0])
        right = args[1]
        if isinstance(right, dict):
            return _QUERY[compare[op]](left, cql2(df, right))
        return _QUERY[compare[op]](_typed(left, right), right)
    raise ValueError(f"unknown CQL2 operator {op!r}")


def sort_keys(df: DataFrame, sortby) -> list[Column]:
    """``"-a,b"``, a list of such names, or of ``{"field", "direction"}``; ties end with the id."""
    names = sortby.split(",") if isinstance(sortby, str) else sortby
    out = []
    for n in names:
        field, down = (n["field"], n.get("direction", "asc") == "desc") if isinstance(n, dict) else (n.strip().lstrip("+-"), n.strip().startswith("-"))
        c = property_of(df, field)
        out.append(c.desc_nulls_last() if down else c.asc_nulls_last())
    return out + ([df["id"].asc()] if "id" in df.columns else [])
