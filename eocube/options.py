"""Engine options, kept in the session's configuration and validated."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

PREFIX = "spark.eocube."


@dataclass(frozen=True)
class Option:
    default: str
    allowed: tuple[str, ...]
    about: str


OPTIONS = {
    "groupby_date_engine": Option("spark", ("spark",), "what aggregates images of one date"),
    "disable_known_warning": Option("true", ("true", "false"), "hide warnings that need no action"),
    "zone_overlap": Option("last", ("last", "all"), "which zones own a pixel that several cover"),
}


def _check(name: str) -> Option:
    if name not in OPTIONS:
        raise KeyError(f"unknown option {name!r}; there are {sorted(OPTIONS)}")
    return OPTIONS[name]


def get_option(spark: SparkSession, name: str) -> str:
    return spark.conf.get(PREFIX + name, _check(name).default)


def set_option(spark: SparkSession, name: str, value: str | bool) -> None:
    option, text = _check(name), str(value).lower() if isinstance(value, bool) else str(value)
    if text not in option.allowed:
        raise ValueError(f"{name}={text!r}; allowed: {option.allowed}")
    spark.conf.set(PREFIX + name, text)


def reset_option(spark: SparkSession, name: str | None = None) -> None:
    for n in [name] if name else OPTIONS:
        _check(n)
        spark.conf.unset(PREFIX + n)


def describe_option(name: str) -> str:
    o = _check(name)
    return f"{name}: {o.about}; default {o.default}, allowed {', '.join(o.allowed)}"


def list_options(spark: SparkSession) -> dict[str, str]:
    return {n: get_option(spark, n) for n in OPTIONS}
