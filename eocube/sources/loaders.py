"""Pixel sources: a registry of loaders, each giving a wide pixel table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..errors import DatacubeCreationError

Loader = Callable[..., DataFrame]
_loaders: dict[str, Loader] = {}


def register_engine_loader(engine: str, loader: Loader) -> None:
    if not callable(loader):
        raise TypeError("a loader is a function that returns a pixel table")
    _loaders[engine] = loader


def unregister_engine_loader(engine: str) -> None:
    if engine not in _loaders:
        raise KeyError(f"no loader {engine!r}")
    del _loaders[engine]


def load(spark: SparkSession, engine: str, *args, **options) -> DataFrame:
    if engine not in _loaders:
        raise DatacubeCreationError(f"no loader {engine!r}; there are {sorted(_loaders)}")
    return _loaders[engine](spark, *args, **options)


def _parquet(spark: SparkSession, path: str, bands: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select("time", "y", "x", *bands) if bands else df


def _csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    return spark.read.schema(schema).options(header=True, **options).csv(path)


for _name in ("parquet", "csv"):
    register_engine_loader(_name, globals()[f"_{_name}"])
