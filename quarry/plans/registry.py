"""Where queries over the given tables are registered, each beside SQL that gives the same rows."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the session's cluster, once, whatever their search path is.

    Workers that never unpickle a function of the package do not load it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="quarry-code-")  # read by the driver's file server alone
    path = os.path.join(folder, "quarry.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for base, names, files in os.walk(os.path.join(root, "quarry")):
            names[:] = [n for n in names if n != "__pycache__"]
            for f in files:
                out.write(os.path.join(base, f), os.path.relpath(os.path.join(base, f), root))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def shipped(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The function, run after ``ship``."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    return run


class Tables:
    """Tables of a folder as attributes: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of Tables under its name, with the SQL if it can be said in SQL."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[function.__name__] = shipped(lambda spark, folder: function(Tables(spark, folder)))
        if sql:
            SQL[function.__name__] = sql
        return function

    return register
