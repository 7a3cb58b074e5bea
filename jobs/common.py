"""What the jobs share: their configuration files and the log."""

from __future__ import annotations

import logging
import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The configuration that a job takes where none is named.
HERE = Path(__file__).parent


def configuration(name: str | None, default: str) -> dict:
    with open(name or HERE / default, "rb") as f:
        return tomllib.load(f)


def logger(name: str) -> logging.Logger:
    return logging.getLogger(f"jobs.{name}")


def show_log() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")


def table(spark: SparkSession, base: str, name: str, kind: str) -> DataFrame:
    return spark.read.format(kind).load(f"{base.rstrip('/')}/{name}")


def session(name: str) -> SparkSession:
    from jobloom.session import session as own

    return own(name)
