"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers that start from now on import this package from where the driver has it.

    (A cluster whose executors don't see that folder gets the package by
    --py-files or an environment archive instead; this does no harm then.)
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])
    return spark


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset (single-machine tests) a temporary
    folder is made, one for each application.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        app = spark.sparkContext.applicationId
        at = _OWN.setdefault(app, "") or tempfile.mkdtemp(prefix="roadloom-")
        _OWN[app] = at
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


SMALL_BYTES = 64 << 20


def is_small(df: DataFrame, most: int = SMALL_BYTES) -> bool:
    """Whether the optimizer knows that a plan's input has at most ``most`` bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most
