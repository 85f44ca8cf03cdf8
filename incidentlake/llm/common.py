"""Small helpers of the text operators: tables, worker code, checkpoints, column names."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()
#: How caches go that an operator keeps in a Python worker from one task to the next, by operator.
CACHES: dict[str, Callable[[], None]] = {}
Batch = TypeVar("Batch")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Kernels are module functions, so a worker imports them. ``addPyFile`` hands the
    archive out over Spark's own file server; no executor reads a driver's folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="llm-"), "incidentlake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def taken(batches: Iterator[Batch], owner: str = "") -> Iterator[Batch]:
    """The batches of a task, in a worker that other operators may have used before.

    Spark reuses Python workers from stage to stage, and what they hold counts beside the executor's heap: caches of other
    operators than ``owner`` go before the first batch, and freed memory goes back to the system there and behind the last.
    """
    for name, drop in CACHES.items():
        if name != owner:
            drop()
    _give_back()
    yield from batches
    _give_back()


def _give_back() -> None:
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def rename(df: DataFrame, **names: str) -> DataFrame:
    """Keep only the named input columns, under the operator's own names.

    Other columns of the input are not touched, so their names cannot clash.
    """
    return df.select(*[df[source].alias(target) for target, source in names.items()])


#: Rows of a single 64-bit key that are broadcast at most (a few dozen MB once hashed); beyond it the join is shuffled.
BROADCAST_KEYS = 1_000_000


def narrowed(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose 64-bit ``key`` is in ``keys``. The keys are counted first and broadcast only if they are few."""
    return df.join(checked(keys, key), key, "left_semi")


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose 64-bit ``key`` is not in ``keys``; as ``narrowed``."""
    return df.join(checked(keys, key), key, "left_anti")


def checked(keys: DataFrame, key: str) -> DataFrame:
    """The distinct keys, to be broadcast if they are few."""
    keys = cut(keys.select(key).distinct())
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
