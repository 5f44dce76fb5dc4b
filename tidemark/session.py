"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

# Independent jobs submitted at a time; one's last tasks overlap another's first.
JOBS_AT_ONCE = 4

# Settings every job of this package is designed around. Shuffle width is left
# to the cluster: AQE coalesces down from whatever the session starts with.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}

# Tasks that list the files of a read with many folders.
LISTING_TASKS = 16

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_fallback_dirs: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with :data:`DEFAULTS`; keyword arguments (dots as ``__``) win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder, which goes with
    the process; a cluster session without it is an error, since a machine-local path
    would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _fallback_dirs.get(sc.applicationId)
        if root is None:
            root = _fallback_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
    return os.path.join(root, "tidemark", spark.sparkContext.applicationId, *parts)


def run_together(
    spark: SparkSession, jobs: Iterable[Callable[[], Result]], at_once: int = JOBS_AT_ONCE
) -> list[Result]:
    """Results of independent driver steps, in order; the first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        steps = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [step.result() for step in steps]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Here the shuffle files of a query go when it ends.

    Spark else keeps them until the driver collects its garbage, so a job of many steps
    may need disk for the shuffles of all of them. For steps that are stored and read
    again: a frame that runs a second time shuffles a second time.
    """
    with _setting(spark, _DROP_SHUFFLES, "true", "false"):
        yield


@contextmanager
def listed_by_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Here the files of many folders are listed by LISTING_TASKS tasks, each taking its
    share of the folders, and not by a task per folder."""
    with _setting(spark, _LISTING, str(LISTING_TASKS), "10000"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
