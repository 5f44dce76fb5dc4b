from __future__ import annotations

import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(work / "shared"),
        spark__sql__warehouse__dir=str(work / "warehouse"),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *names):
    """Rows as a sorted list of plain tuples, NULLs last."""
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, v) for v in t])


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = disk.getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def no_more_shuffle_files(spark, before):
    """Whether all shuffle files but those of ``before`` go, as they do in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False
