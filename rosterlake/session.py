"""Session settings for local runs, tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

#: HotSpot does not compile methods beyond 8000 bytes. The wide projections of the cleansing steps can exceed that, and
#: uncompiled generated code takes twice as long as Spark's own fallback.
HUGE_METHOD = "8000"

#: What a task of a full run reads at most, from files or from a shuffle. Rows of text are ten to thirty times as large in memory as
#: they are packed, and aggregations over text sort them: tasks of Spark's default sizes spill them.
TASK_BYTES = "8m"
#: No more partitions than a shuffle writes without sorting by them.
LEAST_PARTITIONS = 200
#: Files that a task writes side by side; only rows of further periods are sorted by period first.
WRITERS = 64


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Settings under which sorts fit into the memory of a task and tables by period are written without a sort by period. What the
    session has set itself stays; all is as before afterwards."""
    settings = {
        "spark.sql.files.maxPartitionBytes": TASK_BYTES,
        "spark.sql.files.openCostInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.maxConcurrentOutputFileWriters": str(WRITERS),
    }
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < LEAST_PARTITIONS:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(LEAST_PARTITIONS)
    own = spark.conf.getAll
    changed = [name for name in settings if name not in own]
    for name in changed:
        spark.conf.set(name, settings[name])
    try:
        yield
    finally:
        for name in changed:
            spark.conf.unset(name)


def local_session(cores: int | str = "*", *, app: str = "rosterlake", **settings: str) -> SparkSession:
    """Local session. Further settings are given with ``__`` for dots: ``spark__sql__shuffle__partitions``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    session = builder.getOrCreate()
    own_checkpoint_folder(session)
    return session


def own_checkpoint_folder(spark: SparkSession) -> None:
    """A temporary checkpoint folder for a session on one machine that names none, as in tests; elsewhere an error."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rosterlake-"))


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a session, wherever the driver found it."""
    name = "rosterlake.zip"
    context = spark.sparkContext
    if any(str(f).endswith(f"/{name}") for f in context.listFiles):
        return
    package = Path(__file__).resolve().parent
    file = Path(tempfile.mkdtemp(prefix="rosterlake-")) / name
    with zipfile.ZipFile(file, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, Path(package.name) / source.relative_to(package))
    context.addPyFile(str(file))
