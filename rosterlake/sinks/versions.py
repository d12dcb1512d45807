"""Versioned tables: a log of versions, each of which names the data that it consists of.

A versioned table is a folder ``<name>.parquet`` with ``data/`` (folders that Spark wrote) and ``versions/`` (one small file per
version, ``000001.json`` and so on). A version names folders or single files, its own, those of earlier versions or of another
table beside it, so that a version can share data instead of copying it. Data is written first. The version's file is written
under another name and moved to its own only if that is free, so readers see a version whole or not at all, and of two writers
that go out from the same version one gets a ``Conflict``. That is as safe as the file system's move without overwriting:
atomic on HDFS.

A run that fails leaves data that no version names; ``vacuum`` removes it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMPRESSION = "zstd"


class Conflict(RuntimeError):
    """Another writer has made the version that this one was to be."""


class Version(NamedTuple):
    number: int
    #: Folders, folders of a period in one, and files, relative to the folder that the table is in.
    paths: tuple[str, ...]
    notes: Mapping[str, Any]


# --- small files on whatever file system Spark uses ----------------------------------------------------


def _path(spark: SparkSession, path: str):
    """File system and path, as Hadoop has them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, files.makeQualified(found)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    files, at = _path(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def read_small(spark: SparkSession, path: str) -> dict:
    files, at = _path(spark, path)
    stream = files.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, content: dict) -> None:
    """A small file that did not exist before; ``Conflict`` if it does."""
    folder, name = path.rsplit("/", 1)
    files, made = _path(spark, f"{folder}/_new/{uuid.uuid4().hex}")
    stream = files.create(made, False)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    target, context = _path(spark, path)[1], spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    mover = hadoop.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration())
    try:
        mover.rename(made, target, context._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as error:
        files.delete(made, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise Conflict(f"{path} exists already") from None
        raise


# --- versions ------------------------------------------------------------------------------------------


def _root(path: str) -> str:
    if not path.rstrip("/").endswith(".parquet"):
        raise ValueError(f"target must end with '.parquet', got {path}")
    return path.rstrip("/").rpartition("/")[0]


def _file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/versions/{number:06d}.json"


def version_of(spark: SparkSession, path: str, number: int) -> Version:
    content = read_small(spark, _file(path, number))
    return Version(number, tuple(content["paths"]), content["notes"])


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The last version; None for a table without one."""
    numbers = [int(n[:-5]) for n in names_in(spark, f"{path.rstrip('/')}/versions") if re.fullmatch(r"\d+\.json", n)]
    return version_of(spark, path, max(numbers)) if numbers else None


def read_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    root = _root(path)
    return spark.read.parquet(*(f"{root}/{p}" if root else p for p in version.paths))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    found = current_version(spark, path)
    if found is None:
        raise FileNotFoundError(f"no version of table {path}")
    return read_version(spark, path, found)


def commit(
    spark: SparkSession, path: str, paths: Iterable[str], base: Version | None, notes: Mapping[str, Any] | None = None
) -> Version:
    """The version after ``base`` that consists of ``paths``; ``Conflict`` if there is one."""
    _root(path)
    version = Version(base.number + 1 if base else 1, tuple(paths), dict(notes or {}))
    create_once(spark, _file(path, version.number), {"paths": version.paths, "notes": version.notes})
    return version


def write_data(df: DataFrame, path: str, base: Version | None, by: Sequence[str] = ()) -> str:
    """``df`` as a folder for the version after ``base``, with folders ``by`` columns in it, which no version names yet; its path in one."""
    name = f"{path.rstrip('/').rpartition('/')[2]}/data/v{base.number + 1 if base else 1:06d}-{uuid.uuid4().hex}"
    df.write.option("compression", COMPRESSION).partitionBy(*by).parquet(f"{_root(path)}/{name}")
    return name


_ANY = object()


def replace_table(df: DataFrame, path: str, *, base: Any = _ANY, notes: Mapping[str, Any] | None = None) -> int:
    """Make ``df`` the next version of the table, all or nothing; ``df`` may read the present version. ``base`` is the version
    that ``df`` was made from, if it is not the one that is current when this is called."""
    _root(path)
    spark = df.sparkSession
    base = current_version(spark, path) if base is _ANY else base
    return commit(spark, path, [write_data(df, path, base)], base, notes).number


def share_version(spark: SparkSession, source: str, version: Version, path: str, notes: Mapping[str, Any] | None = None) -> Version:
    """Make a version of the table ``source`` beside it the next version of ``path``, without copying any data."""
    if _root(source) != _root(path):
        raise ValueError(f"{source} and {path} are not in one folder")
    return commit(spark, path, version.paths, current_version(spark, path), notes)


#: A data file as a version names it: table, folder of a write, folder of a period if there is one, file.
FILE = r"[^/]+/data/[^/]+(/[^/]+=[^/]+)?/[^/]+$"


def relative_file(file: str) -> str:
    """A data file as a version names it."""
    return re.search(FILE, file)[0]


def files_of(spark: SparkSession, path: str, version: Version) -> list[str]:
    return sorted(map(relative_file, read_version(spark, path, version).inputFiles()))


def paths_of(version: Version, wanted: Iterable[str], files: Iterable[str]) -> tuple[str, ...]:
    """``wanted`` of the ``files`` of a version as few paths: a folder of the version where all its files are wanted."""
    wanted = set(wanted)
    parts = {f.rpartition("/")[0] for f in files if f not in wanted}
    whole = {p for p in version.paths if p not in parts} - wanted
    return tuple(sorted({f if (folder := f.rpartition("/")[0]) not in whole else folder for f in wanted}))


def remove_unnamed(spark: SparkSession, path: str, kept: Iterable[str]) -> list[str]:
    """Remove the data of a table that is not under one of the paths ``kept``; the folders and files removed. Not while a run
    writes the table or reads an older version."""
    kept = set(kept)
    name = path.rstrip("/").rpartition("/")[2]
    files, data = _path(spark, f"{path}/data")
    gone = []
    for folder in names_in(spark, f"{path}/data"):
        of_folder = f"{name}/data/{folder}"
        if of_folder in kept:
            continue
        single = {k for k in kept if k.startswith(f"{of_folder}/")}
        at = _path(spark, f"{path}/data/{folder}")[1]
        if not single:
            files.delete(at, True)
            gone.append(folder)
            continue
        for file in names_in(spark, f"{path}/data/{folder}"):
            if f"{of_folder}/{file}" not in single and not file.startswith((".", "_")):
                files.delete(_path(spark, f"{path}/data/{folder}/{file}")[1], True)
                gone.append(f"{folder}/{file}")
    return sorted(gone)
