"""Tables that change in one step: versioned folders, and one pointer that readers resolve.

A table at ``path`` keeps its rows in ``data/version=<name>/[part=<value>/]`` and its states in
``_commits/<number>.json``. The newest commit tells which version holds each partition, so a reader
sees one state whole: the data of the next one is written beside it and only counts once its commit
file has been renamed into place. A run that breaks off at any step leaves the last state readable,
and its folders go with the next ``vacuum``. Commits are numbered without gaps; of two writers that
start from the same state one fails. The manifest has one entry per partition value, which for
calendar partitions is bounded by the calendar.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.schemas import ddl

#: Partition value of a table without partitions, and of rows whose partition is null.
WHOLE, NULL = "", "__HIVE_DEFAULT_PARTITION__"


class CommitConflict(RuntimeError):
    """Another writer committed since the state was read."""


@dataclass(frozen=True)
class Commit:
    """A state: its number, the version of each partition, what each version holds, and notes."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    written: dict[str, list[str]] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


def files_of(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    files, at = files_of(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, at = files_of(spark, path)
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_once(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole, by a rename; fails if it is there already."""
    files, at = files_of(spark, path)
    _, draft = files_of(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if files.exists(at) or not files.rename(draft, at):
        files.delete(draft, False)
        raise CommitConflict(f"{path} is there already")


def remove(spark: SparkSession, path: str) -> None:
    files, at = files_of(spark, path)
    files.delete(at, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(x[:-5]) for x in listed(spark, f"{path}/_commits") if x.endswith(".json") and x[0] != "."]


def head(spark: SparkSession, path: str) -> Commit | None:
    """The newest state; None before the first commit."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    return Commit(**json.loads(read_text(spark, f"{path}/_commits/{max(numbers):08d}.json")))


def commit(spark: SparkSession, path: str, base: Commit | None, version: str | None, values: Sequence[str],
           gone: Iterable[str], notes: dict[str, str], more: dict[str, Sequence[str]] | None = None) -> Commit:
    """Put ``values`` of a written version in place of what ``base`` has for them, and drop ``gone``.

    ``more`` names further versions with their own values, put in place in the same step.
    """
    base = base or Commit()
    fresh = {k: v for v, held in {version: values, **(more or {})}.items() for k in held}
    parts = {k: v for k, v in base.parts.items() if k not in set(gone) | set(fresh)} | fresh
    written = {**base.written, **{v: sorted(held) for v, held in {version: values, **(more or {})}.items() if held}}
    state = Commit(base.number + 1, parts, {v: written[v] for v in sorted(set(parts.values()))},
                   {**base.notes, **notes})
    put_once(spark, f"{path}/_commits/{state.number:08d}.json", json.dumps(state.__dict__))
    return state


def write_version(df: DataFrame, path: str, part: str | None = None) -> tuple[str, list[str]]:
    """Write the rows as a new version that no state refers to yet; its name and partition values.

    ``df`` is arranged by the caller; executors write it, the driver lists the partitions.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/data/version={version}"
    writer = df.write.partitionBy(part) if part else df.write
    writer.parquet(folder)
    if part is None:
        return version, [WHOLE]
    return version, [x.partition("=")[2] for x in listed(spark, folder) if x.startswith(f"{part}=")]


def folders(state: Commit, path: str, part: str | None, only: Iterable[str] | None = None) -> list[str]:
    """Folders that hold a state: a version's own one if all it wrote still counts."""
    wanted = state.parts if only is None else {k: state.parts[k] for k in only if k in state.parts}
    by_version: dict[str, list[str]] = {}
    for value, version in wanted.items():
        by_version.setdefault(version, []).append(value)
    out = []
    for version, values in sorted(by_version.items()):
        top = f"{path}/data/version={version}"
        out += [top] if part is None or sorted(values) == state.written[version] else [
            f"{top}/{part}={value}" for value in sorted(values)]
    return out


def read(spark: SparkSession, path: str, schema: dict[str, str], part: str | None = None,
         part_type: str = "date", state: Commit | None = None, only: Iterable[str] | None = None) -> DataFrame | None:
    """The newest (or a given) state, or some partitions of it; None before the first commit.

    Only folders of the state are listed. ``part`` is a column of its own if ``schema`` lacks it.
    """
    state = state or head(spark, path)
    if state is None:
        return None
    columns = schema if part is None or part in schema else {**schema, part: part_type}
    found = folders(state, path, part, only)
    if not found:
        return spark.createDataFrame([], ddl(columns))
    rows = spark.read.schema(ddl(columns)).option("basePath", f"{path}/data").parquet(*found)
    return rows.select(*columns)


def replace(df: DataFrame, path: str, part: str | None = None, base: Commit | None = None,
            touched: Iterable[str] | None = None, notes: dict[str, str] | None = None) -> Commit:
    """Put ``df`` in place of the whole table, or of the ``touched`` partitions, in one step.

    Touched partitions without rows are empty from then on; ``df`` may be computed from the table.
    """
    spark = df.sparkSession
    base = base or head(spark, path)
    version, values = write_version(df, path, part)
    gone = (base.parts if base else {}) if touched is None else touched
    return commit(spark, path, base, version, values, gone, notes or {})


def vacuum(spark: SparkSession, path: str, keep: int = 3) -> None:
    """Remove folders that none of the newest ``keep`` states uses, and older commit files.

    Readers of those states are safe. A writer that has not committed yet is not: call it where
    no other run writes the table.
    """
    numbers = sorted(_numbers(spark, path))
    states = [Commit(**json.loads(read_text(spark, f"{path}/_commits/{n:08d}.json"))) for n in numbers[-keep:]]
    used = {f"version={v}" for s in states for v in s.parts.values()}
    for name in listed(spark, f"{path}/data"):
        if name.startswith("version=") and name not in used:
            remove(spark, f"{path}/data/{name}")
    for n in numbers[:-keep]:
        remove(spark, f"{path}/_commits/{n:08d}.json")


def part_text(value: object) -> str:
    """A partition value as folders name it."""
    return NULL if value is None else str(value)


def values_of(df: DataFrame, part: str) -> list[str]:
    """Partition values of some rows; bounded by the calendar or a number of shards."""
    return [part_text(r[0]) for r in df.select(F.col(part).cast("string")).distinct().collect()]
