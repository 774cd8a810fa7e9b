"""Versions of a stored mart.

A load writes into folders of its own and commits last, by one small file that names for every
table the loads it is made of and the parts (sale dates, buckets) that each of them still holds. Readers
resolve all tables through the newest such file, so they see a load whole or not at all, and a load
that died leaves nothing but folders nobody reads. One writer at a time; a second one that commits
the same number fails.

The file grows with the number of dates and buckets, not with rows. The last `KEPT` versions stay
readable; what only older ones name is deleted after a commit, and so are the folders of dead loads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

FOLDER = "_versions"
KEPT = 2
WHOLE = ""  # the only part of a table that is not divided


class LoadConflict(RuntimeError):
    """Another load has committed meanwhile."""


@dataclass(frozen=True)
class Version:
    """`tables`: parts by load by table; `sizes`: parts a load wrote; `prints`: fingerprints by part by table."""

    number: int = 0
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    sizes: dict[str, dict[str, int]] = field(default_factory=dict)
    prints: dict[str, dict[str, str]] = field(default_factory=dict)

    def parts(self, table: str) -> dict[str, list[str]]:
        return self.tables.get(table, {})

    def is_whole(self, table: str, load: str) -> bool:
        """Whether all parts that the load wrote are still its own."""
        return len(self.parts(table)[load]) == self.sizes[table][load]

    def replacing(self, table: str, load: str, parts: Iterable[str], instead: Iterable[str]) -> Version:
        """With the parts that a load wrote, and without those in `instead` of earlier loads."""
        mine, gone = sorted(parts), {*instead, *parts}
        left = {name: [p for p in held if p not in gone] for name, held in self.parts(table).items()}
        left = {name: held for name, held in left.items() if held}
        sizes = {name: self.sizes[table][name] for name in left}
        if mine:
            left[load], sizes[load] = mine, len(mine)
        return Version(
            self.number, {**self.tables, table: left}, {**self.sizes, table: sizes}, self.prints
        )

    def adding(self, table: str, load: str, parts: Iterable[str]) -> Version:
        """With more rows of parts that other loads may hold, too."""
        mine = sorted(parts)
        if not mine:
            return self
        held = {**self.parts(table), load: mine}
        sizes = {**self.sizes.get(table, {}), load: len(mine)}
        return Version(self.number, {**self.tables, table: held}, {**self.sizes, table: sizes}, self.prints)

    def emptied(self, table: str) -> Version:
        return Version(self.number, {**self.tables, table: {}}, {**self.sizes, table: {}}, self.prints)

    def with_prints(self, table: str, prints: dict[str, str]) -> Version:
        return Version(self.number, self.tables, self.sizes, {**self.prints, table: prints})

    def next(self) -> Version:
        return Version(self.number + 1, self.tables, self.sizes, self.prints)

    def to_json(self) -> str:
        return json.dumps(vars(self), sort_keys=True)


def new_load(version: Version) -> str:
    """Folder name of a load on top of a version; unique, so a repeated load has its own."""
    return f"{version.number + 1:010d}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    fs, folder = _path(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def numbers(spark: SparkSession, root: str) -> list[int]:
    found = names(spark, f"{root}/{FOLDER}")
    return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith(("_", "."))]


def _file(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:010d}.json"


def read(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version by number, by default the newest; an empty one before the first commit."""
    if number is None:
        found = numbers(spark, root)
        if not found:
            return Version()
        number = found[-1]
    fs, path = _path(spark, _file(root, number))
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def commit(spark: SparkSession, root: str, version: Version) -> None:
    """Make a version the newest, in one step: the file is written aside and renamed."""
    target = _file(root, version.number)
    fs, path = _path(spark, target)
    if fs.exists(path):
        raise LoadConflict(f"version {version.number} of {root} exists already")
    _, aside = _path(spark, f"{root}/{FOLDER}/_{version.number}-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(version.to_json(), "utf-8"))
    finally:
        stream.close()
    if not fs.rename(aside, path):
        fs.delete(aside, False)
        raise LoadConflict(f"version {version.number} of {root} exists already")


def clean(spark: SparkSession, root: str, folders: dict[str, tuple[str, str]], kept: int = KEPT) -> None:
    """Delete what none of the newest versions names.

    `folders` gives each table's folder and the name of a part's folder in a load (`{}` for the part,
    empty if parts have none of their own).
    The file of an old version goes after what it names, so a clean-up that died is taken up again.
    """
    have = numbers(spark, root)
    current = [read(spark, root, n) for n in have[-kept:]]
    for number in have[:-kept]:
        old = read(spark, root, number)
        for table, (folder, inner) in folders.items():
            for load, parts in old.parts(table).items() if inner else ():
                live = {p for v in current for p in v.parts(table).get(load, ())}
                for part in set(parts) - live:
                    delete(spark, f"{root}/{folder}/load={load}/{inner.format(part)}")
        delete(spark, _file(root, number))
    for folder in {folder for folder, _ in folders.values()}:
        tables = [t for t, (f, _) in folders.items() if f == folder]
        live = {f"load={load}" for v in current for t in tables for load in v.parts(t)}
        for name in names(spark, f"{root}/{folder}"):
            if name.startswith("load=") and name not in live:
                delete(spark, f"{root}/{folder}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _path(spark, path)
    if fs.exists(folder):
        fs.delete(folder, True)


def part_names(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders that a write left."""
    return [n.split("=", 1)[1] for n in names(spark, path) if n.startswith(f"{column}=")]


def covers(parts: Collection[str], low: str, high: str) -> list[str]:
    """The parts from `low` to `high` in text order, which is that of dates."""
    return [p for p in parts if low <= p <= high]
