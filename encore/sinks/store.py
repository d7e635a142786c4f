"""The tables as parquet under one root folder, changed all at once or not at all.

A table is a list of folders, one for each insert. Which folders those are stands in a
manifest; a change writes new folders first and then one new manifest, so readers see the old
tables until the last step, and a job that fails leaves them as they were. Manifests are
numbered and each is created once: of two changes at the same time the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from encore.schemas import PLAYS_BY_MONTH, TABLES, Table
from encore.scratch import discard

STORED = {**TABLES, PLAYS_BY_MONTH.name: PLAYS_BY_MONTH}


def by_name(df: DataFrame, table: Table) -> DataFrame:
    """The columns of ``table`` picked from ``df`` by name, in target order."""
    return df.select(*table.names)


def by_position(df: DataFrame, table: Table) -> DataFrame:
    """The columns of ``df`` taken in order, under the names of ``table``."""
    if len(df.columns) != len(table.columns):
        raise ValueError(f"{table.name} has {len(table.columns)} columns, got {len(df.columns)}")
    return df.toDF(*table.names)


class Manifests:
    """Numbered small JSON files in one folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._folder = self._path(folder)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._folder)]
        return sorted((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), reverse=True)

    def last(self) -> tuple[int, dict]:
        """Number and content of the newest whole one; a writer that died may have left part of one."""
        numbers = self._numbers()
        for number in numbers:
            stream = self._files.open(self._path(self._folder, f"{number:012d}.json"))
            try:
                return numbers[0], json.loads(self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except json.JSONDecodeError:
                continue
            finally:
                stream.close()
        return (numbers[0] if numbers else 0), {}

    def add(self, number: int, content: dict) -> None:
        """Fails if there is one of that number."""
        stream = self._files.create(self._path(self._folder, f"{number:012d}.json"), False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()


class TableStore:
    """Reads and writes the declared tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._manifests = Manifests(spark, f"{self.root}/_manifests")
        self._open: dict | None = None  # what a change has made so far

    def _state(self) -> dict:
        if self._open is not None:
            return self._open
        return {"tables": {}, "notes": {}} | self._manifests.last()[1]

    @contextmanager
    def change(self) -> Iterator[None]:
        """All writes inside become visible together at the end, or none if one fails.

        Reads inside see them. A change inside a change is part of it.
        """
        if self._open is not None:
            yield
            return
        number, _ = self._manifests.last()
        self._open = self._state()
        before = {f for folders in self._open["tables"].values() for f in folders}
        try:
            yield
            self._manifests.add(number + 1, self._open)
        except BaseException:
            made = {f for folders in self._open["tables"].values() for f in folders} - before
            for folder in made:
                discard(self.spark, f"{self.root}/{folder}")
            raise
        finally:
            self._open = None

    def parts(self, name: str) -> list[str]:
        """The folders of a table below ``root``, in the order of their inserts."""
        return list(self._state()["tables"].get(STORED[name].name, []))

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The stored rows, or those of some inserts, with the declared schema instead of one from file footers."""
        folders = self.parts(name) if parts is None else list(parts)
        schema = STORED[name].schema
        if not folders:
            if parts is None and name not in self._state()["tables"]:
                raise ValueError(f"{self.root} has no table {name}")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def create_views(self) -> None:
        """Make the tables known to ``spark.sql`` under their own names."""
        for name in TABLES:
            self.read(name).createOrReplaceTempView(name)

    def append(self, name: str, df: DataFrame) -> None:
        """Insert rows. Keys do not stop a repeated insert."""
        self._write(name, df, self.parts(name))

    def overwrite(self, name: str, df: DataFrame) -> None:
        self._write(name, df, [])

    def _write(self, name: str, df: DataFrame, kept: list[str]) -> None:
        table = STORED[name]
        typed = df.select(*[df[c.name].cast(c.type).alias(c.name) for c in table.columns])
        folder = f"{name}/{uuid.uuid4().hex}"
        with self.change():
            self._open["tables"][name] = [*kept, folder]
            self._open["notes"].pop(name, None)
            typed.write.parquet(f"{self.root}/{folder}")

    def note(self, name: str) -> dict:
        """What was noted on a table since its rows last changed."""
        return dict(self._state()["notes"].get(name, {}))

    def take_note(self, name: str, **facts) -> None:
        with self.change():
            self._open["notes"][name] = self.note(name) | facts

    def rebuild(self, names: Iterable[str] = tuple(TABLES)) -> None:
        """Replace the tables by empty ones, parents before children."""
        wanted = set(names)
        with self.change():
            for table in TABLES.values():
                if table.name in wanted:
                    self.overwrite(table.name, self.spark.createDataFrame([], table.schema).coalesce(1))

    def create_missing(self) -> None:
        """Create the tables that do not exist yet."""
        there = self._state()["tables"]
        missing = [name for name in TABLES if name not in there]
        if missing:
            self.rebuild(missing)

    def compact(self, name: str) -> None:
        """The rows of all inserts in one folder, files sorted as declared; notes stay."""
        table, was = STORED[name], self.parts(name)
        if len(was) < 2:
            return
        rows = self.read(name)
        if table.sort is not None:
            rows = rows.repartitionByRange(table.sort).sortWithinPartitions(table.sort)
        with self.change():
            notes = self._open["notes"]
            kept = notes.get(name)
            self.overwrite(name, rows)
            if kept is not None:
                notes[name] = kept
            now = self.parts(name)
            for facts in notes.values():  # of tables made from the rows that are now elsewhere
                if set(facts.get(f"parts of {name}", [])) == set(was):
                    facts[f"parts of {name}"] = now

    def vacuum(self) -> list[str]:
        """Delete the folders no longer in any table; for times when nobody reads old ones or writes."""
        used = {f for folders in self._state()["tables"].values() for f in folders}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        gone = []
        for name in STORED:
            top = path(f"{self.root}/{name}")
            files = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in files.listStatus(top) if files.exists(top) else []:
                folder = f"{name}/{status.getPath().getName()}"
                if folder not in used:
                    discard(self.spark, f"{self.root}/{folder}")
                    gone.append(folder)
        return gone
