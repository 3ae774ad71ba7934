"""Tables that change together, and runs that can be taken up again.

A run writes the tables of its stages below a folder of its own version. A stage whose tables are all
written leaves a record of them (rows, digest, schema); a run that is started again over the same
inputs skips such stages and repeats the others. The manifest of a version is written last, under a
name that did not exist before. Readers go through the newest manifest, so they see all tables of a
version or none: a run that fails between two tables changes nothing for them.

    root/runs/<version>/begin.json, <stage>.json      what is under way
    root/tables/<version>/<layer>/<table>             Parquet
    root/manifests/<version>.json                     what is published
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tutela.sources.digest import table_digest
from tutela.sources.warehouse import LAYOUT, write_table


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    path: str
    rows: int
    digest: str | None  # not made before a run is to be published
    schema: str


class Files:
    """Small files on the file system of a path, by way of Spark."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def write_new(self, name: str, text: str, replace: bool = False) -> None:
        """Appears whole or not at all; an existing file stays unless it may be replaced."""
        part = self._path(f"{name}.part")
        out = self._fs.create(part, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        if replace:
            self._fs.delete(self._path(name), False)
        if self._fs.exists(self._path(name)) or not self._fs.rename(part, self._path(name)):
            self._fs.delete(part, False)
            raise FileExistsError(f"{self.root}/{name}")

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def list(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def fingerprint(self, names: Iterable[str]) -> dict[str, list]:
        """Length and time of change of every file below the named paths of this root."""
        out: dict[str, list] = {}
        for name in names:
            files = self._fs.listFiles(self._path(name), True)
            seen = []
            while files.hasNext():
                one = files.next()
                seen.append([one.getPath().getName(), one.getLen(), one.getModificationTime()])
            out[name] = sorted(seen)
        return out


class Version:
    """Published tables, all of one run."""

    def __init__(self, spark: SparkSession, version: str, manifest: dict):
        self.spark, self.version = spark, version
        self.source = manifest["source"]
        self.tables = {t["name"]: Table(**t) for t in manifest["tables"]}

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.tables[name])

    def layer(self, layer: str) -> dict[str, DataFrame]:
        return {n: self.read(n) for n, t in self.tables.items() if t.layer == layer}

    def broken(self) -> list[str]:
        """Tables whose files do not hold what was written."""
        out = []
        for name, t in self.tables.items():
            found = table_digest(self.read(name), name).first()
            if (found["rows"], found["digest"]) != (t.rows, t.digest):
                out.append(name)
        return out


def read_table(spark: SparkSession, table: Table) -> DataFrame:
    """With the recorded schema: no job looks at footers."""
    return spark.read.schema(T.StructType.fromJson(json.loads(table.schema))).parquet(table.path)


class Run:
    """A version under way. One that is not to be published, for the caller alone, makes no
    digests; a later run over the same inputs adds them to the tables that it takes up."""

    def __init__(self, store: Store, version: str, source: dict, publishing: bool = True):
        self.store, self.version, self.source = store, version, source
        self.publishing = publishing
        self.tables: dict[str, Table] = {}
        self.skipped: list[str] = []
        self.done: list[str] = []

    def stage(self, name: str, layer: str, build: Callable[[], dict[str, DataFrame]]) \
            -> dict[str, DataFrame]:
        """The tables of a stage, read back. They are built unless their record says that they have
        been; ``build`` is then not called. Rows and digest come from the job that writes."""
        files, spark = self.store.files, self.store.spark
        file = f"runs/{self.version}/{name}.json"
        record = files.read(file)
        if record is None:
            found = [self._written(layer, n, df) for n, df in build().items()]
            files.write_new(file, json.dumps([asdict(t) for t in found]))
            self.done.append(name)
        else:
            found = [Table(**t) for t in json.loads(record)]
            if self.publishing and any(t.digest is None for t in found):
                found = [self._digested(t) for t in found]
                files.write_new(file, json.dumps([asdict(t) for t in found]), replace=True)
            self.skipped.append(name)
        self.tables |= {t.name: t for t in found}
        return {t.name: read_table(spark, t) for t in found}

    def _written(self, layer: str, name: str, df: DataFrame) -> Table:
        path = f"{self.store.files.root}/tables/{self.version}/{layer}/{name}"
        parts, order = LAYOUT.get(name, ([], []))
        seen = write_table(df, path, partition_by=parts, sort_by=order, digested=self.publishing)
        rows, digest = seen if self.publishing else (seen, None)
        return Table(name, layer, path, rows, digest, json.dumps(
            T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]).jsonValue()))

    def _digested(self, table: Table) -> Table:
        """With the digest of the rows that were written; files that hold other ones stop the run."""
        found = table_digest(read_table(self.store.spark, table), table.name).first()
        if found["rows"] != table.rows:
            raise ValueError(f"{table.path} holds {found['rows']} rows, not {table.rows}")
        return replace(table, digest=found["digest"])

    def _manifest(self) -> dict:
        return {"source": self.source, "tables": [asdict(t) for t in self.tables.values()]}

    def so_far(self) -> Version:
        """The tables that this run has written or found, for its caller only: not published."""
        return Version(self.store.spark, self.version, self._manifest())

    def published(self) -> Version | None:
        """This version as readers see it, if they do."""
        have = self.store.manifest(self.version)
        return have and Version(self.store.spark, self.version, have)

    def publish(self) -> Version:
        """From now on readers get these tables."""
        manifest = self._manifest()
        have = self.store.manifest(self.version)
        if have != manifest:
            self.store.files.write_new(f"manifests/{self.version}.json", json.dumps(manifest))
        return Version(self.store.spark, self.version, manifest)


class Store:
    """Versions of a warehouse below one folder that every executor reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    def versions(self) -> list[str]:
        """Published ones, oldest first."""
        return [n.removesuffix(".json") for n in self.files.list("manifests")
                if n.endswith(".json")]

    def manifest(self, version: str) -> dict | None:
        text = self.files.read(f"manifests/{version}.json")
        return None if text is None else json.loads(text)

    def current(self) -> Version:
        found = self.versions()
        if not found:
            raise LookupError(f"nothing is published below {self.files.root}")
        return Version(self.spark, found[-1], self.manifest(found[-1]))

    def begin(self, source: dict, publishing: bool = True) -> Run:
        """A run over the inputs that ``source`` describes: the last one if it was over the same
        and nothing else has been begun since, else a new version."""
        begun = self.files.list("runs")
        if begun:
            last = json.loads(self.files.read(f"runs/{begun[-1]}/begin.json") or "null")
            if last == source:
                return Run(self, begun[-1], source, publishing)
        version = f"v{int(begun[-1][1:]) + 1 if begun else 1:08d}"
        self.files.write_new(f"runs/{version}/begin.json", json.dumps(source))
        return Run(self, version, source, publishing)

    def prune(self, keep: int = 2) -> list[str]:
        """Removes all but the newest ``keep`` published versions and what never got published
        before them. The manifest goes first: no reader is sent to tables that are being removed."""
        published = self.versions()
        oldest = published[-keep] if len(published) >= keep else ""
        gone = [v for v in self.files.list("runs") if v < oldest]
        for version in gone:
            self.files.remove(f"manifests/{version}.json")
            self.files.remove(f"tables/{version}")
            self.files.remove(f"runs/{version}")
        return gone
