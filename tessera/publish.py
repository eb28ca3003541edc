"""Published tables: versioned folders behind a manifest that is written last.

    root/data/<token>/...            files of one write, never changed afterwards
    root/manifest/<n>-<token>.json   version n: its columns and the folders it consists of

A write first writes its files, then its manifest, under another name, and renames that into
place.  Readers take the manifest of the highest number, so they see a version whole or not at
all, and a writer that dies leaves the version before.  A token names one write: published a
second time it changes nothing, so a retried job is safe.  Writers that race for a number claim
it by a file that only one of them can create; the others go on top of what it published.

With ``by`` a version has a folder for each value of that column, and ``replace`` makes a new
version of the given rows and of the untouched folders of the version before: their files are
neither read nor written.  ``collect_garbage`` removes what no recent version names.

All file work goes through Hadoop's FileSystem, so that any store that Spark reads will do.
"""

from __future__ import annotations

import contextlib
import json
import re
import time
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_NAME = re.compile(r"(\d{12})-(.+)\.json\Z")
#: Seconds to wait for other writers, and after which a claim without a manifest is a dead writer's.
WAIT, STALE = 300, 60


@dataclass(frozen=True)
class Manifest:
    """One version: ``parts`` are folders under the root by the column ``by``'s value (as in the folder's name), or one under ''."""

    version: int
    token: str
    schema: str
    by: str | None = None
    parts: dict[str, str] = field(default_factory=dict)


class NothingPublished(LookupError):
    pass


class Store:
    """A published table at ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- files

    def _names(self, *parts: str) -> list[str]:
        at = self._path(*parts)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _read(self, *parts: str) -> str:
        rows = self.spark.read.text(self._path(*parts).toString(), wholetext=True).collect()  # a manifest
        return rows[0][0]

    def _write_new(self, text: str, *parts: str) -> bool:
        """Put a file in place in one step; False if there is one of that name already."""
        to, part = self._path(*parts), self._path("manifest", f"_{uuid.uuid4().hex}")
        out = self._fs.create(part, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            done = not self._fs.exists(to) and self._fs.rename(part, to)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            done = False
        if not done:
            self._fs.delete(part, False)
        return bool(done)

    # ---- versions

    def _manifests(self) -> list[str]:
        return [n for n in self._names("manifest") if _NAME.match(n)]

    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of the newest, or of a given, version."""
        names = self._manifests()
        wanted = names[-1:] if version is None else [n for n in names if int(_NAME.match(n)[1]) == version]
        if not wanted:
            raise NothingPublished(f"{self.root}: no version{'' if version is None else f' {version}'}")
        return Manifest(**json.loads(self._read("manifest", wanted[0])))

    def versions(self) -> list[int]:
        return [int(_NAME.match(n)[1]) for n in self._manifests()]

    def _published(self, token: str) -> Manifest | None:
        found = [n for n in self._manifests() if _NAME.match(n)[2] == token]
        return Manifest(**json.loads(self._read("manifest", found[0]))) if found else None

    def _commit(self, token: str, of) -> Manifest:
        """Publish ``of(version before or None)``'s schema, by and parts under the next free number."""
        end = time.monotonic() + WAIT
        while time.monotonic() < end:
            done = self._published(token)
            if done:
                return done
            try:
                last = self.manifest()
            except NothingPublished:
                last = None
            made = Manifest((last.version if last else 0) + 1, token, *of(last))
            if self._claim(made.version):
                try:
                    return made if self._write_new(json.dumps(asdict(made)), "manifest", f"{made.version:012d}-{token}.json") else self._published(token)
                finally:
                    self._fs.delete(self._path("manifest", f"_claim-{made.version:012d}"), False)
            time.sleep(0.1)
        raise TimeoutError(f"{self.root}: other writers held every number for {WAIT} s")

    def _claim(self, version: int) -> bool:
        """Take a free version number: by a file that only one writer can create.  One that is left by a dead writer grows old."""
        claim = self._path("manifest", f"_claim-{version:012d}")
        try:
            self._fs.create(claim, False).close()
        except Py4JJavaError:
            probe = self._path("manifest", f"_{uuid.uuid4().hex}")  # the store's own clock
            self._fs.create(probe, False).close()
            now = self._fs.getFileStatus(probe).getModificationTime()
            self._fs.delete(probe, False)
            with contextlib.suppress(Py4JJavaError):  # it may go meanwhile
                if now - self._fs.getFileStatus(claim).getModificationTime() > STALE * 1000:
                    self._fs.delete(claim, False)
            return False
        if version in self.versions():  # it was published while we came
            self._fs.delete(claim, False)
            return False
        return True

    def _files(self, rows: DataFrame, token: str, by: str | None) -> dict[str, str]:
        """Write the files of a token (over those of an attempt before) and list their folders."""
        rows = rows.select(*[c for c in rows.columns if c != by], by) if by else rows
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self._path("data", token).toString())
        if not by:
            return {"": f"data/{token}"}
        return {n.partition("=")[2]: f"data/{token}/{n}" for n in self._names("data", token) if n.startswith(f"{by}=")}

    def publish(self, rows: DataFrame, token: str | None = None, by: str | None = None) -> Manifest:
        """A version of exactly ``rows``."""
        token = token or uuid.uuid4().hex
        done = self._published(token)
        if done:
            return done
        parts = self._files(rows, token, by)
        return self._commit(token, lambda _: (rows.schema.json(), by, parts))

    def replace(self, rows: DataFrame, token: str | None = None, drop: tuple = ()) -> Manifest:
        """A version in which ``rows`` replace the folders of their values, those named in ``drop`` go, and the others stay as they are.

        Columns must be those of the version before, which must have been published with ``by``.
        """
        token = token or uuid.uuid4().hex
        done = self._published(token)
        if done:
            return done
        last = self.manifest()
        if not last.by:
            raise ValueError(f"{self.root}: published without folders to replace")
        schema = StructType.fromJson(json.loads(last.schema))
        rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
        parts = self._files(rows, token, last.by)

        def merged(now: Manifest | None):
            if not now or (now.by, now.schema) != (last.by, last.schema):
                raise RuntimeError(f"{self.root}: another writer changed the table's form")
            return now.schema, now.by, {k: v for k, v in now.parts.items() if k not in drop} | parts

        return self._commit(token, merged)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version.  A reader keeps the version it began with."""
        m = self.manifest(version)
        schema = StructType.fromJson(json.loads(m.schema))
        by_write: dict[str, list[str]] = {}
        for part in m.parts.values():
            by_write.setdefault("/".join(part.split("/")[:2]), []).append(part)
        rows = self.spark.createDataFrame([], schema)
        for write, parts in by_write.items():
            reader = self.spark.read.schema(schema).option("basePath", self._path(write).toString())
            rows = rows.unionByName(reader.parquet(*[self._path(p).toString() for p in parts]))
        return rows

    def collect_garbage(self, keep: int = 2) -> list[str]:
        """Forget all but the newest ``keep`` versions and remove the folders that they do not name.

        Not while a writer is at work: files without a manifest yet look like those of a dead one.
        """
        names = self._manifests()
        kept = [Manifest(**json.loads(self._read("manifest", n))) for n in names[-keep:]]
        live = {p for m in kept for p in m.parts.values()}
        for n in names[:-keep]:
            self._fs.delete(self._path("manifest", n), False)
        gone = []
        for write in self._names("data"):
            folder = f"data/{write}"
            if not any(p == folder or p.startswith(f"{folder}/") for p in live):
                gone.append(folder)
            elif folder not in live:
                gone += [f"{folder}/{n}" for n in self._names(folder) if "=" in n and f"{folder}/{n}" not in live]
        for folder in gone:
            self._fs.delete(self._path(folder), True)
        return gone
