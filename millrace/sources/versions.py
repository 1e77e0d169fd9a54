"""Tables whose versions are named by manifests.

``root/data/<id>`` folders are written once and never changed, moved or
overwritten. ``root/versions/<n>.json`` lists the folders of a version, by part;
writing that one file switches to it. A reader takes the newest complete
manifest, so it sees one version whole, and a failed write leaves the version
before it. A part is named by an expression over the row; changes write the
parts that they touch and list the folders of all others again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PART = "_part"


class Conflict(RuntimeError):
    """Another writer has made this version."""


class VersionedTable:
    """A table at ``root``; ``part`` names the part of a row (a text without slashes)."""

    def __init__(self, spark: SparkSession, root: str, part: Column | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.part = F.lit("all") if part is None else F.coalesce(part.cast("string"), F.lit("none"))

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    # manifests

    def versions(self) -> list[int]:
        """Numbers of all manifests."""
        folder, fs = self._path("versions")
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def _manifest(self, version: int) -> dict | None:
        path, fs = self._path(f"versions/{version}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:  # its writer was lost on the way
            return None

    def manifest(self, version: int | None = None) -> dict:
        """``schema`` and ``parts`` (part to folders) of a version, or of the newest complete one."""
        for number in reversed(self.versions()):
            if version is None or number == version:
                if found := self._manifest(number):
                    return found
        return {"schema": None, "parts": {}}

    def commit(self, schema: StructType, parts: dict[str, list[str]]) -> int:
        """Switch to a new version, by writing its manifest."""
        number = max(self.versions(), default=-1) + 1
        path, fs = self._path(f"versions/{number}.json")
        text = json.dumps({"schema": schema.jsonValue(), "parts": {k: v for k, v in parts.items() if v}})
        try:
            out = fs.create(path, False)
        except Exception as error:
            raise Conflict(f"version {number} exists") from error
        out.write(bytearray(text.encode()))
        out.close()
        return number

    # reading

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """Rows of a version, or of some of its parts only."""
        found = self.manifest(version)
        folders = [f for part, own in found["parts"].items() if parts is None or part in parts for f in own]
        schema = StructType.fromJson(found["schema"]) if found["schema"] else None
        if schema is None:
            raise FileNotFoundError(f"no version of {self.root}")
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def parts(self, version: int | None = None) -> list[str]:
        return sorted(self.manifest(version)["parts"])

    # writing

    def written(self, df: DataFrame) -> dict[str, list[str]]:
        """Write rows to new folders, one for each part; no version has them yet."""
        name = f"data/{uuid.uuid4().hex}"
        placed = df.withColumn(_PART, self.part)
        placed.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.root}/{name}")
        folder, fs = self._path(name)
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        return {unquote(n.removeprefix(f"{_PART}=")): [f"{self.root}/{name}/{n}"] for n in names}

    def reload(self, df: DataFrame) -> int:
        """Replace all rows."""
        return self.commit(df.schema, self.written(df))

    def append(self, df: DataFrame) -> int:
        """Add rows; columns that the table does not have yet are null in its old rows."""
        now = self.manifest()
        schema = StructType.fromJson(now["schema"]) if now["schema"] else StructType()
        schema = StructType([*schema.fields, *[f for f in df.schema.fields if f.name not in schema.names]])
        fresh = self.written(df)
        return self.commit(schema, {p: now["parts"].get(p, []) + fresh.get(p, []) for p in {*now["parts"], *fresh}})

    def detach(self, part: str) -> list[str]:
        """Take a part out of the table; its folders are returned and stay where they are."""
        now = self.manifest()
        folders = now["parts"].pop(part, None)
        if folders is None:
            raise FileNotFoundError(f"no part {part} in {self.root}")
        self.commit(StructType.fromJson(now["schema"]), now["parts"])
        return folders

    def attach(self, part: str, folders: list[str]) -> int:
        """Take folders in as a part, after checking that every row belongs to it."""
        now = self.manifest()
        if part in now["parts"]:
            raise FileExistsError(f"part {part} is already attached")
        schema = StructType.fromJson(now["schema"])
        others = self.spark.read.schema(schema).parquet(*folders).where(self.part != part)
        if not others.isEmpty():
            raise ValueError(f"rows outside part {part}")
        return self.commit(schema, now["parts"] | {part: folders})

    def drop_parts(self, which: Callable[[str], bool]) -> list[str]:
        """Retention: a version without the parts that ``which`` names."""
        now = self.manifest()
        gone = sorted(p for p in now["parts"] if which(p))
        self.commit(StructType.fromJson(now["schema"]), {p: f for p, f in now["parts"].items() if p not in gone})
        return gone

    def rewrite(self, touched: list[str], change: Callable[[DataFrame], DataFrame]) -> int:
        """Rows of the touched parts become what ``change`` makes of them, in the same or other parts; the other folders stay as they are.

        ``change`` must keep rows within the touched parts, or its new rows are
        added to the parts that they name.
        """
        now = self.manifest()
        schema = StructType.fromJson(now["schema"])
        fresh = self.written(change(self.read(parts=touched)).select(*schema.names))
        kept = {p: f for p, f in now["parts"].items() if p not in touched}
        return self.commit(schema, {p: kept.get(p, []) + fresh.get(p, []) for p in {*kept, *fresh}})

    def update_where_key_in(self, keys: DataFrame, key: str, column: str, value: Column) -> int:
        """Set ``column`` where ``key`` is listed; the part must follow from the key."""
        listed = keys.select(key).distinct()
        touched = self.touched(listed)
        hit = listed.withColumn("_hit", F.lit(True))
        return self.rewrite(touched, lambda rows: rows.join(hit, key, "left").withColumn(
            column, F.when(F.col("_hit"), value).otherwise(F.col(column))).drop("_hit"))

    def merge_additive(self, delta: DataFrame, keys: list[str], measures: list[str]) -> int:
        """Add the measures of matched keys and insert new keys; the part must follow from the keys."""
        def merged(rows: DataFrame) -> DataFrame:
            both = rows.select(*keys, *measures).unionByName(delta.select(*keys, *measures))
            kinds = {f.name: f.dataType for f in rows.schema}
            return both.groupBy(*keys).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])

        return self.rewrite(self.touched(delta), merged)

    def touched(self, rows: DataFrame) -> list[str]:
        """Parts that rows belong to: at most as many as the table has parts, or new ones."""
        return sorted(r[0] for r in rows.select(self.part.alias(_PART)).distinct().collect())

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the newest ``keep`` versions lists, and older manifests. Not while a reader may use them."""
        numbers = self.versions()
        used = {f for n in numbers[-keep:] if (m := self._manifest(n)) for own in m["parts"].values() for f in own}
        gone = []
        for number in numbers[:-keep]:
            for own in (self._manifest(number) or {"parts": {}})["parts"].values():
                gone += [f for f in own if f not in used and f.startswith(self.root)]
            path, fs = self._path(f"versions/{number}.json")
            fs.delete(path, False)
        for folder in sorted(set(gone)):
            path, fs = self._path(folder.removeprefix(f"{self.root}/"))
            fs.delete(path, True)
        return sorted(set(gone))


def hash_part(key: str, parts: int) -> Column:
    """Part of a key among a fixed number of parts."""
    return F.lpad(F.pmod(F.xxhash64(key), F.lit(parts)).cast("string"), 4, "0")
