"""Tables whose versions switch together, their rows in buckets that split as they grow.

A folder holds data files and one manifest for each version. The manifest lists every table with its buckets and the files
of each; it is written last, under a new name, and readers take the newest one. So a run that breaks off leaves the version
before it, of all tables at once, and what it had written is removed by the next run. One writer at a time is assumed; of two,
the second finds its version taken and fails.

Buckets are those of extendible hashing: bucket ``(depth, prefix)`` has the rows whose key hash ends with ``depth`` bits equal to
``prefix``. A change opens only the buckets its keys fall into. One that has more than ``ROWS`` rows is split by the next bits,
unless one key fills it, so what a change opens does not grow with the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Rows of a bucket before it splits, and files of a bucket before it is written anew.
ROWS = 1 << 20
FILES = 8
DEEPEST = 24
LEAF = "_leaf"


@dataclass(frozen=True)
class Bucket:
    depth: int = 0
    prefix: int = 0
    rows: int = 0
    paths: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"d{self.depth}p{self.prefix}"


@dataclass
class Table:
    """The state of a table in one version: its schema, its key and its buckets (slices by value where it has no key)."""

    schema: str
    keys: list[str] = field(default_factory=list)
    buckets: dict[str, Bucket] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(b.rows for b in self.buckets.values())


def _name_at(depth: int, hashed: Column) -> Column:
    return F.concat(F.lit(f"d{depth}p"), hashed.bitwiseAND(F.lit((1 << depth) - 1)).cast("string"))


def _hash(keys: Sequence[str]) -> Column:
    """Keys are columns or expressions over them."""
    return F.xxhash64(*[F.expr(k) for k in keys]) if keys else F.lit(0).cast("bigint")


class Versions:
    """The newest version of the tables in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.version, self.facts, self.tables = 0, {}, {}
        names = self._manifests()
        if names:
            self._load(names[-1])

    # Files, through the file system of the folder.

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, pattern: str) -> list[str]:
        found = self._files().globStatus(self._path(f"{self.folder}/{pattern}")) or []
        return sorted(s.getPath().toString() for s in found)

    def _manifests(self) -> list[str]:
        return self._listed("_manifests/v*.json")

    def _load(self, path: str) -> None:
        read = json.loads("\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect()))
        self.version, self.facts = read["version"], read["facts"]
        self.tables = {
            name: Table(t["schema"], t["keys"], {b: Bucket(d, p, n, tuple(paths)) for b, d, p, n, paths in t["buckets"]})
            for name, t in read["tables"].items()
        }

    def _at(self, path: str) -> Versions:
        version = Versions.__new__(Versions)
        version.spark, version.folder = self.spark, self.folder
        version._load(path)
        return version

    def size_of(self, paths: Sequence[str]) -> int:
        """Bytes of the files under ``paths``."""
        files = self._files()
        return sum(files.getContentSummary(self._path(p)).getLength() for p in paths)

    # Reading.

    def read(self, name: str, only: Sequence[str] | None = None) -> DataFrame:
        """A table, or some of its buckets."""
        table = self.tables[name]
        paths = [p for n, b in table.buckets.items() if only is None or n in only for p in b.paths]
        schema = T.StructType.fromJson(json.loads(table.schema))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def placed(self, name: str, rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """``rows`` with the bucket their ``keys`` (by default named as in the table) fall into.

        The list of buckets is sent to all tasks: a row of some bytes for each million rows of the table.
        """
        table = self.tables[name]
        hashed = _hash(keys or table.keys)
        depths = sorted({b.depth for b in table.buckets.values()})
        if len(depths) == 1:
            return rows.withColumn(LEAF, _name_at(depths[0], hashed))
        tried = rows.withColumn(LEAF, F.explode(F.array(*[_name_at(d, hashed) for d in depths])))
        known = self.spark.createDataFrame([(n,) for n in table.buckets], f"{LEAF} string")
        return tried.join(F.broadcast(known), LEAF, "left_semi")

    def touched(self, name: str, rows: DataFrame, keys: Sequence[str] | None = None) -> list[str]:
        """Names of the buckets that ``rows`` fall into; one for each bucket at most reaches the driver."""
        return sorted(r[0] for r in self.placed(name, rows, keys).select(LEAF).distinct().collect())


class Change(Versions):
    """A version in the making: reads its own state, and is seen by others only after :meth:`commit`."""

    def __init__(self, spark: SparkSession, folder: str, rows: int = ROWS):
        super().__init__(spark, folder)
        self.limit = rows
        self.opened: set[str] = set()
        self.written: list[str] = []
        files = self._files()
        for left in self._listed(f"data/v{self.version + 1:09d}-*"):  # of a run that broke off
            files.delete(self._path(left), True)

    def table(self, name: str, schema: T.StructType, keys: Sequence[str] = ()) -> None:
        """Make an empty table unless there is one."""
        if name not in self.tables:
            self.tables[name] = Table(schema.json(), list(keys), {"d0p0": Bucket()})

    def read(self, name: str, only: Sequence[str] | None = None) -> DataFrame:
        self.opened.update(p for n, b in self.tables[name].buckets.items() if only is None or n in only for p in b.paths)
        return super().read(name, only)

    def _new_folder(self) -> str:
        return f"{self.folder}/data/v{self.version + 1:09d}-{uuid.uuid4().hex[:12]}"

    def whole(self, name: str, rows: DataFrame) -> None:
        """Replace a table without keys."""
        self.tables[name] = Table(rows.schema.json(), [], {})
        folder = self._new_folder()
        rows.write.parquet(folder)
        self.written.append(folder)
        count = self.spark.read.schema(rows.schema).parquet(folder).count()
        self.tables[name].buckets = {"d0p0": Bucket(0, 0, count, (folder,))}

    def _write(self, name: str, leaved: DataFrame) -> dict[str, tuple[int, str]]:
        """Write rows with their bucket; rows and folder of each bucket.

        Rows are gathered by bucket, and adaptive execution splits one that is too large for a task.
        """
        folder = self._new_folder()
        schema = T.StructType.fromJson(json.loads(self.tables[name].schema))
        leaved.select(*schema.names, LEAF).hint("rebalance", LEAF).write.partitionBy(LEAF).parquet(folder)
        wide = T.StructType([*schema.fields, T.StructField(LEAF, T.StringType())])
        counts = self.spark.read.schema(wide).parquet(folder).groupBy(LEAF).count().collect()
        found = {r[0]: (r[1], f"{folder}/{LEAF}={r[0]}") for r in counts}
        self.written += [path for _, path in found.values()]
        return found

    def _sized(self, name: str, leaved: DataFrame) -> dict[str, tuple[int, int]]:
        """Rows and different keys that each bucket is to get, from the columns of the key alone."""
        counts = leaved.groupBy(LEAF).agg(F.count("*"), F.approx_count_distinct(_hash(self.tables[name].keys)))
        return {r[0]: (r[1], r[2]) for r in counts.collect()}

    def _cleared(self, name: str, leaf: str, rows: int, keys: int) -> None:
        """Empty a bucket that is to get so many rows of so many keys, and split it where they are too many.

        Buckets are split before their rows are written, so these are shuffled and written once, all buckets in one job.
        """
        buckets = self.tables[name].buckets
        old = buckets.pop(leaf)
        deeper = max(min((-(-rows // self.limit) - 1).bit_length(), max(keys - 1, 0).bit_length(), DEEPEST - old.depth), 0)
        for k in range(1 << deeper):
            child = Bucket(old.depth + deeper, old.prefix | (k << old.depth))
            buckets[child.name] = child

    def _add(self, name: str, rows: DataFrame) -> None:
        """Write rows beside those that their buckets have."""
        buckets = self.tables[name].buckets
        for leaf, (n, path) in self._write(name, self.placed(name, rows)).items():
            old = buckets[leaf]
            buckets[leaf] = Bucket(old.depth, old.prefix, old.rows + n, (*old.paths, path))

    def slices(self, name: str, rows: DataFrame, column: str, values: Sequence) -> None:
        """Replace the slices ``values`` of ``column`` by ``rows``; a slice without rows is emptied, the others are not touched."""
        if name not in self.tables:
            self.tables[name] = Table(rows.schema.json())
        buckets = self.tables[name].buckets
        new = self._write(name, rows.withColumn(LEAF, F.coalesce(F.col(column).cast("string"), F.lit("null"))))
        for value in {*map(str, values), *new}:
            count, path = new.get(value, (0, None))
            if path:
                buckets[value] = Bucket(0, 0, count, (path,))
            else:
                buckets.pop(value, None)

    def append(self, name: str, rows: DataFrame, merged: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Add rows: new files beside the old ones. Only a bucket with too many rows or files is written anew.

        ``merged`` is what a bucket written anew makes of its rows, such as one sum of several. ``rows`` is read more than once:
        pass a written table.
        """
        buckets = self.tables[name].buckets
        sized = self._sized(name, self.placed(name, rows))
        if not sized:
            return 0
        full = [leaf for leaf, (n, _) in sized.items() if buckets[leaf].rows + n > self.limit or len(buckets[leaf].paths) >= FILES]
        anew = [leaf for leaf in full if buckets[leaf].paths]
        content, sizes = rows, sized
        if anew:
            leaved, again = self.placed(name, rows), F.col(LEAF).isin(anew)
            both = self.read(name, anew).unionByName(leaved.where(again).drop(LEAF))
            both = merged(both) if merged else both
            sizes = sized | self._sized(name, self.placed(name, both))
            content = leaved.where(~again).drop(LEAF).unionByName(both.select(*rows.columns))
        for leaf in full:
            self._cleared(name, leaf, *sizes[leaf])
        self._add(name, content)
        return sum(n for n, _ in sized.values())

    def rewrite(self, name: str, leaves: Sequence[str], content: DataFrame) -> None:
        """Replace the rows of some buckets by ``content``, which has rows of these buckets only.

        ``content`` is worked out twice, the first time for its keys alone.
        """
        sized = self._sized(name, self.placed(name, content))
        for leaf in leaves:
            self._cleared(name, leaf, *sized.get(leaf, (0, 0)))
        if sized:
            self._add(name, content)

    def replace_groups(self, name: str, fresh: DataFrame, kept: Callable[[DataFrame], DataFrame]) -> None:
        """Put ``fresh`` in place of the rows that ``kept`` leaves out, in the buckets that ``fresh`` falls into."""
        leaves = self.touched(name, fresh)
        if leaves:
            self.rewrite(name, leaves, kept(self.read(name, leaves)).unionByName(fresh))

    def cost(self) -> dict[str, int]:
        """Bytes opened and written so far."""
        return {"read": self.size_of(sorted(self.opened)), "written": self.size_of(self.written)}

    def commit(self, **facts) -> None:
        """Make the new version the newest. Versions but the last two go, with the files only they name."""
        tables = {
            name: {"schema": t.schema, "keys": t.keys, "buckets": [[n, b.depth, b.prefix, b.rows, list(b.paths)] for n, b in t.buckets.items()]}
            for name, t in self.tables.items()
        }
        self.facts = self.facts | facts
        self.version += 1
        text = json.dumps({"version": self.version, "facts": self.facts, "tables": tables})
        files, final = self._files(), self._path(f"{self.folder}/_manifests/v{self.version:09d}.json")
        draft = self._path(f"{self.folder}/_manifests/.draft-{uuid.uuid4().hex[:12]}")
        out = files.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if files.exists(final) or not files.rename(draft, final):
            raise RuntimeError(f"version {self.version} of {self.folder} has been written by another run")
        self._clean()

    def _clean(self) -> None:
        files = self._files()
        old, new = self._manifests()[:-2], self._manifests()[-2:]
        used: set[str] = set()
        for path in new:
            used |= _paths(self._at(path))
        for path in old:
            for data in sorted(_paths(self._at(path)) - used):
                files.delete(self._path(data), True)
            files.delete(self._path(path), False)


def _paths(version: Versions) -> set[str]:
    return {p for t in version.tables.values() for b in t.buckets.values() for p in b.paths}
