"""Stores of keyed parts whose last published state is always whole.

A part is a folder of Parquet files, written once and never changed (``<path>/data/<run>/_part=<n>``). A state is a small
pointer file (``<path>/pointers/<number>``) that names the folder and the schema of every part. A refresh writes its parts
first and its pointer last, so a run that is lost in between changes nothing: readers follow the newest whole pointer, and
the next run drops the folders that no pointer names. There is one pointer for the whole store, so parts that are refreshed
together change together. Pointers are as large as the number of parts: metrics, or weeks that are kept.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
#: States whose parts are kept, so that a reader that has just opened one can finish.
KEPT_STATES = 2


@dataclass(frozen=True)
class Part:
    """``folder``: below the store, None without rows. ``schema``: of the rows, as JSON, None if never known."""

    folder: str | None
    schema: str | None
    note: Mapping[str, Any] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else T.StructType()


class Folder:
    """The few file operations that a pointer needs, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.files = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        place = self.at(name)
        return sorted(s.getPath().getName() for s in self.files.listStatus(place)) if self.files.exists(place) else []

    def exists(self, name: str) -> bool:
        return self.files.exists(self.at(name))

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails if the file exists."""
        stream = self.files.create(self.at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def drop(self, name: str) -> None:
        self.files.delete(self.at(name), True)


def layout_changes(old: T.StructType, new: T.StructType) -> list[str]:
    """Columns that are new, gone or of another type; their order does not count."""
    before, after = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (old, new))
    out = [f"{name}: gone" for name in before if name not in after]
    out += [f"{name}: new" for name in after if name not in before]
    return out + [f"{n}: {before[n]} became {after[n]}" for n in before if n in after and before[n] != after[n]]


class Store:
    """Keyed parts at ``path``. One writer at a time; readers need no care."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.folder = spark, Folder(spark, path)
        self.staged: set[str] = set()  # folders of this writer that do not count yet

    def states(self) -> list[tuple[int, dict[str, Part]]]:
        """The newest whole states, the last one first."""
        out = []
        for name in reversed(self.folder.names("pointers")):
            try:
                parts = json.loads(self.folder.read(f"pointers/{name}"))["parts"]
            except ValueError:  # its writer was lost
                continue
            except Py4JJavaError as error:
                if "ChecksumException" not in str(error.java_exception):
                    raise
                continue
            out.append((int(name), {key: Part(**part) for key, part in parts.items()}))
            if len(out) == KEPT_STATES:
                break
        return out

    def parts(self) -> dict[str, Part]:
        """The parts of the last published state, by key; none before the first."""
        states = self.states()
        return states[0][1] if states else {}

    def stage(self, rows: DataFrame, key: Column, keys: Sequence[str], notes: Mapping[str, Mapping] | None = None) -> dict[str, Part]:
        """Write the rows of some keys, in one job, beside what is published; a key without rows becomes an empty part.

        ``key`` gives each row's key, one of ``keys``. Folders that no state names, other than
        those staged here, are dropped first.
        """
        self.drop_unused()
        if PART in rows.columns:
            raise ValueError(f"a column is named {PART}")
        name = uuid.uuid4().hex
        self.staged.add(name)
        run = f"data/{name}"
        place = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in keys]), key), F.lit(0)).cast("int")
        dealt = rows.withColumn(PART, place).hint("rebalance", PART)
        dealt.write.partitionBy(PART).parquet(f"{self.folder.path}/{run}")
        if self.folder.exists(f"{run}/{PART}=0"):
            raise ValueError("rows of other keys than those given")
        found, schema = set(self.folder.names(run)), json.dumps(rows.schema.jsonValue())
        return {
            k: Part(f"{run}/{PART}={i}" if f"{PART}={i}" in found else None, schema, dict((notes or {}).get(k, {})))
            for i, k in enumerate(keys, 1)
        }

    def publish(self, parts: Mapping[str, Part], drop: Iterable[str] = (), whole: bool = False) -> None:
        """Make the staged parts count, all at once; other parts stay unless dropped, or unless these are the ``whole`` store."""
        lost = [p.folder for p in parts.values() if p.folder and not self.folder.exists(p.folder)]
        if lost:
            raise ValueError(f"staged parts are gone, another refresh has run: {lost}")
        now = {} if whole else self.parts()
        gone = set(drop)
        state = {k: p for k, p in {**now, **parts}.items() if k not in gone}
        names = self.folder.names("pointers")
        number = int(names[-1]) + 1 if names else 1
        text = json.dumps({"parts": {k: asdict(p) for k, p in state.items()}})
        self.folder.create(f"pointers/{number:012d}", text)

    def drop_unused(self) -> None:
        """Drop folders and pointers that the last states do not name."""
        states = self.states()
        used = {p.folder.split("/")[1] for _, parts in states for p in parts.values() if p.folder}
        for name in self.folder.names("data"):
            if name not in used | self.staged:
                self.folder.drop(f"data/{name}")
        newest = {f"{number:012d}" for number, _ in states}
        for name in self.folder.names("pointers"):
            if states and name not in newest:
                self.folder.drop(f"pointers/{name}")

    def read(self, *keys: str) -> DataFrame:
        """Rows of the given parts, with the schema they were written with; all of them must share it."""
        parts = self.parts()
        unknown = [k for k in keys if k not in parts]
        if unknown:
            raise KeyError(f"not in {self.folder.path}: {', '.join(unknown)}")
        own = [parts[k] for k in keys]
        schema = own[0].struct if own else T.StructType()
        for k, part in zip(keys, own):
            if changes := layout_changes(schema, part.struct):
                raise ValueError(f"{k} has other columns than {keys[0]}: {'; '.join(changes)}")
        folders = [f"{self.folder.path}/{p.folder}" for p in own if p.folder]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)
