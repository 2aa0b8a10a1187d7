"""Tables made of parts, of which a manifest names the live ones.

A table is a set of parts (a key and a folder of Parquet files). A manifest is one small
file ``_manifests/<number>.json`` with the folder of every live part and the marks of the
batches that it holds. A commit writes the new manifest beside the old one and moves it to
its final name, which fails if another writer took that number: of two writers one wins, the
other has changed nothing. Readers take the newest manifest once and read only the folders it
names, so they see one state of the table, also while parts are replaced; the folders of the
last ``keep`` manifests stay for readers that hold an older one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_manifests"
#: Manifests whose folders stay: a reader has as many commits' time to finish.
KEEP = 10


class CommitConflict(RuntimeError):
    """Another writer published this number first."""


@dataclass
class Manifest:
    number: int = -1
    parts: dict[str, str] = field(default_factory=dict)  # part -> folder below the table
    marks: dict[str, int] = field(default_factory=dict)  # writer -> its last batch

    def holds(self, writer: str, batch: int) -> bool:
        return self.marks.get(writer, -1) >= batch


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _numbers(spark: SparkSession, path: str) -> list[int]:
    Path, fs, _ = _fs(spark, path)
    folder = Path(f"{path}/{FOLDER}")
    names = [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest:
    """The manifest of this number, by default the newest; an empty one if there is none."""
    if number is None:
        found = _numbers(spark, path)
        if not found:
            return Manifest()
        number = found[-1]
    Path, fs, _ = _fs(spark, path)
    stream = fs.open(Path(f"{path}/{FOLDER}/{number}.json"))
    try:
        content = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Manifest(number, content["parts"], content["marks"])


def commit(spark: SparkSession, path: str, new: Manifest, keep: int = KEEP) -> Manifest:
    """Publish ``new`` under its number, which must be one above the newest; raises
    ``CommitConflict`` if that number is taken."""
    Path, fs, _ = _fs(spark, path)
    scratch = Path(f"{path}/{FOLDER}/_new-{uuid.uuid4().hex}")
    stream = fs.create(scratch, False)
    stream.write(bytearray(json.dumps({"parts": new.parts, "marks": new.marks}).encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(scratch, Path(f"{path}/{FOLDER}/{new.number}.json"), options)  # refuses to replace a file
    except Exception as error:
        fs.delete(scratch, False)
        if fs.exists(Path(f"{path}/{FOLDER}/{new.number}.json")):
            raise CommitConflict(f"manifest {new.number} of {path} exists") from error
        raise
    _vacuum(spark, path, keep)
    return new


def _vacuum(spark: SparkSession, path: str, keep: int) -> None:
    """Drop manifests beyond the newest ``keep`` and the folders that only they name."""
    numbers = _numbers(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]
    if not old:
        return
    Path, fs, _ = _fs(spark, path)
    live = {f for n in kept for f in read_manifest(spark, path, n).parts.values()}
    for n in old:
        for folder in set(read_manifest(spark, path, n).parts.values()) - live:
            fs.delete(Path(f"{path}/{folder}"), True)
        fs.delete(Path(f"{path}/{FOLDER}/{n}.json"), False)


def new_folder() -> str:
    return f"data/part={uuid.uuid4().hex}"


def read_parts(spark: SparkSession, path: str, schema: T.StructType, manifest: Manifest | None = None, parts: list[str] | None = None) -> DataFrame:
    """Rows of the live parts (or of some of them), as of one manifest."""
    manifest = manifest or read_manifest(spark, path)
    folders = [f"{path}/{f}" for p, f in manifest.parts.items() if parts is None or p in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    # One base path: a part's own partition folders stay columns that a reader can prune by.
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def update(spark: SparkSession, path: str, change, keep: int = KEEP, attempts: int = 10) -> Manifest:
    """Commit ``change(newest manifest)`` (parts, marks), anew on a newer manifest if another
    writer came first; ``change`` returns None to leave the table as it is."""
    for _ in range(attempts):
        now = read_manifest(spark, path)
        wanted = change(now)
        if wanted is None:
            return now
        try:
            return commit(spark, path, Manifest(now.number + 1, *wanted), keep)
        except CommitConflict:
            continue
    raise CommitConflict(f"{path}: no commit in {attempts} attempts")
