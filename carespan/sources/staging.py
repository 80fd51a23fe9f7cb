"""Staged tables: a result written once and read back.

A staged table cuts the lineage, survives the loss of executors, and has a known
size, so Spark can decide by itself whether it is small enough to broadcast.

Inside ``resumable`` staged tables keep their place from run to run, and a run begins
where the one before it has stopped.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHARED_MOUNT = "spark.carespan.sharedMount"
MARKER = "_stage.json"  # written when a resumable stage is whole; Spark passes over its name
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)  # of this thread
_local_folders: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names; one of our own only in local mode.

    On a cluster a path of the machine itself is refused, unless ``SHARED_MOUNT`` says
    that it is a mount which all machines share.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    local = spark.sparkContext.master.startswith("local")
    if named:
        own = urlparse(named).scheme == "file"
        if own and not local and spark.conf.get(SHARED_MOUNT, "false") != "true":
            raise ValueError(f"{named} is each machine's own; name a shared {CHECKPOINT_DIR}")
        return named.rstrip("/")
    if not local:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the staging folder that nothing has used."""
    app = spark.sparkContext.applicationId
    path = f"{staging_root(spark)}/{app}/{name}-{uuid.uuid4().hex}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what is staged inside, at the end; write the result before that.

    Stages of ``resumable`` stay.
    """
    token = _scratch.set([])
    try:
        yield
    finally:
        for path in _scratch.get():
            fs, folder = _file_system(spark, path)
            fs.delete(folder, True)
        _scratch.reset(token)


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


@dataclass
class Resumed:
    """A run whose stages are kept: where, how many it has come to, and which it wrote."""

    folder: str
    reached: int
    written: list[str]

    def next_path(self, name: str) -> str:
        self.reached += 1
        return f"{self.folder}/{self.reached:04d}-{name}"


_resumed: ContextVar[Resumed | None] = ContextVar("resumed", default=None)


@contextmanager
def resumable(spark: SparkSession, folder: str, fingerprint: str) -> Iterator[Resumed]:
    """Keeps what is staged inside below ``folder``, and reads what an earlier run has kept.

    A stage's place is given by the fingerprint, its number in the run and its name, so the
    same steps must be taken in the same order: the fingerprint must tell inputs and
    parameters apart (``fingerprint``), and a new version of the program needs another one.
    A stage counts as whole once its marker is written, after Spark has committed its files;
    the marker holds the schema and the measures. A stage without one, or with another
    schema, is written anew. Two runs at once must not share a fingerprint. The folder must
    be one that all machines share; clear it when its results are no longer wanted.
    """
    run = Resumed(f"{folder.rstrip('/')}/{fingerprint}", 0, [])
    token = _resumed.set(run)
    try:
        yield run
    finally:
        _resumed.reset(token)


def fingerprint(spark: SparkSession, paths: Iterable[str], *parameters) -> str:
    """A digest of the files below ``paths`` (names, sizes, times) and of the parameters.

    The files are listed by Spark, not opened, and one row comes back for each path.
    """
    digest = hashlib.sha256(repr(parameters).encode())
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        one = F.xxhash64("path", "length", "modificationTime")
        row = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.bit_xor(one)).first()
        digest.update(repr((path, *row)).encode())
    return digest.hexdigest()[:32]


def _kept(df: DataFrame, path: str) -> dict | None:
    """The measures of a whole stage with this schema, else None."""
    fs, marker = _file_system(df.sparkSession, f"{path}/{MARKER}")
    if not fs.exists(marker):
        return None
    stream = fs.open(marker)
    try:
        text = df.sparkSession.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:  # cut off while it was written
        return None
    return found["measures"] if found["schema"] == df.schema.json() else None


def _keep(df: DataFrame, path: str, measures: dict) -> None:
    fs, marker = _file_system(df.sparkSession, f"{path}/{MARKER}")
    stream = fs.create(marker, True)
    stream.write(bytearray(json.dumps({"schema": df.schema.json(), "measures": measures}).encode()))
    stream.close()


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` and read it back."""
    return stage_and_measure(df, name)[0]


def stage_and_measure(
    df: DataFrame, name: str, **measures: Column
) -> tuple[DataFrame, dict]:
    """Stage ``df`` and return aggregates of it, taken while it is written."""
    spark, run = df.sparkSession, _resumed.get()
    path = new_path(spark, name) if run is None else run.next_path(name)
    seen = None if run is None else _kept(df, path)
    if seen is None:
        watched, seen = df, {}
        if measures:
            observation = Observation()
            watched = df.observe(observation, *[c.alias(k) for k, c in measures.items()])
        mode = "errorifexists" if run is None else "overwrite"
        watched.write.mode(mode).option("compression", "zstd").parquet(path)
        if measures:
            seen = observation.get
        if run is not None:
            _keep(df, path, seen)
            run.written.append(path)
    return spark.read.schema(df.schema).parquet(path), seen
