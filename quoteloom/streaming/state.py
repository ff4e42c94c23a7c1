"""State tables kept by small deltas and compaction.

A batch is written as a run of its own, so what it costs follows from what it changes.  A
run that has grown to a fixed share of the one before is merged with it, and so on: sizes
fall by that ratio from run to run, a row is rewritten a logarithmic number of times, and a
reader meets few runs.  How many files a run has follows from its size.

Which runs make up the table stands in a small manifest; a new one is renamed into place at
the end of a batch.  A batch that the manifest already names is not applied again, and what
a failed batch left is dropped later.  One writer at a time; readers see whole batches.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import dedupe
from ..sinks.store import COMPRESSION, _hadoop_path

RATIO = 4  # a run is merged into the one before once it has a fourth of its rows
BATCH = "_batch"
_MANIFEST = "_manifest-"


@dataclass
class Manifest:
    version: int = 0
    last_batch: int = -1
    keys: list[str] = field(default_factory=list)
    runs: list[dict] = field(default_factory=list)  # oldest first: name, rows

    @property
    def rows(self) -> int:
        return sum(r["rows"] for r in self.runs)


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, root = _hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n[len(_MANIFEST) : -5]) for n in names if n.startswith(_MANIFEST) and n.endswith(".json"))


def _load(spark: SparkSession, path: str, version: int) -> Manifest:
    fs, p = _hadoop_path(spark, f"{path}/{_MANIFEST}{version:012d}.json")
    stream = fs.open(p)
    try:
        return Manifest(**json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest; an empty one where there is no table yet."""
    versions = _versions(spark, path)
    return _load(spark, path, versions[-1]) if versions else Manifest()


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    fs, final = _hadoop_path(spark, f"{path}/{_MANIFEST}{new.version:012d}.json")
    _, draft = _hadoop_path(spark, f"{path}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(new.__dict__).encode()))
    finally:
        stream.close()
    if not fs.rename(draft, final):
        raise RuntimeError(f"another writer made {final}")


def _drop_unused(spark: SparkSession, path: str) -> None:
    """Runs that neither of the last two manifests names: a reader of the one before may
    still be at work."""
    versions = _versions(spark, path)
    kept = versions[-2:]
    used = {r["name"] for v in kept for r in _load(spark, path, v).runs}
    fs, runs = _hadoop_path(spark, f"{path}/runs")
    for status in fs.listStatus(runs) if fs.exists(runs) else []:
        if status.getPath().getName() not in used:
            fs.delete(status.getPath(), True)
    for v in versions[:-2]:
        fs.delete(_hadoop_path(spark, f"{path}/{_MANIFEST}{v:012d}.json")[1], False)


def _read_runs(spark: SparkSession, path: str, runs: list[dict]) -> DataFrame:
    """Rows of the runs; later ones may have columns that earlier ones lack."""
    parts = [spark.read.parquet(f"{path}/runs/{r['name']}") for r in runs]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def put(batch: DataFrame, batch_id: int, path: str, keys: list[str], order_by: list[str] | None = None) -> Manifest:
    """Apply one batch: its row of a key replaces the stored one.  ``order_by`` decides among
    several rows of a key inside the batch.

    Null keys are a key; an empty batch writes nothing but its number; the same batch again
    changes nothing.
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    now = manifest(spark, path)
    if batch_id <= now.last_batch:
        return now
    rows = dedupe(batch, keys, order_by) if order_by else batch
    rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long")).persist()
    try:
        size, merged, runs = rows.count(), rows, list(now.runs)
        first = len(runs)
        if size:
            total = size
            while first and runs[first - 1]["rows"] <= RATIO * total:
                first -= 1
                total += runs[first]["rows"]
            if first < len(runs):
                both = _read_runs(spark, path, runs[first:]).unionByName(rows, allowMissingColumns=True)
                merged = dedupe(both, keys, [BATCH])
            name = f"{batch_id:012d}-{uuid.uuid4().hex}"
            # The hint gives small runs one file and large ones files of an even size.
            merged.hint("rebalance").write.option("compression", COMPRESSION).parquet(f"{path}/runs/{name}")
            written = size if merged is rows else spark.read.parquet(f"{path}/runs/{name}").count()
            runs = [*runs[:first], {"name": name, "rows": written}]
        new = Manifest(now.version + 1, batch_id, list(keys), runs)
        fs, root = _hadoop_path(spark, path)
        fs.mkdirs(root)
        _commit(spark, path, new)
    finally:
        rows.unpersist()
    _drop_unused(spark, path)
    return new


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every key."""
    path = path.rstrip("/")
    now = manifest(spark, path)
    if not now.runs:
        raise FileNotFoundError(f"no state at {path}")
    rows = _read_runs(spark, path, now.runs)
    newest = rows if len(now.runs) == 1 else dedupe(rows, now.keys, [BATCH])
    return newest.drop(BATCH)
