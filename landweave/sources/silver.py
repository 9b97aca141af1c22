"""Tables that are validated once: the first run repairs what isn't valid, later ones read what it has left."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators import repair
from ..operators.storage import written

MARKER = "validated.json"


def _paths(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, silver: str) -> dict | None:
    """What the marker says: ``path`` to read, ``n_rows`` and ``n_fixed``; None where no run has ended or what it wrote is gone."""
    _, at, fs = _paths(spark, f"{silver}/{MARKER}")
    if not fs.exists(at):
        return None
    said = json.loads("".join(r.value for r in spark.read.text(str(at)).collect()))
    _, data, fs = _paths(spark, said["path"])
    return said if fs.exists(data) else None


def _commit(spark: SparkSession, silver: str, said: dict, force: bool) -> bool:
    """Puts the whole marker in place by one rename, which fails if there is one (unless ``force``); whether it was this run's."""
    jvm, at, fs = _paths(spark, f"{silver}/{MARKER}")
    fs.mkdirs(at.getParent())
    own = jvm.org.apache.hadoop.fs.Path(f"{silver}/.{MARKER}-{uuid.uuid4().hex}")
    out = fs.create(own, False)
    out.write(json.dumps(said).encode())
    out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE if force else option.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(own, at, options)
        return True
    except Exception as e:
        fs.delete(own, False)
        if "FileAlreadyExists" not in str(e):
            raise
        return False


def validate_once(spark: SparkSession, bronze: str, silver: str, key: str = "fid", force: bool = False) -> str:
    """The path to read for the polygons in ``bronze`` (Parquet with ``geom`` and its box): there if all are valid, else a copy under ``silver``
    in which those that weren't are repaired and all others are as they were. Those that enclose nothing are left out.

    A marker under ``silver`` tells later runs, which then write nothing. Every run writes to a folder of its own and puts the marker in place last,
    so runs may race or die: the first marker counts, and who comes second drops its copy and reads the other's. ``force`` validates anew.
    Missing input: FileNotFoundError.
    """
    jvm, at, fs = _paths(spark, bronze)
    if not fs.exists(at):
        raise FileNotFoundError(bronze)
    if not force and (said := committed(spark, silver)):
        return said["path"]
    table = spark.read.parquet(bronze)
    bad = written(repair.validity(table, key).filter("NOT is_valid").select(key), "invalid-keys")
    fixed = bad.count()
    said = {"path": f"{silver}/data-{uuid.uuid4().hex}" if fixed else bronze, "n_rows": table.count(), "n_fixed": fixed}
    if fixed:
        clean(table, bad, key).write.parquet(said["path"])
    # A marker that points to what is gone counts for nothing.
    if not _commit(spark, silver, said, force or committed(spark, silver) is None and _stale(spark, silver)):
        if fixed:
            _, own, fs = _paths(spark, said["path"])
            fs.delete(own, True)
        return committed(spark, silver)["path"]
    return said["path"]


def _stale(spark: SparkSession, silver: str) -> bool:
    _, at, fs = _paths(spark, f"{silver}/{MARKER}")
    return fs.exists(at)


def clean(table: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    return table.join(bad, key, "left_anti").unionByName(repair.repaired(table.join(bad, key, "left_semi"), key))
