"""Landed files of paged feature services: GeoJSON pages, written stages, and a stream that resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "type string, numberMatched long, exceededTransferLimit boolean, properties struct<exceededTransferLimit: boolean>, features array<struct<id: long, properties: map<string, string>, geometry: string>>"


def geojson_pages(spark: SparkSession, path: str) -> DataFrame:
    """Features of FeatureCollection pages, one page a line: (page, id, properties, geometry as JSON text). Other bodies are left to ``rejected``."""
    return _pages(spark, path).filter("type = 'FeatureCollection'").select("page", F.explode("features").alias("f")).select("page", "f.*")


def _pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.sha2("value", 256).alias("page"), "value", F.from_json("value", PAGE).alias("j")).select("page", "value", "j.*")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """Pages that are not a FeatureCollection."""
    return _pages(spark, path).filter("type IS NULL OR type <> 'FeatureCollection'").select("page", F.substring("value", 1, 200).alias("body"))


def cut_off(spark: SparkSession, path: str) -> DataFrame:
    """Pages that say there is more; the flag may stand at the top or among properties."""
    return _pages(spark, path).filter(F.coalesce("exceededTransferLimit", "properties.exceededTransferLimit", F.lit(False))).select("page")


MEMBER = "`ms:feature` struct<`_gml:id`: string, `ms:objectid`: long, `ms:dataset`: string, `gml:posList`: string>"


def gml_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of GML pages, any number to a file: (gml_id, objectid, dataset, vertices). Bodies without members (ExceptionReport, HTML) give none; see ``gml_rejected``.

    ``gml:posList`` holds x and y in turn; a feature without it has no vertices.
    """
    # Files are split where members end, so their number and size don't matter; what stands before a member's start is the page around it.
    text = spark.read.option("lineSep", "</wfs:member>").text(path).filter(F.col("value").rlike(r"<wfs:member[\s>]"))
    member = F.concat(F.lit("<wfs:member"), F.substring_index("value", "<wfs:member", -1), F.lit("</wfs:member>"))
    rows = text.select(F.from_xml(member, MEMBER, {"rowTag": "wfs:member"}).alias("m")).select("m.`ms:feature`.*")
    numbers = F.filter(F.split(F.coalesce("`gml:posList`", F.lit("")), r"\s+"), lambda x: x != "")
    vertices = F.when(F.size(numbers) >= 2, F.transform(F.sequence(F.lit(0), F.size(numbers) - 2, F.lit(2)), lambda i: F.struct(F.get(numbers, i).cast("double").alias("x"), F.get(numbers, i + 1).cast("double").alias("y"))))
    return rows.select(F.col("`_gml:id`").alias("gml_id"), F.col("`ms:objectid`").alias("objectid"), F.col("`ms:dataset`").alias("dataset"), F.coalesce(vertices, F.array().cast("array<struct<x:double,y:double>>")).alias("vertices"))


def gml_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Pages (one a line) that are no feature collection."""
    return spark.read.text(path).filter(~F.col("value").contains("<wfs:FeatureCollection")).select(F.substring("value", 1, 200).alias("body"))


def write_stage(df: DataFrame, path: str, layer: str, stage: str, run_date: str) -> str:
    """Writes a stage under layer, stage and date; a second run of a day replaces that day's, and no rows still make a readable table."""
    out = f"{path}/layer={layer}/stage={stage}/run_date={run_date}"
    df.write.mode("overwrite").parquet(out)
    return out


def write_tiles(df: DataFrame, tiles: DataFrame, path: str, ledger: str, layer: str, stage: str, run_date: str) -> None:
    """Writes the rows of some tiles (column tile_id) under layer, stage, date and tile: only these tiles' folders are replaced, those of others stay.

    ``tiles`` (tile_id) are the tiles that were run; those without rows are emptied. Then one row a tile goes to the ledger (tile_id, layer, stage,
    run_date, status `ok:n` or `empty`, n), which is what counts: a run that dies before leaves no such row and is simply run again.
    """
    spark, part = df.sparkSession, ["layer", "stage", "run_date", "tile_id"]
    where = {"layer": layer, "stage": stage, "run_date": run_date}
    rows = df.join(tiles.select("tile_id").distinct(), "tile_id", "left_semi").withColumns({k: F.lit(v) for k, v in where.items()})
    rows = rows.repartition("tile_id")  # a tile's rows make one file, or few if it is split
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*part).parquet(path)
    told = read_tiles(spark, path, df.schema).filter(F.expr(" AND ".join(f"{k} = '{v}'" for k, v in where.items()))).groupBy("tile_id").agg(F.count("*").alias("n"))
    gone = told.join(df.select("tile_id").distinct(), "tile_id", "left_anti").join(tiles.select("tile_id").distinct(), "tile_id", "left_semi")
    for r in gone.toLocalIterator():  # tiles that had rows and have none now: folders, not rows
        _remove(spark, f"{path}/" + "/".join(f"{k}={v}" for k, v in where.items()) + f"/tile_id={r.tile_id}")
    counts = rows.groupBy("tile_id").agg(F.count("*").alias("n"))
    state = tiles.select("tile_id").distinct().join(counts, "tile_id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    state = state.withColumn("status", F.when(F.col("n") > 0, F.concat(F.lit("ok:"), F.col("n").cast("string"))).otherwise("empty")).withColumns({k: F.lit(v) for k, v in where.items()})
    state.withColumn("at", F.current_timestamp()).write.mode("append").parquet(ledger)


def read_tiles(spark: SparkSession, path: str, schema) -> DataFrame:
    """All tiles written so far, typed as ``schema``; an empty table is one too."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != "tile_id"]
    return spark.read.schema(", ".join([*fields, "layer string", "stage string", "run_date string", "tile_id string"])).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


PAGES = "dataset string, page long, objectid long"


def ingest_stream(spark: SparkSession, landing: str, table: str, checkpoint: str) -> None:
    """Adds landed pages (JSON lines: dataset, page, objectid) to a table once each: files already read are not read again.

    A batch is written to the folder of its number, in place of what is there, so one that is replayed after a crash is stored once.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(["dataset", "page", "objectid"]).write.mode("overwrite").parquet(f"{table}/batch={number}")

    stream = spark.readStream.schema(PAGES).json(landing)
    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, table: str) -> DataFrame:
    """(dataset, page, objectid) of all batches, once each: a page that was landed twice counts once."""
    return spark.read.schema(PAGES + ", batch long").parquet(table).select("dataset", "page", "objectid").distinct()


class PartialLoadError(RuntimeError):
    """A load that ended has fewer (or more) objects than the service told."""


def load_state(got: DataFrame, told: DataFrame) -> DataFrame:
    """Per dataset of ``told`` (dataset, expected) or ``got``: n, expected and state: `closed` where they agree or none was told, else `open`."""
    n = got.groupBy("dataset").agg(F.count_distinct("objectid").alias("n"))
    both = n.join(told, "dataset", "full").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return both.select("dataset", "n", "expected", F.when(F.col("expected").isNull() | (F.col("n") == F.col("expected")), "closed").otherwise("open").alias("state"))


def close_load(got: DataFrame, told: DataFrame) -> DataFrame:
    """``load_state`` once every dataset is closed; PartialLoadError with dataset, expected and got else."""
    state = load_state(got, told)
    if rows := state.filter("state = 'open'").orderBy("dataset").limit(20).collect():
        raise PartialLoadError("; ".join(f"{r.dataset}: expected {r.expected}, got {r.n}" for r in rows))
    return state
