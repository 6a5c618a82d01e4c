"""Rebuild of play tables as raw game documents arrive: a file stream whose checkpoint knows what was read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.games import GAME, exists


def stream_games(spark: SparkSession, raw_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """New game documents under ``raw_dir``; final documents don't change, so a file is read once."""
    return spark.readStream.schema(GAME).option("multiLine", True).option(
        "maxFilesPerTrigger", files_per_trigger
    ).option("recursiveFileLookup", True).json(raw_dir).selectExpr("*", "_metadata.file_name AS file_name")


def rebuild(games: DataFrame, build: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str) -> StreamingQuery:
    """Writes the plays of the games that arrived, replacing the partitions of these games only, so a repeated batch
    gives the same table."""

    def write(batch: DataFrame, _: int) -> None:
        build(batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("season", "game_id").parquet(out_dir)

    return games.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---- upserts that can be run again ----------------------------------------------------------------------------------


def _source(spark: SparkSession) -> str:
    """The stream that runs the batch; it keeps its id as long as it keeps its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _note(games: DataFrame, out_dir: str, name: str) -> None:
    """The batch's row for each game, written last: what has none doesn't count."""
    games.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/manifest/batch={name}")


def upsert_batch(batch: DataFrame, number: int, build: Callable[[DataFrame], DataFrame], out_dir: str) -> None:
    """Writes the plays of a batch's games, packed by season, and then its games to the manifest. A batch that died on the
    way left plays without a manifest, which no reader sees; run again, it replaces them."""
    spark = batch.sparkSession
    name = f"{_source(spark)}-{number}"
    path = f"{out_dir}/plays/batch={name}"
    build(batch).withColumn("plays_of", F.col("season")).repartition("plays_of").write.mode("overwrite").partitionBy("plays_of").parquet(path)
    counts = spark.read.parquet(path).groupBy("game_id").agg(F.count(F.lit(1)).alias("n_plays")) if exists(spark, f"{path}/_SUCCESS") else None
    games = batch.select("game_id", "season").distinct()
    counted = games.join(counts, "game_id", "left") if counts is not None else games.withColumn("n_plays", F.lit(None).cast("long"))
    at = F.lit(spark.sql("SELECT current_timestamp()").first()[0])
    _note(counted.select("game_id", "season", F.coalesce("n_plays", F.lit(0)).alias("n_plays"), at.alias("written_at"), F.lit(number).cast("long").alias("number")), out_dir, name)


def upserts(games: DataFrame, build: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str) -> StreamingQuery:
    """:func:`upsert_batch` for each batch of a stream of games (with game_id)."""
    return games.writeStream.foreachBatch(lambda batch, number: upsert_batch(batch, number, build, out_dir)).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()


def manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """(game_id, season, n_plays, written_at, number, batch): of each game the batch that wrote it last."""
    rows = spark.read.option("basePath", f"{out_dir}/manifest").schema(
        "game_id string, season int, n_plays long, written_at timestamp, number long, batch string"
    ).parquet(f"{out_dir}/manifest")
    latest = F.max_by(F.struct(*(c for c in rows.columns if c != "game_id")), F.struct("written_at", "number", "batch")).alias("r")
    return rows.groupBy("game_id").agg(latest).select("game_id", "r.*")


def current_plays(spark: SparkSession, out_dir: str, schema: StructType | None = None) -> DataFrame:
    """The plays of each game as the batch that wrote it last has them."""
    reader = spark.read.option("basePath", f"{out_dir}/plays")
    rows = (reader.schema(schema) if schema is not None else reader).parquet(f"{out_dir}/plays")
    return rows.join(manifest(spark, out_dir).select("game_id", "batch"), ["game_id", "batch"], "left_semi").drop("batch", "plays_of")


def compact(spark: SparkSession, out_dir: str, into: str) -> int:
    """Writes the plays that count now, packed by season, with a manifest of one batch to ``into``, a new folder that can take the
    place of ``out_dir``; returns the number of games."""
    current_plays(spark, out_dir).withColumn("plays_of", F.col("season")).repartition("plays_of").write.mode("overwrite").partitionBy("plays_of").parquet(
        f"{into}/plays/batch=compact"
    )
    games = manifest(spark, out_dir).drop("batch")
    _note(games, into, "compact")
    return spark.read.parquet(f"{into}/manifest").count()
