"""Sources and sinks of flat tables: contract checks, dataset files, manifests, digests."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import upsert
from .games import exists


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df``, if it has all ``columns`` and a row; else a ValueError that names what is missing."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df


def write_checked(
    df: DataFrame, path: str, columns: Iterable[str] = (), complete: Iterable[str] = (), per: str | None = None,
    partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> dict[str, int]:
    """Writes ``df`` as Parquet and returns what was seen on the way: ``rows``, ``null:c`` of each of ``columns``, and about
    how many values of ``per`` there are. The metrics are taken while the rows are written, so nothing is counted twice.

    A ValueError names ``columns`` that are missing before anything is written. If the table turns out to have no row, or
    nulls in ``complete``, what was written is deleted and a ValueError names the columns."""
    columns, complete = list(columns), list(complete)
    missing = sorted({*columns, *complete, *([per] if per else [])} - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in dict.fromkeys([*columns, *complete]))]
    if per:
        counts.append(F.approx_count_distinct(per).alias(per))
    df.observe(seen, *counts).write.mode(mode).partitionBy(*partition_by).parquet(path)
    found = {k: int(v or 0) for k, v in seen.get.items()}
    empty = [c for c in complete if found[f"null:{c}"]]
    if not found["rows"] or empty:
        if mode == "overwrite":
            remove(df.sparkSession, path)
        raise ValueError("the table has no rows" if not found["rows"] else f"nulls in: {', '.join(empty)}")
    return found


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def store_by_game(df: DataFrame, name: str, path: str, buckets: int, order: Sequence[str] = ("play_seq", "feed_pos")) -> DataFrame:
    """``df`` as the table ``name`` at ``path`` in ``buckets`` of game_id, sorted by game and play: windows over a game or a part
    of it, and joins by game, then read it without a shuffle. Choose as many buckets as a bucket shall fit a task."""
    spark = df.sparkSession
    rows = df.repartition(buckets, "game_id")  # one file a bucket
    rows.write.mode("overwrite").bucketBy(buckets, "game_id").sortBy("game_id", *(c for c in order if c in df.columns)).option("path", path).saveAsTable(name)
    return spark.table(name)


def joined_by_game(spark: SparkSession) -> None:
    """Lets joins on game_id and more columns use buckets of game_id alone; a setting of the session."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def read_seasons(spark: SparkSession, root: str, seasons: Sequence[int]) -> DataFrame:
    """Tables of seasons in ``root/season=N``; a season without a table is an error. Only these partitions are read."""
    paths = {s: f"{root}/season={s}" for s in seasons}
    missing = [s for s, path in paths.items() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"no table of seasons {', '.join(map(str, missing))} in {root}")
    return spark.read.option("basePath", root).parquet(*paths.values())


def from_source(source: str, readers: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """The table of the reader that ``source`` names; another name is an error."""
    if source not in readers:
        raise ValueError(f"{source}: the source has to be one of {', '.join(sorted(readers))}")
    return readers[source]()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def list_text(c: Column | str) -> Column:
    """A nested column as JSON; null if it is empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.size(c) > 0, F.to_json(c))


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as text, for formats that know none."""
    nested = {n for n, kind in df.dtypes if kind.startswith(("array", "map", "struct"))}
    return df.select(
        *(
            (list_text(n) if dict(df.dtypes)[n].startswith(("array", "map")) else F.to_json(n)).alias(n) if n in nested else F.col(n)
            for n in df.columns
        )
    )


def write_dataset(df: DataFrame, root: str, name: str) -> bool:
    """``df`` as Parquet and gzipped CSV under ``root``; nothing and False if it has no rows."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(f"{root}/parquet/{name}")
    flat_columns(df).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(f"{root}/csv/{name}")
    return True


def update_manifest(old: DataFrame | None, season: int, data: DataFrame) -> DataFrame:
    """(season, row_count, generated_at_utc) with the row of ``season`` replaced, sorted."""
    new = data.agg(
        F.lit(season).cast("int").alias("season"), F.count(F.lit(1)).alias("row_count"),
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("string").alias("generated_at_utc")
    )
    return (upsert(old, new, ["season"]) if old is not None else new).orderBy("season")


def digested(df: DataFrame, content: str) -> DataFrame:
    """``df`` with ``size`` in bytes and ``sha256`` in place of the column ``content`` (bytes or text); null gives nulls."""
    facts = (F.octet_length(content).cast("long").alias("size"), F.sha2(content, 256).alias("sha256"))
    return df.select(*(c for c in df.columns if c != content), *facts)


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, size, sha256) of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return digested(files.select(F.substring_index("path", "/", -1).alias("name"), "content"), "content")


def artifact_plan(spark: SparkSession, path: str, suffix: str = ".ubj") -> DataFrame:
    """Model files and, of the same stem, their cards (null without one)."""
    names = spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("name"))
    stem = F.regexp_replace("name", r"\.[^.]+$", "")
    models = names.where(F.endswith("name", F.lit(suffix))).select(stem.alias("stem"), F.col("name").alias("model"))
    cards = names.where(F.endswith("name", F.lit(".json"))).select(stem.alias("stem"), F.col("name").alias("card"))
    return models.join(cards, "stem", "left").select("model", "card").distinct().orderBy("model")
