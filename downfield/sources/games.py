"""Nested game documents and payloads, read with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import once
from ..operators.joins import first_of, present

STAT = "STRUCT<statType:INT, yards:DOUBLE, gsisPlayerId:STRING, gsisPlayerName:STRING, teamId:STRING>"
PLAY = (
    "STRUCT<playId:STRING, playSequenceNumber:DOUBLE, playType:STRING, specialTeamsPlayType:STRING, quarter:INT, clockTime:STRING, down:INT, yardsRemaining:INT, "
    "yardLine:STRING, yardsGained:INT, playDescription:STRING, playIsGoalToGo:BOOLEAN, playDeleted:BOOLEAN, playScored:BOOLEAN, scoringPlayType:STRING, "
    f"scoringTeamId:STRING, stats:ARRAY<{STAT}>>"
)
_SIDE, _SUM = "STRUCT<teamId:STRING, currentLogo:STRING>", "STRUCT<teamId:STRING, score:STRUCT<total:INT>>"
#: Schema of a game document.
GAME = (
    f"season INT, week INT, seasonType STRING, homeTeam {_SIDE}, awayTeam {_SIDE}, summary STRUCT<homeTeam:{_SUM}, awayTeam:{_SUM}>, "
    f"driveChart STRUCT<drives:ARRAY<STRUCT<teamId:STRING, startedPlaySequenceNumber:DOUBLE, endedPlaySequenceNumber:DOUBLE>>, plays:ARRAY<{PLAY}>>"
)


def read_games(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A row for each game document; ``game_id`` is the file's stem."""
    raw = spark.read.schema(GAME).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return raw.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("game_id"))


#: Why a document is no game: Spark SQL conditions on a row read with ``_broken``, and what is said of it.
FAULTS = (
    ("_broken is not null", "broken JSON"), ("season is null", "no season"), ("homeTeam is null or awayTeam is null", "a team is missing"),
    ("coalesce(rtrim('/', homeTeam.currentLogo), '') = '' or coalesce(rtrim('/', awayTeam.currentLogo), '') = ''", "a team has no logo"),
    ("driveChart is null", "no drive chart"),
)


def checked_games(spark: SparkSession, path: str | Sequence[str], aside: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables: the games as :func:`read_games` has them, and (file_name, fault, document) of files that hold none.

    Reading the games raises an error that names the file as soon as such a file is met; with ``aside`` it leaves them out
    instead, for the caller to store the second table. An empty file is no document and gives a row in neither."""
    raw = spark.read.schema(f"{GAME}, _broken STRING").option("multiLine", True).option("recursiveFileLookup", True).option(
        "columnNameOfCorruptRecord", "_broken"
    ).option("pathGlobFilter", "*.json").json(path)
    fault = F.coalesce(*(F.when(F.expr(condition), said) for condition, said in FAULTS))
    rows = raw.select("*", F.col("_metadata.file_name").alias("file_name"), fault.alias("fault"))
    bad = rows.where("fault is not null").select(
        "file_name", "fault", F.coalesce("_broken", F.to_json(F.struct(*(c for c in raw.columns if c != "_broken")))).alias("document")
    )
    game_id = F.regexp_replace("file_name", r"\.json$", "")
    if aside:
        games = rows.where("fault is null").withColumn("game_id", game_id)
    else:
        message = F.concat("file_name", F.lit(": "), "fault")
        games = rows.withColumn("game_id", F.when(F.col("fault").isNotNull(), F.raise_error(message)).otherwise(game_id))
    return games.drop("_broken", "file_name", "fault"), bad


def season_games(spark: SparkSession, root: str, season: int, ids: Sequence[str] | None = None) -> DataFrame:
    """Games of one season from files ``season_*.json``; with ``ids`` only these. Only matching files are opened."""
    raw = spark.read.schema(GAME).option("multiLine", True).option("recursiveFileLookup", True).option(
        "pathGlobFilter", f"{season}_*.json"
    ).json(root)
    rows = raw.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("game_id"))
    return rows if ids is None else rows.where(F.col("game_id").isin(*ids))


def library_files(spark: SparkSession, root: str, suffix: str = ".json") -> DataFrame:
    """(game_id, size) of a library's files, sorted; other files aren't listed and none is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size")
    )
    return files.where(F.endswith("name", F.lit(suffix))).select(
        F.substring("name", F.lit(1), F.length("name") - len(suffix)).alias("game_id"), "size"
    ).orderBy("game_id")


def split_games(payload: DataFrame, root: str, column: str = "value") -> int:
    """Writes each game of weekly payloads under ``root/game_id=...`` and returns how many; games without an id or with one
    that another game has are an error, and nothing is written."""
    rows = weekly_games(payload, column)
    bad = rows.groupBy("game_id").agg(F.count(F.lit(1)).alias("n")).where("game_id is null or n > 1").limit(5).collect()
    if bad:
        raise ValueError(f"game ids that are null or repeat: {', '.join(str(r.game_id) for r in bad)}")
    rows.write.partitionBy("game_id").mode("overwrite").text(root)
    return rows.count()


def store_new(payload: DataFrame, root: str, column: str = "value") -> int:
    """Appends the games of weekly payloads that the library under ``root`` doesn't have yet, one folder a game, and
    returns how many: run again, it writes nothing. Of a game that comes twice the longer document stays."""
    spark = payload.sparkSession
    rows = weekly_games(payload, column).where("game_id is not null").groupBy("game_id").agg(
        F.max_by("game", F.struct(F.length("game"), "game")).alias("game")
    )
    if exists(spark, root):
        rows = wanted_not_cached(rows, read_library(spark, root))
    new = rows.persist()
    try:
        found = new.count()  # before the write, which makes Spark read the library, and so the new games, again
        new.select("game", "game_id").write.partitionBy("game_id").mode("append").text(root)
        return found
    finally:
        new.unpersist()


def read_library(spark: SparkSession, root: str) -> DataFrame:
    """(game, game_id) of a library: the document as text. Without a look at ``game`` only folder names are read."""
    return spark.read.schema("value string, game_id string").text(root).withColumnRenamed("value", "game")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_schedule(spark: SparkSession, path: str) -> DataFrame | None:
    """game_id and those of roof, spread_line and total_line that the table at ``path`` has; None without a table, for
    ``plans.plays.build_plays`` to go on without."""
    if not exists(spark, path):
        return None
    rows = spark.read.parquet(path)
    facts = [c for c in ("roof", "spread_line", "total_line") if c in rows.columns]
    rows = rows.select("game_id", *facts)
    return first_of(rows, ["game_id"], facts) if facts else rows.distinct()


def weekly_games(payload: DataFrame, column: str = "value") -> DataFrame:
    """Games of weekly payloads (JSON text), which are lists or objects with ``games`` or ``data``: (game, game_id), the
    id from the first of id, nflId and gameId."""
    games = F.coalesce(
        *(
            F.from_json(F.when(cond, F.get_json_object(column, path)), "array<string>")
            for cond, path in ((~F.startswith(F.ltrim(column), F.lit("{")), "$"), (F.lit(True), "$.games"), (F.lit(True), "$.data"))
        )
    )
    rows = payload.select(F.explode(games).alias("game"))
    return rows.withColumn("game_id", F.coalesce(*(F.get_json_object("game", f"$.{k}") for k in ("id", "nflId", "gameId"))))


def wanted_not_cached(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """Ids that are still to fetch: what a resumed ingest asks for."""
    return present(wanted, cached, ["game_id"], there=False)


def season_range(text: str) -> list[int]:
    """``A`` or ``A:B``, both ends included."""
    first, _, last = text.partition(":")
    low, high = int(first), int(last or first)
    if high < low:
        raise ValueError(f"{text}: the range ends before it begins")
    return list(range(low, high + 1))


def season_values(values: Sequence[int]) -> list[int]:
    """Two values are a range with both ends; one, or three and more, are a list."""
    if len(values) == 2:
        return season_range(f"{values[0]}:{values[1]}")
    return sorted(set(values))


def week_calendar(payload: DataFrame, column: str = "value") -> DataFrame:
    """(week) of payloads ``{"weeks": [{"week": ...}]}``, sorted, once each; what is no whole number is left out."""
    weeks = F.from_json(F.get_json_object(column, "$.weeks"), "array<struct<week:string>>")
    return payload.select(F.explode(weeks).alias("w")).select(
        F.col("w.week").try_cast("int").alias("week")
    ).where("week is not null").distinct().orderBy("week")


def regular_weeks(calendar: DataFrame) -> Column:
    """Length of the regular season from (week, weekType) rows; 18 if they don't tell."""
    return F.coalesce(F.max(F.when(F.col("weekType") == "REG", F.col("week").try_cast("int"))), F.lit(18))


def raw_url(base: str, season: Column, game_id: Column) -> Column:
    return F.format_string(f"{base}/%d/%s.json", season, game_id)


def game_id_of(season: Column, week: Column, season_type: Column, away: Column, home: Column) -> Column:
    """``season_week_away_home``; weeks of the postseason follow those of the regular season."""
    shift = F.when(season_type == "POST", F.when(season <= 2020, 17).otherwise(18)).otherwise(0)
    return F.format_string("%d_%02d_%s_%s", season, week + shift, away, home)


#: Fixed values: (name now, name before, last season of the old name).
MOVES = (("LA", "STL", 2015), ("LAC", "SD", 2016), ("LV", "OAK", 2019))


def team_of(logo: Column, season: Column) -> Column:
    """Team from the last part of a logo's URL, under the name it had in ``season``."""

    def at_the_time(name: Column) -> Column:
        out = F.when(name == "AZ", "ARI").when(name == "", F.lit(None).cast("string"))
        for now, before, last in MOVES:
            out = out.when((name == now) & (season <= last), before)
        return out.otherwise(name)

    return once(F.substring_index(F.regexp_replace(logo, "/+$", ""), "/", -1), at_the_time)
