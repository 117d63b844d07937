"""Scans of the public rating-dump layout (CSV with a header) or of Parquet, always
with a fixed schema: no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph import schemas


MALFORMED = "_malformed"


def _csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """The file's rows, and the raw line of those that do not parse in MALFORMED."""
    with_line = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])
    reader = (spark.read.schema(with_line).option("header", header).option("quote", '"')
              .option("escape", '"').option("mode", "PERMISSIVE").option("encoding", "UTF-8")
              .option("columnNameOfCorruptRecord", MALFORMED)
              .option("columnPruning", False))  # a row is judged whole, whatever columns are asked for
    # the header must name the columns
    return (reader.option("enforceSchema", False) if header else reader).csv(path)


def _checked(rows: DataFrame, needed: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``reason`` and ``line``). A row is rejected where it does not
    parse (too few or many fields, a field of another type) or lacks a needed column."""
    reason = F.when(F.col(MALFORMED).isNotNull(), "malformed")
    for column, name in needed.items():
        reason = reason.when(F.col(column).isNull(), f"no {name}")
    fields = [c for c in rows.columns if c != MALFORMED]
    tagged = rows.withColumn("reason", reason)
    line = F.coalesce(F.col(MALFORMED), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]))
    return (tagged.where(F.col("reason").isNull()).select(*fields),
            tagged.where(F.col("reason").isNotNull()).select("reason", line.alias("line")))


def path_exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_ratings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """user_id, item_id, rating, ts (seconds since the epoch -> timestamp)."""
    if fmt == "parquet":
        return spark.read.schema(schemas.RATINGS).parquet(path)
    return checked_ratings(spark, path)[0]


def checked_ratings(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The accepted ratings, and the rejected rows of the CSV file (reason, line), which the caller may
    count or write; both are scans of the same file."""
    good, bad = _checked(_csv(spark, path, schemas.RATINGS_CSV, header),
                         {"userId": "user_id", "movieId": "item_id", "rating": "rating"})
    return good.select(F.col("userId").alias("user_id"), F.col("movieId").alias("item_id"),
                       "rating", F.timestamp_seconds("timestamp").alias("ts")), bad


def read_items(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """item_id, title, genres (bar-joined; quoted titles with commas are kept whole)."""
    if fmt == "parquet":
        return spark.read.schema(schemas.ITEMS).parquet(path)
    return checked_items(spark, path)[0]


def checked_items(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    good, bad = _checked(_csv(spark, path, schemas.ITEMS_CSV, header), {"movieId": "item_id"})
    return good.select(F.col("movieId").alias("item_id"), "title", "genres"), bad


def read_links(spark: SparkSession, path: str | None, fmt: str = "csv") -> DataFrame:
    """item_id, imdb ('' when blank), tmdb (null when blank or not a number). A
    missing table (path None, or no file there) is an empty relation."""
    if path is None or not path_exists(spark, path):
        return spark.createDataFrame([], schemas.LINKS)
    if fmt == "parquet":
        return spark.read.schema(schemas.LINKS).parquet(path)
    return checked_links(spark, path)[0]


def checked_links(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    good, bad = _checked(_csv(spark, path, schemas.LINKS_CSV, header), {"movieId": "item_id"})
    return good.select(
        F.col("movieId").alias("item_id"),
        F.coalesce(F.trim(F.col("imdbId")), F.lit("")).alias("imdb"),
        F.nullif(F.trim(F.col("tmdbId")), F.lit("")).try_cast("long").alias("tmdb"),
    ), bad
