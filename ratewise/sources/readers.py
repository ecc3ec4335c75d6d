"""Readers for the rating CSV files and the JSON-lines side tables.

Every reader takes an explicit schema, so JSON parsing is limited to the declared fields
(column pruning at the source) and nothing is inferred from a sample. ``min_partitions`` is the
input split hint; left unset, Spark sizes splits from ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.sources import schemas


def _split_hint(spark: SparkSession, min_partitions: int | None) -> None:
    """Ask for at least so many input splits: smaller splits, no shuffle. The hint is a setting of
    the session and holds for its later reads too."""
    if min_partitions:
        spark.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))


#: Where a row stands in its input: file, start of the split, and number within the partition, which
#: grows with the row within a split. Ordering by it is the order of the lines.
LINE = "line"


def _with_line(df: DataFrame) -> DataFrame:
    return df.withColumn(LINE, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                        F.monotonically_increasing_id().alias("row")))


def _csv(spark: SparkSession, path: str, schema, min_partitions: int | None, header: str, ordered: bool) -> DataFrame:
    """Rows without header lines. ``header="field"``: the first line of each file, and others whose first
    field is ``user_id``; ``header="line"``: every line that equals the first line of the input, fields
    split at commas without quoting. An empty id is the empty string, an id like any other. ``ordered``
    adds the column ``line``."""
    _split_hint(spark, min_partitions)
    add = _with_line if ordered else lambda df: df
    if header == "line":
        lines = add(spark.read.text(path))
        found = spark.read.text(path).head()
        df = lines.where(F.col("value") != F.lit(found[0])) if found else lines
        parts = F.split(F.col("value"), ",")
        df = df.select(*[F.get(parts, F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)],
                       *([LINE] if ordered else []))
    elif header == "field":
        df = add(spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path))
        df = df.filter(~F.col("user_id").eqNullSafe(F.lit("user_id")))
    else:
        raise ValueError(f"header must be 'field' or 'line', got {header!r}")
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("user_id", "business_id")})


def _number(c: str) -> Column:
    """The column as a double; anything but a number fails the job instead of turning NULL."""
    bad = F.raise_error(F.concat(F.lit(f"{c} is not a number: "), F.coalesce(c, F.lit("(empty)"))))
    return F.coalesce(F.trim(c).try_cast("double"), bad.cast("double"))


def read_ratings_csv(spark: SparkSession, path: str, min_partitions: int | None = None, header: str = "field",
                     ordered: bool = False) -> DataFrame:
    """``user_id,business_id,stars`` with a header row; extra columns are ignored. A rating that is
    not a number fails the read. With ``ordered`` a column ``line`` gives the order of the lines."""
    df = _csv(spark, path, schemas.RATINGS_TEXT, min_partitions, header, ordered)
    return df.withColumn("stars", _number("stars"))


def read_pairs_csv(spark: SparkSession, path: str, min_partitions: int | None = None, header: str = "field",
                   ordered: bool = False) -> DataFrame:
    """``user_id,business_id`` pairs to score; a third column (a label), if present, is ignored."""
    return _csv(spark, path, schemas.PAIRS, min_partitions, header, ordered)


def read_labelled_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Pairs with their true rating in the third column (for evaluation)."""
    return read_ratings_csv(spark, path).withColumnRenamed("stars", "label")


def _json(spark: SparkSession, schema, path: str, min_partitions: int | None) -> DataFrame:
    _split_hint(spark, min_partitions)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_business_json(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    return _json(spark, schemas.BUSINESS, path, min_partitions)


def read_user_json(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    return _json(spark, schemas.USER, path, min_partitions)


def read_checkin_json(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    return _json(spark, schemas.CHECKIN, path, min_partitions)


def read_tip_json(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    return _json(spark, schemas.TIP, path, min_partitions)
