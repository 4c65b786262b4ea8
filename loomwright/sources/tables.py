"""Readers and writers: Parquet tables, JSON and CSV files, keyed replacement and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV file with header and quotes; empty fields are null; rows without a required field are left out."""
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, quote='"', escape='"', encoding="UTF-8", enforceSchema=False)
    return df.dropna(subset=list(required)) if required else df


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Whole JSON files, one document each."""
    return spark.read.json(path, schema=schema, multiLine=True)


def read_files(spark: SparkSession, pattern: str) -> DataFrame:
    """All Parquet files and folders of files that a pattern names, with the name that it meets as `release` for each row."""
    # A file's place without scheme and host, cut at the pattern's depth.
    place = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/", "")
    name = F.split(place, "/")[spark._jvm.org.apache.hadoop.fs.Path(pattern).depth() - 1]
    return spark.read.parquet(pattern).select("*", F.url_decode(name).alias("release"))


def present(df: DataFrame, message: str) -> DataFrame:
    """df, a lookup's few rows; running it fails with the message if there is none."""
    n = df.agg(F.count(F.lit(1)).alias("_n")).select(F.when(F.col("_n") > 0, True).otherwise(F.raise_error(F.lit(message)).cast("boolean")).alias("_some"))
    return n.join(df, F.col("_some"), "left").drop("_some")


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with header; arrays are joined by '; ' in sorted, distinct form."""
    joined = [F.array_join(F.array_sort(F.array_distinct(c)), "; ").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes]
    df.select(*joined).write.csv(path, header=True, quoteAll=True, escape='"')


def archive(df: DataFrame, path: str, *partitions: str) -> None:
    """Append to a Parquet archive in folders by the given columns; rows of a folder are brought together first."""
    df.repartition(*partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def keyed_replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def delete_keys(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """old without the rows whose keys are in gone."""
    return old.join(gone.select(*keys), keys, "left_anti")


def update_where(old: DataFrame, test: Column, **values: Column) -> DataFrame:
    """old with new values in the rows that meet the test; a null test is none."""
    return old.select(*[F.when(test, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in old.columns])


def merge_upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_first: tuple[str, ...] = ()) -> DataFrame:
    """new over old by key, nulls too; of the columns in keep_first the smaller value stays. new must have each key once."""
    sides = old.alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), keys, "full_outer")
    known = F.col("n._new").isNotNull()

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in keep_first:
            return F.least(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)
        return F.when(known, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return sides.select(*[merged(c) for c in old.columns])
