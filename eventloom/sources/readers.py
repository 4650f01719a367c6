"""Sources: stories, dimensions, dictionaries, dumps; every schema is declared, and a row that breaks it fails the read."""

from __future__ import annotations

import io
import warnings
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STORY = "id string, date string, pub_date string, event_text string, headline string, publisher string, story_id string, version string, event_type array<string>, event_mode array<string>, contexts array<string>"
COUNTRY = "CCA2 string, Name string, CCA3 string, Nationality string"
CODEBOOK = "event string, event_def string, mode string, mode_def string, extraction_notes string"
ARTICLE = "title string, short_desc string, intro_para string, alternative_names array<string>, redirects array<string>, affiliated_people array<string>, box_type string, infobox map<string,string>, categories array<string>, update date"
PAGE = "title string, revision struct<text:struct<_VALUE:string,_bytes:long>>"


def require_columns(df: DataFrame, required: list[str], wanted: list[str] = ()) -> DataFrame:
    """df, if it has all required columns; a missing wanted one is a warning."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    for c in wanted:
        if c not in df.columns:
            warnings.warn(f"column {c} is missing", stacklevel=2)
    return df


def read_stories(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Stories of JSON lines with doc_position; with most over 0 the first so many.

    Positions follow the files' order: the number of rows in earlier partitions and the place within one.
    """
    rows = spark.read.schema(STORY).option("mode", "FAILFAST").json(path).withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = rows.withColumn("_part", part).join(F.broadcast(bases), "_part") if counts.count() <= 100_000 else rows.withColumn("_part", part).join(bases, "_part")
    stories = placed.withColumn("doc_position", F.col("base") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "base")
    return stories.orderBy("doc_position").limit(most) if most and most > 0 else stories


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, name, code, nationality) of a country CSV with header."""
    rows = require_columns(spark.read.schema(COUNTRY).option("header", True).option("mode", "FAILFAST").csv(path), ["Name", "CCA3", "Nationality"])
    return rows.select(F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).alias("ordinal"), F.col("Name").alias("name"), F.col("CCA3").alias("code"), F.col("Nationality").alias("nationality"))


def country_lookup(countries: DataFrame) -> DataFrame:
    """(code, name) for looking names up, with the empty code and intergovernmental organizations."""
    spark = countries.sparkSession
    fixed = spark.createDataFrame([("", ""), ("IGO", "Intergovernmental Organization")], "code string, name string")
    return countries.groupBy("code").agg(F.min_by("name", "ordinal").alias("name")).unionByName(fixed)


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    """The codebook CSV with the order of its rows; event and event_def must be there, mode and extraction_notes should."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    require_columns(rows, ["event", "event_def"], ["mode", "extraction_notes"])
    full = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in ("mode", "mode_def", "extraction_notes") if c not in rows.columns])
    return full.withColumn("ordinal", F.monotonically_increasing_id())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of a text file, numbered in order: the agent dictionary's source."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), "value")


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(title, text) of each page of an XML dump, plain or compressed; pages without a title or revision are left out, a null text is empty."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    return pages.where("title is not null and revision is not null").select("title", F.coalesce("revision.text._VALUE", F.lit("")).alias("text"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles of a Parquet knowledge base; one without redirects fails, as it was built before those were joined."""
    return require_columns(spark.read.parquet(path), ["title", "intro_para", "redirects"], ["short_desc", "infobox"])


def latest_version(spark: SparkSession, folder: str, prefix: str) -> str | None:
    """The path with the highest number after prefix in a folder of any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    found = [(int(n[len(prefix) :]), n) for n in (s.getPath().getName() for s in listed) if n.startswith(prefix) and n[len(prefix) :].isdigit()]
    return f"{folder}/{max(found)[1]}" if found else None


def read_zipped_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the CSV files inside zip archives. An archive can't be split, so each is unpacked by one task, line by line."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for content in (c for f in frames for c in f["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in archive.namelist():
                    if name.endswith(".csv"):
                        with archive.open(name) as member:
                            yield from (c[columns] for c in pd.read_csv(member, dtype=str, chunksize=10_000))

    columns = [f.split()[0] for f in schema.split(", ")]
    texts = ", ".join(f"{c} string" for c in columns)
    rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpack, texts)
    return rows.selectExpr(*[f"cast({c} as {f.split()[1]}) as {c}" for c, f in zip(columns, schema.split(", "))])


def codes_valid_in(rows: DataFrame, when: Column) -> DataFrame:
    """Country codes whose validity interval (valid_from, valid_until, open if null) holds the year when."""
    return rows.where((F.coalesce("valid_from", F.lit(-9999)) <= when) & (F.coalesce("valid_until", F.lit(9999)) >= when))
