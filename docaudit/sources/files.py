"""Readers and writers: JSON, JSON lines, CSV and binary files, result folders, caches by key."""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docaudit.functions.html import decode_bytes, parse_html

#: Names under which a manifest may give the path and the id of a sample (fixed values).
PATH_NAMES = ("path", "candidate_path", "html_path", "file_path")
ID_NAMES = ("sample_id", "id")


def _exists(spark: SparkSession, path: str) -> bool:
    if "://" in path:
        jvm = spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        return found is not None and len(found) > 0
    return bool(glob.glob(path))


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per file, with the file it came from; what does not parse has nulls and its text in ``_corrupt``."""
    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    shape = T.StructType([*shape.fields, T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(shape).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("source_file", F.col("_metadata.file_path"))


def read_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; blank lines are skipped, a byte order mark is tolerated, a missing path gives no rows."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    text = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("value")).where(F.trim("value") != "")
    return text.select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV or JSON-lines manifest with ``path`` and ``sample_id`` taken from whichever names it uses; a row without a path raises."""
    csv = path.lower().endswith(".csv")
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path) if csv else spark.read.json(path)
    rows = rows.toDF(*(c.lstrip("﻿") for c in rows.columns))
    pick = lambda names: F.coalesce(*(F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in rows.columns), F.lit(None).cast("string"))
    place = pick(PATH_NAMES)
    return rows.withColumn("path", F.when(place.isNull(), F.raise_error(F.lit("manifest row without a path"))).otherwise(place)).withColumn("sample_id", pick(ID_NAMES))


def read_results(spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str = "*.json", required: list[str] | None = None) -> DataFrame:
    """All result files below a folder, in the order of their paths; unreadable ones and those without a required field are left out."""
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("mode", "DROPMALFORMED")
    rows = reader.json(folder).withColumn("source_file", F.col("_metadata.file_path"))
    for c in required or []:
        rows = rows.where(F.col(c).isNotNull())
    return rows.orderBy("source_file")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML files as ``source_file, size, text, encoding, fallback_used, page``: decoded by fallback and parsed once."""
    raw = spark.read.format("binaryFile").load(path)
    decoded = raw.select(F.col("path").alias("source_file"), F.col("length").alias("size"), decode_bytes("content").alias("d"))
    return decoded.select("source_file", "size", "d.*").withColumn("page", parse_html("text"))


def embedded_json(html: F.Column, marker: str, schema: T.StructType | str) -> F.Column:
    """JSON that a page carries behind a marker, up to the end of its script."""
    return F.from_json(F.regexp_extract(html, rf"(?s){marker}\s*(.*?)\s*;?\s*</script>", 1), schema)


def expand_jobs(config: DataFrame, discovered: DataFrame, most: int) -> DataFrame:
    """Download jobs of a config ``(institution, url, kind)``: direct files as they are, landing pages as up to
    ``most`` of their ``discovered (source_url, url, ordinal)`` links, each url once."""
    direct = config.where("kind = 'direct_pdf'").select("institution", "url", F.col("url").alias("source_url"))
    landing = config.where("kind = 'landing_page'").select("institution", F.col("url").alias("source_url"))
    few = discovered.where(F.col("ordinal") <= most)
    return direct.unionByName(landing.join(few, "source_url").select("institution", "url", "source_url")).dropDuplicates(["institution", "url"])


def flat(df: DataFrame, joiner: str = ";") -> DataFrame:
    """Columns that CSV can hold: arrays joined, structs and maps as JSON."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, joiner)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat(df).write.mode(mode).option("header", True).csv(path)


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Parquet in folders by value; rows of a value are put together first, so that each folder has few files."""
    df.repartition(*by).write.mode(mode).partitionBy(*by).parquet(path)


def write_markdown(rows: DataFrame, path: str, title: str, most: int = 200) -> None:
    """A small report table for people; reports are summaries, so at most ``most`` rows reach the driver."""
    names = rows.columns
    body = ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in flat(rows).limit(most).collect()]
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join([f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "---|" * len(names), *body, ""]))


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key has no result yet: run these, append their results, and a broken run resumes."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")
