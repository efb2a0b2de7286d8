"""Packages of JSON lines with a checksum inventory, and the readers around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines under an explicit schema; a broken line is an error, or with ``strict`` off a row with its text in ``_corrupt``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    full = T.StructType([*full.fields, T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with keys in alphabetical order, nulls kept."""
    df.select(*sorted(df.columns)).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def checksums(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(name, bytes, sha256) of the files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    name = F.regexp_replace("path", f"^.*?{root.rstrip('/').split('/')[-1]}/", "")
    return files.select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(actual: DataFrame, recorded: DataFrame) -> DataFrame:
    """(name, problem): missing, extra, changed or recorded twice; no rows if a package is whole."""
    twice = recorded.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("sha256").alias("want"))
    both = twice.join(actual.select("name", F.col("sha256").alias("have")), "name", "full_outer")
    problem = F.when(F.col("n") > 1, "duplicate").when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("want") != F.col("have"), "changed")
    return both.select("name", problem.alias("problem")).where("problem is not null")


#: Shape of a page-wise recognition result.
OCR_RESULT = "layoutParsingResults array<struct<prunedResult:struct<parsing_res_list:array<struct<block_label:string,block_content:string,block_bbox:array<double>>>>>>"


def read_ocr_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, block_index, block_label, text, bbox) of recognition results; pages and blocks count from 0."""
    raw = spark.read.schema(OCR_RESULT).option("multiLine", "true").option("recursiveFileLookup", "true").json(path).withColumn("path", F.input_file_name())
    pages = raw.select("path", F.posexplode("layoutParsingResults").alias("page", "p"))
    blocks = pages.select("path", "page", F.posexplode("p.prunedResult.parsing_res_list").alias("block_index", "b"))
    return blocks.select("path", "page", "block_index", "b.block_label", F.col("b.block_content").alias("text"), F.col("b.block_bbox").alias("bbox"))


def inspect_pdf(files: DataFrame, least_bytes: int = 1024) -> DataFrame:
    """(path, pages, problem) of binary files: too small, no header, no end mark in the last 2 KiB, or sound."""
    body = F.decode("content", "ISO-8859-1")
    tail = F.substring("content", -2048, 2048).cast("string")
    problem = (
        F.when(F.length("content") < least_bytes, "too_small")
        .when(F.substring("content", 1, 4).cast("string") != "%PDF", "no_header")
        .when(~F.contains(tail, F.lit("%%EOF")), "no_end")
    )
    return files.select("path", F.regexp_count(body, F.lit(r"/Type\s*/Page[^s]")).alias("pages"), problem.alias("problem"))


def parse_jsonp(col: F.Column, schema: str) -> F.Column:
    """A JSON object, bare or in a callback; null for anything else."""
    inner = F.regexp_extract(col, r"(?s)^\s*(?:[\w$.]+\s*\()?\s*(\{.*\})\s*\)?\s*;?\s*$", 1)
    return F.when(inner != "", F.from_json(inner, schema))


def abstract_from_index(col: F.Column) -> F.Column:
    """A text from a map of words to their positions."""
    pairs = F.flatten(F.transform(F.map_entries(col), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.concat_ws(" ", F.transform(F.array_sort(pairs), lambda x: x["w"]))
