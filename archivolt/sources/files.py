"""Files in and out: folder listings, CSV in the archive's layouts, pages from PDF files.

Reading the pages of a PDF needs a library that isn't part of this package, so
``read_pages`` takes an extractor (bytes -> list of page texts or null) and runs
it in Arrow batches on the executors. An extractor's exception becomes the row's
``error`` instead of vanishing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.functions.text import strip

HITS = T.StructType([T.StructField(n, t) for n, t in (("folder", T.StringType()), ("filename", T.StringType()), ("page", T.IntegerType()), ("keyword", T.StringType()), ("context", T.StringType()))])
CRAWL_HITS = T.StructType([T.StructField(n, t) for n, t in (("folder", T.StringType()), ("keyword", T.StringType()), ("filename", T.StringType()), ("page", T.IntegerType()), ("context", T.StringType()))])
FILE_KEYWORD = T.StructType([T.StructField("File Name", T.StringType()), T.StructField("Keyword", T.StringType())])

_CSV = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}


def list_files(spark: SparkSession, root: str, folders: str = "DS-*", files: str = "*.pdf") -> DataFrame:
    """``path, folder, filename, length`` of the files in the root's folders; one level deep, case counts. Files of no bytes aren't listed."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).load(f"{root}/{folders}")
    parts = F.split("path", "/")
    return found.select("path", F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("filename"), "length")


def read_pages(spark: SparkSession, root: str, extract: Callable[[bytes], list[str] | None], folders: str = "DS-*", files: str = "*.pdf") -> DataFrame:
    """``folder, filename, pages, error`` by an extractor; null pages where it finds no text layer."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", files).load(f"{root}/{folders}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    pages, error = extract(content), None
                except Exception as e:  # any extractor may fail in its own way
                    pages, error = None, f"{type(e).__name__}: {e}"
                rows.append((*path.split("/")[-2:], pages, error))
            yield pd.DataFrame(rows, columns=["folder", "filename", "pages", "error"])

    return raw.select("path", "content").mapInPandas(run, "folder string, filename string, pages array<string>, error string")


def ocr_missing(pages: DataFrame, ocr: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Two paths in one plan: rows that need OCR go through ``ocr``, the others stay as they are."""
    from archivolt.operators.search import needs_ocr

    flagged = needs_ocr(pages)
    return flagged.where(~F.col("needs_ocr")).drop("needs_ocr").unionByName(ocr(flagged.where("needs_ocr").drop("needs_ocr")))


def joined_text(pages: DataFrame) -> DataFrame:
    """``filename, text``: non-empty pages, each followed by a line feed; files without any text are left out."""
    kept = F.filter("pages", lambda p: p.isNotNull() & (p != ""))
    return pages.where("pages is not null").select("filename", F.concat(F.array_join(kept, "\n"), F.lit("\n")).alias("text")).where(strip(F.col("text")) != "")


def read_lines(spark: SparkSession, path: str, column: str = "keyword") -> DataFrame:
    """One row a line, with its number in the file's order."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias(column))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.options(**_CSV).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, schema: T.StructType = HITS) -> None:
    """Overwrites; only the layout's columns, in its order."""
    df.select(*schema.fieldNames()).write.mode("overwrite").options(**_CSV).csv(path)


def write_markdown(df: DataFrame, path: str) -> None:
    """One text file a row (``name, markdown``) below a folder a name; every executor writes its own rows."""
    df.select("name", F.col("markdown").alias("value")).write.mode("overwrite").partitionBy("name").text(path)


def copy_plan(matched: DataFrame, listing: DataFrame) -> DataFrame:
    """``path, target`` of the files to copy; a hit without a file is ignored and stays uncopied."""
    return listing.join(matched.select("folder", "filename").distinct(), ["folder", "filename"], "left_semi").select("path", F.concat_ws("_", "folder", "filename").alias("target")).distinct()
