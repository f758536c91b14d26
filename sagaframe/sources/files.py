"""Sources and sinks: texts, JSON, JSON lines, manifests, chapters, rule files; written with Spark's committers."""

from __future__ import annotations

import json
import tomllib
from dataclasses import fields, is_dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sagaframe.functions.text import clean_text

#: Files of a run that hold no data rows.
METADATA = ("manifest", "failures", "run_status")
BOM = "﻿"


def _no_bom(c: Column) -> Column:
    return F.when(F.startswith(c, F.lit(BOM)), F.substring(c, 2, 1 << 30)).otherwise(c)


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """file_name, text: whole files without a byte order mark."""
    return spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), _no_bom(F.col("value")).alias("text"))


def read_json_files(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.json") -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", glob).json(path).withColumn("file_name", F.col("_metadata.file_name"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON lines; blank lines and lines that are no object are left out."""
    lines = spark.read.text(path).select(_no_bom(F.col("value")).alias("value")).filter(F.trim("value").rlike(r"^\{.*\}$"))
    return lines.select(F.from_json("value", schema).alias("r")).filter("r is not null").select("r.*")


def without_metadata(df: DataFrame, prefixes: tuple[str, ...] = METADATA) -> DataFrame:
    skip = F.lit(False)
    for p in prefixes:
        skip = skip | F.startswith("file_name", F.lit(p))
    return df.filter(~skip)


def optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON lines table, or no rows where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return read_jsonl(spark, path, schema) if there else spark.createDataFrame([], schema)


class MissingFiles(ValueError):
    """Files that a manifest names are not there."""


def read_manifest(spark: SparkSession, folder: str, manifest: DataFrame, file_col: str, schema: T.StructType) -> DataFrame:
    """Only the files that a manifest names; it is an error if one is missing, and others are not scanned."""
    found = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias(file_col))
    lost = manifest.select(file_col).join(found, file_col, "left_anti").limit(5).collect()
    if lost:
        raise MissingFiles(", ".join(r[0] for r in lost))
    rows = read_json_files(spark, folder, schema)
    return rows.join(manifest.select(F.col(file_col).alias("file_name")), "file_name", "left_semi")


def chapters(texts: DataFrame, pattern: str = r"chapter_(\w+)\.txt") -> DataFrame:
    """chapter_id from the file name, title (first line with text), body (the rest)."""
    lines = F.split("text", "\n")
    at = F.array_position(F.transform(lines, lambda x: clean_text(x) != ""), True)
    title = F.when(at > 0, clean_text(F.get(lines, (at - 1).cast("int")))).otherwise("")
    body = F.when(at > 0, clean_text(F.array_join(F.slice(lines, (at + 1).cast("int"), F.size(lines)), "\n"))).otherwise("")
    return texts.select(F.regexp_extract("file_name", pattern, 1).alias("chapter_id"), title.alias("chapter_title"), body.alias("body"), F.col("file_name").alias("source_file"))


def facts_by_chapter(facts: DataFrame, chapter: str = "chapter_id") -> DataFrame:
    return facts.groupBy(chapter).agg(F.count(F.lit(1)).alias("rows"))


def validated(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose required columns hold something, the others)."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.when(F.col(c).isNull(), False).otherwise(clean_text(F.col(c).cast("string")) != "")
    return df.filter(ok), df.filter(~ok)


def load_rules(text: str, kind: type, form: str = "toml") -> Any:
    """A dataclass of rules from the text of a TOML or JSON file; what the file lacks keeps its default, what it adds is an error."""
    data = tomllib.loads(text) if form == "toml" else json.loads(text.removeprefix(BOM))
    if not is_dataclass(kind):
        raise TypeError("rules are dataclasses")
    unknown = data.keys() - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"unknown rules: {', '.join(sorted(unknown))}")
    return kind(**{k: tuple(map(tuple, v)) if v and isinstance(v, list) and isinstance(v[0], list) else tuple(v) if isinstance(v, list) else v for k, v in data.items()})


def write_table(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite", by: list[str] | None = None) -> None:
    """Written whole or not at all, by the job's commit."""
    writer = df.write.mode(mode).format(form)
    (writer.partitionBy(*by) if by else writer).save(path)


def write_tables(tables: dict[str, DataFrame], folder: str, form: str = "json") -> dict[str, int]:
    """Several tables under a folder, and their row counts for a manifest."""
    counts = {}
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", form)
        counts[name] = df.sparkSession.read.schema(df.schema).format(form).load(f"{folder}/{name}").count()
    return counts


def markdown_report(title: str, rows: DataFrame, limit: int = 50) -> str:
    """A report of the first rows of a small table."""
    names = rows.columns
    lines = [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + " --- |" * len(names)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.limit(limit).collect()]
    return "\n".join(lines) + "\n"
