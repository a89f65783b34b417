"""Listing files read whole and in order (S6, S7): plain text lists and JSON
directories. Listings are control files of a few megabytes each; any number of
them is read in parallel, one file a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What ends a line, as Python's splitlines has it.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def read_whole(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, value): each file's whole text."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S6 input: (path, line_no, value), every line of every file in its place."""
    whole = read_whole(spark, path)
    lines = whole.select("path", F.posexplode(F.split("value", _LINE_END)).alias("line_no", "value"))
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


def _empty_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files without a byte: Spark's readers skip them, so only the file system
    tells of them. Listings are a few files."""
    hadoop, found = spark._jvm.org.apache.hadoop.fs, []
    for p in [path] if isinstance(path, str) else path:
        target = hadoop.Path(p)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        for top in fs.globStatus(target) or []:
            for f in fs.listStatus(top.getPath()):
                if f.isFile() and f.getLen() == 0 and not f.getPath().getName().startswith(("_", ".")):
                    found.append(f.getPath().toString())
    return sorted(found)


def _key(name: str) -> Column:
    return F.try_variant_get("value", "$['" + name.replace("'", "\\'") + "']", "string").alias(name)


def read_json_records(spark: SparkSession, path: str | list[str], keys: list[str]) -> DataFrame:
    """S7 input: the objects of JSON arrays, one array a file: a text column per
    key (null where an object lacks it), path and row_no, the place of a record
    by (path, position in the array). Elements that are no objects are left out.
    A file that is no JSON, or holds no array or an empty one, raises ValueError
    with its name: a broken download must not replace a listing."""
    parsed = read_whole(spark, path).withColumn("v", F.try_parse_json("value"))
    kind = F.schema_of_variant("v")
    wrong = F.when(F.col("v").isNull(), "is no valid JSON").when(~kind.startswith("ARRAY"), "holds no array").when(
        F.regexp_replace(F.trim("value"), r"\s", "") == "[]", "holds an empty array")
    # at most a few names reach the driver
    bad = parsed.select("path", wrong.alias("why")).where("why is not null").orderBy("path").limit(5).collect()
    bad += [{"path": p, "why": "is no valid JSON"} for p in _empty_files(spark, path)]
    if bad:
        raise ValueError("company directory: " + "; ".join(f"{r['path']} {r['why']}" for r in bad))
    rows = parsed.select("path", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("path", "pos", "value")
    rows = rows.where(F.schema_of_variant("value").startswith("OBJECT"))
    return rows.select("path", F.concat_ws("#", "path", F.lpad(F.col("pos").cast("string"), 12, "0")).alias("row_no"), *(_key(k) for k in keys))
