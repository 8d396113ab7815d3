"""Logs, pages and checked tables: reading what was appended, writing only what is complete."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def work_dir(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share; a temporary one where none is set and all run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quarrymill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON-lines log. A cut last line of a file is dropped; a broken line elsewhere fails the job."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__at"))
    parsed = lines.withColumn("__r", F.from_json("value", StructType.fromDDL(schema + ", __corrupt string"), {"columnNameOfCorruptRecord": "__corrupt"}))
    last = parsed.groupBy("__file").agg(F.max("__at").alias("__last"))
    bad = F.col("__r.__corrupt").isNotNull()
    broken = F.raise_error(F.concat(F.lit("broken line in "), F.col("__file"))).cast("boolean")
    rows = parsed.join(last, "__file").where(F.when(bad & (F.col("__at") == F.col("__last")), False).when(bad, broken).otherwise(True))
    return rows.select(*[F.col(f"__r.{f}") for f in StructType.fromDDL(schema).names])


def parse_log_lines(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Records of JSON lines that are a column already; broken ones are left out."""
    parsed = lines.select(F.from_json(column, StructType.fromDDL(schema + ", __corrupt string"), {"columnNameOfCorruptRecord": "__corrupt"}).alias("r"))
    return parsed.where("r.__corrupt is null").select(*[F.col(f"r.{f}") for f in StructType.fromDDL(schema).names])


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a JSON-lines log; each task's file appears whole or not at all."""
    df.write.mode("append").json(path)


def write_verified(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write to a new folder and read back; rows and columns must agree before the table is handed out."""
    from pyspark.sql import Observation

    path = path or f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    seen = Observation(f"w{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    n = back.count()  # from the files' footers
    if n != seen.get["n"] or back.columns != df.columns:
        raise ValueError(f"{path}: {n} rows of {back.columns}, not {seen.get['n']} of {df.columns}")
    return back


def page_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, position, link, label of each anchor of a page; a page of another shape has no rows."""
    pattern = F.lit('<a href="(/[^"]*)">([^<]*)</a>')
    found = F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(1)).alias("link"), F.regexp_extract_all(html, pattern, F.lit(2)).alias("label"))
    return pages.select(key, F.posexplode(found).alias("position", "x")).select(key, "position", "x.link", "x.label")


def flatten_cells(notebook: Column) -> Column:
    """Code of a notebook as text, both layouts; null if it isn't one."""
    cell = "struct<cell_type:string,source:array<string>,input:array<string>>"
    # a cell's text may be one string instead of a list of lines
    notebook = F.regexp_replace(notebook, r'''("(?:source|input)"\s*:\s*)("(?:[^"\\]|\\.)*")''', "$1[$2]")
    new = F.from_json(notebook, f"cells array<{cell}>")["cells"]
    old = F.flatten(F.transform(F.from_json(notebook, f"worksheets array<struct<cells:array<{cell}>>>")["worksheets"], lambda w: w["cells"]))
    text = lambda c: F.array_join(F.coalesce(c["source"], c["input"]), "")
    code = F.filter(F.coalesce(new, old), lambda c: c["cell_type"] == "code")
    return F.when(F.coalesce(new, old).isNotNull(), F.array_join(F.transform(code, text), "\n# ---\n"))
