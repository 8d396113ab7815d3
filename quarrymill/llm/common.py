"""Shared small pieces: tables cut from their lineage, splits by crc32, hashed tokens."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = re.compile(r"\w+|[^\w\s]+")
WORD = re.compile(r"\w+")
#: Entries after which a worker forgets the tokens it has met; bounds memory, never results.
CACHE = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where it is unset, one of this machine, if that is all the cluster there is."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quarrymill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._quarrymill_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that materialize wrote and nothing reads any more."""
    for df in tables:
        path = getattr(df, "_quarrymill_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df has it, in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, mod modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


class Hashed(dict):
    """token -> bucket by crc32; forgets everything when it grows past CACHE entries."""

    def __init__(self, buckets: int):
        super().__init__()
        self.mask = buckets - 1

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        got = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) & self.mask
        return got
