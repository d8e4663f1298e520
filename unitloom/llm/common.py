"""Helpers of the training-data operators: shared scratch tables, size-checked broadcasts, joins on hot keys, bounded Arrow batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bounded_batches as bounded_batches

#: Regular expression of a word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: A table of at most so many bytes may be broadcast; above it joins shuffle.
BROADCAST_BYTES = 32 << 20
#: No more keys than this can be hot in a join on counted keys.
HOT_KEYS = 100_000
HOT_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, with its file system spelled out (a folder without a scheme is on
    Hadoop's default file system). Only a local master may go without; it gets a temporary folder."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not at:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="unitloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


class Scratch:
    """Written tables in the shared folder. They cut lineage and survive lost executors; drop() removes one, the rest goes at exit."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/unitloom-{name}-{uuid.uuid4().hex}"
        self.written: list[str] = []
        atexit.register(self._quiet_drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        self.written.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for at in [self.path(n) for n in names] or [self.root]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _quiet_drop(self) -> None:
        try:
            self.drop()
        except Exception:  # the session may be gone at exit
            pass


def small(table: DataFrame) -> bool:
    """Whether a (written) table takes at most BROADCAST_BYTES: its strings' bytes, 8 a number and 16 a row are added up."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c, f in zip(quoted(*table.columns), table.schema.fields, strict=True) if isinstance(f.dataType, T.StringType | T.BinaryType)]
    row = sum(wide, F.lit(16 + 8 * (len(table.columns) - len(wide))))
    return (table.agg(F.sum(row.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES


def small_broadcast(table: DataFrame) -> DataFrame:
    """table with a broadcast hint if it is small(), else as it is (joins then shuffle)."""
    return F.broadcast(table) if small(table) else table


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], how: str = "inner", n: str = "n") -> DataFrame:
    """rows joined to counted (written; one row a key, n: how many of rows have the key; the result is without n).

    A key with more than a HOT_KEYS-th of all rows is hot: there are at most HOT_KEYS such, so they are broadcast, and their rows
    stay where they are. The other keys' rows are shuffled, and none of them can fill a task."""
    total = counted.agg(F.sum(n)).first()[0] or 0
    limit = max(HOT_ROWS, -(-total // HOT_KEYS))
    hot = counted.where(F.col(n) >= limit)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(counted.where(F.col(n) < limit).drop(n), keys, how)
    return rows.join(F.broadcast(hot.drop(n)), keys).unionByName(cold)


def quoted(*names: str) -> list:
    """Columns by exact name, whatever characters the names hold."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def with_arrow_columns(docs: DataFrame, ddl: str, make, *more: str) -> DataFrame:
    """docs with the columns of a DDL string, which make(batch, names) gives as Arrow arrays (names: docs' column names in the
    batch's order). A column of docs with the name of an added one is replaced; columns named in `more` are only read."""
    added = T.StructType.fromDDL(ddl)
    docs = docs.drop(*added.names)
    names = docs.columns
    kept = [n for n in names if n not in more]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), *added.fields])
    places = [names.index(n) for n in kept]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *make(batch, names)], names=[*kept, *added.names])

    plain = [c.alias(f"c{k}") for k, c in enumerate(quoted(*names))]  # mapInArrow looks columns up by name and stumbles over dots
    return docs.select(*plain).mapInArrow(run, schema)
