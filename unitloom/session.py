"""A session with the settings that the operators are written for."""

from pyspark.sql import SparkSession


def session(master: str | None = None, app: str = "unitloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def cut(df):
    """df checkpointed in the shared folder of spark.checkpoint.dir, so that later plans start from it. Only a local master may go
    without that setting; it gets a temporary folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        at = context.getConf().get("spark.checkpoint.dir")
        if not at:
            if context.master.split("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            at = tempfile.mkdtemp(prefix="unitloom-")
        context.setCheckpointDir(at)
    return df.checkpoint()


def spread(df, least: int = 1 << 20, split: int = 128 << 20):
    """df dealt to all cores if its files are small: one file of one row group would keep a single core busy. Files of `split` bytes a
    core or more have enough row groups and are read as they lie, without a shuffle; so are those under `least` bytes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if least <= size < split * cores else df


def bounded_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Caps the rows of an Arrow batch, so that a Python worker holds few long texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def slices(batches, size: int = 1 << 20, rows: int = 256):
    """Arrow batches in slices of about `size` bytes and at most `rows` rows, without a copy, so that Python objects are made of few
    texts at a time, however long a batch is."""
    for batch in batches:
        step = max(1, min(rows, size * batch.num_rows // max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
