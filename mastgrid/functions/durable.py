"""Intermediate tables that outlive lost executors."""
import posixpath
import tempfile
import uuid


def shared_folder(spark):
    """The folder that the driver and all executors share.

    It is the checkpoint folder of the session: what ``setCheckpointDir`` or
    ``spark.checkpoint.dir`` names. A local session without one gets a temporary folder; any
    other raises, because each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.split("[")[0] == "local":
        raise ValueError("name a shared folder in spark.checkpoint.dir or setCheckpointDir")
    return tempfile.mkdtemp(prefix="mastgrid-")


def shared_path(spark):
    """A new path in the shared folder."""
    return posixpath.join(shared_folder(spark), f"mastgrid-{uuid.uuid4().hex}")


def durable(df, partition_by=(), compression=None):
    """Write ``df`` as a Parquet table in the shared folder and return that table.

    What follows reads the columns and partitions it needs of a short plan, and a lost
    executor costs a re-read and not the work done so far. The files stay in the folder
    until ``discard`` or its owner clears them, as those of a checkpoint do. ``compression``
    names a Parquet codec other than the session's.
    """
    path = shared_path(df.sparkSession)
    writer = df.write
    if partition_by:
        # Adaptive execution splits large partitions over tasks and joins small ones.
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    writer.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df):
    """Delete the files of a table that ``durable`` returned, once nothing reads it again."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {posixpath.dirname(f) for f in df.inputFiles()}:
        while "mastgrid-" in posixpath.dirname(folder):
            folder = posixpath.dirname(folder)
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
