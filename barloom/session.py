"""Where intermediate tables go, and how they are cut off from their lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the shared one the cluster names.

    Without ``spark.checkpoint.dir`` a temporary folder is used, but only when
    the master is local; elsewhere executors would not see the same files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/barloom-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="barloom-")
    return _local_roots[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Used where several later passes need the same rows: the table outlives
    lost executors, is columnar (a later pass reads only its columns), and
    values such as partition numbers stay what they were when written.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application."""
    root = scratch_root(spark)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _local_roots.pop(spark.sparkContext.applicationId, None)
