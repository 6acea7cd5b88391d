"""Tables that cut lineage, kept in the folder all executors share.

Iterative operators write their state as parquet instead of caching it: the files
survive the loss of any executor. The folder is ``spark.checkpoint.dir``. Only a
local master may do without it; it then gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        own = tempfile.mkdtemp(prefix="corvane-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _LOCAL_ROOTS[app] = f"file://{own}"
    return _LOCAL_ROOTS[app]


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input has fewer splits than there are cores, whatever its size.

    A split is never smaller than the cost of opening a file, so the plan's own size
    estimate over that cost is the number of splits a table can be read in. A table
    with at least one a core is read as it is: nothing large is ever moved.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.openCostInBytes"))
    return df.repartition(cores) if size < cores * least else df


class Workspace:
    """Numbered parquet tables under one run folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._count = 0

    def save(self, df: DataFrame, label: str = "t", *by: str) -> DataFrame:
        """Write ``df`` once, in folders ``by`` some columns, and return a reader of what was written."""
        self._count += 1
        path = f"{self.path}/{self._count:03d}-{label}"
        df.write.partitionBy(*by).parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._corvane_path = path
        return saved

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later plan reads."""
        path = getattr(df, "_corvane_path", None)
        if path is None:
            return
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
