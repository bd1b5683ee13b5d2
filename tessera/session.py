"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Options that every query assumes. Cluster-sized options (executors, memory,
#: shuffle partitions) are left to the submitter; AQE coalesces and splits.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    conf = DEFAULTS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName("tessera").config(map=conf | extra).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is read from ``spark.checkpoint.dir``. Only where the cluster names none
    (local runs) a folder of our own is made and set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    if made.isDefined():
        return made.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _own_folder(spark: SparkSession) -> str:
    """This application's folder in the shared one; deleted when its file system closes."""
    path = os.path.join(shared_dir(spark), f"tessera-{spark.sparkContext.applicationId}")
    if getattr(spark.sparkContext, "_tessera_folder", None) != path:
        fs, p = _path(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        spark.sparkContext._tessera_folder = path
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in this application's folder, which all executors share."""
    return os.path.join(_own_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Moves ``path`` to ``to``; False, leaving both, if something is there."""
    fs, p = _path(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    return not fs.exists(target) and fs.rename(p, target)


def write_atomically(spark: SparkSession, path: str, text: str) -> None:
    """Puts ``text`` into the file ``path``: readers see the old or the new one, never none."""
    jvm = spark._jvm
    fresh = f"{path}.{uuid.uuid4().hex[:8]}"
    fs, p = _path(spark, fresh)
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(p, jvm.org.apache.hadoop.fs.Path(path), options)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and keeps
    the result columnar, so later readers prune columns. The tables of a session
    lie in one folder, which goes when the session ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    """The file system of ``path`` and the path for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def files_of(df: DataFrame) -> list[tuple[str, int, int]]:
    """Name, length and time of change of every file that ``df`` reads."""
    out = []
    for name in sorted(df.inputFiles()):
        fs, p = _path(df.sparkSession, name)
        status = fs.getFileStatus(p)
        out.append((name, int(status.getLen()), int(status.getModificationTime())))
    return out


def ship(spark: SparkSession) -> None:
    """Gives the package to Python workers that could not import it.

    Nothing is done where the workers see it anyway: started in the
    repository's folder, or with it in PYTHONPATH. Else Spark serves it, once
    for each context.
    """
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if root in known or os.getcwd() == root or getattr(context, "_tessera_shipped", False):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera"), "zip", root, "tessera")
    context.addPyFile(archive)
    context._tessera_shipped = True
