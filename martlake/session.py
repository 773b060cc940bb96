"""Session construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every plan in this package is written against.  AQE re-plans joins
# from runtime sizes (the broadcast threshold is a checked size), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "martlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized to the input (roughly input bytes /
    128 MB), which AQE coalesces down when stages turn out smaller.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder in that setting and we use it as is.  Only
    with a local master (tests) is a private scratch folder made where it is unset; a cluster
    without the setting is an error when the folder is first needed.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="martlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def materialize(df):
    """Cut lineage by writing ``df`` to the shared checkpoint folder (reliable
    checkpoint, survives executor loss; never a machine-local checkpoint).

    Used for small derived relations (marts) that several subplans read, so
    they are computed once instead of once per subplan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df):
    """``df`` written to a folder of its own in the shared checkpoint folder and read back: columns and
    rows are those of the files."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors through Spark's own file server (once per
    application), so Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="martlake-ship-"), "martlake_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(os.path.join(root, "martlake")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
