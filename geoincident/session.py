"""Session construction and cluster-safety helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution re-plans joins from
# runtime sizes, splits skewed shuffle partitions and coalesces tiny ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # checkpoint files of iterative steps are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", app: str = "geoincident",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A session with the scale settings above; the UI stays off."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for ``DataFrame.checkpoint()`` and staged tables.

    The session names it in ``spark.checkpoint.dir``. Only a session with a
    local master may leave it unset: there the driver and the executors are one
    process, so a scratch folder of this machine serves. Any other master
    without the setting is an error, because executors would not see each
    other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(
                "spark.checkpoint.dir is not set; name a folder that all executors share "
                f"(master is {master})")
        configured = tempfile.mkdtemp(prefix="geoincident-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    UDFs pickle their functions by module name, so the workers must be able to
    import ``geoincident``. The sources go out once per SparkContext as a zip
    through ``addPyFile``, whatever the workers' own path is.
    """
    sc = spark.sparkContext
    if getattr(sc, "_geoincident_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="geoincident-py-")) / "geoincident.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, Path("geoincident") / source.relative_to(root))
    sc.addPyFile(str(target))
    sc._geoincident_shipped = True
