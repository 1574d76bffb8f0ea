"""Session settings and shipping of this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: What queries here rely on. The cluster's own sizes (memory, shuffle partitions) stay as they are.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings and send the package to the executors, once per application."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessella-checkpoint-"))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        bundle = Path(tempfile.mkdtemp(prefix="tessella-")) / "tessella.zip"
        with zipfile.ZipFile(bundle, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(bundle))
        _shipped.add(app)
    return spark


def local_session(app: str = "tessella", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
