"""Where the tables of each zone live."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Zone names (fixed values).
RAW, STAGING, SOR, RECONCILE = "raw", "stg", "sor", "reconcile"
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class Zones:
    """Paths of zone tables under one base URI.

    ``Zones("file:/data")`` gives ``file:/data/raw/orders``; with the base
    ``s3a://`` each zone is a bucket of its own.
    """

    base: str

    def zone(self, zone: str) -> str:
        return self.base + zone if self.base.endswith("://") else f"{self.base.rstrip('/')}/{zone}"

    def table(self, zone: str, name: str) -> str:
        return f"{self.zone(zone)}/{name}"


def shared_scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder for an intermediate table, removed when the driver's JVM ends.

    It lies in the folder that ``spark.checkpoint.dir`` names, or else in the session's
    warehouse: both are shared by all executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{folder.toString()}/table"
