"""Session settings and the layer layout.

The library never builds its own session: the caller (a cluster job, the
test suite, the driver) hands one in, and ``configure`` sets the few SQL
options the table operations rely on.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Database and table names of the two layers.
LAYERS = {
    "BRONZE": {
        "database": "b_prod_prices",
        "tables": {"products": "b_products", "sellers": "b_sellers"},
    },
    "SILVER": {
        "database": "s_prod_prices",
        "tables": {
            "catalog": "s_catalog_products",
            "catalog_state": "s_catalog_state",
            "last_version": "s_last_ver_products",
            "categories": "s_categories_catalog",
        },
    },
}

# Load-date partition column and load timestamp column.
PARTITION_COLUMN = "dt_refe_crga"
LOAD_TS_COLUMN = "dh_exec"
# Fixed value: time zone of the load dates.
TIME_ZONE = "-03:00"


def configure(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Set the options the table layer depends on; return the same session.

    * dynamic partition overwrite, so ``INSERT OVERWRITE`` replaces only the
      load dates present in the new data;
    * no type inference for partition values: ``2025-04-07`` stays a string,
      as the partition column is declared;
    * AQE with skew-join splitting and partition coalescing.
    """
    conf = spark.conf
    conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if time_zone:
        conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def layer_table(layer: str, table: str, databases: dict[str, str] | None = None) -> str:
    """Qualified name of a layer table, e.g. ``layer_table('SILVER', 'catalog')``.

    ``databases`` maps a layer to another database name (isolated runs).
    """
    spec = LAYERS[layer.upper()]
    database = (databases or {}).get(layer.upper(), spec["database"])
    return f"{database}.{spec['tables'][table]}"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; it is read from
    the session. Only a local-mode session without the setting (tests) gets
    its own folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            root = current
        elif sc.master.startswith("local"):
            root = tempfile.mkdtemp(prefix="vitrine-ckpt-")
            try:
                spark.conf.set("spark.checkpoint.dir", root)
            except Exception:  # a core setting some sessions refuse at runtime
                pass
        else:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_location(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the checkpoint root, for one job's tables or files."""
    return f"{checkpoint_root(spark)}/vitrine/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side checks in local mode."""
    return path[5:] if path.startswith("file:") else path


__all__ = [
    "LAYERS",
    "PARTITION_COLUMN",
    "LOAD_TS_COLUMN",
    "TIME_ZONE",
    "configure",
    "layer_table",
    "checkpoint_root",
    "scratch_location",
    "local_path",
]
