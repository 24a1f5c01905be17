"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

# one BLAS thread per Python process: Spark already runs one task per core
for _v in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
    os.environ.setdefault(_v, "1")

from pyspark.sql import SparkSession


SPREAD = "listing_yield.spread"  # number of partitions for the single-row-group test files
# Longer generated methods are never compiled by the JVM (wide projections are): Spark then makes these operators of short ones.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
HUGE_METHOD_BYTES = "8000"


def keep_methods_short(spark: SparkSession) -> None:
    """Limits generated methods to what the JVM compiles, unless the session names a limit of its own."""
    if spark.conf.get(HUGE_METHOD, None) is None:
        spark.conf.set(HUGE_METHOD, HUGE_METHOD_BYTES)


def build_session(app: str = "listing_yield", cpus: int | str = "*",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's session."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(SPREAD, str(parts))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LY_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``. Where it is unset, a local session (tests, the bench)
    gets a scratch folder; a cluster session is an error, since its executors would each write to their own disk."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="ly-ckpt-", dir=os.environ.get("LY_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df, label: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    A lineage cut that survives executor loss (the files live in the folder the
    cluster names in ``spark.checkpoint.dir``), keeps columnar pushdown for the
    readers, and stops a plan that is reused by several branches from being
    recomputed once per branch.
    """
    import uuid

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def spread(df):
    """``df`` itself, unless the session was built for the small test files (``build_session``).

    Those are single Parquet row groups, which one task would read and parse; a local test or bench session deals
    them out over its cores.  A cluster session never does.
    """
    n = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``listing_yield`` importable in Python workers (the model's ``mapInPandas``
    functions live in it): zip the package once per application and ``addPyFile`` it,
    as ``--py-files`` would on a cluster."""
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="ly-pyfiles-"), "listing_yield.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)
