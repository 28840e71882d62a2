"""Session settings and shared scratch space."""

import tempfile
import uuid


def prepare_session(spark):
    """Runtime settings the operators rely on. Safe to call on any running session."""
    # Page payloads may repeat a key; the last one counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Of long texts 10,000 rows are tens of MB, which an executor holds beside its heap, and each of its workers once more.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark


_LOCAL_FOLDERS = {}


def scratch_path(spark, name):
    """A new path in the shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    A session on one machine that has no such folder gets one in the machine's temporary folder, one per application.
    Elsewhere executors could not read each other's files there, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL_FOLDERS.get(context.applicationId)
        if not root:
            root = _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="clickmart-")
    return f"{root}/clickmart/{name}-{uuid.uuid4().hex}"


def stored_path(df, name):
    """Writes ``df`` to scratch space and returns the path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def stored(df, name):
    """Write ``df`` to scratch space and read it back: fixes its values and cuts its lineage."""
    return df.sparkSession.read.schema(df.schema).parquet(stored_path(df, name))
