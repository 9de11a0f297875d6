"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("plinth")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the folder named by spark.checkpoint.dir and read back, so that its lineage ends there.

    A folder of our own is set only where the session names none and all runs on one machine, as in tests; a cluster without one is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "plinth-checkpoints"))
    return df.checkpoint(eager=True)
