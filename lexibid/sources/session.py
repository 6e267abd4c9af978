"""Sessions for tests and the bench. Library code takes the session it is given."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int, app: str, **conf: str) -> SparkSession:
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    settings = {
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        # one machine only: its temporary folder is shared by all of the session's tasks
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexibid-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark
