"""The session of tests and trial runs."""

import tempfile

from pyspark.sql import SparkSession

from metaloom.functions.skew import SETTINGS


def session(**more):
    builder = (
        SparkSession.builder.master("local[8]").appName("metaloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="metaloom-checkpoint-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
