"""Session defaults for tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: int = 4, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle and scan sizes for a run over ``input_bytes`` on ``cores`` executor cores.

    Shuffles start with enough partitions for about 256 MB each; AQE joins the small ones and
    splits the skewed ones. Scans are cut so that every core has several tasks.
    """
    shuffle = max(3 * cores, input_bytes // 8 // (256 << 20))
    split = min(max(input_bytes // (8 * cores), 128 << 20), 1 << 30)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
