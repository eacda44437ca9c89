"""A local session, as the tests and the benchmark use it."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    name: str, cores: int, memory: str, shared: str, more: dict[str, str] | None = None
) -> SparkSession:
    """As many threads and shuffle partitions as ``cores``; ``shared`` takes what queries store."""
    sizes = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.checkpoint.dir": shared,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    session = builder.config(map=SETTINGS | sizes | (more or {})).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
