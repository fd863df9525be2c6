"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Semantics, not tuning: instants are compared in UTC and partition labels
#: such as ``hour=07`` stay text.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def ensure(spark: SparkSession) -> SparkSession:
    """Set the required settings on a session and return it."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def object_store(spark: SparkSession, endpoint: str, key: str, secret: str, path_style: bool = True) -> SparkSession:
    """Let ``s3a://`` paths reach an object store."""
    settings = {"endpoint": endpoint, "access.key": key, "secret.key": secret, "path.style.access": str(path_style).lower(), "connection.ssl.enabled": str(endpoint.startswith("https")).lower()}
    for name, value in settings.items():
        spark._jsc.hadoopConfiguration().set(f"fs.s3a.{name}", value)
    return spark


def effective(spark: SparkSession) -> dict[str, str | None]:
    """The settings that hold in a session, read back; secrets are not shown."""
    store = spark._jsc.hadoopConfiguration()
    found = {k: spark.conf.get(k, None) for k in (*REQUIRED, "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.checkpoint.dir")}
    found |= {f"fs.s3a.{n}": store.get(f"fs.s3a.{n}") for n in ("endpoint", "path.style.access")}
    return found | {f"fs.s3a.{n}": "set" if store.get(f"fs.s3a.{n}") else None for n in ("access.key", "secret.key")}


def ask(spark: SparkSession, sql: str, **parameters: object) -> DataFrame:
    """SQL over the session's views with named parameters, ``:name`` in the text."""
    return ensure(spark).sql(sql, args=parameters)


def local(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("punctual")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = ensure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
