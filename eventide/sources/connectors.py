"""Topic, registry and JDBC connectors, parameterised by format.

The broker, Avro and JDBC-driver jars are not on this image's classpath, so every function takes
the source format as a parameter: on a cluster with the connectors it is ``"kafka"``; in tests
the same topic shape (a ``value`` text column, optional ``key`` / ``headers``) comes from JSON or
parquet files. Decoding is always the same built-in ``from_json`` / ``from_avro`` expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topic(spark: SparkSession, topic: str, servers: str | None = None,
               fmt: str = "kafka", stream: bool = True, starting: str = "earliest",
               schema: str | None = "key string, value string", **options) -> DataFrame:
    """A topic as a DataFrame with ``key``/``value`` as text (plus ``headers``, ``partition``,
    ``offset``, ``timestamp`` for the broker source). ``starting="earliest"`` reads from the
    beginning; consumer offsets are tracked by the query checkpoint, not by auto-commit.

    For ``fmt != "kafka"``, ``topic`` is a folder of files of that format holding the same
    columns, read with ``schema`` (tests)."""
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic).option("startingOffsets", starting)
             .option("includeHeaders", "true"))
        if not stream:
            r = r.option("endingOffsets", "latest")
        for k, v in options.items():
            r = r.option(k, v)
        df = r.load()
        return df.withColumn("key", F.col("key").cast("string")).withColumn(
            "value", F.col("value").cast("string"))
    r = reader.format(fmt)
    if schema:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(topic)


def write_topic(df: DataFrame, topic: str, servers: str | None = None, fmt: str = "kafka",
                checkpoint: str | None = None, path: str | None = None, **options):
    """Write a ``value`` (and optional ``key``) column to a topic. Streams need ``checkpoint``
    (the broker sink is at-least-once, like the reference's producer)."""
    if df.isStreaming:
        w = df.writeStream.option("checkpointLocation", checkpoint)
        if fmt == "kafka":
            w = w.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            return w.start()
        return w.format(fmt).start(path or topic)
    if fmt == "kafka":
        return (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("topic", topic).save())
    return df.write.mode("append").format(fmt).save(path or topic)


def bounded_peek(spark: SparkSession, topic: str, n: int, servers: str | None = None,
                 fmt: str = "kafka", **options) -> DataFrame:
    """At most ``n`` records from the beginning of a topic (batch read, earliest..latest)."""
    df = read_topic(spark, topic, servers, fmt=fmt, stream=False, **options)
    order = [c for c in ("partition", "offset") if c in df.columns]
    return (df.orderBy(*order) if order else df).limit(n)


def decode_avro(value: Column, json_schema: str) -> Column:
    """Avro value -> struct with the given reader schema (JSON text). Needs the spark-avro
    package at run time; a registry wire-format prefix must be stripped by the caller."""
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover - pyspark always ships the wrapper
        raise RuntimeError("Avro support needs pyspark.sql.avro") from e
    return from_avro(value, json_schema, {"mode": "PERMISSIVE"})


def encode_avro(data: Column, json_schema: str | None = None) -> Column:
    try:
        from pyspark.sql.avro.functions import to_avro
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("Avro support needs pyspark.sql.avro") from e
    return to_avro(data, json_schema) if json_schema else to_avro(data)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table; with a partition column the read is split into parallel ranges."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


HEADER_TYPE = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                        T.StructField("value", T.BinaryType())]))
