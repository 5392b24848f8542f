"""Session settings the engine expects."""

from pyspark.sql import SparkSession


def builder(app="anchorage"):
    """Session builder; cluster sizing (master, memory, shuffle width) stays with the caller.

    AQE coalesces small shuffle partitions and splits skewed join partitions, so
    ``spark.sql.shuffle.partitions`` may be set generously on a cluster.
    """
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        # sides are broadcast by their known size only; a cohort of this size is worth it
        .config("spark.sql.autoBroadcastJoinThreshold", "64MB")
        # hash the small side of a shuffled join, where it fits, instead of sorting the big one
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        # call sites of every column call are only useful when debugging, and cost round trips
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
