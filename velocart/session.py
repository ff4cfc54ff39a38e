"""Session construction and cluster-shared locations."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the reports depend on for their semantics, plus the adaptive
# execution switches they rely on for plan sizing at scale.
SEMANTIC_CONF = {
    # order_date / dob handling assumes UTC wall-clock dates
    "spark.sql.session.timeZone": "UTC",
    # bad text -> date casts and decimal overflow must fail, not turn NULL
    "spark.sql.ansi.enabled": "true",
}

ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hot keys (one brand/state/customer holding a large share of rows)
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "velocart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    largest_shuffle_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the engine expects.

    On a cluster, leave ``master`` unset (spark-submit decides) and pass
    ``largest_shuffle_bytes`` and ``total_cores`` to size partitions with
    ``sizing_conf``. Tests pass ``local[*]`` and a small partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **SEMANTIC_CONF,
        **ADAPTIVE_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if largest_shuffle_bytes is not None:
        if total_cores is None:
            raise ValueError("total_cores is needed to size partitions")
        conf.update(sizing_conf(largest_shuffle_bytes, total_cores))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def sizing_conf(
    largest_shuffle_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    filtered_side_bytes: int | None = None,
) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run, as Spark settings.

    ``largest_shuffle_bytes`` is the biggest input that gets shuffled (for
    these reports the order lines after column pruning). Reduce partitions
    aim at ``target_partition_bytes`` with at least two waves of tasks. Scan
    splits use the same target, which also bounds the map-task count; both
    counts grow with the input. Adaptive execution merges small partitions
    back to the target and splits skewed ones. ``filtered_side_bytes`` is the
    expected size of a filtered order side (R8): up to it, Spark builds a
    runtime Bloom filter of its keys, which cuts the lines before their
    shuffle. Pass the result as ``extra`` to ``build_session`` or to
    spark-submit.
    """
    partitions = max(2 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        # on a shared cluster, merge medium shuffles up to the target size
        # instead of spreading them over every core in tiny partitions
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    if filtered_side_bytes is not None:
        keys = max(1_000_000, filtered_side_bytes // 16)  # two longs a row
        conf.update(
            {
                "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(filtered_side_bytes),
                "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(keys),
                "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(keys),
                "spark.sql.optimizer.runtime.bloomFilter.numBits": str(8 * keys),
                "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(8 * keys),
            }
        )
    return conf
