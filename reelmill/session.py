"""Session defaults, sizes and results written once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

PARTITION_BYTES = 128 << 20     # aimed size of one shuffle partition
EXPANSION = 3                   # shuffled bytes per stored byte
UNKNOWN_BYTES = 1 << 60         # estimates above this are Spark's "unknown"


#: What the plans are written for, where neither the caller nor spark-submit says otherwise.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "4000",
}


def build_session(app: str = "reelmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for.

    Defaults fill in what is not set; a session that already runs is returned as it is, with
    only ``conf`` changed. AQE merges small shuffle partitions and splits skewed ones but adds
    none, so a query that is not written by ``TableStore`` starts from
    ``spark.sql.shuffle.partitions``; the default is the number for some 0.5 TB of shuffled
    data, which a larger cluster raises and a local run lowers. Writes size it themselves.
    """
    running = SparkSession.getActiveSession()
    builder = SparkSession.builder if running else SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    return session if running else with_defaults(session)


def with_defaults(session: SparkSession) -> SparkSession:
    """Set on the session the defaults that its application was started without."""
    given = session.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            session.conf.set(key, value)
    return session


def input_bytes(df: DataFrame) -> float:
    """Size of what the plan reads; infinite where the session does not tell.

    Leaves are summed because Catalyst estimates a join as the product of its sides.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    except AttributeError:
        return float("inf")
    total = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return float(total) if total < UNKNOWN_BYTES else float("inf")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size rule broadcasts this side of a join."""
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:
        return False
    return int(str(size)) <= int(limit)


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[None]:
    """Start shuffles with enough partitions for the input while ``df`` runs.

    AQE merges partitions that turn out small but never adds any, so the number it
    starts from has to grow with the data; the session's setting stays the floor.
    """
    conf = df.sparkSession.conf
    floor = int(conf.get("spark.sql.shuffle.partitions"))
    wanted = input_bytes(df) * EXPANSION / PARTITION_BYTES
    before = conf.get(INITIAL_PARTITIONS, None)
    if before is not None or not floor < wanted < float("inf"):
        yield
        return
    conf.set(INITIAL_PARTITIONS, str(ceil(wanted)))
    try:
        yield
    finally:
        conf.unset(INITIAL_PARTITIONS)


def written_once(df: DataFrame, location: str) -> DataFrame:
    """``df`` written to ``location`` and read back, for results read several times.

    ``location`` is a new folder that all executors share, such as one below a store's
    root. Unlike a checkpoint the files prune columns and tell their size, so a small
    result is still broadcast and a large one is not.
    """
    with sized_shuffles(df):
        df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)
