"""Session settings that the plans rely on.

Only runtime SQL settings are touched, so this works on a session somebody else
created. Memory, cores and the master belong to the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# What a driver can track. Beyond 256 GiB of input files partitions grow above their share of the
# target size instead of in number; sorts and joins then spill, and AQE still splits join partitions.
MAX_SHUFFLE_PARTITIONS = 32_768
# Rows in a sort or a hash table take some 20 times their bytes in encoded files or compressed shuffle
# blocks, and a task may hold several of them. So shuffles are cut finer than scans: partitions per target
# size of input, and the size up to which AQE merges them.
SHUFFLE_SPLIT = 16
MERGED_PARTITION_BYTES = TARGET_PARTITION_BYTES // SHUFFLE_SPLIT
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {unit: 1 << 10 * i for i, unit in enumerate("bkmgtp")}
MAX_SCAN_TASKS = 200_000

# Input up to which a reference table is broadcast: bytes of files, and rows in them. Bytes alone
# say little, for encoded or compressed files may hold hundreds of times more rows.
BROADCAST_LIMIT = 16 * 1024 * 1024
BROADCAST_ROWS = 2_000_000

# A hot join key is split by AQE, also where that costs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession, *inputs: DataFrame) -> SparkSession:
    """Apply the runtime settings and size the shuffle for ``inputs``.

    The number of shuffle partitions is only ever raised: AQE merges partitions
    that turn out small, but it cannot split a plain aggregation's partitions. The size up to
    which it merges them is only ever lowered. Scan splits grow only where the default would
    give more tasks than a driver can track.
    """
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if byte_size(spark.conf.get(_ADVISORY)) > MERGED_PARTITION_BYTES:
        spark.conf.set(_ADVISORY, str(MERGED_PARTITION_BYTES))
    total = sum(input_bytes(df) for df in inputs)
    wanted = shuffle_partitions(total * SHUFFLE_SPLIT)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    if total > MAX_SCAN_TASKS * TARGET_PARTITION_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(total // MAX_SCAN_TASKS))
    return spark


def byte_size(text: str) -> int:
    """Bytes of a size setting: a number, with or without a unit like k, MB or g."""
    number = text.strip().lower().rstrip("b")
    if number[-1:] in _UNITS:
        return int(number[:-1]) * _UNITS[number[-1]]
    return int(number)


def shuffle_partitions(total_bytes: int) -> int:
    """Partitions needed to keep each near the target size."""
    needed = -(-total_bytes // TARGET_PARTITION_BYTES)
    return int(max(1, min(needed, MAX_SHUFFLE_PARTITIONS)))


def input_bytes(df: DataFrame) -> int:
    """Size of the tables or files a frame is computed from."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.length()))


def broadcast_if_small(reference: DataFrame) -> DataFrame:
    """Mark reference data for broadcast if its input is small; leave it as it is otherwise.

    Spark multiplies the sizes of joined tables when it estimates a join, so it would
    shuffle the deals against any reference table that was itself looked up. The
    input size bounds a table built by key lookups, filters and grouping. Beyond the
    limit the join is a shuffle join, in which AQE splits hot keys.
    """
    return F.broadcast(reference) if is_small(reference) else reference


def is_small(reference: DataFrame) -> bool:
    return input_bytes(reference) <= BROADCAST_LIMIT and input_rows(reference) <= BROADCAST_ROWS


_ROWS: dict[tuple, int] = {}


def input_rows(df: DataFrame) -> int:
    """Rows in the files that a frame is computed from; only asked for files of few bytes.

    Parquet files are counted from their footers, text files by their lines. A file list is
    counted once, as long as the files keep their size and time.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    total = 0
    for i in range(leaves.length()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        kind = relation.fileFormat().toString().lower()
        files = tuple(relation.location().inputFiles())
        if not files:
            continue
        states = _states(df.sparkSession, files)
        key = (kind, *states)
        if key not in _ROWS:
            reader, paths = df.sparkSession.read, [path for path, _, _ in states]
            frame = reader.parquet(*paths) if kind == "parquet" else reader.text(paths)
            _ROWS[key] = frame.count()
        total += _ROWS[key]
    return total


def _states(spark: SparkSession, files: tuple[str, ...]) -> list[tuple[str, int, int]]:
    """Path, size and time of each file. Asked only for the few files of a table that may be broadcast."""
    found = []
    for name in files:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        found.append((place.toString(), status.getLen(), status.getModificationTime()))
    return found


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """Folder for staged tables: the cluster's checkpoint folder where it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback
