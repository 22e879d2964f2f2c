"""Building blocks that keep an operator spread over the cluster.

``lookup_join``  broadcast behind a size check, salted shuffle join beyond it
``cutoffs``      exact k-th smallest value per group without sorting a group
``ordinals``     0-based position among equal rows without one task per hot key
``number_rows``  dense row numbers in input order
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A lookup side with at most this many rows may be broadcast.
BROADCAST_ROWS = 500_000
# Copies of a lookup side, and pieces of a hot key, in the salted join (power of 2).
SALTS = 32
# Most pieces of the row ids, and the rows in a piece of smaller tables.
ID_PIECES = 4096
PIECE_ROWS = 65_536


def shared_folder(spark: SparkSession) -> str:
    """Folder every node can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
        folder = tempfile.mkdtemp(prefix="termloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> str:
    """Write a frame as parquet to the shared folder and return its path."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table, read again: computed once, its lineage cut."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that would keep most cores idle; leave others alone.

    A single small file or a multi-line CSV is read by one task. A scan of many
    files already has more tasks than cores and must not be shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    lookup_rows: int | None,
    spread_by: str,
    how: str = "inner",
) -> DataFrame:
    """Join rows to a lookup that is unique on ``on``.

    ``lookup_rows`` is a proven bound or a count of the lookup, None if unknown. Up
    to ``BROADCAST_ROWS`` the lookup is broadcast and the facts stay where they
    are. Beyond it both sides are shuffled, with the facts of one key spread over
    ``SALTS`` pieces by ``spread_by`` and the lookup repeated once per piece.
    """
    if lookup_rows is not None and lookup_rows <= BROADCAST_ROWS:
        return facts.join(F.broadcast(lookup), list(on), how)
    last = F.lit(SALTS - 1).cast("long")
    salted = facts.withColumn("_salt", F.xxhash64(spread_by).bitwiseAND(last))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def id_borders(df: DataFrame, row_id: str, rows: int = PIECE_ROWS) -> list[float]:
    """Ascending ids that cut the rows into pieces of about ``rows`` (at most ``ID_PIECES``).

    An equi-depth histogram from one quantile sketch, so that a few far ids or dense
    clusters leave no piece much larger than the others.
    """
    pieces = min(ID_PIECES, -(-df.count() // rows))
    if pieces <= 1:
        return []
    shares = [k / pieces for k in range(1, pieces)]
    found = df.agg(F.percentile_approx(row_id, shares, 16 * pieces)).first()[0]
    return sorted({float(x) for x in found or ()})


def with_pieces(
    df: DataFrame, row_id: str, rows: int = PIECE_ROWS, name: str = "_piece"
) -> DataFrame:
    """Add the piece of a row (see ``id_borders``); it never decreases with the id."""
    borders = id_borders(df, row_id, rows)
    if not borders:
        return df.withColumn(name, F.lit(0).cast("long"))
    ends = float("inf")
    cut = Bucketizer(
        splits=[-ends, *borders, ends], inputCol="_place", outputCol=name, handleInvalid="keep"
    )
    placed = cut.transform(df.withColumn("_place", F.col(row_id).cast("double")))
    return placed.withColumn(name, F.col(name).cast("long")).drop("_place")


def id_range(df: DataFrame, row_id: str) -> tuple[int, int]:
    """Smallest and largest id; (0, 0) for an empty frame."""
    low, high = df.agg(F.min(row_id), F.max(row_id)).first()
    return (0, 0) if low is None else (low, high)


def cutoffs(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    bucket: Column,
    wanted: Callable[[Column], Column],
) -> DataFrame:
    """Value of ``order`` at position ``wanted(group size)`` of every group.

    ``bucket`` must not decrease with ``order``. Buckets are counted (a partial
    aggregate), the bucket that holds the position is found, and only the rows of
    that bucket are sorted, so no task sees a whole group. Groups in which nothing
    is wanted have no row. The result is materialised: ``keys`` and ``cutoff``.
    """
    keys = list(keys)
    slim = rows.select(*keys, F.col(order).alias("_order"), bucket.alias("_bucket"))
    counted = slim.groupBy(*keys, "_bucket").agg(F.count("*").alias("_rows"))
    group = W.partitionBy(*keys)
    upto = group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    sized = counted.select(
        *keys,
        "_bucket",
        (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"),
        F.col("_rows"),
        F.sum("_rows").over(group).alias("_total"),
    )
    need = F.least(wanted(F.col("_total")).cast("long"), F.col("_total"))
    edge = materialise(
        sized.where((F.col("_before") < need) & (need <= F.col("_before") + F.col("_rows")))
        .select(*keys, "_bucket", (need - F.col("_before")).alias("_need"))
    )
    inside = lookup_join(slim, edge, [*keys, "_bucket"], edge.count(), "_order")
    place = F.row_number().over(W.partitionBy(*keys).orderBy("_order"))
    return materialise(
        inside.withColumn("_place", place)
        .where(F.col("_place") == F.col("_need"))
        .select(*keys, F.col("_order").alias("cutoff"))
    )


def ordinals(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str = "row_id",
    name: str = "ordinal",
    rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add the 0-based position of a row among rows with equal ``keys``, by row id.

    Rows are numbered inside (keys, piece of the ids); the count of earlier
    pieces is added afterwards, so a key that holds a third of all rows is spread
    over up to ``ID_PIECES`` tasks, however its ids lie. The frame is read four times:
    materialise what is expensive to make, and keep ``keys`` narrow, see ``digest``.
    """
    keys = list(keys)
    pieces = with_pieces(df, row_id, rows)
    counted = pieces.groupBy(*keys, "_piece").agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    # Only keys that reach into a second piece have an offset.
    offsets = (
        counted.withColumn("_offset", F.sum("_rows").over(earlier))
        .where(F.col("_offset").isNotNull())
        .drop("_rows")
    )
    here = W.partitionBy(*keys, "_piece").orderBy(row_id)
    local = pieces.withColumn("_local", F.row_number().over(here) - 1)
    position = F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))
    return (
        local.join(offsets, [*keys, "_piece"], "left")
        .withColumn(name, position.cast("long"))
        .drop("_piece", "_local", "_offset")
    )


def digest(*columns: Column) -> Column:
    """SHA-256 over strings; equal exactly when all of them are equal."""
    parts = [F.concat(F.length(c).cast("string"), F.lit(":"), c) for c in columns]
    # Never null, so that joins on it add no null check that hashes again.
    return F.coalesce(F.unhex(F.sha2(F.concat(*parts), 256)), F.lit(b""))


def _numbered(files: DataFrame, place: list[str], index: str, name: str) -> DataFrame:
    """Number rows by file (in the order of ``place``), then by index in the file."""
    sizes = files.groupBy(*place).agg(F.count("*").alias("_rows"))
    # One row per file: small enough for one ordered window.
    earlier = W.orderBy(*place).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    starts = materialise(sizes.select(*place, start))
    joined = lookup_join(files, starts, place, starts.count(), index)
    number = (F.col("_start") + F.col(index)).cast("long").alias(name)
    rest = [c for c in files.columns if c not in {*place, index}]
    return joined.select(number, *rest)


def number_rows(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number rows 0..n-1 in input order (partition order, then order inside it).

    The frame is written to the shared folder once; a row's number is the number of
    rows in earlier files plus its index in its own file, so it does not depend on
    how the files are split into tasks later. Prefer a key of the source, or
    ``number_files`` for parquet.
    """
    staged = df.sparkSession.read.parquet(written(df, "rows"))
    file = F.col("_metadata.file_name")
    placed = staged.select(
        "*",
        F.regexp_extract(file, r"^part-(\d+)-", 1).cast("long").alias("_part"),
        F.regexp_extract(file, r"-c(\d+)\.", 1).cast("long").alias("_chunk"),
        F.col("_metadata.row_index").alias("_index"),
    )
    return _numbered(placed, ["_part", "_chunk"], "_index", name)


def number_records(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the records of a file scan 0..n-1 by file path and place in the file.

    For formats whose files are read by one task each (multi-line CSV): the place is the
    running number of the task less the file's first one. Nothing is written again; the
    files are read twice, the first time without their columns.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_running"),
    )
    firsts = materialise(
        placed.groupBy("_file").agg(F.min("_running").alias("_first"), F.count("*").alias("_rows"))
    )
    earlier = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    # One row per file: small enough for one ordered window.
    offsets = materialise(firsts.select("_file", start.alias("_offset")))
    joined = lookup_join(placed, offsets, ["_file"], offsets.count(), "_running")
    number = (F.col("_running") + F.col("_offset")).cast("long").alias(name)
    return joined.select(number, *df.columns)


def number_files(spark: SparkSession, path: str, name: str = "row_id") -> DataFrame:
    """Read parquet with rows numbered 0..n-1 by file path and place in the file.

    Nothing is copied: the sizes of the files come from a scan without columns.
    """
    placed = spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    return _numbered(placed, ["_file"], "_index", name)
