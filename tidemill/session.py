"""Session settings and the helpers every multi-step job needs: scratch tables and size checks."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: A side may be broadcast, or shipped to tasks, only up to this many rows.
BROADCAST_ROWS = 10_000
#: As many bytes of rows go to a Python worker at once, unless the session says otherwise.
BATCH_BYTES = 4 << 20
#: Spark's setting that removes the shuffle files of a query when it ends; else they stay until the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "tidemill", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume: UTC, adaptive execution, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call sites for every column expression make building a large plan several times slower.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package, once per application, wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_tidemill_shipped", False):
        return
    folder = Path(__file__).resolve().parent
    place = tempfile.TemporaryDirectory()  # executors fetch the file from the driver, so it stays as long as the application
    archive = Path(place.name) / "tidemill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(folder.rglob("*.py")):
            out.write(file, Path(folder.name) / file.relative_to(folder))
    context.addPyFile(str(archive))
    context._tidemill_shipped = place


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only on a local master, where driver and tasks share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, *, large: bool = False) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back, which drops the lineage.

    The copy outlives any executor, the rows are computed once (a checkpoint computes them twice), and the
    planner knows the size of what it reads, so it can tell small sides from large ones. ``large`` is for rows of up to megabytes:
    row groups are then closed by their size, looked at after every row, and compressed harder. Shuffle files of the rows go
    once they are written, unless the session sets ``FREE_SHUFFLES`` itself.
    """
    path = scratch_path(df.sparkSession, "step")
    writer = df.write
    if large:
        writer = writer.options(**{"compression": "zstd", "parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1})
    conf = df.sparkSession.conf
    free = conf.get(FREE_SHUFFLES, None) is None
    if free:
        conf.set(FREE_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        if free:
            conf.unset(FREE_SHUFFLES)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order, name: str = "pos") -> DataFrame:
    """``df`` with the places 0, 1, ... of its rows in an order, dealt to tasks by ranges; the order should settle ties."""
    rows = cut(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_place", "_part", "_before")


def bound_batches(spark: SparkSession) -> None:
    """Let long rows go to Python workers in batches of a few MB: the usual 10,000 texts take tens of MB, several times over on either side."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, spark.conf.get(key, str(BATCH_BYTES)))


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads no more than ``limit + 1`` of them."""
    return df.limit(limit + 1).count() <= limit
