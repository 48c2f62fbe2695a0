"""What the operators share: reading tables, cutting lineage, bounded samples of labelled rows, shipping the package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.tables.storage import Storage, scratch_folder

ROW_KEY = "__row_key"

# Bytes of a batch on its way to a Python worker. Spark's own limit of 64 MB is held twice on each side, by every task
# of an executor; results do not depend on it. A session that sets a limit of its own keeps it.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_BATCH, BATCH = "67108864b", "8m"

# A write's shuffle files go as soon as it ends. Otherwise they stay until the driver happens to collect its garbage, and at
# some GB of input those of several steps lie there together.
SHUFFLES_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BITMAP = 1 << 15  # bits that bitmap_construct_agg has in a row
BITMAPS = 1 << 11  # rows at most: 8 MB
BITS_EACH = 32

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, and batches of a moderate size."""
    if spark.conf.get(BATCH_SETTING) == SPARKS_BATCH:
        spark.conf.set(BATCH_SETTING, BATCH)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="run-ship-")) / "daybook_workers.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: later steps survive a lost executor without the work before."""
    return _written(frame, scratch_folder(frame.sparkSession, label))


@contextmanager
def passing(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """The same for rows that are read within the block only: their folder goes at its end."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, label)
    try:
        yield _written(frame, folder)
    finally:
        Storage(spark).delete(folder)


def _written(frame: DataFrame, folder: str) -> DataFrame:
    spark, path = frame.sparkSession, f"{folder}/rows"
    before = spark.conf.get(SHUFFLES_SETTING, "false")
    spark.conf.set(SHUFFLES_SETTING, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_SETTING, before)
    return spark.read.schema(frame.schema).parquet(path)


def narrowed(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is among ``ids``, and a few others: before a join that would shuffle all rows as a whole.

    Every task gets a bitmap of hashed ids, of about ``BITS_EACH`` bits an id and 8 MB at most; from about ten million ids
    on it lets more and more other rows through. It never loses a row.
    """
    parts = min(BITMAPS, max(1, -(-ids.count() * BITS_EACH // BITMAP)))

    def place(expression: Column) -> Column:
        return F.pmod(F.xxhash64(expression), F.lit(parts * BITMAP))

    spots = ids.select(place(F.col(column)).alias("spot"))
    bitmap = spots.groupBy(F.expr(f"spot div {BITMAP}").alias("part")).agg(F.bitmap_construct_agg(F.col("spot") % BITMAP).alias("bits"))
    placed = rows.withColumn("spot", place(F.col(column))).withColumn("part", F.expr(f"spot div {BITMAP}"))
    byte = F.expr(f"substring(bits, cast((spot % {BITMAP}) div 8 + 1 AS INT), 1)")
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("spot") % 8).cast("int")) == 1
    return placed.join(F.broadcast(bitmap), "part").where(hit).select(*rows.columns)


def keyed(frame: DataFrame, label: str) -> DataFrame:
    """The rows with a key of their own in ``ROW_KEY``, written out once so that every later read sees the same keys."""
    return saved(frame.withColumn(ROW_KEY, F.monotonically_increasing_id()), label)


def fold(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null"))) % parts


def labelled_sample(rows: DataFrame, labels: DataFrame, limit: int) -> pa.Table:
    """At most ``limit`` labelled rows (doc_id, text, label) in an order that only depends on the ids.

    ``labels`` has doc_id and label; rows with a null in either are left out, repeated labels count once. Of several
    rows with one id the one whose text has the smallest hash is taken, in the map tasks already.
    """
    return _with_texts(rows, _labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def sample_by_label(rows: DataFrame, labels: DataFrame, limit: int) -> tuple[pa.Table, dict]:
    """The same with at most ``limit`` rows of each label, and how many labelled ids there are of each.

    Labels are few. Ids are thinned by their hash to about twice the limit before a label's are ordered.
    """
    known = _labels(labels)
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).toArrow()
    if not sizes.num_rows:
        return _with_texts(rows, known.limit(0)), {}
    counted = rows.sparkSession.createDataFrame(sizes)
    steps = 1 << 30
    kept_step = F.ceil(F.lit(2.0 * limit * steps) / F.col("n"))
    thinned = known.join(F.broadcast(counted), "label").where(
        (F.col("n") <= 4 * limit) | (F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < kept_step)
    )
    nth = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    picked = thinned.withColumn("nth", nth).where(F.col("nth") <= limit).select("doc_id", "label")
    return _with_texts(rows, picked), dict(zip(sizes["label"].to_pylist(), sizes["n"].to_pylist()))


def _labels(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))


def _with_texts(rows: DataFrame, picked: DataFrame) -> pa.Table:
    """The picked ids (a bounded number) with one text each."""
    found = picked.toArrow()
    ids = rows.sparkSession.createDataFrame(found) if found.num_rows else picked.limit(0)
    texts = rows.select("doc_id", "text").where("text IS NOT NULL")
    # Two columns of a bounded number of rows: the bound of this broadcast.
    joined = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("row")
    )
    return joined.select("doc_id", "row.text", "row.label").toArrow().sort_by([("doc_id", "ascending")])


def slices(values: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``most`` bytes together; a longer text stands alone."""
    first, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += int(n)
    if first < len(values):
        yield first, len(values)
