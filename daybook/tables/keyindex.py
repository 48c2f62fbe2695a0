"""Which stored files hold which keys: a bitmap per file and bucket of 32,768 consecutive keys.

A batch is compared only with files that hold one of its keys. The index is exact for integer keys, is joined by bucket
(an equality, so no key meets a file that has none of its neighbours), and costs one bit per key where keys run on, a
few compressed bytes more where they are sparse. It is built from the key column alone, once per commit, by the first
reader that needs it: ``<root>/keys/<build>/`` holds the rows of one build and ``<root>/keys/<build>.json`` its commits.
A build without that file, left by a lost driver, does not count and is built again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.tables.daytable import DayTable, Live, Snapshot

SCHEMA = "commit STRING, day DATE, file STRING, bucket BIGINT, bits BINARY, rows BIGINT"


class KeyIndex:
    def __init__(self, table: DayTable):
        kind = table.spec.schema[table.spec.primary_key].dataType
        if not isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            raise TypeError(f"{table.spec.name}: keys must be integers, not {kind.simpleString()}")
        self.table = table
        self.root = f"{table.root}/keys"

    def _builds(self) -> dict[str, frozenset[str]]:
        """Complete builds and the commits each covers."""
        storage = self.table.storage
        return {
            e.name.removesuffix(".json"): frozenset(json.loads(storage.read_text(e.path))["commits"])
            for e in storage.list(self.root)
            if e.name.endswith(".json") and not e.name.startswith(".")
        }

    def refresh(self) -> int:
        """Index the live commits that are not indexed yet, in one job; returns how many."""
        live = self.table.snapshot().live
        known = frozenset().union(*self._builds().values())
        # Every day of such a commit that is live; one that is replaced meanwhile is no longer read.
        missing = [Live(e.day, e.commit, e.files) for e in live if e.commit not in known]
        if not missing:
            return 0
        spec, build = self.table.spec, uuid.uuid4().hex[:16]
        key = F.col(spec.primary_key).cast("bigint")
        rows = self.table.scan_entries(missing).select(
            self.table.file_name().alias("file"), F.col(spec.date_column).alias("day"),
            F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("position"),
        )
        # The same key twice in a file sets one bit; the count tells.
        index = rows.groupBy("file", "day", "bucket").agg(
            F.bitmap_construct_agg("position").alias("bits"), F.count(F.lit(1)).alias("rows")
        )
        commit = F.regexp_extract("file", r"^commit=([^/]+)/", 1)
        columns = ("commit", "day", "file", "bucket", "bits", "rows")
        index.withColumn("commit", commit).select(*columns).write.parquet(f"{self.root}/{build}")
        commits = sorted({e.commit for e in missing})
        self.table.storage.publish_text(f"{self.root}/{build}.json", json.dumps({"commits": commits}))
        return len(commits)

    def rows(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Index rows of a snapshot's files, the newest by default; ``refresh`` first."""
        snapshot = snapshot or self.table.snapshot()
        used = {e.commit for e in snapshot.live}
        paths = [f"{self.root}/{build}" for build, commits in self._builds().items() if commits & used]
        spark = self.table.spark
        if not paths:
            return spark.createDataFrame([], SCHEMA)
        whole, single = self.table.named(
            self.table.snapshots().filter(F.col("snapshot_id") == F.lit(snapshot.snapshot_id))
        )
        index = spark.read.schema(SCHEMA).parquet(*paths)
        return index.join(whole, ["commit", "day"], "left_semi").select(*index.columns).unionByName(
            index.join(single, "file", "left_semi").select(*index.columns)
        )

    def holders(self, keys: DataFrame) -> DataFrame:
        """``commit, day, file`` of the stored files that hold one of ``keys`` (a frame with the table's key)."""
        key = F.col(self.table.spec.primary_key).cast("bigint")
        # Bitmaps meet bitmaps: a row per file and bucket, however many keys both have.
        wanted = keys.filter(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("wanted")
        )
        found = self.rows().select("commit", "day", "file", "bucket", "bits").join(wanted, "bucket")
        both = found.select("commit", "day", "file", "bucket", F.explode(F.array("bits", "wanted")).alias("bits"))
        shared = both.groupBy("commit", "day", "file", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("keys"))
        return shared.filter("keys > 0").select("commit", "day", "file").distinct()

    def prune(self) -> int:
        """Remove builds of which no retained snapshot needs a commit; returns how many."""
        published = self.table.published_commits()
        gone = [build for build, commits in self._builds().items() if not commits & published]
        for build in gone:
            self.table.storage.delete(f"{self.root}/{build}.json")
            self.table.storage.delete(f"{self.root}/{build}")
        return len(gone)
