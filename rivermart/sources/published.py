"""A keyed table that a stream publishes for other jobs, as plain Parquet.

The stream's own state, in Spark's state store, is the table; what it publishes
are the rows each batch has changed and, now and then, a whole copy. Whole copies
are sorted by key and carry Bloom filters, so a read of a few keys opens the pages
that may hold them and no others. Folders are named by batch: writing one again
replaces it, and one without Spark's success mark does not count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rivermart.operators.keyed import upsert_latest
from rivermart.operators.lookup import keyed_scan
from rivermart.sources.storage import finished_batches, remove_folder

#: Keys that are written into a scan's filter; more are joined.
LISTED_KEYS = 1000
PUSHDOWN = "spark.sql.parquet.pushdown.inFilterThreshold"
BATCH = "batch"


def write_sorted(rows: DataFrame, folder: str, key: str, **options: str) -> None:
    """Parquet files by ranges of ``key``, sorted, with small pages and a Bloom filter on it."""
    (rows.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite")
     .options(**{f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
                 "parquet.page.row.count.limit": "1000", **options}).parquet(folder))


def pick_keys(rows: DataFrame, key: str, facts: DataFrame, fact_key: str, listed: int = LISTED_KEYS) -> DataFrame:
    """The rows of a scan whose key occurs in the facts.

    Up to ``listed`` keys go into the scan's own filter, which Parquet checks against
    page bounds and Bloom filters; beyond that the keys are joined.
    """
    kind = rows.schema[key].dataType.simpleString()
    wanted = facts.select(F.col(fact_key).cast(kind).alias("_key")).where("_key IS NOT NULL").distinct()
    found = [row[0] for row in wanted.limit(listed + 1).collect()]
    if len(found) > listed:
        return keyed_scan(rows, key, facts, fact_key)
    conf = rows.sparkSession.conf
    if int(conf.get(PUSHDOWN)) < listed:
        conf.set(PUSHDOWN, str(listed))
    return rows.where(F.col(key).isin(found))


@dataclass(frozen=True)
class PublishedTable:
    """The table under ``path``, one row per ``key``. One stream writes it, any job reads it.

    After ``every`` batches of changes a new whole copy is written. What the copy
    before last needed is removed then, so a read outlasts ``every`` batches.
    The table belongs to its stream's checkpoint: a new checkpoint starts from the
    topic's beginning and publishes to a new folder.
    """
    spark: SparkSession
    path: str
    columns: str
    key: str = "id"
    every: int = 50

    def put(self, rows: DataFrame, batch: int) -> None:
        """Publish a batch's rows, one per key."""
        rows.write.mode("overwrite").parquet(self._folder("changes", batch))

    def gather(self, before: int) -> None:
        """Write a whole copy of what the batches before have published, if it is time."""
        wholes, changes = self._state(before)
        if len(changes) < self.every:
            return
        write_sorted(self.read(before), self._folder("whole", changes[-1]), self.key)
        last = wholes[-1] if wholes else -1
        for kind, numbers in (("whole", wholes[:-1]), ("changes", self._numbers("changes"))):
            for number in numbers:
                if number <= last:
                    remove_folder(self.spark, self._folder(kind, number))

    def read(self, before: int | None = None) -> DataFrame:
        """The table, or what it was before a batch."""
        return self._merged(before, lambda rows: rows)

    def read_keys(self, facts: DataFrame, fact_key: str) -> DataFrame:
        """The rows whose key occurs in the facts, picked before the merge."""
        return self._merged(None, lambda rows: pick_keys(rows, self.key, facts, fact_key))

    def _merged(self, before: int | None, wanted) -> DataFrame:
        wholes, changes = self._state(before)
        parts = [wanted(self._load("whole", wholes[-1:])) if wholes else None,
                 wanted(self._load("changes", changes)) if changes else None]
        parts = [part for part in parts if part is not None]
        if not parts:
            return self.spark.range(0).select(*(
                F.lit(None).cast(field.dataType).alias(field.name) for field in StructType.fromDDL(self.columns)))
        if not changes:
            return parts[0].drop(BATCH)
        return upsert_latest(parts[0] if len(parts) == 2 else None, parts[-1], [self.key], [BATCH]).drop(BATCH)

    def _state(self, before: int | None) -> tuple[list[int], list[int]]:
        """Numbers of the whole copies, and of the changes that the last of them lacks."""
        def earlier(kind: str) -> list[int]:
            return [n for n in self._numbers(kind) if before is None or n < before]
        wholes = earlier("whole")
        return wholes, [n for n in earlier("changes") if not wholes or n > wholes[-1]]

    def _numbers(self, kind: str) -> list[int]:
        return finished_batches(self.spark, f"{self.path}/{kind}")

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/{BATCH}={batch}"

    def _load(self, kind: str, batches: list[int]) -> DataFrame:
        return (self.spark.read.schema(f"{self.columns}, {BATCH} bigint").option("basePath", f"{self.path}/{kind}")
                .parquet(*(self._folder(kind, batch) for batch in batches)))
