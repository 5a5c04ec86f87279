"""Folders as streams of changes: also a file that is rewritten under its old path arrives, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicledger.sources.files import checksums, file_listing
from civicledger.streaming.ingest import ingest

VERSION = ["size_bytes", "modified"]
CHANGES = "relative_path string, kind string, size_bytes bigint, modified bigint, number int"


def listing_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What differs between two listings: (relative_path, kind, size_bytes, modified).

    ``kind`` is ``added``, ``changed`` (another size or time, also an earlier one) or ``removed``, whose size and time
    are those it had. Paths are distinct within a listing.
    """
    old = before.select("relative_path", F.struct(*VERSION).alias("old"))
    new = after.select("relative_path", F.struct(*VERSION).alias("new"))
    both = old.join(new, "relative_path", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.select("relative_path", kind.alias("kind"), F.coalesce("new", "old").alias("version")).select("relative_path", "kind", "version.*")


class FolderChanges:
    """The listings of a folder and what changed between them, as tables below ``state``.

    ``poll`` takes a listing and appends the changes; ``stream`` reads them as they are appended. A poll that was
    interrupted is finished by the next one from the listing it had taken. One process polls at a time; listings before
    the last one are kept only as a history.
    """

    def __init__(self, spark: SparkSession, root: str, state: str, glob: str | None = None, direct: tuple[str, ...] = ("file",)):
        self.spark, self.root, self.state, self.glob, self.direct = spark, root, state.rstrip("/"), glob, direct

    def _finished(self, table: str) -> int:
        """The number of the last finished part of a table, 0 before the first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{table}/number=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return max((int(status.getPath().getParent().getName().split("=")[1]) for status in found), default=0)

    def listing(self, number: int) -> DataFrame:
        """A listing by its number; the one before the first is empty."""
        kind = "relative_path string, size_bytes bigint, modified bigint"
        if not number:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(f"{self.state}/listings/number={number}")

    def poll(self) -> int:
        """Lists the folder and appends what changed since the last poll; gives the listing's number."""
        number = self._finished("changes") + 1
        if self._finished("listings") < number:
            found = file_listing(self.spark, self.root, self.glob, self.direct).drop("path")
            found.write.mode("overwrite").parquet(f"{self.state}/listings/number={number}")
        changes = listing_changes(self.listing(number - 1), self.listing(number))
        changes.write.mode("overwrite").parquet(f"{self.state}/changes/number={number}")
        return number

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(CHANGES).parquet(f"{self.state}/changes")

    def ingest(self, manifest: str, checkpoint: str) -> int:
        """Polls, and adds an entry to the manifest log for each file whose content is new under its path.

        Of several changes of one path since the last run the last counts, and none if that is its removal. A file that
        is touched but not changed, or a batch that is repeated, adds nothing.
        """
        number = self.poll()

        def entries(batch: DataFrame) -> DataFrame:
            last = batch.groupBy("relative_path").agg(F.max_by(F.struct("kind", *VERSION), "number").alias("last"))
            present = last.where("last.kind <> 'removed'").select("relative_path", "last.*")
            summed = checksums(self.spark, self.root, present, self.direct).where("checksum IS NOT NULL")
            time = F.date_format(F.timestamp_millis("modified"), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
            return present.join(summed, "relative_path").select("relative_path", "checksum", "size_bytes", time.alias("timestamp"))

        ingest(self.stream(), entries, manifest, checkpoint)
        return number
