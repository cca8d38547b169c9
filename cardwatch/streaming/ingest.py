"""T5: continuous feed ingest with archiving, as Structured Streaming jobs.

A file source watches the inbox for new feed files.  Only their paths stream
(the files' content is not read by the source); each micro-batch loads its
files through the same readers as the batch loads, so columns are bound by
header name and a header-only file keeps its meaning.  A loaded file moves to
``archive_dir`` as soon as its load is committed, the last one too.

Progress lives in ``checkpoint`` on the shared file system, so a restarted
driver continues where it stopped.  Each file is loaded through the load
ledger, which knows a file that is loaded, and every load is safe to replay:

* transactions: T2 + K1 with the ``skip`` policy drops rows already loaded;
* blacklist: insert-if-absent (L1) adds nothing the second time;
* terminal snapshots: one file per micro-batch, in day order within a
  backlog of one batch; each is applied at the start of its file's day (or at
  ``as_of``) as its own history version (L10).  Applying the same snapshot
  again changes nothing, and one that arrives after a later day's is refused.

A file that a replayed batch names but that is archived already was loaded
before: it is skipped.  Run with ``Trigger.AvailableNow`` for a backlog, or a
processing-time trigger for continuous arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cardwatch.plans.daily import ARCHIVED, load_feed
from cardwatch.plans.warehouse import Warehouse
from cardwatch.sources.feeds import feed_day_of, feed_present
from cardwatch.sources.files import move

# Feed file patterns picked up by the streams.
TRANSACTIONS_PATTERN = "transactions_*.txt"
BLACKLIST_PATTERN = "passport_blacklist_*.csv"
TERMINALS_PATTERN = "terminals_*.csv"

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def feed_files(spark: SparkSession, feed_dir: str, pattern: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of new feed files."""
    reader = (spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("pathGlobFilter", pattern)
              .option("ignoreMissingFiles", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(feed_dir).select("path")


def _ingest(wh: Warehouse, files: DataFrame, load: Callable[[str], None], checkpoint: str, archive_dir: str | None,
            available_now: bool, processing_time: str | None) -> StreamingQuery:
    def load_batch(batch: DataFrame, _epoch: int) -> None:
        # a batch names as many files as the trigger admits, in day order
        paths = sorted((r.path for r in batch.collect()), key=lambda p: (str(feed_day_of(p)), p))
        for path in paths:
            if feed_present(wh.spark, path):
                load(path)
                if archive_dir:
                    move(wh.spark, path, archive_dir, ARCHIVED)

    wh.ensure_tables()
    writer = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_transactions(wh: Warehouse, feed_dir: str, checkpoint: str, archive_dir: str | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        key_policy: str = "skip", pattern: str = TRANSACTIONS_PATTERN) -> StreamingQuery:
    """Start the transactions ingest; with ``available_now`` it stops after
    the backlog."""
    def load(path: str) -> None:
        load_feed(wh, "transactions", path, feed_day_of(path), key_policy=key_policy, fmt="csv")

    return _ingest(wh, feed_files(wh.spark, feed_dir, pattern), load, checkpoint, archive_dir, available_now,
                   processing_time)


def ingest_blacklist(wh: Warehouse, feed_dir: str, checkpoint: str, archive_dir: str | None = None,
                     available_now: bool = True, processing_time: str | None = None,
                     pattern: str = BLACKLIST_PATTERN) -> StreamingQuery:
    """Start the document-blacklist ingest: each file is loaded with L1 as a
    daily run would (a passport repeated inside one file is kept twice; one
    repeated on a later day is not)."""
    return _ingest(wh, feed_files(wh.spark, feed_dir, pattern),
                   lambda path: load_feed(wh, "blacklist", path, feed_day_of(path), fmt="csv"), checkpoint,
                   archive_dir, available_now, processing_time)


def ingest_terminals(wh: Warehouse, feed_dir: str, checkpoint: str, archive_dir: str | None = None,
                     available_now: bool = True, processing_time: str | None = None,
                     pattern: str = TERMINALS_PATTERN, mode: str = "reference", as_of=None) -> StreamingQuery:
    """Start the terminal-snapshot ingest: each file is applied at ``as_of``,
    by default the start of the day in its name.  A file with only a header
    deletes every terminal, as an empty snapshot must."""
    def load(path: str) -> None:
        day = feed_day_of(path)
        if as_of is None and day is None:
            raise ValueError(f"no day in the name of {path}")
        load_feed(wh, "terminals", path, day, as_of=as_of, history_mode=mode, fmt="csv")

    return _ingest(wh, feed_files(wh.spark, feed_dir, pattern), load, checkpoint, archive_dir, available_now,
                   processing_time)
