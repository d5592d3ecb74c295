"""Incremental (Structured Streaming) runs of the aggregations that have a
bounded result: the business functions are pure DataFrame transformations,
so the same function runs on a streaming source.

* ``txn_totals_by_type``: state = one row per transaction type;
* ``orders_per_hour``: state = 24 hours; the items stream is joined to the
  static orders table (stream-static join, no join state);
* ``trial_starts_per_week``: state = one row per week.

Results are kept in ``complete`` mode (the whole small table every trigger).
Progress and state live under the session's checkpoint folder, so a restarted
or re-scheduled query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean
from ..plans import bank, delivery, subscriptions
from ..session import checkpoint_dir
from ..sources import bindings as b
from ..sources import schemas
from ..sources.paths import hadoop_path
from ..sources.tables import Tables


class StreamingTables(Tables):
    """Like ``Tables`` but the tables named in ``streamed`` are file streams
    (new Parquet files under the table path are picked up as they arrive)."""

    def __init__(self, spark: SparkSession, root: str, streamed: Iterable[str],
                 max_files_per_trigger: int | None = None):
        super().__init__(spark, root)
        self.streamed = set(streamed)
        self.max_files = max_files_per_trigger

    def __call__(self, name: str) -> DataFrame:
        if name not in self.streamed:
            return super().__call__(name)
        reader = self.spark.readStream.schema(schemas.TABLES[name])
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        path = self.path(name)
        fs, hp = hadoop_path(self.spark, path)
        # a file stream watches a folder; a single-file table is watched
        # through a glob on its name
        return reader.parquet(path if fs.getFileStatus(hp).isDirectory() else path + "*")


# key -> (streamed tables, builder of the result from StreamingTables)
STREAMABLE: dict[str, tuple[tuple[str, ...], Callable[[StreamingTables], DataFrame]]] = {
    "txn_totals_by_type": (("orders",), lambda t: bank.txn_totals_by_type(b.customer_transactions(t))),
    "orders_per_hour": (("lineitem",), lambda t: delivery.orders_per_hour(
        clean.clean_customer_orders(b.customer_orders(t)))),
    "trial_starts_per_week": (("events",), lambda t: subscriptions.trial_starts_per_week(b.subscriptions(t))),
}


def start(spark: SparkSession, key: str, root: str, query_name: str | None = None,
          sink: str = "memory", available_now: bool = True,
          checkpoint_location: str | None = None) -> StreamingQuery:
    """Start the streaming twin of ``key`` over the tables under ``root``.
    ``available_now`` processes what is there and stops; otherwise it keeps
    running on new files.  The memory sink exposes ``query_name`` as a table."""
    streamed, build = STREAMABLE[key]
    df = build(StreamingTables(spark, root, streamed))
    name = query_name or f"{key}_stream"
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/tillroll-streams/{name}"
    w = (df.writeStream.outputMode("complete").format(sink).queryName(name)
         .option("checkpointLocation", location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
