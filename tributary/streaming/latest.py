"""Latest-wins deduplication in a stream, with a bound on how far apart a record's versions may be.

Spark keeps one row per record and session in its state: versions less than ``bound`` apart in event time
belong together, whatever order they come in. A session leaves the state, as one row, once the watermark
has passed its end; a version that comes later than that, or later than the watermark, is dropped from the
stream. The state thus holds the records of the last ``bound`` only. The raw table keeps every version, so
a batch run still sees what the stream dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_versions(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], event_time: str,
                    bound: str) -> DataFrame:
    """One row per record and session: its greatest version by ``newest_first``, and ``n_versions``.

    Repeated versions count in ``n_versions`` only. Rows without an event time belong to no session. On a
    table the same frame gives what the stream gives for rows that are never late.
    """
    if df.isStreaming:
        df = df.withWatermark(event_time, bound)
    version = F.max_by(F.struct(*df.columns), F.struct(*newest_first))
    return (df.groupBy(*keys, F.session_window(event_time, bound).alias("_session"))
            .agg(version.alias("_row"), F.count("*").alias("n_versions"))
            .select("_row.*", "n_versions"))


def start_latest(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], newest_first: Sequence[str],
                 event_time: str, bound: str) -> StreamingQuery:
    """Write closed records to Parquet files, each once, until everything that has arrived is done."""
    return (latest_versions(stream, keys, newest_first, event_time, bound)
            .writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(target))
