"""Run operators on a stream.

``tokenize``, ``extract`` and ``extract_first`` need no state, so with a model built for
``lookup="inline"`` they take a streaming DataFrame as it is; ``write_stream`` only starts the query.
Operators that need a batch, above all those that look word lists up by join, run on one
micro-batch after the other: ``write_batches``. Both append to files and go on after a failure, by a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to files under ``path``, each row once.

    ``available_now`` takes what is there, in several batches if it is much, and stops.
    """
    if not stream.isStreaming:
        raise ValueError("write_stream needs a streaming DataFrame; use df.write for a batch")
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


#: Sinks in which what a batch wrote before a failure can be replaced as a whole.
FILE_FORMATS = ("parquet", "orc", "json", "csv")
BATCH = "batch_id"


def write_batches(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Write ``work(batch)`` of each micro-batch of a stream under ``path``, each row once.

    ``work`` gets a batch and may join, sort and aggregate it. A batch fills a folder of its own,
    named by its number, and a batch that is repeated after a failure replaces that folder, so no row
    is lost or doubled. Read back, the files have the number as a column ``batch_id``.
    """
    if not stream.isStreaming:
        raise ValueError("write_batches needs a streaming DataFrame; use df.write for a batch")
    if fmt not in FILE_FORMATS:
        raise ValueError(
            f"sink {fmt!r} cannot replace a batch that was written before; use one of {', '.join(FILE_FORMATS)}"
        )

    def replace(batch: DataFrame, number: int) -> None:
        work(batch).write.format(fmt).mode("overwrite").save(f"{path}/{BATCH}={number}")

    writer = stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
