"""The sweep as a Structured Streaming sink over the committed state.

Spark's commit log decides which files a batch has; the state folder is versioned, and its pointer is
written last.  A batch that is repeated after a crash finds its number in the pointer, or is applied to
the state before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from syncweave.plans.commit import StateFolder
from syncweave.plans.incremental import PAYLOAD, Summary, _apply
from syncweave.schema import Field
from syncweave.sources.fact import latest_per_key


def sweep_batch(folder: StateFolder, batch: DataFrame, batch_id: int, capacity: int, fields: tuple[Field, ...] = PAYLOAD) -> Summary | None:
    """One micro-batch; None if it was applied before."""
    version, mark = folder.latest()
    if version >= batch_id + 1:
        return None
    done, summary = _apply(latest_per_key(batch), folder.load(), capacity, mark or "", fields)
    done.watermark = max(filter(None, (mark, summary.new_watermark)), default=None)
    folder.save(done, batch_id + 1)
    folder.prune()
    return summary


def start(stream: DataFrame, folder: StateFolder, checkpoint: str, capacity: int = 20_000, fields: tuple[Field, ...] = PAYLOAD, **trigger):
    """Starts the sweep; trigger: ``availableNow=True`` for one drain, or ``processingTime='15 minutes'``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        sweep_batch(folder, batch, batch_id, capacity, fields)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
