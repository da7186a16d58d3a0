"""Records that keep coming: each micro-batch goes through the same functions as a batch and is appended to the store.

The rules are functions from DataFrame to DataFrame, so they hold for a batch of a stream as they are. A batch replaces its own
version when it is run again, so a restart after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quadrille import terms
from quadrille.store import QuadStore


def ingest(records: DataFrame, to_quads: Callable[[DataFrame], DataFrame], store: QuadStore, source: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Starts a query that writes the statements of a stream of records; ``once`` takes what there is and ends."""

    def batch(rows: DataFrame, number: int) -> None:
        store.replace(to_quads(rows).dropDuplicates(list(terms.KEY)), source, f"batch-{number:012d}")

    writer = records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
