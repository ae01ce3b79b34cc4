"""Handing rows to an external store in batches, from the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from linernotes import fixed_values as fv


def deliveries(
    df: DataFrame, send: Callable[[list[dict]], None], batch_rows: int = fv.SINK_BATCH_ROWS
) -> DataFrame:
    """Call ``send`` with lists of at most ``batch_rows`` rows; one result row per call.

    A retried task sends its rows again, so ``send`` has to be a keyed upsert.
    """

    # A nested function travels to the executors by value.
    def run(frames: Iterator) -> Iterator:
        import pyarrow as pa

        pending: list[dict] = []

        def sent(rows: list[dict]):
            send(rows)
            return pa.RecordBatch.from_pydict({"rows": pa.array([len(rows)], pa.int64())})

        for frame in frames:
            pending.extend(frame.to_pylist())
            while len(pending) >= batch_rows:
                yield sent(pending[:batch_rows])
                del pending[:batch_rows]
        if pending:
            yield sent(pending)

    return df.mapInArrow(run, "rows BIGINT")


def deliver(
    df: DataFrame, send: Callable[[list[dict]], None], batch_rows: int = fv.SINK_BATCH_ROWS
) -> int:
    """Send all rows now; returns how many were sent."""
    total = deliveries(df, send, batch_rows).agg(F.coalesce(F.sum("rows"), F.lit(0)))
    return total.first()[0]
