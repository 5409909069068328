"""Whether to build again: a run is skipped if every index is newer than the last change of the graph."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: How build times are written in manifests.
STAMP = "%Y%m%dT%H%M%SZ"  # fixed value


def latest_transaction(log: DataFrame, state: str = "SUCCEEDED") -> DataFrame:
    """(latest): when the last transaction in that state was made; null if there is none.

    An aggregate, not a sort: every task sends one value.
    """
    return log.where(F.col("state") == state).agg(F.max("created_datetime").alias("latest"))


def stamp(when: datetime) -> str:
    return (when if when.tzinfo else when.replace(tzinfo=UTC)).astimezone(UTC).strftime(STAMP)


def read_stamp(text: str) -> datetime:
    return datetime.strptime(text, STAMP).replace(tzinfo=UTC)


def transaction_time(log: DataFrame, state: str = "SUCCEEDED") -> datetime:
    """The last transaction's time in UTC; without one, midnight a day ago, so that missing indices are built."""
    found = latest_transaction(log, state).first()[0]
    if found is None:
        return datetime.now(UTC).replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(days=1)
    if isinstance(found, str):
        found = datetime.fromisoformat(found)
    return found if found.tzinfo else found.replace(tzinfo=UTC)


def must_build(built: Iterable[str | None], last: datetime, force: bool = False) -> bool:
    """``built`` are the stamps of all indices, None where there is no index.

    Nothing is done if all have one stamp and it isn't older than ``last``.
    """
    stamps = list(built)
    if force or not stamps or None in stamps or len(set(stamps)) > 1:
        return True
    return read_stamp(stamps[0]) < last.replace(microsecond=0)


def watch(log: DataFrame, build: Callable[[DataFrame, int], None], checkpoint: str, state: str = "SUCCEEDED", every: str | None = None) -> StreamingQuery:
    """Build once for each batch of new transactions of a streaming ``log``.

    Without ``every`` it takes what there is and ends.  A batch without a
    transaction in that state builds nothing.
    """

    def each(batch: DataFrame, number: int) -> None:
        found = batch.where(F.col("state") == state)
        if not found.isEmpty():
            build(found, number)

    writer = log.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
