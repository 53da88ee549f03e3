"""Actions that run at the same time; Spark's scheduler interleaves their tasks."""

from __future__ import annotations

import queue
import threading
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.util import inheritable_thread_target


def start_all(spark: SparkSession, actions: Mapping[str, Callable[[], Any]]) -> dict[str, Future]:
    """Start each action on its own driver thread and return at once.

    The jobs of an action carry its name as tag, so ``stop(spark, name)`` ends them. Set
    ``spark.scheduler.mode=FAIR`` to let them share a busy cluster evenly.
    """
    pool = ThreadPoolExecutor(max_workers=max(1, len(actions)))

    def tagged(tag: str, action: Callable[[], Any]) -> Any:
        # The session's tags are known to their own thread only, the context's to all.
        spark.addTag(tag)
        spark.sparkContext.addJobTag(tag)
        return action()

    # Wrapped once per action: the wrapper holds the job properties its thread will change.
    futures = {
        tag: pool.submit(inheritable_thread_target(spark)(tagged), tag, action)
        for tag, action in actions.items()
    }
    pool.shutdown(wait=False)
    return futures


def stop(spark: SparkSession, tag: str) -> None:
    """Cancel the jobs that carry the tag; the action that waits for them fails."""
    spark.sparkContext.cancelJobsWithTag(tag)


def collect_nowait(df: DataFrame, tag: str, at_most: int = 100_000) -> Future[list[Row]]:
    """Start collecting ``df``; ``.result()`` waits for the rows.

    A result of more than ``at_most`` rows raises ValueError and is not brought to the driver whole.
    """

    def collect() -> list[Row]:
        rows = df.limit(at_most + 1).collect()
        if len(rows) > at_most:
            raise ValueError(f"more than {at_most} rows")
        return rows

    return start_all(df.sparkSession, {tag: collect})[tag]


def run_all(spark: SparkSession, actions: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """The results of all actions, run at the same time.

    When one fails, the jobs of the others are interrupted and its error is raised; results that nobody
    will see need not be computed to the end.
    """
    futures = start_all(spark, actions)
    done, running = wait(futures.values(), return_when=FIRST_EXCEPTION)
    failed = next((future for future in done if future.exception() is not None), None)
    if failed is None:
        return {tag: future.result() for tag, future in futures.items()}
    while running:
        # An action may start another job after an interruption.
        for tag, future in futures.items():
            if future in running:
                stop(spark, tag)
        _, running = wait(running, timeout=0.5)
    raise failed.exception()


class RowStream(Iterator[Row]):
    """Rows of a running query, in the order of its partitions; see ``stream_nowait``."""

    def __init__(self, df: DataFrame, tag: str, ahead: int):
        self.spark, self.tag = df.sparkSession, tag
        self.rows: queue.Queue = queue.Queue(maxsize=ahead)
        self.closed = threading.Event()
        self.future = start_all(self.spark, {tag: lambda: self._fetch(df)})[tag]

    def _fetch(self, df: DataFrame) -> None:
        try:
            # One partition is fetched while the one before it is read.
            for row in df.toLocalIterator(prefetchPartitions=True):
                if not self._put(row):
                    return
            self._put(None)
        except Exception as error:
            self._put(error)

    def _put(self, item: Row | Exception | None) -> bool:
        while not self.closed.is_set():
            try:
                self.rows.put(item, timeout=0.1)
                return True
            except queue.Full:
                continue
        return False

    def __next__(self) -> Row:
        if self.closed.is_set():
            raise StopIteration
        item = self.rows.get()
        if isinstance(item, Exception):
            self.close()
            raise item
        if item is None:
            self.closed.set()
            raise StopIteration
        return item

    def close(self) -> None:
        """Abandon the query: its jobs are interrupted and no further row is fetched."""
        if not self.closed.is_set():
            self.closed.set()
            stop(self.spark, self.tag)

    def __enter__(self) -> RowStream:
        return self

    def __exit__(self, *raised) -> None:
        self.close()


def stream_nowait(df: DataFrame, tag: str, ahead: int = 10_000) -> RowStream:
    """Start ``df`` and return an iterator over its rows at once, for results of any size.

    The driver holds two partitions and ``ahead`` rows at most. Closing the iterator, or leaving its
    ``with`` block, abandons what is left. An error of the query is raised where its rows would come.
    """
    return RowStream(df, tag, ahead)
