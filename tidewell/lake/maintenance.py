"""Compaction of many tables from one driver."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target

from tidewell.lake.table import LakeTable


def compact_all(tables: Sequence[LakeTable], workers: int = 4,
                only_due: bool = False) -> dict[str, Exception]:
    """Compact the tables, a few at a time; each is a Spark job of its own.
    A table that fails does not stop the others. Returns the errors by root."""

    def compact(table: LakeTable) -> None:
        if not only_due or table.due():
            table.compact()

    errors: dict[str, Exception] = {}
    with ThreadPoolExecutor(workers) as pool:
        jobs = {t.root: pool.submit(inheritable_thread_target(t.spark)(compact), t) for t in tables}
        for root, job in jobs.items():
            try:
                job.result()
            except Exception as error:
                errors[root] = error
    return errors


def compact_rounds(tables: Sequence[LakeTable], every_seconds: float = 600, workers: int = 4,
                   go_on: Callable[[], bool] = lambda: True,
                   report: Callable[[dict[str, Exception]], None] = lambda errors: None) -> None:
    """Compact all tables again and again, ``every_seconds`` apart, while ``go_on()``."""
    while go_on():
        report(compact_all(tables, workers))
        time.sleep(every_seconds)
