"""Enrichment of rows by an external call, concurrently within each task."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


class Unavailable(Exception):
    """Raised by a call whose failure is worth a retry, such as a server error."""


#: Failures that are retried; OSError covers connections and sockets.  Any other error is a fault of the call and fails the task.
RETRIED = (Unavailable, OSError)


def call_with_retry(call: Callable[[dict], dict | None], row: dict, retries: int, delay: float, backoff: float,
                    deadline: float, retry_empty: bool, sleep=time.sleep) -> dict | None:
    """Result of the call, retried after ``RETRIED`` errors and (where asked) empty results; None when it never succeeds."""
    for attempt in range(retries + 1):
        try:
            result = call(row)
            if result or not retry_empty:
                return result
        except RETRIED:
            pass
        pause = delay * backoff**attempt
        if attempt == retries or time.monotonic() + pause > deadline:
            return None
        sleep(pause)
    return None


def enrich(df: DataFrame, call: Callable[[dict], dict | None], outputs: str, fallback: str = "drop",
           capacity: int = 100, timeout: float = 2.0, retries: int = 3, delay: float = 1.0, backoff: float = 1.0,
           retry_empty: bool = True) -> DataFrame:
    """Rows with the fields a call returns; order is not kept.

    Up to ``capacity`` calls run at once in each task, across its batches, and
    results leave as they complete.  A call that fails to the end, or has no
    result ``timeout`` seconds after it began, drops its row (``drop``) or lets
    it through with NULLs (``passthrough``); a late result is ignored and its
    place is free for another row.  Errors other than ``RETRIED`` fail the
    task.  Fixed delays have ``backoff=1``; 2 doubles the delay each time.
    """
    if fallback not in ("drop", "passthrough"):
        raise ValueError(f"unknown fallback {fallback}")
    added = StructType.fromDDL(outputs)
    schema = StructType([*df.schema.fields, *added.fields])
    names = [f.name for f in added.fields]
    new_fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in added.fields]

    def run(batches):
        answers, waiting, done_rows, number = queue.SimpleQueue(), {}, [], 0

        def work(number: int, row: dict, deadline: float) -> None:
            try:
                answers.put((number, call_with_retry(call, row, retries, delay, backoff, deadline, retry_empty), None))
            except BaseException as error:  # raised again in the task's own thread
                answers.put((number, None, error))

        def leave(row: dict, result: dict | None) -> None:
            if result:
                done_rows.append({**row, **{n: result.get(n) for n in names}})
            elif fallback == "passthrough":
                done_rows.append({**row, **dict.fromkeys(names)})

        def collect() -> None:
            """Wait for one answer, at most until the oldest call's deadline."""
            first = next(iter(waiting))
            row, deadline = waiting[first]
            try:
                number, result, error = answers.get(timeout=max(0.0, deadline - time.monotonic()))
            except queue.Empty:
                del waiting[first]
                return leave(row, None)
            if number not in waiting:
                return None
            if error is not None:
                raise error
            row, deadline = waiting.pop(number)
            return leave(row, result)

        def finished(form: pa.Schema) -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(done_rows, schema=pa.schema([*form, *new_fields]))
            done_rows.clear()
            return out

        form = None
        for batch in batches:
            form = batch.schema
            for row in batch.to_pylist():
                while len(waiting) >= capacity:
                    collect()
                number += 1
                deadline = time.monotonic() + timeout
                waiting[number] = row, deadline
                # A thread of its own that ends with the process: a stuck call holds up neither the task nor other calls.
                threading.Thread(target=work, args=(number, row, deadline), daemon=True).start()
            yield finished(form)
        while waiting:
            collect()
        if done_rows:
            yield finished(form)

    return df.mapInArrow(run, schema)
