"""Fitting a model to a bounded sample inside a task."""

from __future__ import annotations

import os
import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame


def fit_in_task(sample: DataFrame, fit: Callable[[list[dict]], object]):
    """What ``fit`` makes of the rows of ``sample``, whose number its caller bounds.

    The rows meet in one task, in any order; only the fitted model goes to the driver. A
    lost executor costs one more fit.
    """

    def run(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else fit([])


def apart(make: Callable[[], object]):
    """What ``make`` returns, computed in a child process: a worker that is used again does not keep its memory."""
    read, write = os.pipe()
    child = os.fork()
    if child == 0:
        os.close(read)
        try:
            said = pickle.dumps((make(), None))
        except BaseException as error:  # noqa: BLE001 - raised again by the parent
            said = pickle.dumps((None, repr(error)))
        with os.fdopen(write, "wb") as pipe:
            pipe.write(said)
        os._exit(0)
    os.close(write)
    with os.fdopen(read, "rb") as pipe:
        said = pipe.read()
    os.waitpid(child, 0)
    if not said:
        raise RuntimeError("the fitting process died")
    made, error = pickle.loads(said)
    if error is not None:
        raise RuntimeError(error)
    return made
