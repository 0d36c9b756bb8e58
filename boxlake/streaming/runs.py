"""Best epochs and early stops while a run is going on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from boxlake.operators.runs import STOP_PATIENCE
from boxlake.sources.sinks import append_history

_OUT = "epoch int, val_loss double, is_best boolean, stop_epoch int"
_STATE = "best double, best_epoch int, stop_epoch int"


def follow_runs(log: DataFrame, patience: int = STOP_PATIENCE, forget_ms: int | None = None) -> DataFrame:
    """Every epoch of a stream (run_id, epoch, val_loss) with `is_best` and the `stop_epoch` decided up to it, if any.

    The rows together are those of `runs.best_epoch`, and `stops` makes those of `runs.early_stop` of them. State per run is
    the best loss, its epoch and the stop, whatever the number of epochs. Epochs of a run arrive in order over the triggers
    and in any order within one; the epochs of one run and trigger are sorted in one task, so bound the
    trigger (maxFilesPerTrigger). A missing loss or NaN counts as above all others. An epoch that comes after a later one of an
    earlier trigger is judged as if it came last. `forget_ms` drops the state of a run that is silent for so long
    (processing time); should it go on, it starts anew.
    """
    key = log.schema["run_id"].dataType.simpleString()

    def advance(run: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts)).sort_values("epoch", kind="stable")
        best, best_epoch, stop = state.get if state.exists else (None, None, None)
        epochs, losses = rows["epoch"].to_numpy(), rows["val_loss"].to_numpy(np.float64, na_value=np.nan)
        flags, stops = [], []
        for epoch, loss in zip(epochs.tolist(), losses.tolist()):
            better = best is None or loss < best or (np.isnan(best) and not np.isnan(loss))
            if better:
                best, best_epoch = loss, epoch
            elif stop is None and epoch - best_epoch >= patience:
                stop = epoch
            flags.append(better)
            stops.append(stop)
        state.update((best, best_epoch, stop))
        if forget_ms is not None:
            state.setTimeoutDuration(forget_ms)
        yield pd.DataFrame({
            "run_id": [run[0]] * len(rows), "epoch": epochs, "val_loss": losses, "is_best": flags,
            "stop_epoch": pd.array(stops, dtype="Int32"),
        })

    timeout = GroupStateTimeout.NoTimeout if forget_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return log.select("run_id", "epoch", "val_loss").groupBy("run_id").applyInPandasWithState(
        advance, f"run_id {key}, {_OUT}", _STATE, "append", timeout
    )


def store_decisions(followed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store the rows of `follow_runs`, one folder per batch; a batch repeated after a failure replaces itself."""
    return (
        followed.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: append_history(batch, path, "runs", batch_id, time=None))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stops(decisions: DataFrame) -> DataFrame:
    """The rows of `runs.early_stop` from stored decisions."""
    return decisions.groupBy("run_id").agg(F.min("stop_epoch").alias("stop_epoch"), F.max("epoch").alias("last_epoch"))
