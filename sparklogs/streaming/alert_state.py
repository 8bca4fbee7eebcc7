"""Alert states kept across micro-batches."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.alerts import STEP

OUTPUT = "rule string, service string, eval_s bigint, value double, held_seconds bigint, state string"
STATE = "since bigint, last bigint"
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]


class AlertStates(StatefulProcessor):
    """Of each rule and service: when the current breach began (-1: none) and the last evaluation."""

    def __init__(self, threshold: float, hold: int, step: int, timed: bool):
        self._threshold, self._hold, self._step, self._timed = threshold, hold, step, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle, self._state = handle, handle.getValueState("breach", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, last = map(int, self._state.get()) if self._state.exists() else (-1, -1)
        out = []
        # One row per 30 seconds and service: a batch holds few of them.
        frame = pd.concat(list(rows)).sort_values("eval_s")
        for moment, value in zip(frame["eval_s"].tolist(), frame["value"].tolist()):
            if since >= 0 and moment - last > self._step:
                if self._timed:
                    out.append((*key, last + self._step, None, 0, "Normal"))
                since = -1
            last = moment
            if value > self._threshold:
                since = last if since < 0 else since
                out.append((*key, last, value, last - since, "Firing" if last - since >= self._hold else "Pending"))
            else:
                since = -1
                out.append((*key, last, value, 0, "Normal"))
        if self._timed:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            if since >= 0:
                # One step of slack: by then an evaluation that does exist has come.
                self._handle.registerTimer((last + 2 * self._step) * 1000)
        self._state.update((since, last))
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since, last = map(int, self._state.get())
        self._state.clear()
        yield pd.DataFrame([(*key, last + self._step, None, 0, "Normal")], columns=COLUMNS)


def stateful_alerts(evaluations: DataFrame, rule: dict, step: int = STEP) -> DataFrame:
    """States of a stream of evaluations (rule, service, eval_s, value), one instance per service.

    A gap between evaluations ends a breach. If `evaluations` has eval_time with a watermark, as the windows of `jobs` do, the
    first evaluation that is missing is told as Normal, without a value, by a timer as soon as it can no longer come, and
    the evaluations may come from aggregations of the same stream; without it, only evaluations that exist are told.
    Evaluations must reach a service in order of time.
    """
    timed = "eval_time" in evaluations.columns
    processor = AlertStates(rule["threshold"], rule["hold_seconds"], step, timed)
    states = evaluations.groupBy("rule", "service").transformWithStateInPandas(
        processor, OUTPUT, "Append", "EventTime" if timed else "None")
    return states.withColumn("eval_ts", F.timestamp_seconds("eval_s"))
