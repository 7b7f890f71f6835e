"""Live plate history as keyed state."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from passgrid.settings import CloneSettings

# Plates share the lists of state, as a key of its own costs each plate milliseconds a trigger.
GROUPS = 1024
_OUT = "{order} bigint, hphm string, at bigint, station_id int, history_size bigint"


class PlateHistory(StatefulProcessor):
    """Seconds of the passes of a group's plates. A pass removes all of its plate that lie more than the horizon away from
    itself, on either side, and is added; so a straggler also removes newer passes.

    Each second goes ``life_s`` after it was written, and those of a plate are written anew when any of them is removed.
    """

    def __init__(self, horizon_s: int, life_s: int, order_col: str):
        self.horizon_s, self.life_s, self.order_col = horizon_s, life_s, order_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", "hphm string, second bigint, written bigint", ttlDurationMs=self.life_s * 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passes = pd.concat(list(rows)).sort_values(self.order_col, kind="stable")
        now = timerValues.getCurrentProcessingTimeInMs()
        before: dict[str, list[tuple[int, int]]] = {}
        for plate, second, written in self.held.get():
            if written + self.life_s * 1000 > now:
                before.setdefault(plate, []).append((second, written))
        held = {plate: sorted(s for s, _ in own) for plate, own in before.items()}
        sizes = []
        for plate, second in zip(passes["hphm"], (passes["at"] // 1_000_000).tolist()):
            near = held.setdefault(plate, [])
            first, end = bisect_left(near, second - self.horizon_s), bisect_right(near, second + self.horizon_s)
            if first or end < len(near):
                near = held[plate] = near[first:end]
                before.pop(plate, None)
            insort(near, second)
            sizes.append(len(near))
        self.held.put(self._rows(held, before, now))
        yield pd.DataFrame({
            self.order_col: passes[self.order_col].to_numpy(), "hphm": passes["hphm"].to_numpy(),
            "at": passes["at"].to_numpy(), "station_id": passes["station_id"].to_numpy(), "history_size": sizes,
        })

    @staticmethod
    def _rows(held: dict[str, list[int]], before: dict[str, list[tuple[int, int]]], now: int) -> list[tuple[str, int, int]]:
        """``before`` has the plates of which nothing was removed, with when their seconds were written."""
        out = []
        for plate, seconds in held.items():
            old = sorted(before.get(plate, ()))
            at = 0
            for second in seconds:
                if at < len(old) and old[at][0] == second:
                    out.append((plate, second, old[at][1]))
                    at += 1
                else:
                    out.append((plate, second, now))
        return out

    def close(self) -> None:
        pass


def history_stream(passes: DataFrame, settings: CloneSettings = CloneSettings(), *,
                   order_col: str = "arrival_seq") -> DataFrame:
    """Live: per pass with a plate, how many passes its plate's history holds: itself and those before it, by arrival,
    within the horizon of each pass since.

    State is a list of plates and seconds for each of ``GROUPS`` groups of plates, by a hash, on the RocksDB state store,
    which the session must name as its provider; a group with passes is read and written whole. It holds of each plate at
    most what lies within the horizon of its newest arrival, and that goes ``horizon_s`` after it was last written on the
    clock of the triggers. The passes of one trigger and group are put in order in one task; limit the rows of a trigger at
    the source where a plate may flood it.
    """
    asked = passes.select(
        F.col(order_col).cast("bigint").alias(order_col), "hphm", F.unix_micros("gcsj").alias("at"),
        F.col("station_id").cast("int").alias("station_id"),
    )
    dealt = asked.withColumn("plates", F.pmod(F.xxhash64("hphm"), F.lit(GROUPS)).cast("int"))
    sized = dealt.groupBy("plates").transformWithStateInPandas(
        PlateHistory(settings.horizon_s, settings.horizon_s, order_col),
        outputStructType=_OUT.format(order=order_col), outputMode="Append", timeMode="ProcessingTime",
    )
    return sized.select(order_col, "hphm", F.timestamp_micros("at").alias("gcsj"), "station_id", "history_size")
