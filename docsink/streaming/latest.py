"""The last version of each id across micro-batches, from keyed state instead of a snapshot."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ACCEPTED = "resource string, id string, version long, op string, doc_json string, topic string, partition int, offset long"


class _Latest(StatefulProcessor):
    """Of equal versions the first to arrive (topic, partition, offset) stays, as a batch has it; an earlier one that comes later replaces it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "version long, topic string, partition int, offset long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, order = None, None
        for frame in rows:
            own = frame.sort_values(["version", "topic", "partition", "offset"], ascending=[False, True, True, True], kind="stable").head(1)
            first = own.iloc[0]
            now = (-int(first["version"]), str(first["topic"]), int(first["partition"]), int(first["offset"]))
            if order is None or now < order:
                best, order = own, now
        held = self.held.get() if self.held.exists() else None
        if best is not None and (held is None or order < (-held[0], *held[1:])):
            self.held.update((-order[0], *order[1:]))
            yield best[["resource", "id", "version", "op", "doc_json", "topic", "partition", "offset"]]

    def close(self) -> None:
        pass


def stream_latest(actions: DataFrame) -> DataFrame:
    """Of a stream of actions, in each micro-batch the writes that become an id's state. Needs the RocksDB state store.

    An id's rows of one micro-batch come in frames, of which only the best row is held.
    """
    return actions.select("resource", "id", "version", "op", "doc_json", "topic", "partition", "offset").groupBy("resource", "id").transformWithStateInPandas(statefulProcessor=_Latest(), outputStructType=ACCEPTED, outputMode="Update", timeMode="None")
