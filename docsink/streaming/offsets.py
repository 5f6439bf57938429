"""Offsets that are safe to commit, across micro-batches: sets of offsets as keyed state.

For each log partition the state has the offset up to which all is committed, and above it which offsets are done and which are
open, as compressed flags by blocks of offsets. What lies below the first open offset is forgotten. A task holds some blocks
at a time, so its memory follows neither the records nor the gaps, however many runs of offsets there are (a log whose
partitions have every fourth offset has a run for each).
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

Runs = list[tuple[int, int]]

#: Offsets of a block; blocks that a task holds at most (64 KiB each).
BLOCK, HELD = 1 << 15, 256


def runs_of(offsets: np.ndarray) -> Runs:
    """Runs (first, last) of the offsets."""
    own = np.unique(offsets)
    if not len(own):
        return []
    cut = np.flatnonzero(np.diff(own) != 1)
    return list(zip(own[np.append(0, cut + 1)].tolist(), own[np.append(cut, len(own) - 1)].tolist(), strict=True))


def union(a: Runs, b: Runs) -> Runs:
    out: Runs = []
    for first, last in sorted(a + b):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def without(a: Runs, b: Runs) -> Runs:
    """The offsets of a that are not in b; both sorted."""
    out, k = [], 0
    for first, last in a:
        while k < len(b) and b[k][1] < first:
            k += 1
        at = k
        while at < len(b) and b[at][0] <= last and first <= last:
            if b[at][0] > first:
                out.append((first, b[at][0] - 1))
            first = b[at][1] + 1
            at += 1
        if first <= last:
            out.append((first, last))
    return out


def packed(flags: np.ndarray) -> tuple[bytes]:
    return (zlib.compress(np.packbits(flags, axis=1).tobytes(), 1),)


def unpacked(row: tuple) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bytes(row[0])), np.uint8).reshape(2, -1), axis=1).astype(bool)


class Blocks:
    """Which offsets of a log partition are done and which open, by blocks of BLOCK offsets.

    `bits`, `marks` and `fresh` are map states by block: the two sets, compressed; what the walk over all blocks needs of them; and
    the sets of the micro-batch alone, where it has more than HELD blocks. What was known counts only after all rows
    of the micro-batch, as any of them may hand the partition over.
    """

    def __init__(self, bits, marks, fresh, committed: int | None):
        self.bits, self.marks, self.fresh, self.committed = bits, marks, fresh, committed
        self.held: dict[int, np.ndarray] = {}  # two rows of flags by block: done and open
        self.spilled = False

    def load(self, block: int) -> np.ndarray:
        return unpacked(self.bits.getValue((block,))) if self.bits.containsKey((block,)) else np.zeros((2, BLOCK), bool)

    def store(self, block: int, flags: np.ndarray) -> None:
        """Done ones stay so, whatever else was told of them."""
        done, opened = flags[0], flags[1] & ~flags[0]
        if not (done.any() or opened.any()):
            self.drop(block)
            return
        self.bits.updateValue((block,), packed(np.stack([done, opened])))
        at = np.flatnonzero(opened)
        starts = sum(int(x[0]) + int(np.count_nonzero(x[1:] & ~x[:-1])) for x in (done, opened))
        last = BLOCK - 1 - int(np.argmax(done[::-1])) if done.any() else -1
        edges = sum(int(x) << k for k, x in enumerate((done[0], done[-1], opened[0], opened[-1])))
        self.marks.updateValue((block,), (int(at[0]) if len(at) else -1, last, starts, edges))

    def drop(self, block: int) -> None:
        if self.bits.containsKey((block,)):
            self.bits.removeKey((block,))
            self.marks.removeKey((block,))

    def add(self, offsets: np.ndarray, done: np.ndarray) -> None:
        own = offsets // BLOCK
        order = np.argsort(own, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(own[order])) + 1) if len(order) else ():
            block = int(own[rows[0]])
            if block not in self.held:
                if len(self.held) >= HELD:
                    self.spill()
                self.held[block] = np.zeros((2, BLOCK), bool)
            self.held[block][np.where(done[rows], 0, 1), offsets[rows] - block * BLOCK] = True

    def spill(self) -> None:
        for block, flags in self.held.items():
            old = unpacked(self.fresh.getValue((block,))) if self.fresh.containsKey((block,)) else False
            self.fresh.updateValue((block,), packed(flags | old))
        self.held.clear()
        self.spilled = True

    def forget(self) -> None:
        self.committed = None
        self.bits.clear()
        self.marks.clear()

    def new(self) -> Iterator[tuple[int, np.ndarray]]:
        if not self.spilled:
            yield from self.held.items()
            return
        self.spill()
        for block in array("q", (k for (k,) in self.fresh.keys())):
            yield block, unpacked(self.fresh.getValue((block,)))
        self.fresh.clear()

    def advance(self) -> int:
        """Moves `committed` to after the last done offset below the first open one, and forgets all below that; the number of runs that stay."""
        for block, flags in self.new():
            if self.committed is not None:
                flags[:, : max(0, min(BLOCK, self.committed - block * BLOCK))] = False
            if flags.any():
                self.store(block, flags | self.load(block))
        first = min((k for (k,), (opened, _, _, _) in self.marks.iterator() if opened >= 0), default=None)
        safe = max((k * BLOCK + last for (k,), (_, last, _, _) in self.marks.iterator() if last >= 0 and (first is None or k < first)), default=None)
        if first is not None:
            flags = self.load(first)
            at = int(np.argmax(flags[1]))
            if len(below := np.flatnonzero(flags[0, :at])):
                safe = first * BLOCK + int(below[-1])
                flags[:, :at] = False
                self.store(first, flags)
        if safe is not None:
            self.committed = safe + 1 if self.committed is None else max(self.committed, safe + 1)
        gone, n = array("q"), 0
        edges = [array("q") for _ in range(4)]
        for (k,), (_, _, starts, own) in self.marks.iterator():
            if first is None or k < first:
                gone.append(k)
                continue
            n += starts
            for j in range(4):
                if own >> j & 1:
                    edges[j].append(k)
        if first is None:
            self.bits.clear()
            self.marks.clear()
        else:
            for k in gone:
                self.drop(k)
        begins, ends = (edges[0], edges[2]), (edges[1], edges[3])
        return n - sum(len(np.intersect1d(np.frombuffer(a, np.int64) - 1, np.frombuffer(b, np.int64))) for a, b in zip(begins, ends, strict=True))


class _Progress(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.committed = handle.getValueState("committed", "commit_offset long")
        self.bits = handle.getMapState("bits", "block long", "flags binary")
        self.marks = handle.getMapState("marks", "block long", "first_open int, last_done int, runs int, edges int")
        self.fresh = handle.getMapState("fresh", "block long", "flags binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        blocks, closed = Blocks(self.bits, self.marks, self.fresh, self.committed.get()[0] if self.committed.exists() else None), False
        for frame in rows:
            closed = closed or bool(frame["closed"].any())
            own = frame[~frame["closed"] & frame["offset"].notna()]
            blocks.add(own["offset"].to_numpy(np.int64), own["processed"].to_numpy(bool))
        if closed:
            self.committed.clear()
            blocks.forget()
        before, n = blocks.committed, blocks.advance()
        if blocks.committed is not None and blocks.committed != before:
            self.committed.update((blocks.committed,))
            yield pd.DataFrame({"topic": [key[0]], "partition": [int(key[1])], "commit_offset": [blocks.committed], "n_runs": [n]})

    def close(self) -> None:
        pass


def stream_safe_offsets(records: DataFrame) -> DataFrame:
    """Of a stream of records (topic, partition, offset, processed), with each micro-batch the partitions whose safe offset grew: topic, partition, commit_offset, n_runs.

    The last one of a partition is what progress.safe_offsets has for all its records. An offset that comes again is done if it ever was.
    A row whose column `closed` is true, if there is one, hands its partition over: what was known of it is dropped before
    the micro-batch's other rows count. Needs the RocksDB state store.
    """
    closed = F.coalesce("closed", F.lit(False)) if "closed" in records.columns else F.lit(False)
    rows = records.select("topic", "partition", "offset", F.coalesce("processed", F.lit(False)).alias("processed"), closed.alias("closed"))
    schema = "topic string, partition int, commit_offset long, n_runs int"
    return rows.groupBy("topic", "partition").transformWithStateInPandas(statefulProcessor=_Progress(), outputStructType=schema, outputMode="Update", timeMode="None")
