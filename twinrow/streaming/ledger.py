"""Additive records of a stream, kept in runs that are merged by generations.

A record is told by some columns and carries sums. What a batch adds is one run of
generation zero. When a generation has ``fan_in`` runs they become one run of the
next: equal records add up, and those whose sums are all zero go, as do those the
owner needs no more. Sums are additive, so runs may be merged in any order, and
a record is rewritten once a generation: a number of times that grows with the
logarithm of the batches.

The runs that count are listed in a manifest of one file, and a new version of it is
the only thing that makes a batch or a merge visible. A failed batch or merge leaves
a folder that nobody reads and that its repetition overwrites; a batch that is in
the manifest is not applied again. Merged runs stay for one more version, for those
who still read them, and are then deleted.

A ledger belongs to one stream and its checkpoint. A single writer is assumed, as a
stream has one; readers may come at any time.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from twinrow.session import exists, folder_bytes, remove

FAN_IN = 8


@dataclass(frozen=True)
class State:
    """What one version of the manifest says."""

    version: int = 0
    batch: int = -1
    #: Folder, generation and rows of each run.
    runs: tuple[tuple[str, int, int], ...] = ()
    #: Folders of runs that were merged in this version.
    merged: tuple[str, ...] = ()
    #: What else the owner keeps with a batch.
    marks: dict = field(default_factory=dict)


class Ledger:
    """The runs below a folder. ``schema`` lists the columns ``by``, then the sums."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str], fan_in: int = FAN_IN
    ):
        if fan_in < 2:
            raise ValueError(f"a merge takes at least two runs: {fan_in}")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.by = list(by)
        self.sums = [c for c in schema.names if c not in self.by]
        self.fan_in = fan_in
        self.state = self._newest()

    def _newest(self) -> State:
        folder = f"{self.path}/manifest"
        if not exists(self.spark, folder):
            return State()
        # The parts of an unfinished version are in a temporary folder, which is not read.
        rows = self.spark.read.text(folder)
        if "version" not in rows.columns:
            return State()
        newest = rows.orderBy(F.desc("version")).select("value").first()
        held = json.loads(newest["value"])
        held["runs"] = tuple(tuple(r) for r in held["runs"])
        held["merged"] = tuple(held["merged"])
        return State(**held)

    def _commit(self, state: State) -> None:
        """Makes a state the newest: one file appears in its place."""
        text = self.spark.createDataFrame([(json.dumps(state.__dict__),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/version={state.version}")
        gone, self.state = self.state, state
        for folder in gone.merged:
            remove(self.spark, f"{self.path}/{folder}")
        if state.version > 2:
            remove(self.spark, f"{self.path}/manifest/version={state.version - 2}")

    def has(self, batch: int) -> bool:
        """Whether a batch is in already, so that it must not be applied again."""
        return batch <= self.state.batch

    def add(self, batch: int, folder: str | None, rows: int = 0, marks: dict | None = None) -> None:
        """Takes a run, written to a folder below the path, in as that of a batch."""
        run = ((folder, 0, rows),) if folder and rows else ()
        self._commit(replace(
            self.state, version=self.state.version + 1, batch=batch, runs=self.state.runs + run,
            merged=(), marks=self.state.marks if marks is None else marks,
        ))

    def stamp(self, batch: int) -> int:
        """When a batch first came, in microseconds, written before the batch is.

        A batch that is repeated has the time of its first try.
        """
        held = self.state.marks.get("stamp")
        if held is None or held[0] != batch:
            # No batch is older than the one before it, whatever the clock does.
            now = max(time.time_ns() // 1000, held[1] if held else 0)
            marks = self.state.marks | {"stamp": [batch, now]}
            self._commit(replace(self.state, version=self.state.version + 1, merged=(), marks=marks))
        return self.state.marks["stamp"][1]

    def read(self, *more: str) -> DataFrame:
        """Rows of all runs, and of further folders below the path; a record may be in several."""
        folders = [f"{self.path}/{f}" for f in (*(r[0] for r in self.state.runs), *more)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def summed(self, rows: DataFrame) -> DataFrame:
        """Each record once, those whose sums are all zero left out."""
        some = F.greatest(*[F.col(c) != 0 for c in self.sums]) if len(self.sums) > 1 else F.col(self.sums[0]) != 0
        return rows.groupBy(*self.by).agg(*[F.sum(c).alias(c) for c in self.sums]).where(some)

    def records(self) -> DataFrame:
        """All records that count now."""
        return self.summed(self.read())

    def compact(self, keep: Column | None = None) -> int:
        """Merges every generation that is full; rows outside ``keep`` go. Returns the merges."""
        merges = 0
        while True:
            sizes: dict[int, list[tuple[str, int, int]]] = {}
            for run in self.state.runs:
                sizes.setdefault(run[1], []).append(run)
            full = [g for g, runs in sorted(sizes.items()) if len(runs) >= self.fan_in]
            if not full:
                return merges
            self._merge(sizes[full[0]], full[0] + 1, keep)
            merges += 1

    def _merge(self, runs: Sequence[tuple[str, int, int]], generation: int, keep: Column | None) -> None:
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{r[0]}" for r in runs])
        version = self.state.version + 1
        folder = f"merged/version={version}"
        kept = self.summed(rows if keep is None else rows.where(keep))
        kept.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        n = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}").count()
        gone = {r[0] for r in runs}
        left = tuple(r for r in self.state.runs if r[0] not in gone)
        new = ((folder, generation, n),) if n else ()
        self._commit(replace(
            self.state, version=version, runs=left + new, merged=tuple(gone) + (() if n else (folder,))
        ))

    def held_rows(self) -> int:
        """Rows in all runs, a record in several counted each time."""
        return sum(r[2] for r in self.state.runs)

    def held_bytes(self) -> int:
        """Bytes of all runs that count."""
        return sum(folder_bytes(self.spark, f"{self.path}/{r[0]}") for r in self.state.runs)
