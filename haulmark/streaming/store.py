"""A table that batches are added to while others read it.

Every batch is a folder of its own below ``data``; a numbered file below ``commits`` lists the folders that make up the table, with
what is known of each. A commit is created whole and never changed, and a number can be taken only once, so two
writers cannot both take it. Readers take the folders of the newest commit. Folders that a later commit no longer lists are
deleted once ``keep`` newer commits exist: whoever has listed them can read on for that long.

Folders are folded by levels: ``fan`` folders of one level become one folder of the next, so a row is rewritten a logarithmic
number of times and the list stays short.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from haulmark import files


@dataclass(frozen=True)
class Folder:
    name: str
    batches: tuple[int, int]  # first and last batch it holds
    level: int = 0
    latest: str | None = None  # the largest time in it, where the table has one


@dataclass(frozen=True)
class Commit:
    number: int = 0
    through: int = -1  # the last batch added
    folders: tuple[Folder, ...] = ()
    clock: str | None = None  # the largest time seen in any batch
    counts: Mapping[str, int] = field(default_factory=dict)  # totals over all batches, such as late rows

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> Commit:
        raw = json.loads(text)
        folders = tuple(Folder(**{**f, "batches": tuple(f["batches"])}) for f in raw.pop("folders"))
        return Commit(folders=folders, **raw)


class BatchStore:
    """Folders of batches and the commits that list them, on any file system Spark writes to."""

    def __init__(self, spark: SparkSession, path: str, fan: int = 8, keep: int = 10):
        if fan < 2 or keep < 1:
            raise ValueError("fold at least two folders, and keep at least one commit")
        self.spark, self.path, self.fan, self.keep = spark, path.rstrip("/"), fan, keep

    # ----------------------------------------------------------------- commits
    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in files.names(self.spark, f"{self.path}/commits") if n.endswith(".json")]

    def _file(self, number: int) -> str:
        return f"{self.path}/commits/{number:012d}.json"

    def _read(self, number: int) -> Commit:
        return Commit.parse(files.read_text(self.spark, self._file(number)))

    def newest(self) -> Commit:
        """The commit that readers see now."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else Commit()

    def as_of(self, batch_id: int) -> Commit:
        """The newest kept commit without batches after ``batch_id``."""
        for n in reversed(self._numbers()):
            commit = self._read(n)
            if commit.through <= batch_id:
                return commit
        return Commit()

    def _publish(self, commit: Commit) -> Commit:
        if not files.write_new(self.spark, self._file(commit.number), commit.text()):
            raise RuntimeError(f"another writer has taken commit {commit.number} of {self.path}")
        return commit

    # --------------------------------------------------------------- reading
    def read(self, commit: Commit | None = None) -> DataFrame | None:
        """Rows of all folders of the newest commit, or of one read before; None before the first batch."""
        commit = commit or self.newest()
        if not commit.folders:
            return None
        return self.spark.read.parquet(*(f"{self.path}/data/{f.name}" for f in commit.folders))

    # --------------------------------------------------------------- writing
    def add(self, batch_id: int, rows: DataFrame, latest: str | None = None, clock: str | None = None, counts: Mapping[str, int] | None = None,
            fold: Callable[[DataFrame], DataFrame] | None = None, expired: Callable[[Folder], bool] | None = None) -> Commit:
        """Add a batch, then fold and clear. A commit holds a batch whole or not at all, so a batch that a stream repeats after a failure is
        passed over if its commit is there. Batch numbers must rise: a stream that starts over needs a store of its own.

        ``fold`` merges rows of several folders; ``expired`` says of a folder that none of its rows matter any more.
        """
        now = self.newest()
        if batch_id <= now.through:
            return now
        name = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.path}/data/{name}")
        folders = tuple(f for f in (*now.folders, Folder(name, (batch_id, batch_id), 0, latest)) if not (expired and expired(f)))
        totals = {k: now.counts.get(k, 0) + (counts or {}).get(k, 0) for k in {*now.counts, *(counts or {})}}
        commit = self._publish(Commit(now.number + 1, batch_id, folders, clock or now.clock, totals))
        if fold is not None:
            commit = self._folded(commit, fold)
        self._clear()
        return commit

    def _folded(self, commit: Commit, fold: Callable[[DataFrame], DataFrame]) -> Commit:
        level = 0
        while True:
            same = [f for f in commit.folders if f.level == level]
            if len(same) < self.fan:
                if not any(f.level > level for f in commit.folders):
                    return commit
                level += 1
                continue
            name = f"level-{level + 1}-{uuid.uuid4().hex[:8]}"
            merged = fold(self.spark.read.parquet(*(f"{self.path}/data/{f.name}" for f in same)))
            merged.write.parquet(f"{self.path}/data/{name}")
            times = [f.latest for f in same if f.latest is not None]
            one = Folder(name, (min(f.batches[0] for f in same), max(f.batches[1] for f in same)), level + 1, max(times, default=None))
            commit = self._publish(replace(commit, number=commit.number + 1, folders=(*(f for f in commit.folders if f not in same), one)))
            level += 1

    def _clear(self) -> None:
        """Delete commits older than the last ``keep``, the folders that only they list, and folders of writes that broke off.

        There is one writer at a time, and it comes here after its commit, so no folder is in the making.
        """
        numbers = self._numbers()
        live = {f.name for n in numbers[-self.keep:] for f in self._read(n).folders}
        for name in files.names(self.spark, f"{self.path}/data"):
            if name not in live:
                files.delete(self.spark, f"{self.path}/data/{name}")
        for n in numbers[:-self.keep]:
            files.delete(self.spark, self._file(n))
