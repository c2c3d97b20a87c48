"""Required fields: rows that lack one go to quarantine with the reasons."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reasons"


class Split:
    """Rows judged by rules, as one frame: ``judged`` has the reasons of broken rows, null for valid ones.

    ``valid`` and ``quarantine`` are cuts of it. Whoever needs both from one pass reads ``judged`` itself, or keeps
    it while the cuts are written (``runs.each_batch`` does). What only one side shows is put on with ``then``.
    """

    def __init__(
        self,
        judged: DataFrame,
        valid: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        quarantine: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ):
        self.judged, self._valid, self._quarantine = judged, valid, quarantine

    @property
    def valid(self) -> DataFrame:
        return self._valid(self.judged.where(F.col(REASONS).isNull()).drop(REASONS))

    @property
    def quarantine(self) -> DataFrame:
        return self._quarantine(self.judged.where(F.col(REASONS).isNotNull()))

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.valid, self.quarantine))

    def then(
        self,
        valid: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        quarantine: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> Split:
        """The same rows, with a further step for either side."""
        mine = self._valid, self._quarantine
        return Split(self.judged, lambda rows: valid(mine[0](rows)), lambda rows: quarantine(mine[1](rows)))

    @contextmanager
    def on_disk(self) -> Iterator[Split]:
        """The same, the judged rows worked out once and kept on the executors' disks; what is lost with one is worked out again."""
        rows = self.judged.persist(StorageLevel.DISK_ONLY)
        try:
            yield self.held(rows)
        finally:
            rows.unpersist()

    def held(self, judged: DataFrame) -> Split:
        """The same cuts of another form of the judged rows, such as one that was written or cached."""
        return Split(judged, self._valid, self._quarantine)


def split_required(df: DataFrame, rules: Mapping[str, Column]) -> Split:
    """Rows that keep every rule, and the others with the names of the broken ones.

    A rule that comes out null is broken. The reasons are worked out for broken rows alone.
    """
    kept = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    whole = reduce(and_, kept.values())
    reasons = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in kept.items()]))
    return Split(df.withColumn(REASONS, F.when(~whole, reasons)))
