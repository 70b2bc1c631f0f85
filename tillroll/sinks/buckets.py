"""Tables in hash buckets of which a change rewrites only those that it touches.

Rows lie in folders ``<table>/change=<number>/bucket=<b>``. A pointer names for
every bucket the changes whose folders make up its rows. A change writes the
buckets it touches under its own number and then moves the pointer on, so it is
seen whole or not at all; a change that runs again after a failure replaces what
it had written, and one that is done already is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sinks import pointer

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketTable:
    """``parts`` named tables over one set of buckets, under one pointer.

    ``keys`` decide a row's bucket. ``owner`` says whose numbers the changes
    have, such as a stream's checkpoint folder: another owner, another number
    of buckets or other keys than those the table was made with are refused.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int
    parts: dict[str, T.StructType]
    owner: str = ""

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _layout(self) -> dict:
        return {"keys": list(self.keys), "buckets": self.buckets, "owner": self.owner}

    def _valid(self) -> tuple[int, dict[str, dict[str, list[int]]]]:
        valid = pointer.resolve(self.spark, self.path)
        if not valid:
            return -1, {part: {} for part in self.parts}
        if valid.content["layout"] != self._layout():
            raise ValueError(f"{self.path} was made with {valid.content['layout']}, not with {self._layout()}")
        return valid.number, valid.content["changes"]

    def last_change(self) -> int:
        """Number of the last change; -1 before the first."""
        return self._valid()[0]

    def changes_of(self, part: str) -> dict[int, list[int]]:
        """Per bucket the changes that its rows are from."""
        return {int(b): list(changes) for b, changes in self._valid()[1][part].items()}

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of ``rows``: at most as many numbers as there are buckets."""
        return sorted(r[BUCKET] for r in rows.select(self.bucket_of().alias(BUCKET)).distinct().collect())

    def read(self, part: str, only: Iterable[int] | None = None) -> DataFrame:
        """Rows of a part, of all buckets or of those named; no other folder is opened."""
        changes = self.changes_of(part)
        wanted = changes if only is None else [b for b in only if b in changes]
        folders = [f"{self.path}/{part}/change={c:020d}/{BUCKET}={b}" for b in wanted for c in changes[b]]
        if not folders:
            return self.spark.createDataFrame([], self.parts[part])
        return self.spark.read.schema(self.parts[part]).parquet(*folders)

    def change(self, number: int, replaced: dict[str, DataFrame], added: dict[str, DataFrame] = {}) -> None:
        """Give the buckets of ``replaced`` rows those rows only, and put ``added`` rows beside what is there.

        A part is replaced or added to, bucket by bucket: buckets without such
        rows stay. A replaced bucket needs all of its rows. A change with a
        number that has been reached already does nothing.
        """
        last, changes = self._valid()
        if number <= last:
            return
        for part in {*replaced, *added}:
            folder = f"{self.path}/{part}/change={number:020d}"
            rows = {kind: given[part] for kind, given in (("replaced", replaced), ("added", added)) if part in given}
            pointer.remove(self.spark, folder)
            for kind, df in rows.items():
                spread = df.select(*self.parts[part].names, self.bucket_of().alias(BUCKET)).hint("rebalance", BUCKET)
                spread.write.mode("append").partitionBy(BUCKET).parquet(folder)
            written = [int(n.split("=")[1]) for n in pointer.names_in(self.spark, folder) if n.startswith(f"{BUCKET}=")]
            fresh = set(written) if "added" not in rows else set()
            if len(rows) == 2:
                fresh = set(self.touched(rows["replaced"]))
            for b in written:
                changes[part][str(b)] = [number] if b in fresh else [*changes[part].get(str(b), []), number]
        pointer.advance(self.spark, self.path, number, {"layout": self._layout(), "changes": changes})
        self._drop_unused()

    def upsert(self, number: int, part: str, rows: DataFrame, by: Sequence[str]) -> None:
        """Put ``rows`` in the place of those with equal values in ``by``, which includes the table's keys."""
        if number <= self.last_change():
            return
        before = self.read(part, self.touched(rows))
        same = [before[c].eqNullSafe(rows[c]) for c in by]
        kept = before.join(rows, same, "left_anti")
        self.change(number, {part: kept.unionByName(rows.select(*before.columns))})

    def _drop_unused(self) -> None:
        """Folders that neither the valid state nor the one before it names."""
        used = {
            (part, f"change={c:020d}", f"{BUCKET}={b}")
            for pointed in pointer.earlier(self.spark, self.path)
            for part, buckets in pointed.content["changes"].items()
            for b, changes in buckets.items()
            for c in changes
        }
        for part in self.parts:
            for change in pointer.names_in(self.spark, f"{self.path}/{part}"):
                inside = pointer.names_in(self.spark, f"{self.path}/{part}/{change}")
                left = [b for b in inside if b.startswith(f"{BUCKET}=") and (part, change, b) in used]
                gone = [b for b in inside if b.startswith(f"{BUCKET}=") and b not in left]
                for b in gone if left else []:
                    pointer.remove(self.spark, f"{self.path}/{part}/{change}/{b}")
                if not left:
                    pointer.remove(self.spark, f"{self.path}/{part}/{change}")
        pointer.forget(self.spark, self.path)
