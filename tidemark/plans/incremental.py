"""Snapshots kept up to date: new or changed lines rebuild only the cutoffs that they touch.

Cutoffs and the ends of their outcome windows cut time into *pieces*. All lines of a piece are
past, or an outcome, for the same cutoffs. A store holds

* the ledger: lines merged to the grain that all features are made of, per piece and batch. Its
  measures add up (sums, counts, earliest dates), so a batch of new lines is just added;
* the snapshots, one partition per cutoff;
* notes, the last of which says which parts of the ledger count, with their digests.

A line of a piece can change the features of the cutoffs after it and the labels of those whose
window holds it. These are built again from the ledger; the partitions of all other cutoffs keep
their files. A note is written last, so a run that breaks off is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SnapshotSettings
from tidemark.functions.scalars import count_reached, timestamp
from tidemark.operators import snapshots as snap
from tidemark.operators.ranking import union_all
from tidemark.sources import digests
from tidemark.sources.digests import Digest
from tidemark.sources.tables import TRANSACTION_COLUMNS

#: Batches of one piece that are read side by side; with more, the piece is merged into one.
MOST_BATCHES = 16


@dataclass(frozen=True)
class Piece:
    """Lines from ``start`` (None: from the beginning) to just before ``end``."""

    start: datetime | None
    end: datetime

    @property
    def name(self) -> str:
        def text(moment):
            return "begin" if moment is None else f"{moment:%Y%m%dT%H%M%S%f}"
        return f"{text(self.start)}_{text(self.end)}"


def pieces_of(settings: SnapshotSettings) -> list[Piece]:
    moments = settings.ordered_cutoffs()
    ends = {m + timedelta(days=settings.horizon_days) for m in moments}
    edges = sorted({*moments, *ends})
    return [Piece(a, b) for a, b in zip([None, *edges], edges)]


def touched(start: datetime | None, settings: SnapshotSettings) -> list[datetime]:
    """The cutoffs that lines from ``start`` on count for, as past or as outcome."""
    horizon = timedelta(days=settings.horizon_days)
    return [m for m in settings.ordered_cutoffs() if start is None or m + horizon > start]


class SnapshotStore:
    """A ledger and snapshots under ``path``, for one set of cutoffs at a time."""

    def __init__(self, spark: SparkSession, path: str, settings: SnapshotSettings) -> None:
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings
        self.pieces = {p.name: p for p in pieces_of(settings)}

    # Reading

    def _note(self) -> tuple[int, dict]:
        return digests.read_note(self.spark, f"{self.path}/notes")

    def _rules(self) -> list:
        s = self.settings
        return [s.horizon_days, s.min_history_days, s.home_market]

    def snapshots(self) -> DataFrame:
        """The stored snapshots of the store's cutoffs."""
        moments = [timestamp(m) for m in self.settings.ordered_cutoffs()]
        return (self.spark.read.schema(snap.SNAPSHOT_SCHEMA).parquet(f"{self.path}/snapshots")
                .filter(F.col("cutoff").isin(moments)))

    def _ledger(self, batches: dict[str, dict[str, list]], subset: list[datetime]) -> DataFrame:
        """The merged lines that count, numbered for a subset of the cutoffs."""
        horizon = timedelta(days=self.settings.horizon_days)
        used = {name: batches[name] for name in batches
                if set(touched(self.pieces[name].start, self.settings)) & set(subset)}
        start = F.element_at(F.create_map(*[x for name in used for x in (
            F.lit(name), timestamp(self.pieces[name].start or datetime.min))]), F.col("piece"))
        keys = [f"{name}/{batch}" for name, found in used.items() for batch in found]
        stored = (self.spark.read.parquet(f"{self.path}/ledger")
                  .filter(F.col("piece").isin(list(used)))
                  .filter(F.concat_ws("/", "piece", "batch").isin(keys)))
        return stored.withColumns({
            "epoch": count_reached(start, subset),
            "first_open": count_reached(start, [m + horizon for m in subset])}) \
            .drop("piece", "batch")

    # Writing

    def _lines(self, transactions: DataFrame) -> DataFrame:
        return transactions.filter(
            F.col("invoice_date") < timestamp(list(self.pieces.values())[-1].end))

    def _piece(self, moment: str) -> Column:
        edges = [p.start for p in self.pieces.values() if p.start is not None]
        names = F.array(*[F.lit(name) for name in self.pieces])
        return F.element_at(names, count_reached(moment, edges) + 1)

    def _digests(self, lines: DataFrame) -> dict[str, Digest]:
        return digests.collected(digests.partition_digests(
            lines, self._piece("invoice_date"), TRANSACTION_COLUMNS))

    def _add_to_ledger(self, lines: DataFrame, names: list[str], batch: str) -> None:
        # What differs between the cutoffs is the same for all lines of a piece, and so is left
        # to the reader.
        here = lines.filter(self._piece("invoice_date").isin(names))
        self._write_ledger(snap.line_grains(here, [datetime.max])
                           .withColumn("piece", self._piece("order_date")), batch)

    def _write_ledger(self, grains: DataFrame, batch: str) -> None:
        key = ["piece", *[c for c in snap.GRAIN if c != "epoch"]]
        measures = [combine(name).alias(name) for name, combine in snap.MEASURES.items()
                    if name != "first_open"]
        # A customer's lines travel and are stored side by side: what they have in common then
        # packs well, here and whenever the ledger is read and placed again.
        merged = union_all([
            lines.groupBy(*key, *(["cell"] if spread else [])).agg(*measures)
            .select(*key, *[name for name in snap.MEASURES if name != "first_open"],
                    F.lit(batch).alias("batch"))
            .sortWithinPartitions("piece", "batch", "customer_id", "invoice_no")
            for lines, spread in snap.placed(grains)])
        (merged.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("piece", "batch")
         .parquet(f"{self.path}/ledger"))

    def _rebuild(self, batches: dict, cutoffs: list[datetime]) -> None:
        """Build the partitions of these cutoffs anew."""
        for moment in cutoffs:
            digests.delete_path(self.spark, f"{self.path}/snapshots/{_directory(moment)}")
        rows = snap.from_grains(self._ledger(batches, cutoffs), cutoffs, self.settings)
        (rows.write.mode("append").partitionBy("cutoff").parquet(f"{self.path}/snapshots"))

    def _commit(self, batches: dict, built: list[datetime]) -> None:
        digests.write_note(self.spark, f"{self.path}/notes", {
            "rules": self._rules(), "built": [m.isoformat() for m in sorted(built)],
            "starts": {name: str(self.pieces[name].start or "") for name in batches},
            "batches": batches})

    def _bring_up(self, note: dict, batches: dict, starts: list[datetime | None]
                  ) -> list[datetime]:
        """Rebuild the cutoffs that are not there yet, and those that lines from ``starts`` on
        count for."""
        known = {datetime.fromisoformat(m) for m in note.get("built", ())}
        if note.get("rules") != self._rules():
            known = set()
        moments = self.settings.ordered_cutoffs()
        due = {m for start in starts for m in touched(start, self.settings)}
        cutoffs = [m for m in moments if m in due or m not in known]
        first = min((self.pieces[name].end for name in batches), default=datetime.max)
        for moment in cutoffs:
            if moment < first:
                raise ValueError(f"no history before {moment:%Y-%m-%d}")
        if cutoffs:
            if note:                 # until the next one it must not vouch for these cutoffs
                kept = [m.isoformat() for m in sorted(known - set(cutoffs))]
                digests.write_note(self.spark, f"{self.path}/notes", {**note, "built": kept})
            self._rebuild(batches, cutoffs)
        self._commit(batches, [*known, *moments])
        return cutoffs

    def refresh(self, transactions: DataFrame) -> list[datetime]:
        """Bring the store up to ``transactions``, the whole table; returns the cutoffs rebuilt.

        Pieces are compared by digest, so changed, removed and added lines are found wherever
        they are. Other cutoffs than last time are fine too: pieces that are the same stay.
        """
        number, note = self._note()
        lines = self._lines(transactions)
        now = self._digests(lines)
        stored = note.get("batches", {})
        before = {name: found for name, found in stored.items() if name in self.pieces}
        same = {name for name, found in before.items()
                if name in now and digests.total(Digest(*d) for d in found.values()) == now[name]}
        fresh = sorted(now.keys() - same)
        batch = f"n{number + 1}"
        if fresh:
            self._add_to_ledger(lines, fresh, batch)
        batches = {name: before[name] if name in same else {batch: list(now[name])}
                   for name in now}
        gone = [note["starts"][name] for name in stored if name not in now]
        starts = [datetime.fromisoformat(text) if text else None for text in gone]
        return self._bring_up(note, batches, starts + [self.pieces[name].start for name in fresh])

    def append(self, new_lines: DataFrame) -> list[datetime]:
        """Add lines that the store has not seen; returns the cutoffs rebuilt.

        Nothing is read of the lines before but their merged form, and that only if a cutoff
        is touched.
        """
        number, note = self._note()
        if not note or note["rules"] != self._rules() or set(note["batches"]) - set(self.pieces):
            raise ValueError("append needs a store of the same cutoffs; use refresh first")
        lines = self._lines(new_lines)
        now = self._digests(lines)
        batch = f"n{number + 1}"
        if now:
            self._add_to_ledger(lines, sorted(now), batch)
        batches = {name: dict(found) for name, found in note["batches"].items()}
        for name, digest in now.items():
            batches.setdefault(name, {})[batch] = list(digest)
        self._merge_long(batches, f"m{number + 1}")
        return self._bring_up(note, batches, [self.pieces[name].start for name in now])

    def _merge_long(self, batches: dict[str, dict[str, list]], batch: str) -> None:
        """Pieces in very many batches become one batch each."""
        long = {name: found for name, found in batches.items() if len(found) > MOST_BATCHES}
        if not long:
            return
        keys = [f"{name}/{k}" for name, found in long.items() for k in found]
        stored = (self.spark.read.parquet(f"{self.path}/ledger")
                  .filter(F.concat_ws("/", "piece", "batch").isin(keys)).drop("batch"))
        self._write_ledger(stored, batch)
        for name, found in long.items():
            batches[name] = {batch: list(digests.total(Digest(*d) for d in found.values()))}


def _directory(moment: datetime) -> str:
    """The name Spark gives the partition of a cutoff."""
    text = f"{moment:%Y-%m-%d %H:%M:%S}" + (f".{moment.microsecond:06d}".rstrip("0")
                                            if moment.microsecond else "")
    return "cutoff=" + text.replace(":", "%3A")
