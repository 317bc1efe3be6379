"""Ledger of a written table: which folders are live and which batches they hold.

The ledger is one small JSON document in versions ``<root>/_ledger/<version>.json``. A version is created whole or not
at all and never changed; a writer that finds its version taken reads again and repeats its change. So a job that dies
leaves either the state before or the state after, two writers cannot lose each other's change, and a batch
that is already held is skipped when it is replayed. Data folders are written first and named by the next version;
what no version names is never read.

The document holds names, dates and number ranges, never rows: it grows with the live folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from adtally.session import child_names, create_text, delete_path, read_text

KEPT_VERSIONS = 20
Ranges = list[list[int]]


def in_ranges(ranges: Ranges, number: int) -> bool:
    return any(low <= number <= high for low, high in ranges)


def joined_ranges(*parts: Ranges) -> Ranges:
    """Union of number ranges, as few as possible."""
    out: Ranges = []
    for low, high in sorted(r for part in parts for r in part):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/_ledger"

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in child_names(self.spark, self.folder) if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> tuple[int, dict]:
        """(version, document); (0, {}) before the first change."""
        versions = self._versions()
        return (versions[-1], json.loads(read_text(self.spark, f"{self.folder}/{versions[-1]:012d}.json"))) if versions else (0, {})

    def change(self, edit: Callable[[dict], dict | None]) -> dict:
        """Apply ``edit`` to the newest document; it may run again on a newer one. None from ``edit`` leaves all as it is."""
        while True:
            version, document = self.read()
            edited = edit(document)
            if edited is None:
                return document
            if create_text(self.spark, f"{self.folder}/{version + 1:012d}.json", json.dumps(edited, sort_keys=True)):
                for old in self._versions()[:-KEPT_VERSIONS]:
                    delete_path(self.spark, f"{self.folder}/{old:012d}.json")
                return edited


class BatchLedger(Ledger):
    """Numbered batches of a stream in folders: ``{"folders": {name: ranges of batch ids}}``."""

    def holds(self, batch_id: int) -> bool:
        return any(in_ranges(r, batch_id) for r in self.folders().values())

    def folders(self) -> dict[str, Ranges]:
        return self.read()[1].get("folders", {})

    def add(self, folder: str, batch_id: int) -> None:
        """A written folder holds a batch; the first writer of a batch stands."""
        def edit(document: dict) -> dict | None:
            held = document.get("folders", {})
            return None if any(in_ranges(r, batch_id) for r in held.values()) else {**document, "folders": {**held, folder: [[batch_id, batch_id]]}}
        self.change(edit)

    def fold(self, folders: list[str], into: str) -> None:
        """One written folder takes the place of several."""
        def edit(document: dict) -> dict:
            held = document["folders"]
            missing = [f for f in folders if f not in held]
            if missing:
                raise RuntimeError(f"folded meanwhile: {missing}")
            rest = {f: r for f, r in held.items() if f not in folders}
            return {**document, "folders": {**rest, into: joined_ranges(*[held[f] for f in folders])}}
        self.change(edit)


class NamedLedger(Ledger):
    """Named batches, a folder each: ``{"batches": {batch: folder}}``."""

    def batches(self) -> dict[str, str]:
        return self.read()[1].get("batches", {})

    def add(self, batch: str, folder: str) -> bool:
        """False if another writer's folder holds the batch already."""
        def edit(document: dict) -> dict | None:
            held = document.get("batches", {})
            return None if batch in held else {**document, "batches": {**held, batch: folder}}
        return self.change(edit)["batches"][batch] == folder
