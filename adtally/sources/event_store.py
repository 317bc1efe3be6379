"""Raw events by load date, with a side index of event ids: an incremental run reads only files that matter.

Every load is a batch folder ``events/batch=.../load_date=...`` of files sorted by event time, entered in the ledger
under its batch id (a repeated load is skipped). Beside it lies the index: for each file, or piece of one that a scan task
reads, a row for every id slice with the file's name, load date, row count, smallest and largest id, and the sorted 64-bit
hashes of the slice's ids.

* What came after ``since`` is a filter on the partition column ``load_date`` and on ``_loaded_at``.
* ``files_holding(ids, ...)`` finds the earlier files that hold one of some ids. Index rows of other loads and of id
  ranges that the ids do not touch are filtered at the scan; the rest meets the ids' hashes slice by slice, both sorted.
* ``read_files`` reads just these.

Why hashes and no Bloom filters: with T touched ids a file is spared only if none of them hits its filter by
chance, which needs some 1.44 * log2(100 T) bits for each id: as many as the hash has for the T of a daily load, while
hashes never spare a file wrongly and read one in vain only if two ids share all 64 bits. The index takes eight bytes for each
raw row and is read once for each run; ids are compared themselves afterwards.

Scale: the index is built from the written files without a shuffle; slices of ids are groups of bounded size (``IDS_PER_SLICE``
on average); a hot retried id is one hash on either side. File names are the only thing that reaches the driver, as
for any scan.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import delete_path
from adtally.sources.io import materialize
from adtally.sources.ledger import NamedLedger
from adtally.sources.load import RAW_SORT_KEYS
from adtally.sources.schemas import RAW_SCHEMAS

SLICES = 256  # id slices of the index, by the hash's upper byte; a run groups them by its size
IDS_PER_SLICE = 1 << 21
FILE_ROWS = 4_000_000
INDEX = "file string, load_date date, slice int, n_rows long, first_id string, last_id string, hashes binary"


def as_ntz(value: dt.datetime) -> F.Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


class EventStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.ledger = spark, root, NamedLedger(spark, root)
        self.schema = RAW_SCHEMAS["ad_events"]

    # ---- loading ------------------------------------------------------------------------------
    def load(self, events: DataFrame, batch_id: str) -> bool:
        """Store a batch of raw events and its index; False if the batch is held already."""
        if batch_id in self.ledger.batches():
            return False
        folder = f"batch={uuid.uuid4().hex[:12]}"
        typed = events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        (typed.withColumn("load_date", F.to_date("_loaded_at")).hint("rebalance", "load_date")
         .sortWithinPartitions("load_date", *RAW_SORT_KEYS["ad_events"])
         .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("load_date").parquet(f"{self.root}/events/{folder}"))
        self._index([folder]).write.parquet(f"{self.root}/index/{folder}")
        if self.ledger.add(batch_id, folder):
            return True
        for kind in ("events", "index"):  # another writer was first
            delete_path(self.spark, f"{self.root}/{kind}/{folder}")
        return False

    def _index(self, folders: list[str]) -> DataFrame:
        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list] = {}
            for batch in batches:
                table = pa.Table.from_batches([batch])
                for file in table.column("file").unique().to_pylist():
                    part = table.filter(pc.equal(table.column("file"), file))
                    ids = part.column("event_id").drop_null()
                    key = (file, part.column("load_date")[0].as_py())
                    kept = held.setdefault(key, [0, None, None, []])
                    kept[0] += len(part)
                    if len(ids):
                        low, high = pc.min_max(ids).as_py().values()
                        kept[1], kept[2] = min(low, kept[1] or low), max(high, kept[2] or high)
                    kept[3].append(np.unique(part.column("hash").to_numpy().view(np.uint64)))
            for (file, day), (rows, low, high, hashes) in held.items():
                every = np.unique(np.concatenate(hashes))
                of_slice = (every >> np.uint64(56)).astype(np.int64)
                ends = np.searchsorted(of_slice, np.arange(SLICES + 1))
                slices = [s for s in range(SLICES) if ends[s + 1] > ends[s]]
                n = len(slices)
                columns = [[file] * n, [day] * n, slices, [rows] * n, [low] * n, [high] * n, [every[ends[s]:ends[s + 1]].tobytes() for s in slices]]
                kinds = [pa.string(), pa.date32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["file", "load_date", "slice", "n_rows", "first_id", "last_id", "hashes"])

        rows = self._scan([f"{self.root}/events/{f}" for f in folders])
        return rows.select(F.col("_metadata.file_path").alias("file"), "load_date", "event_id",
                           F.xxhash64("event_id").alias("hash")).mapInArrow(build, INDEX)

    # ---- reading ------------------------------------------------------------------------------
    def _scan(self, paths: list[str]) -> DataFrame:
        schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields], "load_date date"])
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, batch string")
        return self.spark.read.schema(f"{schema}, batch string").option("basePath", f"{self.root}/events").parquet(*paths)

    def _paths(self, kind: str, batches: Iterable[str] | None) -> list[str]:
        held = self.ledger.batches()
        return [f"{self.root}/{kind}/{held[b]}" for b in (held if batches is None else batches)]

    def read(self, batches: Iterable[str] | None = None) -> DataFrame:
        """Events with ``load_date`` and ``batch``, of all batches or of some."""
        return self._scan(self._paths("events", batches))

    def events(self, batches: Iterable[str] | None = None) -> DataFrame:
        return self.read(batches).select(*self.schema.names)

    def after(self, since: dt.datetime) -> DataFrame:
        """Events loaded after ``since``: later load dates and what is left of its own."""
        return self.read().where((F.col("load_date") >= F.lit(since.date())) & (F.col("_loaded_at") > as_ntz(since))).select(*self.schema.names)

    def index(self, batches: Iterable[str] | None = None) -> DataFrame:
        paths = self._paths("index", batches)
        return self.spark.read.schema(INDEX).parquet(*paths) if paths else self.spark.createDataFrame([], INDEX)

    def files_holding(self, ids: DataFrame, batches: Iterable[str] | None = None, until: dt.date | None = None) -> list[str]:
        """Files that hold an id of ``ids`` (event_id; null is an id, too), of some batches or load dates up to ``until``."""
        if not self._paths("index", batches):
            return []
        span = ids.agg(F.count("*").alias("rows"), F.count("event_id").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
        if not span["rows"]:
            return []
        index = self.index(batches)
        if until is not None:
            index = index.where(F.col("load_date") <= F.lit(until))
        if span["rows"] == span["n"]:
            index = index.where((F.col("last_id") >= span["low"]) & (F.col("first_id") <= span["high"]))
        groups = max(1, min(SLICES, math.ceil(span["rows"] / IDS_PER_SLICE)))
        rows = index.select((F.col("slice") % groups).alias("part"), "file", "hashes")
        hashed = ids.select(F.xxhash64("event_id").alias("hash")).withColumn("part", F.shiftrightunsigned("hash", 56).cast("int") % groups)

        def holding(asked: pa.Table, held: pa.Table) -> pa.Table:
            wanted = np.unique(asked.column("hash").to_numpy().view(np.uint64))
            found = set()
            for file, packed in zip(held.column("file").to_pylist(), held.column("hashes")):
                if file not in found:
                    hashes = np.frombuffer(packed.as_buffer(), np.uint64)
                    few, many = (hashes, wanted) if len(hashes) < len(wanted) else (wanted, hashes)
                    at = np.searchsorted(many, few)
                    if np.any(many[np.minimum(at, len(many) - 1)] == few):
                        found.add(file)
            return pa.table({"file": pa.array(sorted(found), pa.string())})

        files = hashed.groupBy("part").cogroup(rows.groupBy("part")).applyInArrow(holding, "file string").distinct()
        return sorted(r.file for r in files.collect())

    def read_files(self, files: list[str]) -> DataFrame:
        return self._scan(files).select(*self.schema.names)

    # ---- unique ids -----------------------------------------------------------------------------
    def repeated_ids(self, fresh: DataFrame, until: dt.date | None = None, batches: Iterable[str] | None = None) -> DataFrame:
        """(event_id, cnt) of the ids among ``fresh`` events that stand on more than one row of them and the earlier loads.

        Earlier files are read only if the index says that they hold one of the ids; ids are then compared themselves. ``fresh``
        must not be among the earlier loads (``batches``, or load dates up to ``until`` that lie before it).
        """
        ids = materialize("fresh_ids", fresh.select("event_id").where("event_id IS NOT NULL").distinct())
        earlier = self.read_files(self.files_holding(ids, batches, until)).join(ids, "event_id", "left_semi").select("event_id")
        return fresh.select("event_id").unionByName(earlier).where("event_id IS NOT NULL").groupBy("event_id").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
