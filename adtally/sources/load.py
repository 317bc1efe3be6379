"""Raw load step: derive the raw tables once and store them in the shared folder.

The original warehouse loads its raw tables first and runs every model over them. Here the
load writes the four raw tables as Parquet under ``spark.checkpoint.dir``; the models then
read those files, so query plans stay small and lineage is cut at the load (a lost executor
re-reads files instead of re-deriving raw rows).

* Large inputs need no shuffle: each task writes the rows it derived, sorted inside the
  file by the table's sort key (events by ``event_timestamp, publisher_id``), so Parquet
  min/max statistics prune time-range and publisher filters. Inputs with fewer splits than
  cores are spread round-robin first, so scans of small data still use every core.
* ``ad_events`` is deliberately *not* bucketed by ``event_id``. Bucketing would let the
  dedup skip its shuffle, but a retried event whose copies make up a large share of the
  rows would land in a single bucket, and one task would then write and dedup all of it.
  The shuffle-based dedup keeps a partial row limit before the exchange, so every map task
  collapses its copies of a hot id to one row first.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import checkpoint_root, delete_path
from adtally.sources.ledger import NamedLedger
from adtally.sources.registry import RAW_TABLES, RawSources, from_testdata
from adtally.sources.schemas import RAW_SCHEMAS

# ---- fixed values: sort keys of the raw tables --------------------------------------------
RAW_SORT_KEYS = {
    "ad_events": ("event_timestamp", "publisher_id"),
    "publishers": ("publisher_id",),
    "campaigns": ("campaign_id",),
    "ad_units": ("ad_unit_id",),
}
# ---- end fixed values ----------------------------------------------------------------------


def write_raw_table(df: DataFrame, path: str, sort_key: tuple[str, ...], spread: bool = False) -> DataFrame:
    """Write one raw table sorted inside each file and read it back typed.

    Large inputs are written as derived (one file per input split, no shuffle). An input
    with fewer splits than the cluster has cores (e.g. one small source file) is first
    spread round-robin when ``spread`` is set (the event table), which is skew-free, so
    later scans use every core; dimensions stay as written.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    df.sortWithinPartitions(*sort_key).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_raw(spark: SparkSession, raw: RawSources, root: str | None = None) -> RawSources:
    """Persist ``raw`` under the shared folder and bind the models to the stored tables."""
    root = root or f"{checkpoint_root(spark)}/raw-{uuid.uuid4().hex[:12]}"
    return RawSources(**{name: write_raw_table(getattr(raw, name), f"{root}/{name}", RAW_SORT_KEYS[name],
                                               spread=(name == "ad_events"))
                         for name in RAW_TABLES})


class StoredRaw(RawSources):
    """The raw tables as ``load_raw`` stores them under ``root``, each written when it is first read."""

    def __init__(self, raw: RawSources, root: str):
        object.__setattr__(self, "_given", (raw, root))

    def __getattr__(self, name: str) -> DataFrame:  # of a table that is not written yet
        if name not in RAW_TABLES:
            raise AttributeError(name)
        raw, root = self._given
        df = write_raw_table(getattr(raw, name), f"{root}/{name}", RAW_SORT_KEYS[name], spread=(name == "ad_events"))
        object.__setattr__(self, name, df)
        return df

    def write_all(self) -> StoredRaw:
        for name in RAW_TABLES:
            getattr(self, name)
        return self


def append_batch(spark: SparkSession, batch: DataFrame, path: str, name: str = "ad_events", batch_id: str | None = None) -> DataFrame:
    """Append a batch of raw rows to a stored raw table, typed and sorted like its other files; read the table.

    With a ``batch_id`` the append can be repeated: the batch is a folder of its own, entered in the table's ledger, and
    one that is held already is skipped. Without one every call appends.
    """
    typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[name].fields]).sortWithinPartitions(*RAW_SORT_KEYS[name])
    if batch_id is None:
        typed.write.mode("append").parquet(path)
    else:
        ledger = NamedLedger(spark, _batches(path))
        if batch_id not in ledger.batches():
            folder = f"batch-{uuid.uuid4().hex[:12]}"
            typed.write.parquet(f"{_batches(path)}/{folder}")
            if not ledger.add(batch_id, folder):
                delete_path(spark, f"{_batches(path)}/{folder}")  # another writer was first
    return read_raw_table(spark, path, name)


def _batches(path: str) -> str:
    return f"{path.rstrip('/')}.batches"


def read_raw_table(spark: SparkSession, path: str, name: str = "ad_events") -> DataFrame:
    """A stored raw table with the batches that its ledger holds."""
    appended = [f"{_batches(path)}/{folder}" for folder in NamedLedger(spark, _batches(path)).batches().values()]
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(path, *appended)


def replay_batch(sample: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """A retry of the sampled rows: the same rows with a new load time."""
    stamp = F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return sample.withColumn("_loaded_at", stamp)


def literal_rows(spark: SparkSession, name: str, rows: Iterable[Sequence | Mapping]) -> DataFrame:
    """Rows given as values (in column order) or by column name, typed as raw table ``name``; columns left out are null.

    Values are cast as a load casts them: text to dates, times and numbers; what does not fit raises.
    """
    schema = RAW_SCHEMAS[name]
    names = [f.name for f in schema.fields]
    made = []
    for row in rows:
        given = dict(row) if isinstance(row, Mapping) else dict(zip(names, row, strict=True))
        if unknown := set(given) - set(names):
            raise ValueError(f"no such columns in {name}: {sorted(unknown)}")
        made.append(tuple(None if given.get(n) is None else str(given[n]) for n in names))
    text = spark.createDataFrame(made, ", ".join(f"`{n}` string" for n in names))
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_testdata(spark: SparkSession, sf_dir: str) -> RawSources:
    """Derive the raw tables from the driver's parquet and load them (see ``load_raw``)."""
    return load_raw(spark, from_testdata(spark, sf_dir))
