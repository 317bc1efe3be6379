"""Small helpers shared by the training-data operators.

Every operator selects the columns it needs under internal names first, so extra columns
of the input (also ones that clash with internal names) never reach its plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import delete_path, temporary_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id as long and the whole text (null: empty), nothing else."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, also in other case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def long_array(values: list[int]) -> Column:
    """Literal array of longs."""
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def partitions(spark: SparkSession, total_bytes: int, target_bytes: int) -> int:
    """Partitions of about ``target_bytes`` each, at least the session's shuffle setting."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(base, math.ceil(total_bytes / target_bytes))


class Stored:
    """A table written to the shared checkpoint folder: it cuts the lineage and survives lost executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, temporary_path(df.sparkSession, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files, once nothing that is still to run reads them; else they go when the application ends."""
        delete_path(self.spark, self.path)


def size_in_bytes(df: DataFrame, *columns: str) -> int:
    """Sum of the columns' bytes, for checks before a broadcast or a choice of partitions."""
    total = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))
    return int(df.agg(F.sum(total.cast("long"))).first()[0] or 0)
