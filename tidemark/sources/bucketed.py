"""A keyed table in buckets of its key: a merge moves the batch, never the table.

Spark knows how a bucketed table of the session's catalog lies.  A join on the key reads each bucket in the task that joins it and
only sends the batch there; what comes out still lies by bucket and is written as it is.  Use it where batches are
large or hold keys of all slices, so that a merge rewrites the table anyway.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.names import require_trusted_name
from tidemark.operators.upsert import merge_newer
from tidemark.session import delete


class BucketedTable:
    """Each state of the table is a bucketed Parquet table ``<name>_v<n>`` with a folder of its own below ``folder``.

    A state appears in the catalog once its files are written, so a merge that fails or loses its driver leaves the
    one before, and can be run again.  The state before the newest stays for those who read it; older ones go.
    One writer at a time.  Catalogs that outlive the session need Hive support, as for every Spark table.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, key: str, buckets: int):
        self.spark, self.name = spark, require_trusted_name(name, "name")
        self.folder, self.key, self.buckets = folder.rstrip("/"), key, buckets

    def _states(self) -> list[int]:
        *database, table = self.name.rsplit(".", 1)
        names = self.spark.sql(f"SHOW TABLES {'IN ' + database[0] if database else ''} LIKE '{table}_v*'").select("tableName").collect()
        found = (re.fullmatch(rf"{re.escape(table)}_v(\d+)", r[0], re.IGNORECASE) for r in names)
        return sorted(int(f[1]) for f in found if f)

    def exists(self) -> bool:
        return bool(self._states())

    def read(self) -> DataFrame:
        states = self._states()
        if not states:
            raise LookupError(f"{self.name} has not been written")
        return self.spark.table(f"{self.name}_v{states[-1]}")

    def replace(self, rows: DataFrame) -> None:
        """All rows anew: shuffled to their buckets once, one file each."""
        self._write(rows.repartition(self.buckets, self.key))

    def merged(self, batch: DataFrame, wins: Column) -> DataFrame:
        """The table after ``batch``, as :func:`merge_newer` has it; the only shuffle is the batch's."""
        return merge_newer(self.read(), batch, self.key, wins)

    def merge(self, batch: DataFrame, wins: Column) -> None:
        """Newer rows of ``batch`` replace, unknown keys are added; both sides hold a key at most once."""
        missing = set(self.read().columns) - set(batch.columns)
        if missing:
            raise ValueError(f"the batch has no {', '.join(sorted(missing))}")
        self._write(self.merged(batch, wins))

    def _write(self, rows: DataFrame) -> None:
        states = self._states()
        following = (states[-1] if states else 0) + 1
        # a folder of its own per attempt: what a broken one left is not in the way
        target = f"{self.folder}/{following}-{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.option("path", target).saveAsTable(f"{self.name}_v{following}")
        for old in states[:-1]:
            self._drop(f"{self.name}_v{old}")

    def _drop(self, table: str) -> None:
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Location").first()
        self.spark.sql(f"DROP TABLE {table}")
        delete(self.spark, about["data_type"])

    def drop(self) -> None:
        """Every state and its files."""
        for state in self._states():
            self._drop(f"{self.name}_v{state}")
