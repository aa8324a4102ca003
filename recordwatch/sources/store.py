"""A store of tables that change together: every run writes a directory, one pointer makes it current.

Tables of a run are written below ``run=<id>``; only when all are there, and pass their checks, is the pointer file
replaced by rename. A failure before that leaves the tables of the run before as they are.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT.json"


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> dict[str, str]:
        """Table -> path, as the last commit left them."""
        at = self._path(f"{self.root}/{POINTER}")
        if not self._fs.exists(at):
            return {}
        return json.loads(self.spark.read.text(f"{self.root}/{POINTER}", wholetext=True).first()[0])

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        path = self.current().get(table)
        if path is None:
            if schema is None:
                raise KeyError(table)
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(path)

    def commit(self, run_id: str, tables: dict[str, DataFrame], check: Callable[[dict[str, DataFrame]], None] | None = None, dry_run: bool = False, allowed: bool = True) -> bool:
        """Write all tables of a run or none. Tables that aren't given stay. Writing a run again replaces it."""
        if dry_run or not allowed:
            return False
        found = self.current()
        for name, df in tables.items():
            path = f"{self.root}/run={run_id}/{name}"
            if found.get(name) == path:  # a run written again must not overwrite what it may read
                path = f"{path}-again" if not path.endswith("-again") else path.removesuffix("-again")
            df.write.mode("overwrite").parquet(path)
            found[name] = path
        if check:
            check({name: self.spark.read.parquet(found[name]) for name in tables})
        temporary = self._path(f"{self.root}/{POINTER}.next")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps(found, sort_keys=True).encode()))
        out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        where = hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        where.rename(self._fs.makeQualified(temporary), self._fs.makeQualified(self._path(f"{self.root}/{POINTER}")), options)
        return True
