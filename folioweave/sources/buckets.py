"""A table in hash buckets whose versions share the buckets that did not change.

Rows lie in the bucket of their key. A change writes the touched buckets alone, into a folder of
its own, partitioned by bucket; a pointer file then names one folder for every bucket. The pointer is
swapped only if no other writer has moved it, so readers see one whole version, and a writer that
fails leaves the old one. Folders that neither the current nor the previous version names are removed.

The pointer holds a name for each bucket, so it stays small however large the table is.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folioweave.sources.files import Files

BUCKETS = 64


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.files = Files(spark)
        # a table keeps the number of buckets that it began with
        self.buckets = (self.state() or {"buckets": buckets})["buckets"]

    @property
    def pointer(self) -> str:
        return f"{self.root}.json"

    def state(self) -> dict | None:
        held = self.files.content(self.pointer)
        return json.loads(held) if held else None

    def snapshot(self) -> bytes | None:
        """The pointer as it is now; a change that began here passes it on as ``seen``."""
        return self.files.content(self.pointer)

    def note(self) -> dict:
        return (self.state() or {}).get("note", {})

    def bucket(self, key: str | None = None) -> Column:
        return F.pmod(F.xxhash64(key or self.key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of all keys of a table: at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect())

    def _folder(self, bucket: str, run: str) -> str:
        return f"{self.root}/run={run}/bucket={bucket}"

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The current rows; of the named buckets alone, the others' files are not opened."""
        folders = (self.state() or {"folders": {}})["folders"]
        wanted = [self._folder(b, run) for b, run in sorted(folders.items()) if only is None or int(b) in set(only)]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*wanted)

    def replace(self, rows: DataFrame, touched: list[int], note: dict | None = None, *order: str,
                seen: bytes | None | object = ...) -> list[int]:
        """Make ``rows`` the whole content of the touched buckets; returns those that hold rows now.

        Rows derived from what was read after a ``snapshot`` name it: another writer since then makes this fail.
        """
        before = self.snapshot() if seen is ... else seen
        state = json.loads(before) if before else {"folders": {}}
        run, filled = uuid.uuid4().hex, []
        if touched:
            dealt = rows.select(*self.schema.names, self.bucket().alias("bucket"))
            # one task a bucket, unless Spark splits a large one
            (dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order)
             .write.partitionBy("bucket").mode("errorifexists").parquet(f"{self.root}/run={run}"))
            filled = [b for b in touched if self.files.exists(self._folder(str(b), run))]
        folders = {b: r for b, r in state["folders"].items() if int(b) not in set(touched)}
        folders.update({str(b): run for b in filled})
        self.files.swap_json(self.pointer, {"buckets": self.buckets, "folders": folders,
                                            "previous": state["folders"], "note": note or state.get("note", {})}, before)
        self._sweep(state.get("previous", {}), state["folders"], folders)
        return filled

    def _sweep(self, older: dict, previous: dict, current: dict) -> None:
        kept = set(previous.items()) | set(current.items())
        for bucket, run in older.items():
            if (bucket, run) not in kept:
                self.files.remove_tree(self._folder(bucket, run))
