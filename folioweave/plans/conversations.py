"""Conversations kept on storage: messages and their parents in hash buckets.

Every change of messages carries a batch identifier. The store keeps one mark for each conversation and
batch beside the messages, written by the same pointer swap, so a change that is retried, by a scheduler
or after a lost driver, is stored once: appended messages do not come twice, a removed message does
not take its predecessor along. A change reads and writes the buckets of its conversations alone; a
writer that lost a race fails and may try again under the same identifier.

The parents (title and times) are a second table, moved forward after the messages: a retry that finds
its messages stored still moves them, which is harmless to repeat, as times only grow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioweave import schemas
from folioweave.operators import chat
from folioweave.sources.buckets import BUCKETS, BucketedTable

_KEY = "conversation_id"
_ROWS = T.StructType([*schemas.MESSAGES.fields, T.StructField("batch", T.StringType(), True)])


class ConversationStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self._messages = BucketedTable(spark, f"{root}/messages", _ROWS, _KEY, buckets)
        self._parents = BucketedTable(spark, f"{root}/conversations", schemas.CONVERSATIONS, "id", buckets)

    # ---- reading ----
    def messages(self, keys: DataFrame | None = None) -> DataFrame:
        """Stored messages; those of given conversations open their buckets only."""
        only = None if keys is None else self._messages.buckets_of(keys)
        rows = self._messages.read(only).where("batch IS NULL").drop("batch")
        return rows if keys is None else rows.join(keys.select(_KEY), _KEY, "left_semi")

    def conversations(self) -> DataFrame:
        return self._parents.read()

    # ---- parents ----
    def _change_parents(self, ids: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        seen = self._parents.snapshot()
        touched = self._parents.buckets_of(ids)
        if touched:
            self._parents.replace(change(self._parents.read(touched)), touched, None, "id", seen=seen)

    def create(self, added: DataFrame) -> None:
        """Insert conversations whose identifier is new; ``added`` names each one once."""
        self._change_parents(added, lambda held: chat.create(held, added.select(*held.columns)))

    def rename(self, conversation_id: str, title: str) -> None:
        ids = self.spark.createDataFrame([(conversation_id,)], "id string")
        self._change_parents(ids, lambda held: chat.rename(held, conversation_id, title))

    def _touch(self, keys: DataFrame, moment) -> None:
        later = F.greatest(F.col("updated_at"), F.lit(moment).cast("timestamp"))
        self._change_parents(keys.select(F.col(_KEY).alias("id")), lambda held: chat.touch(held, keys, later))

    # ---- messages ----
    def _change(self, batch: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame], seen=...) -> bool:
        """Apply one batch to the buckets of ``keys``; False where it is stored already."""
        if not batch:
            raise ValueError("a change of messages needs a batch identifier")
        if keys.where(F.col(_KEY).isNull()).head() is not None:
            raise ValueError("a message lacks its conversation")
        seen = self._messages.snapshot() if seen is ... else seen
        touched = self._messages.buckets_of(keys)
        held = self._messages.read(touched)
        if not touched or held.where(F.col("batch") == batch).head() is not None:
            return False
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MESSAGES if f.name != _KEY]
        marks = keys.select(_KEY, *nothing, F.lit(batch).alias("batch"))
        after = change(held.where("batch IS NULL").drop("batch")).withColumn("batch", F.lit(None).cast("string"))
        rows = after.unionByName(held.where("batch IS NOT NULL")).unionByName(marks)
        self._messages.replace(rows, touched, None, _KEY, "seq", seen=seen)
        return True

    def append(self, added: DataFrame, batch: str, moment) -> bool:
        """Add messages after the last one of their conversations, once a batch."""
        keys = added.select(_KEY).distinct()
        fresh = self._change(batch, keys, lambda held: chat.append(held, added.select(*held.columns)))
        self._touch(keys, moment)
        return fresh

    def remove_last(self, keys: DataFrame, batch: str, moment) -> bool:
        """Take the latest message from each of the given conversations, once a batch."""
        keys = keys.select(_KEY).distinct()

        def shorter(held: DataFrame) -> DataFrame:
            mine = chat.remove_last(held.join(keys, _KEY, "left_semi"))
            return held.join(keys, _KEY, "left_anti").unionByName(mine)

        fresh = self._change(batch, keys, shorter)
        self._touch(keys, moment)
        return fresh

    def dump(self, memory: DataFrame, batch: str, moment) -> bool:
        """Working memory replaces the stored messages of the conversations that differ."""
        seen = self._messages.snapshot()
        keys = memory.select(_KEY).distinct()
        changed = chat.changed_conversations(self.messages(keys), memory)
        moving = memory.join(changed, _KEY, "left_semi")

        def replaced(held: DataFrame) -> DataFrame:
            return held.join(changed, _KEY, "left_anti").unionByName(moving.select(*held.columns))

        fresh = self._change(batch, changed, replaced, seen)
        # the marks tell which conversations moved, also to a retry that finds nothing different
        marked = self._messages.read(self._messages.buckets_of(keys)).where(F.col("batch") == batch)
        self._touch(marked.select(_KEY), moment)
        return fresh

    def drop(self, keys: DataFrame, batch: str) -> bool:
        """Remove conversations with their messages; their marks stay."""
        keys = keys.select(_KEY).distinct()
        fresh = self._change(batch, keys, lambda held: held.join(keys, _KEY, "left_anti"))
        ids = keys.select(F.col(_KEY).alias("id"))
        self._change_parents(ids, lambda held: held.join(ids, "id", "left_anti"))
        return fresh
