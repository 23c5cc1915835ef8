import datetime

import pytest
from pyspark.sql import functions as F

from folioweave import schemas
from folioweave.operators import chat

ROWS = [("1", 0, "user", "hi", None, None), ("1", 1, "agent", "yes", None, '[{"query":"q"}]'), ("2", 0, "user", "solo", None, None)]


def messages(spark, rows=ROWS):
    return spark.createDataFrame([(a, b, c, d, e, f) for a, b, c, d, e, f in rows], schemas.MESSAGES)


def keys(frame):
    return sorted((r["conversation_id"], r["seq"]) for r in frame.collect())


def test_memory_operations(spark):
    rows = messages(spark)
    assert keys(chat.remove_last(rows)) == [("1", 0)]
    added = messages(spark, [("1", 0, "user", "more", None, None), ("3", 0, "user", "new", None, None)])
    assert keys(chat.append(rows, added)) == [("1", 0), ("1", 1), ("1", 2), ("2", 0), ("3", 0)]
    assert keys(chat.drop(rows, ["1"])) == [("2", 0)]
    assert [r["content"] for r in chat.in_order(rows, "1").collect()] == ["hi", "yes"]


def test_messages_encode_and_decode(spark):
    coded = messages(spark).select(chat.encode(F.col("role"), F.col("content"), F.col("retrievals")).alias("e")).collect()
    assert sorted(r["e"] for r in coded) == [
        '{"role":"agent","content":"yes","retrievals":[{"query":"q"}]}', '{"role":"user","content":"hi"}',
        '{"role":"user","content":"solo"}']


def test_dump_replaces_only_what_differs(spark):
    stored = messages(spark)
    memory = messages(spark, [("1", 0, "user", "hi", None, None), ("2", 0, "user", "edited", None, None), ("4", 0, "user", "x", None, None)])
    changed = chat.changed_conversations(stored, memory)
    assert sorted(r[0] for r in changed.collect()) == ["1", "2", "4"]
    assert chat.changed_conversations(stored, stored).count() == 0
    later = stored.withColumn("seq", F.col("seq") + 57)
    assert chat.changed_conversations(later, stored).count() == 0
    assert sorted(r["content"] for r in chat.dump(stored, memory).collect()) == ["edited", "hi", "x"]
    old, now = datetime.datetime(2024, 1, 1), datetime.datetime(2025, 1, 1)
    parents = spark.createDataFrame([("1", "t", old, old), ("9", None, old, old)], schemas.CONVERSATIONS)
    touched = {r["id"]: r for r in chat.touch(parents, changed, F.lit(now)).collect()}
    assert touched["1"]["updated_at"] == now and touched["9"]["updated_at"] == old and touched["4"]["created_at"] == now


def test_conversation_rules(spark):
    old = datetime.datetime(2024, 1, 1)
    parents = spark.createDataFrame([("1", None, old, old)], schemas.CONVERSATIONS)
    bad = messages(spark, ROWS + [("1", 2, "system", "x", None, None), ("1", 3, "user", "", None, None)])
    found = sorted((r["rule"], r["key"]) for r in chat.message_violations(bad, parents).collect())
    assert found == [("conversation_missing", "2"), ("message", "1#2"), ("message", "1#3")]
    assert chat.create(parents, parents).count() == 1
    assert chat.rename(parents, "1", "T").head()["title"] == "T"
    with pytest.raises(ValueError):
        chat.rename(parents, "1", "")
    assert chat.with_messages(parents, messages(spark)).count() == 2


def test_opening_moves_between_memory_and_store(spark):
    stored = messages(spark)
    memory = messages(spark, [("2", 0, "user", "solo", None, None), ("2", 1, "agent", "late", None, None)])
    after, held = chat.open_conversation(stored, memory, "1", "2")
    assert keys(after) == [("1", 0), ("1", 1), ("2", 0), ("2", 1)] and keys(held) == [("1", 0), ("1", 1)]
    assert chat.is_loaded(held, "1") and not chat.is_loaded(held, "2")
    shown = messages(spark, [("1", 0, "agent", "a", None, '[{"passages":[1,2]},{"passages":[3]}]'), ("2", 0, "user", "b", None, None)])
    assert dict(map(tuple, chat.passage_totals(shown).collect())) == {"1": 3, "2": 0}
