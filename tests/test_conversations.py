import datetime

import pytest
from pyspark.sql import functions as F

from folioweave import schemas
from folioweave.plans.conversations import ConversationStore

OLD, NOW = datetime.datetime(2024, 1, 1), datetime.datetime(2025, 1, 1)


def rows(spark, *triples):
    return spark.createDataFrame([(c, s, "user", t, None, None) for c, s, t in triples], schemas.MESSAGES)


def held(store, *ids):
    keys = store.spark.createDataFrame([(i,) for i in ids], "conversation_id string") if ids else None
    return sorted((r["conversation_id"], r["seq"], r["content"]) for r in store.messages(keys).collect())


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "conversation_id string")


def folders(store):
    return store._messages.state()["folders"]


@pytest.fixture
def store(spark, tmp_path):
    return ConversationStore(spark, str(tmp_path / "chat"), 8)


def test_a_retried_change_is_stored_once(spark, store):
    first = rows(spark, ("1", 0, "hi"), ("1", 1, "there"), ("2", 0, "solo"))
    assert store.append(first, "b1", OLD) and not store.append(first, "b1", OLD)
    assert held(store) == [("1", 0, "hi"), ("1", 1, "there"), ("2", 0, "solo")]
    assert store.remove_last(keys(spark, "1"), "b2", NOW)
    assert not store.remove_last(keys(spark, "1"), "b2", NOW)
    # a late retry of the first batch brings back nothing either
    assert not store.append(first, "b1", OLD)
    assert held(store) == [("1", 0, "hi"), ("2", 0, "solo")]
    assert store.append(rows(spark, ("1", 0, "again")), "b3", NOW)
    assert held(store, "1") == [("1", 0, "hi"), ("1", 1, "again")]
    times = {r["id"]: r["updated_at"] for r in store.conversations().collect()}
    assert times == {"1": NOW, "2": OLD}


def test_changes_touch_the_buckets_of_their_conversations(spark, store):
    store.append(rows(spark, *[(str(i), 0, "x") for i in range(40)]), "b1", OLD)
    before = folders(store)
    assert len(before) == 8
    store.append(rows(spark, ("7", 0, "more")), "b2", NOW)
    after = folders(store)
    assert sum(before[b] != after[b] for b in before) == 1
    store.dump(rows(spark, ("7", 0, "x"), ("7", 1, "more"), ("9", 0, "edited"), ("5", 0, "x")), "b3", NOW)
    last = folders(store)
    nine = store._messages.buckets_of(keys(spark, "9"))
    assert [int(b) for b in after if after[b] != last[b]] == nine
    assert held(store, "9") == [("9", 0, "edited")] and held(store, "5") == [("5", 0, "x")]


def test_dump_retried_after_a_lost_driver_still_moves_the_time(spark, store):
    store.append(rows(spark, ("1", 0, "a"), ("2", 0, "b")), "b1", OLD)
    memory = rows(spark, ("1", 0, "changed"), ("2", 0, "b"))
    touch, store._touch = store._touch, lambda *_: None
    assert store.dump(memory, "b2", NOW)
    store._touch = touch
    assert not store.dump(memory, "b2", NOW)
    assert {r["id"]: r["updated_at"] for r in store.conversations().collect()} == {"1": NOW, "2": OLD}


def test_parents_and_dropping(spark, store):
    parents = spark.createDataFrame([("1", "t", OLD, OLD), ("3", None, OLD, OLD)], schemas.CONVERSATIONS)
    store.create(parents)
    store.create(parents.withColumn("title", F.lit("ignored")))
    store.rename("3", "named")
    assert sorted((r["id"], r["title"]) for r in store.conversations().collect()) == [("1", "t"), ("3", "named")]
    store.append(rows(spark, ("1", 0, "a"), ("3", 0, "b")), "b1", NOW)
    assert store.drop(keys(spark, "1"), "b2") and not store.drop(keys(spark, "1"), "b2")
    assert held(store) == [("3", 0, "b")] and [r["id"] for r in store.conversations().collect()] == ["3"]


def test_a_writer_that_lost_the_race_fails(spark, store):
    store.append(rows(spark, ("1", 0, "a")), "b1", OLD)

    def change(messages):
        store.append(rows(spark, ("1", 0, "other")), "b2", OLD)
        return messages

    with pytest.raises(ValueError, match="moved"):
        store._change("b3", keys(spark, "1"), change)
    assert held(store) == [("1", 0, "a"), ("1", 1, "other")]


def test_nothing_and_missing_identifiers(spark, store):
    assert held(store) == [] and not store.append(rows(spark), "b1", OLD)
    with pytest.raises(ValueError):
        store.append(rows(spark, ("1", 0, "a")), "", OLD)
    with pytest.raises(ValueError):
        store.append(rows(spark, (None, 0, "a")), "b1", OLD)
