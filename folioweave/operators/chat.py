"""Conversation store and working memory as keyed message tables.

Messages carry ``(conversation_id, seq)``. Work is keyed on both columns wherever it can
be, so one very long conversation does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioweave import fixed_values as V
from folioweave.operators.listing import lookup

BODY = ("role", "content", "retrievals")


def message_violations(messages: DataFrame, conversations: DataFrame) -> DataFrame:
    """Role outside the enumeration, empty content, or no parent conversation."""
    rows = messages.select(F.lit("message").alias("rule"), "conversation_id", "seq", "role",
                           "content")
    bad = rows.where(~F.col("role").isin(*V.MESSAGE_ROLES) | (F.length("content") == 0)
                     | F.col("content").isNull())
    parents = conversations.select(F.col("id").alias("conversation_id"))
    orphans = messages.groupBy("conversation_id").count().join(
        parents, "conversation_id", "left_anti")
    key = F.concat_ws("#", "conversation_id", F.col("seq").cast("string"))
    return bad.select("rule", key.alias("key"), F.lit(None).cast("string").alias("detail")
                      ).unionByName(orphans.select(
                          F.lit("conversation_missing").alias("rule"),
                          F.col("conversation_id").alias("key"),
                          F.col("count").cast("string").alias("detail")))


def conversation_listing(conversations: DataFrame) -> DataFrame:
    return conversations.orderBy(F.desc("updated_at"), F.desc("created_at"), F.desc("id"))


def display_title(title: Column) -> Column:
    return F.coalesce(title, F.lit(V.UNTITLED))


def user_content(question: Column, context: Column) -> Column:
    """The question, with its context appended when there is one."""
    return F.when(F.length(context) > 0, F.concat(question, F.lit("\n\nContext: "), context)
                  ).otherwise(question)


def in_order(messages: DataFrame, conversation_id=None) -> DataFrame:
    """Messages oldest first; one conversation or all of them."""
    rows = messages if conversation_id is None else lookup(
        messages, "conversation_id", conversation_id)
    return rows.orderBy("conversation_id", "seq")


def with_messages(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """Conversations beside their messages; one without messages keeps one null row."""
    parent = conversations.withColumnRenamed("id", "conversation_id")
    return parent.join(messages.drop("created_at"), "conversation_id", "left")


def encode(role: Column, content: Column, retrievals: Column) -> Column:
    """Message JSON; ``retrievals`` (JSON text, kept as it is) only when there are any."""
    body = F.to_json(F.struct(role.alias("role"), content.alias("content")))
    extended = F.concat(F.substring(body, 1, F.length(body) - 1), F.lit(',"retrievals":'),
                        retrievals, F.lit("}"))
    return F.when(F.length(retrievals) > 2, extended).otherwise(body)


def decode(encoded: Column) -> Column:
    return F.from_json(encoded, "role string, content string, retrievals variant")


def create(conversations: DataFrame, added: DataFrame) -> DataFrame:
    """Add conversations whose identifier is new; existing rows stay as they are."""
    fresh = added.join(conversations.select("id"), "id", "left_anti")
    return conversations.unionByName(fresh)


def rename(conversations: DataFrame, conversation_id: str, title: str) -> DataFrame:
    if not title:
        raise ValueError("a title must not be empty")
    mine = F.col("id") == F.lit(conversation_id)
    return conversations.withColumn("title", F.when(mine, F.lit(title)).otherwise(F.col("title")))


def append(messages: DataFrame, added: DataFrame) -> DataFrame:
    """Append rows after each conversation's last message.

    ``added`` has its own ``seq`` order per conversation. The last stored position is a
    maximum over the conversations that are added to, one partial row per task.
    """
    touched = added.select("conversation_id").distinct()
    last = messages.join(touched, "conversation_id", "left_semi").groupBy("conversation_id").agg(F.max("seq").alias("last"))
    placed = added.join(last, "conversation_id", "left").withColumn(
        "seq", F.coalesce(F.col("last") + 1, F.lit(0)) + F.col("seq")).drop("last")
    return messages.unionByName(placed.select(*messages.columns))


def remove_last(messages: DataFrame) -> DataFrame:
    """Every conversation without its latest message.

    The maxima join back on (conversation, position), which has no hot key.
    """
    last = messages.groupBy("conversation_id").agg(F.max("seq").alias("seq"))
    return messages.join(last, ["conversation_id", "seq"], "left_anti")


def drop(messages: DataFrame, conversation_ids: list[str]) -> DataFrame:
    return messages.where(~F.col("conversation_id").isin(*conversation_ids))


def load(memory: DataFrame, messages: DataFrame, conversation_id: str) -> DataFrame:
    """Replace what memory holds of one conversation by its stored messages."""
    stored = lookup(messages, "conversation_id", conversation_id)
    return drop(memory, [conversation_id]).unionByName(stored.select(*memory.columns))


def is_loaded(memory: DataFrame, conversation_id: str) -> bool:
    return lookup(memory, "conversation_id", conversation_id).head() is not None


def open_conversation(stored: DataFrame, memory: DataFrame, conversation_id: str,
                      previous_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Dump the conversation being left, then load the one being opened.

    Returns the new store and the new memory.
    """
    if previous_id and previous_id != conversation_id:
        leaving = lookup(memory, "conversation_id", previous_id)
        stored = dump(stored, leaving)
        memory = drop(memory, [previous_id])
    return stored, load(memory, stored, conversation_id)


def passage_totals(messages: DataFrame) -> DataFrame:
    """Passages shown per conversation, over all searches of its messages."""
    searches = F.from_json("retrievals", "array<struct<passages: array<variant>>>")
    shown = F.aggregate(F.transform(searches, lambda x: F.coalesce(F.size(x["passages"]), F.lit(0))),
                        F.lit(0), lambda total, n: total + n)
    return messages.groupBy("conversation_id").agg(
        F.coalesce(F.sum(F.greatest(shown, F.lit(0))), F.lit(0)).alias("passages"))


def changed_conversations(stored: DataFrame, memory: DataFrame) -> DataFrame:
    """Conversations in ``memory`` whose messages differ from the stored ones.

    Compared by position: a hash per (conversation, position) from each side, then one
    flag per conversation. Both steps combine before they shuffle.
    """
    content = F.sha2(F.to_json(F.struct(*BODY), {"ignoreNullFields": "false"}), 256)

    def side(rows: DataFrame, own: str, other: str) -> DataFrame:
        # Positions are counted from the conversation's first message.
        first = rows.groupBy("conversation_id").agg(F.min("seq").alias("first"))
        return rows.join(first, "conversation_id").select(
            "conversation_id", (F.col("seq") - F.col("first")).alias("seq"), content.alias(own),
            F.lit(None).cast("string").alias(other))

    both = side(memory, "new", "old").unionByName(side(stored, "old", "new"))
    paired = both.groupBy("conversation_id", "seq").agg(
        F.max("new").alias("new"), F.max("old").alias("old"))
    verdict = paired.groupBy("conversation_id").agg(
        F.count("new").alias("held"),
        F.bool_or(~F.col("new").eqNullSafe(F.col("old"))).alias("differs"))
    return verdict.where("held > 0 AND differs").select("conversation_id")


def dump(stored: DataFrame, memory: DataFrame) -> DataFrame:
    """Stored messages after working memory replaced the conversations that differ."""
    changed = changed_conversations(stored, memory)
    kept = stored.join(changed, "conversation_id", "left_anti")
    return kept.unionByName(memory.join(changed, "conversation_id", "left_semi")
                            .select(*stored.columns))


def touch(conversations: DataFrame, changed: DataFrame, moment: Column) -> DataFrame:
    """``updated_at`` moves only for conversations that changed; unknown ones are made."""
    marks = changed.select(F.col("conversation_id").alias("id"), F.lit(True).alias("hit"))
    joined = conversations.join(marks, "id", "full_outer")
    return joined.select(
        "id", "title", F.coalesce("created_at", moment).alias("created_at"),
        F.when(F.col("hit"), moment).otherwise(F.col("updated_at")).alias("updated_at"))
