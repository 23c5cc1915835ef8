"""Queries on the conversation store and working memory."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import text as X
from folioweave.operators import chat
from folioweave.plans import corpus, sql_parts as S
from folioweave.plans.conversations import ConversationStore
from folioweave.plans.registry import query
from folioweave.sources.files import shared_folder

_SEARCHES = '[{"query":"q","passages":[]}]'
_MESSAGES = f"""messages AS (SELECT conv_id::VARCHAR AS conversation_id, turn AS seq,
  CASE role WHEN 'assistant' THEN 'agent' ELSE role END AS role, text AS content,
  CASE WHEN role = 'assistant' THEN '{_SEARCHES}' END AS retrievals FROM conversations),
store AS (SELECT conversation_id AS id, arg_min(content, seq) AS first_content, count(*) AS n FROM messages GROUP BY 1),
titled AS (SELECT id, n, CASE WHEN n % 3 > 0 THEN {{title}} END AS title,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * (id::BIGINT) AS created_at,
  TIMESTAMP '2024-06-01 00:00:00' + INTERVAL 1 DAY * n AS updated_at FROM store)"""
_BARE = f"regexp_replace(trim({S.strip('first_content')}, '\"'''), '\\.+\\z', '')"
_MESSAGES = _MESSAGES.replace("{title}", f"substring({_BARE}, 1, 80)")


def messages(spark, sf):
    rows = corpus.table(spark, sf, "conversations")
    role = F.when(F.col("role") == "assistant", "agent").otherwise(F.col("role"))
    return rows.select(F.col("conv_id").cast("string").alias("conversation_id"),
                       F.col("turn").alias("seq"), role.alias("role"),
                       F.col("text").alias("content"),
                       F.when(F.col("role") == "assistant", _SEARCHES).alias("retrievals"))


def conversations(spark, sf):
    first = messages(spark, sf).groupBy(F.col("conversation_id").alias("id")).agg(
        F.min_by("content", "seq").alias("first_content"), F.count("*").alias("n"))
    title = F.when(F.col("n") % 3 > 0, X.conversation_title(F.col("first_content")))
    hours = F.make_interval(hours=F.col("id").cast("int"))
    days = F.make_interval(days=F.col("n").cast("int"))
    return first.select("id", title.alias("title"),
                        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + hours).alias("created_at"),
                        (F.lit("2024-06-01 00:00:00").cast("timestamp_ntz") + days).alias("updated_at"))


def _shown(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name.split(".")[-1])


@query("conversation_listing", f"""WITH {_MESSAGES}
SELECT id,
  coalesce(title, 'Untitled chat') AS title,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM titled
ORDER BY titled.updated_at DESC, titled.created_at DESC, id DESC""")
def conversation_listing(spark, sf):
    """All sidebar entries, most recently active first: one range sort."""
    return chat.conversation_listing(conversations(spark, sf)).select(
        "id", chat.display_title(F.col("title")).alias("title"),
        _shown("updated_at"), _shown("created_at"))


@query("messages_in_order", f"""WITH {_MESSAGES} SELECT conversation_id, seq, role, content, retrievals FROM messages
ORDER BY conversation_id, seq""")
def messages_in_order(spark, sf):
    return chat.in_order(messages(spark, sf))


@query("one_conversation", f"""WITH {_MESSAGES} SELECT conversation_id, title, seq, role, content FROM titled
JOIN messages ON conversation_id = id WHERE id = '3'""")
def one_conversation(spark, sf):
    rows = chat.with_messages(conversations(spark, sf).where("id = '3'"),
                              messages(spark, sf).where("conversation_id = '3'").withColumn(
                                  "created_at", F.lit(None).cast("timestamp")))
    return rows.select("conversation_id", "title", "seq", "role", "content").orderBy("seq")


@query("drop_last_message", f"""WITH {_MESSAGES} SELECT conversation_id, seq, role FROM messages m
WHERE seq < (SELECT max(seq) FROM messages o WHERE o.conversation_id = m.conversation_id)""")
def drop_last_message(spark, sf):
    return chat.remove_last(messages(spark, sf)).select("conversation_id", "seq", "role")


@query("message_json", f"""WITH {_MESSAGES} SELECT conversation_id, seq, '{{"role":' || to_json(role)::VARCHAR || ',"content":' || to_json(content)::VARCHAR
  || CASE WHEN retrievals IS NULL THEN '' ELSE ',"retrievals":' || retrievals END || '}}' AS encoded, content AS decoded_content FROM messages""")
def message_json(spark, sf):
    rows = messages(spark, sf)
    encoded = rows.withColumn("encoded", chat.encode(
        F.col("role"), F.col("content"), F.col("retrievals")))
    return encoded.select("conversation_id", "seq", "encoded",
                          chat.decode(F.col("encoded"))["content"].alias("decoded_content"))


@query("message_violations", f"""WITH {_MESSAGES} SELECT 'message' AS rule, conversation_id || '#' || seq AS key FROM messages WHERE role = 'system'
UNION ALL SELECT DISTINCT 'conversation_missing', conversation_id FROM messages
WHERE conversation_id NOT IN (SELECT id FROM titled WHERE title IS NOT NULL)""")
def message_violations(spark, sf):
    """System roles are outside the contract; untitled parents are taken away here."""
    parents = conversations(spark, sf).where("title IS NOT NULL")
    return chat.message_violations(messages(spark, sf), parents).select("rule", "key")


_MEMORY = f"""{_MESSAGES}, memory AS (SELECT conversation_id, seq, role, CASE WHEN role = 'agent' AND length(content) > 400
  THEN content || '!' ELSE content END AS content, retrievals FROM messages
  UNION ALL SELECT conversation_id, max(seq) + 1, 'user', 'more', NULL FROM messages GROUP BY 1 HAVING max(seq) > 6),
pairs AS (SELECT coalesce(m.conversation_id, s.conversation_id) AS conversation_id,
  (m.role, m.content, m.retrievals) IS DISTINCT FROM (s.role, s.content, s.retrievals) AS odd
  FROM memory m FULL OUTER JOIN messages s ON m.conversation_id = s.conversation_id AND m.seq = s.seq),
changed AS (SELECT conversation_id FROM pairs GROUP BY 1 HAVING bool_or(odd))"""


def _memory(spark, sf):
    rows = messages(spark, sf)
    longer = (F.col("role") == "agent") & (F.length("content") > 400)
    edited = rows.withColumn("content", F.when(longer, F.concat("content", F.lit("!")))
                             .otherwise(F.col("content")))
    extra = rows.groupBy("conversation_id").agg(F.max("seq").alias("last")).where("last > 6")
    added = extra.select("conversation_id", F.lit(0).cast("long").alias("seq"),
                         F.lit("user").alias("role"), F.lit("more").alias("content"),
                         F.lit(None).cast("string").alias("retrievals"))
    return chat.append(edited, added)


@query("changed_conversations", f"WITH {_MEMORY} SELECT conversation_id FROM changed")
def changed_conversations(spark, sf):
    return chat.changed_conversations(messages(spark, sf), _memory(spark, sf))


@query("dumped_messages", f"""WITH {_MEMORY} SELECT conversation_id, seq, role, content FROM messages WHERE conversation_id NOT IN (SELECT * FROM changed)
UNION ALL SELECT conversation_id, seq, role, content FROM memory WHERE conversation_id IN (SELECT * FROM changed)""")
def dumped_messages(spark, sf):
    after = chat.dump(messages(spark, sf), _memory(spark, sf))
    return after.select("conversation_id", "seq", "role", "content")


@query("touched_conversations", f"""WITH {_MEMORY} SELECT id, title, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(CASE WHEN id IN (SELECT * FROM changed) THEN TIMESTAMP '2025-01-01 00:00:00' ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at FROM titled""")
def touched_conversations(spark, sf):
    changed = chat.changed_conversations(messages(spark, sf), _memory(spark, sf))
    moved = chat.touch(conversations(spark, sf), changed,
                       F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    return moved.select("id", "title", _shown("created_at"), _shown("updated_at"))


@query("user_prompts", f"""WITH {_MESSAGES} SELECT m.conversation_id, m.seq, CASE WHEN title IS NULL THEN content
  ELSE content || chr(10) || chr(10) || 'Context: ' || title END AS prompt FROM messages m JOIN titled ON id = conversation_id WHERE role = 'user'""")
def user_prompts(spark, sf):
    titles = conversations(spark, sf).select(F.col("id").alias("conversation_id"), "title")
    rows = messages(spark, sf).where("role = 'user'").join(titles, "conversation_id")
    return rows.select("conversation_id", "seq", chat.user_content(
        F.col("content"), F.col("title")).alias("prompt"))


@query("created_conversations", f"""WITH {_MESSAGES} SELECT id, title FROM titled WHERE id <> '5' AND title IS NOT NULL
UNION ALL SELECT id, 'renamed' FROM titled WHERE id = '5' AND title IS NOT NULL
UNION ALL SELECT id, NULL FROM titled WHERE title IS NULL""")
def created_conversations(spark, sf):
    """Insert-or-ignore of untitled conversations, then one rename."""
    every = conversations(spark, sf)
    stored = every.where("title IS NOT NULL")
    added = every.withColumn("title", F.lit(None).cast("string"))
    made = chat.create(stored, added)
    named = made.withColumn("title", F.when(F.col("title").isNotNull() & (F.col("id") == "5"),
                                            "renamed").otherwise(F.col("title")))
    return named.select("id", "title")


@query("passage_totals", f"""WITH {_MESSAGES}
SELECT conversation_id, coalesce(sum(CASE WHEN role = 'agent' THEN seq % 4 END), 0)::BIGINT AS passages
FROM messages GROUP BY conversation_id""")
def passage_totals(spark, sf):
    """Passages shown in each conversation; every reply of this store shows up to three."""
    shown = F.array_join(F.array_repeat(F.lit("{}"), (F.col("seq") % 4).cast("int")), ",")
    searches = F.concat(F.lit('[{"query":"q","passages":['), shown, F.lit("]}]"))
    rows = messages(spark, sf).withColumn("retrievals", F.when(F.col("role") == "agent", searches))
    return chat.passage_totals(rows)


@query("opened_conversation", f"""WITH {_MESSAGES}
SELECT 'store' AS side, conversation_id, seq, CASE WHEN conversation_id = '3' THEN upper(content) ELSE content END AS content FROM messages
UNION ALL SELECT 'memory', conversation_id, seq, content FROM messages WHERE conversation_id = '5'""")
def opened_conversation(spark, sf):
    """Conversation 5 is opened while an edited conversation 3 is left: it is stored first."""
    stored = messages(spark, sf)
    memory = stored.where("conversation_id = '3'").withColumn("content", F.upper("content"))
    store, held = chat.open_conversation(stored, memory, "5", "3")
    sides = [rows.select(F.lit(side).alias("side"), "conversation_id", "seq", "content")
             for side, rows in (("store", store), ("memory", held))]
    return sides[0].unionByName(sides[1])


_LATE = "2025-01-01 00:00:00"
_BUCKETS = 8  # units of rewriting, not of parallel work: large buckets are written by several tasks


def _store_of_turns(spark, sf):
    """A store to which all user turns came as one batch and the replies as a second, which was retried."""
    store = ConversationStore(spark, shared_folder(spark), _BUCKETS)
    rows = messages(spark, sf).withColumn("created_at", F.lit(None).cast("timestamp"))
    first = F.lit("2024-03-01 00:00:00")
    store.append(rows.where("role = 'user'"), "questions", first)
    for _ in range(2):
        store.append(rows.where("role <> 'user'"), "replies", first)
    return store


@query("stored_messages", f"""WITH {_MESSAGES},
asked AS (SELECT conversation_id, max(seq) + 1 AS next FROM messages WHERE role = 'user' GROUP BY 1),
placed AS (SELECT conversation_id, CASE WHEN role = 'user' THEN seq ELSE coalesce(next, 0) + seq END AS seq, role, content
  FROM messages LEFT JOIN asked USING (conversation_id)),
ended AS (SELECT conversation_id, max(seq) AS seq FROM placed WHERE conversation_id::BIGINT % 4 = 0 GROUP BY 1)
SELECT * FROM placed ANTI JOIN ended USING (conversation_id, seq)""")
def stored_messages(spark, sf):
    """Read back from storage: two appended batches, then one conversation in four loses its latest message, once."""
    store = _store_of_turns(spark, sf)
    ended = messages(spark, sf).where(F.col("conversation_id").cast("long") % 4 == 0)
    for _ in range(2):
        store.remove_last(ended, "undo", F.lit(_LATE))
    return store.messages().select("conversation_id", "seq", "role", "content")


@query("stored_conversations", f"""WITH {_MESSAGES},
edited AS (SELECT DISTINCT conversation_id FROM messages WHERE role = 'agent' AND length(content) > 400)
SELECT id, title, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(CASE WHEN id IN (FROM edited)
  THEN greatest(updated_at, TIMESTAMP '{_LATE}') ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at FROM titled""")
def stored_conversations(spark, sf):
    """Parents on storage: created twice, then dumped memory moves those that it changed, once."""
    store = ConversationStore(spark, shared_folder(spark), _BUCKETS)
    parents = conversations(spark, sf).withColumns({n: F.col(n).cast("timestamp") for n in ("created_at", "updated_at")})
    rows = messages(spark, sf).withColumn("created_at", F.lit(None).cast("timestamp"))
    longer = (F.col("role") == "agent") & (F.length("content") > 400)
    store.create(parents)
    store.append(rows, "all", F.lit("2024-01-01 00:00:00"))
    store.create(parents.withColumn("title", F.lit("ignored")))
    memory = rows.withColumn("content", F.when(longer, F.concat("content", F.lit("!"))).otherwise(F.col("content")))
    for _ in range(2):
        store.dump(memory, "edits", F.lit(_LATE))
    return store.conversations().select("id", "title", _shown("created_at"), _shown("updated_at"))
