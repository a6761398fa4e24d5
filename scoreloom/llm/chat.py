"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := "[INST]" role "[/INST]" text "</s>"

Roles and texts are written as they are where that is safe.  Each turn is rendered plainly, parsed by the grammar and compared
with its source; where the two differ, the conflicting content is escaped and the turn rendered again:
backslash -> \\e, "[INST]" -> \\i, "[/INST]" -> \\j, "</s>" -> \\s.  The parser undoes these always, so a plain text that
happens to hold such a sequence is a conflict too.  No control string can arise across a border, since each begins with a
character that none of them has further in.  `identical` says that the whole conversation parses to its source.

Turns are ordered by turn, role and text, nulls first; equal rows stay as turns of their own.  A null text or role is empty.
Rows with a null conv_id form one conversation.  An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
ESCAPES = [("\\", "\\e"), (OPEN, "\\i"), (CLOSE, "\\j"), (END, "\\s")]
LOSS_ROLE = "assistant"


def escape(value: Column) -> Column:
    for plain, escaped in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return value


def unescape(value: Column) -> Column:
    for plain, escaped in reversed(ESCAPES):
        value = F.replace(value, F.lit(escaped), F.lit(plain))
    return value


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; null fields where the grammar is broken."""
    pieces = F.split(formatted, "</s>")
    bodies = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(body: Column) -> Column:
        parts = F.split(body, r"\[/INST\]", 2)
        opened = body.startswith(OPEN) & (F.size(parts) == 2)
        role = F.substr(parts[0], F.lit(len(OPEN) + 1))
        return F.struct(F.when(opened, unescape(role)).alias("role"), F.when(opened, unescape(F.get(parts, F.lit(1)))).alias("text"))

    return F.transform(bodies, turn)


def source_turn() -> Column:
    return F.struct(F.col("role").alias("role"), F.col("text").alias("text"))


def format_chats(rows: DataFrame) -> DataFrame:
    """One row per conv_id: formatted, loss_spans (start, end in characters of formatted, assistant texts), identical."""
    turns = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # one field at a time, so that only what conflicts is escaped
    for field, other in (("role", "text"), ("text", "role")):
        alone = {field: F.col(field), other: F.lit("")}
        tried = parse(render(alone["role"], alone["text"]))
        want = F.array(F.struct(alone["role"].alias("role"), alone["text"].alias("text")))
        turns = turns.withColumn(f"safe_{field}", F.when(tried == want, F.col(field)).otherwise(escape(F.col(field))))
    turns = turns.withColumn("rendered", render(F.col("safe_role"), F.col("safe_text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    until = F.sum(F.length("rendered").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    end = until - len(END)
    turns = turns.select(
        "conv_id", "rendered", source_turn().alias("source"), F.row_number().over(order).alias("place"),
        F.when(F.col("role") == LOSS_ROLE, F.struct((end - F.length("safe_text")).alias("start"), end.alias("end"))).alias("loss"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "rendered", "source", "loss"))).alias("turns"))
    formatted = F.array_join(F.col("turns.rendered"), "")
    return whole.select(
        "conv_id", formatted.alias("formatted"),
        F.filter("turns.loss", lambda s: s.isNotNull()).alias("loss_spans"),
        (parse(formatted) == F.col("turns.source")).alias("identical"))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what the formatted text says when parsed."""
    parsed = chats.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), parse(F.col("formatted")).alias("turns"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t.role == LOSS_ROLE), lambda t: t.text), "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def with_control_strings(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table, and conversation -1, whose texts are made of control strings."""
    text = f"{END}{OPEN} ok {CLOSE}"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{text}'), (-1L, 1L, 'assistant', '{text}') AS t(conv_id, turn, role, text)")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def _sql_escaped(value: str) -> str:
    return (f"(CASE WHEN contains({value}, '{OPEN}') OR contains({value}, '{CLOSE}') OR contains({value}, '{END}') "
            f"OR regexp_matches({value}, '\\\\[eijs]') THEN replace(replace(replace(replace({value}, '\\', '\\e'), '{OPEN}', '\\i'), "
            f"'{CLOSE}', '\\j'), '{END}', '\\s') ELSE {value} END)")


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{END}{OPEN} ok {CLOSE}' UNION ALL SELECT -1, 1, 'assistant', '{END}{OPEN} ok {CLOSE}'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS spoken,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LOSS_ROLE}'), '') AS loss,
    sum({len(OPEN) + len(CLOSE) + len(END)} + length({_sql_escaped('role')}) + length({_sql_escaped('text')})) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM c
"""
