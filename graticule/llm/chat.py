"""Chat examples: every assistant turn with all turns before it, only that reply trainable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import table

START, END = "<|turn|>", "<|end|>"


def escaped(text: Column) -> Column:
    """The text without ``<|``, reversibly: ``&`` and ``<|`` become ``&amp;`` and ``&lt;|``."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def prefix_examples(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", reply: str = "assistant"
) -> DataFrame:
    """One example per reply: conv_id, example (0, 1, ...), trainable, formatted, loss_start, loss_end.

    A turn is written ``<|turn|>role\\ntext<|end|>\\n`` with role and text escaped, so
    the marks stand nowhere else and reading back is exact. An example holds all turns up
    to its reply; the mask is the code points loss_start (inclusive) to loss_end (exclusive)
    of ``formatted``: the escaped reply, nothing else. Turns after the last reply (or a
    conversation without one) make one more example that is not trainable: mask empty.

    Turns are ordered by turn, then role and text (nulls first, repeated rows stay). A null
    role or text counts as empty; a null conv_id is a conversation of its own; an empty
    reply has an empty mask but is trainable; an empty table gives no rows; other columns
    are not read. A conversation's turns meet in one row, as every example of it needs them.
    """
    shown = F.concat(F.lit(START), escaped_role(F.col(role)), F.lit("\n"))
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
            shown.alias("head"), escaped(F.col(text)).alias("body"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    whole = whole.select(
        "conv_id",
        F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))).alias("shown"),
        F.transform("ts", lambda t: t["role"] == F.lit(reply)).alias("is_reply"),
        F.transform("ts", lambda t: F.length(t["body"])).alias("lengths"),
    )
    last = F.size("shown") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("is_reply", i) | (i == last))
    cut = whole.select("*", F.posexplode(ends).alias("example", "at"))
    trainable = F.get("is_reply", F.col("at"))
    formatted = F.array_join(F.slice("shown", F.lit(1), F.col("at") + 1), "")
    examples = cut.select("conv_id", "example", trainable.alias("trainable"), formatted.alias("formatted"), F.get("lengths", F.col("at")).alias("_body"))
    end = F.length("formatted") - F.lit(len(END) + 1)
    return examples.select(
        "conv_id", "example", "trainable", "formatted",
        F.when(F.col("trainable"), end - F.col("_body")).otherwise(F.length("formatted")).alias("loss_start"),
        F.when(F.col("trainable"), end).otherwise(F.length("formatted")).alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say: the turns of the longest one and all masked text in order."""
    masked = unescaped(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    parts = examples.select("conv_id", "example", "formatted", F.when(F.col("trainable"), masked).otherwise("").alias("masked"))
    whole = parts.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "masked"))), lambda x: x["masked"]), "").alias("loss"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    pieces = F.slice(F.split("formatted", "<\\|end\\|>\n"), F.lit(1), F.size(F.split("formatted", "<\\|end\\|>\n")) - 1)
    plain = F.transform(
        pieces,
        lambda p: F.concat(
            unescaped_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)),
            F.lit("\n"),
            unescaped(F.substr(p, F.instr(p, "\n") + 1)),
            F.lit("\n"),
        ),
    )
    return whole.select(
        "conv_id",
        F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(F.array_join(plain, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def query(spark, sf_dir):
    """All conversations and one whose texts look like another template's marks."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    return read_back(prefix_examples(given.unionByName(odd)))


SQL = """
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place, count(*) OVER (PARTITION BY conv_id) AS n,
         length('<|turn|>' || replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;') || chr(10)
                || replace(replace(text, '&', '&amp;'), '<|', '&lt;|') || '<|end|>' || chr(10)) AS chars
  FROM given),
sums AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM shown)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (role = 'assistant' OR place = n), 0)::BIGINT AS formatted_chars
FROM sums GROUP BY conv_id
"""
