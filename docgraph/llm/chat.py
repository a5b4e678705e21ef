"""Chat formatting: prefix-target expansion. DataFrame operations only.

A turn is written `<|im_start|>role\\ntext<|im_end|>\\n`. Inside a text every `<`, backslashes, `|` gets one more
backslash, so that no text holds `<|`; taking one backslash out again restores it. In a role, backslash and line
feed are escaped as well, so that the first line feed of a turn ends its role.

Every assistant turn becomes an example: all turns before it as context, its own text as the only trainable span.
An example is a prefix of the conversation's formatted text, so a conversation is formatted once and its examples
are spans over it, found from running sums; `examples` writes them out one per row. Turns after the last assistant turn are kept as one more
example without a trainable span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\", -1), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(parts, "\\"))


def pack(turns: DataFrame, train_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, examples: array of (example, start, chars, end, loss), counted in code points from 0.

    Input: conv_id, turn, role, text; other columns are ignored. Null role or text: empty. Turns stand in the order
    (turn, role, text), null turns first, so ties and repeated rows have one result; each row counts as a turn.
    Rows whose conv_id is null form one conversation. An empty table gives no rows. A conversation is gathered in
    one row, because its text, and a digest of it, is one value.
    """
    text = F.coalesce("text", F.lit(""))
    order = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    head, body = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n")), escape(text)
    own = turns.select("conv_id", order.alias("t"), head.alias("head"), body.alias("body"), F.coalesce(F.col("role") == train_role, F.lit(False)).alias("loss"))
    so_far = Window.partitionBy("conv_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    chars = F.length("body").cast("long")
    placed = own.withColumns({"k": F.count("*").over(so_far), "end": F.sum(F.length("head") + chars + len(END)).over(so_far), "nth": F.sum(F.col("loss").cast("int")).over(so_far)})
    span = F.struct((F.col("nth") - 1).cast("int").alias("example"), (F.col("end") - len(END) - chars).alias("start"), chars.alias("chars"), F.col("end"), F.col("loss"))
    written = F.struct("k", F.concat("head", "body", F.lit(END)).alias("written"))
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(written)).alias("w"), F.sort_array(F.collect_list(F.when(F.col("loss"), span))).alias("spans"))
    grouped = grouped.select("conv_id", F.array_join(F.transform("w", lambda x: x["written"]), "").alias("formatted"), "spans")
    whole = F.length("formatted").cast("long")
    tail = F.struct(F.size("spans").alias("example"), whole.alias("start"), F.lit(0).cast("long").alias("chars"), whole.alias("end"), F.lit(False).alias("loss"))
    covered = F.coalesce(F.try_element_at("spans", F.lit(-1))["end"], F.lit(0)) == whole
    return grouped.select("conv_id", "formatted", F.when(covered, F.col("spans")).otherwise(F.concat("spans", F.array(tail))).alias("examples"))


def examples(packed: DataFrame) -> DataFrame:
    """One row per example, its text written out: conv_id, example, formatted, loss_start, loss_chars, loss, last (whether
    it is the conversation's last example, which holds all turns)."""
    rows = packed.select("conv_id", "formatted", F.size("examples").alias("n"), F.explode("examples").alias("e"))
    return rows.select("conv_id", F.col("e.example").alias("example"), F.substring("formatted", F.lit(1), F.col("e.end").cast("int")).alias("formatted"), F.col("e.start").alias("loss_start"), F.col("e.chars").alias("loss_chars"), F.col("e.loss").alias("loss"), (F.col("e.example") == F.col("n") - 1).alias("last"))


def read_turns(formatted: Column) -> Column:
    """array of (role, text), parsed from a formatted text."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1).substr(F.lit(len(START) + 1), F.length(p))).alias("role"),
            unescape(p.substr(F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text"),
        ),
    )


def digests(written: DataFrame) -> DataFrame:
    """Per conversation, read back from its written examples: the turns from the last one's text, each target from the
    text of its own example, and the characters of all of them."""
    turns = read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    target = unescape(F.substring("formatted", F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    rows = written.select("conv_id", F.struct("example", F.when(F.col("loss"), target).otherwise(F.lit("")).alias("target")).alias("e"), F.length("formatted").cast("long").alias("chars"), F.when(F.col("last"), turns).alias("turns"))
    rows = rows.select("conv_id", "e", "chars", F.when(F.col("turns").isNotNull(), F.struct(F.size("turns").cast("long").alias("n"), F.sha2(said, 256).alias("sha"))).alias("all"))
    got = rows.groupBy("conv_id").agg(F.max("all").alias("all"), F.sort_array(F.collect_list("e")).alias("e"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("e", lambda x: x["target"]), "")
    return got.select("conv_id", F.col("all.n").alias("n_turns"), F.col("all.sha").alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", F.size("e").cast("long").alias("n_examples"))


def with_control(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts are control strings."""
    control = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(control)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(examples(pack(with_control(spark, table(spark, sf_dir, "conversations")))))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
f AS (SELECT *, row_number() OVER w AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back,
        sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1) OVER w AS upto
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR back = 1) AS n_examples
FROM f GROUP BY conv_id
"""
