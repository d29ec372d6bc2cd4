"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and only its
text trainable. A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles ``<|`` becomes
``&lt;|`` and ``&`` becomes ``&amp;`` (in roles a line break ``&nl;`` too), so no text can forge a mark and all can be read
back. A conversation that doesn't end with an assistant turn has a last row with nothing trainable, which
keeps the turns after the last reply.

An example holds its conversation up to its reply, so a row is as long as the conversation, and examples of
n turns hold on the order of n^2 turns: that is the format asked for. Rows come one at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def examples(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end) with spans in code points, an empty one where nothing is trained.

    Turns are ordered by number, null first, and where it repeats by role and text; all rows count as
    turns. Null texts and roles are empty. Turns of a null conversation are a conversation."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text")).alias("t"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    piece = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n"))
    number = F.sequence(F.lit(1), F.size("turns"))
    # an example for each assistant turn, and one for what follows the last
    wanted = F.filter(number, lambda i: (F.element_at("turns", i)["role"] == "assistant") | (i == F.size("turns")))
    made = held.select("conv_id", "turns", F.transform("turns", piece).alias("pieces"), F.posexplode(wanted).alias("example", "at"))
    last = F.element_at("turns", F.col("at"))
    made = made.select("conv_id", "example", F.array_join(F.slice("pieces", 1, F.col("at")), "").alias("formatted"), last["role"].alias("role"), F.char_length(escape(last["text"])).alias("n"))
    end = F.char_length("formatted") - len(END) - 1
    trained = F.col("role") == "assistant"
    return made.select("conv_id", "example", "formatted", F.when(trained, end - F.col("n")).otherwise(end).alias("loss_start"), end.alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, array<struct<role, text>>."""
    parts = F.slice(F.split(formatted, r"<\|im_end\|>\n", -1), 1, F.size(F.split(formatted, r"<\|im_end\|>\n", -1)) - 1)
    bare = lambda p: F.substring(p, len(START) + 1, 2**30)
    role = lambda p: F.substring_index(bare(p), "\n", 1)
    text = lambda p: F.substr(bare(p), F.char_length(role(p)) + 2)
    return F.transform(parts, lambda p: F.struct(unescape_role(role(p)).alias("role"), unescape(text(p)).alias("text")))


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example."""
    return unescape(F.substr(formatted, start + 1, end - start))


def op2_prefix_targets(spark, sf_dir):
    """Digests of what can be read back from the examples of all conversations."""
    turns = shared.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    turns = turns.unionByName(spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    read = examples(turns).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")))
    whole = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"),
    )
    back = whole.withColumn("turns", read_turns(F.col("last")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), digest(flat).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), digest(F.col("loss")).alias("loss_sha256"), "formatted_chars",
    )


QUERIES = {"op2_prefix_targets": op2_prefix_targets}
ORACLES = {
    "op2_prefix_targets": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), p AS (
  SELECT *, 24 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;')) + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS turns
  FROM t
), s AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM p
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = turns) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
}
