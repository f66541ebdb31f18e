"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and only its reply trainable. Turns
after the last assistant turn, which no example needs, form one more row with nothing trainable (kind "rest"). A turn is
written `<|im_start|>role LF text<|im_end|> LF`; inside a text, a backslash is doubled and `<|` becomes `<\\|`, so no text can
hold a control string, and unescaping gives the text again. A role is written in percent encoding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Examples (conv_id, example, kind, text, loss_start, loss_end) of turns (conv_id, turn, role, text).

    loss_start and loss_end delimit the trainable reply in text, in code points, end exclusive; it stands escaped there.
    Turns are ordered by turn, then role and text, nulls first; a null role or text is empty; rows with a null conv_id form one
    conversation. An empty table gives no examples. Other columns are not read. The one shuffle groups by conv_id; the
    length of an example grows with its turn, as the method has it.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), F.concat(F.lit(START), F.url_encode(role), F.lit("\n")).alias("head"), escaped(text).alias("body"))
    shown = lambda x: F.concat(x["head"], x["body"], F.lit(END))
    return (
        turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .withColumn("targets", F.filter(F.transform("turns", lambda x, k: F.when(x["role"] == "assistant", k)), lambda k: k.isNotNull()))
        .withColumn("last", F.coalesce(F.array_max("targets"), F.lit(-1)))
        # One example to each target; -1 stands for the rest of the turns.
        .withColumn("target", F.explode(F.when(F.col("last") + 1 < F.size("turns"), F.concat("targets", F.array(F.lit(-1)))).otherwise(F.col("targets"))))
        .withColumn("rest", F.col("target") < 0)
        .withColumn("context", F.array_join(F.transform(F.when(F.col("rest"), F.slice("turns", F.col("last") + 2, F.size("turns"))).otherwise(F.slice("turns", F.lit(1), F.greatest("target", F.lit(0)))), shown), ""))
        .withColumn("reply", F.get("turns", F.greatest("target", F.lit(0))))
        .withColumn("before", F.when(F.col("rest"), F.col("context")).otherwise(F.concat("context", F.col("reply.head"))))
        .withColumn("loss_start", F.length("before").cast("long"))
        .select(
            "conv_id", F.when(F.col("rest"), F.col("last") + 1).otherwise(F.col("target")).cast("long").alias("example"), F.when(F.col("rest"), "rest").otherwise("reply").alias("kind"),
            F.when(F.col("rest"), F.col("before")).otherwise(F.concat("before", "reply.body", F.lit(END))).alias("text"),
            "loss_start", (F.col("loss_start") + F.when(F.col("rest"), F.lit(0)).otherwise(F.length("reply.body"))).alias("loss_end"),
        )
    )


def turns_of(text: Column) -> Column:
    """The turns (role, text), unescaped, that a formatted text says."""
    parts = F.transform(F.filter(F.split(text, F.lit(r"<\|im_end\|>\n")), lambda x: x != ""), lambda x: F.substring(x, len(START) + 1, 1 << 30))
    return F.transform(parts, lambda x: F.struct(F.url_decode(F.substring_index(x, "\n", 1)).alias("role"), unescaped(x.substr(F.locate("\n", x) + 1, F.length(x))).alias("text")))


def read_turns(examples: DataFrame) -> DataFrame:
    """Examples with what their text says: turns (role, text), unescaped, and the trainable text, unescaped. No examples give no rows."""
    trained = unescaped(F.col("text").substr((F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))
    return examples.withColumn("turns", turns_of(F.col("text"))).withColumn("trained", trained)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """For each conversation, from its examples' texts: the last reply's example holds all turns up to it, the rest follow.

    Of the other examples only the trainable text and the length are kept, so a conversation's row grows with its turns alone. A null
    conv_id is one conversation; no examples give no rows.
    """
    reply = F.col("kind") != "rest"
    grouped = (
        read_turns(examples).drop("turns").groupBy("conv_id").agg(
            F.max_by(F.when(reply, F.col("text")), F.when(reply, F.col("example"))).alias("upto"), F.max_by(F.when(~reply, F.col("text")), F.when(~reply, F.col("example"))).alias("after"),
            F.array_sort(F.collect_list(F.when(reply, F.struct("example", "trained")))).alias("replies"), F.sum(F.length("text")).cast("long").alias("formatted_chars"),
        )
        .withColumn("whole", turns_of(F.concat(F.coalesce("upto", F.lit("")), F.coalesce("after", F.lit("")))))
        .withColumn("trained", F.array_join(F.transform("replies", lambda x: x["trained"]), ""))
    )
    said = F.array_join(F.transform("whole", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return grouped.select(
        "conv_id", F.size("whole").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained"), 256).alias("loss_sha256"), "formatted_chars",
    )
