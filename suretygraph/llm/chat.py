"""Chat conversations as training examples by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, its text alone is under the loss
mask. A conversation that doesn't end with an assistant turn also gives its whole text once without a mask, so that no turn
is lost. A turn is written as <|im_start|>role, line end, text, <|im_end|>, line end. In roles and texts <| becomes <\\|, and
<, n backslashes, | become n + 1 of them; so no control string is left, and taking one away gives the text back. A line end
in a role becomes <|nl|>.

Built-in functions only. An example holds its whole context, so one conversation has to fit a row anyway; conversations are
gathered once, and what is made of them stays in the same tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def expand(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Examples: ``conv_id``, ``example`` (from 1), ``formatted``, and the mask's ``loss_begin`` and ``loss_end`` in it.

    Turns are ordered by number, then role, then text, nulls first; repeated rows are turns of their own. A null text or
    role is empty. Rows with a null conversation are one conversation.
    """
    own = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = gathered.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == TARGET).alias("target"),
        F.transform("turns", lambda t: F.concat(F.lit(START), _role(t["role"]), F.lit("\n"))).alias("heads"),
        F.transform("turns", lambda t: escape(t["text"])).alias("texts"),
    ).withColumn("whole", F.zip_with("heads", "texts", lambda h, t: F.concat(h, t, F.lit(END + "\n"))))
    n = F.size("target")
    last = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("target", i - 1) | (i == n))
    return parts.select("*", F.posexplode(last).alias("number", "at")).select(
        "conv_id", (F.col("number") + 1).cast("long").alias("example"),
        F.array_join(F.slice("whole", 1, F.col("at")), "").alias("formatted"),
        F.get("target", F.col("at") - 1).alias("trains"), F.length(F.get("texts", F.col("at") - 1)).alias("size"),
    ).select(
        "conv_id", "example", "formatted",
        F.when(F.col("trains"), F.length("formatted") - len(END) - 1 - F.col("size")).otherwise(F.length("formatted")).alias("loss_begin"),
        F.when(F.col("trains"), F.length("formatted") - len(END) - 1).otherwise(F.length("formatted")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of an example's text."""
    written = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")

    def turn(x: Column) -> Column:
        head = F.instr(x, "\n")
        role = F.substring(x, F.lit(len(START) + 1), head - 1 - len(START))
        return F.struct(
            unescape(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"),
            unescape(F.substring(x, head + 1, F.length(x))).alias("text"),
        )

    return F.transform(written, turn)


def digests(examples: DataFrame) -> DataFrame:
    """What a reader gets back from the examples: for each conversation the number and digest of its turns, the size and
    digest of all text under the mask, and the size of all examples."""
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_begin") + 1, F.col("loss_end") - F.col("loss_begin")))
    longest = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("all"),
        F.array_sort(F.collect_list(F.struct("example", loss.alias("loss")))).alias("losses"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
    )
    read = longest.select(
        "conv_id", "formatted_chars", read_turns(F.col("all")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
