"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: the conversation up to and including
that turn, of which only that reply is trainable.  Turns after the last reply
(or a conversation without one) make one more example without a trainable part,
so the output holds every turn.

Template: ``<s>`` role ``[INST]`` text ``[/INST]</s>`` for other roles, and
``<s>`` role ``[/INST]`` text ``</s>`` for the assistant.  Control strings inside
roles and texts are escaped: every backslash is doubled, and a backslash goes
behind the first character of a control string, so none is left; dropping each
backslash that introduces another character gives the text back.

Expanding prefixes takes the sum of all prefixes' lengths by its nature; an
example, like any row, has to fit into memory.

Defined results: rows are ordered by (turn, role, text), null turns first; null
texts and roles are empty; repeated rows are turns of their own; a row without
a conv_id is a conversation of its own, named in ``lone`` by the hash of its
content and the number of the copy (the same at every run); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The control strings of the template.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = r"(<)(s>|/s>|<SYS>>|</SYS>>)|(\[)(INST\]|/INST\])"
ASSISTANT = "assistant"
#: Copies of one row without a conv_id that are numbered in one array.
COPIES = 65_536


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted_turn(role: Column, text: Column) -> Column:
    other = F.concat(F.lit(BEGIN), escaped(role), F.lit(OPEN), escaped(text), F.lit(CLOSE + END))
    reply = F.concat(F.lit(BEGIN), escaped(role), F.lit(CLOSE), escaped(text), F.lit(END))
    return F.when(role == ASSISTANT, reply).otherwise(other)


def lone_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, lone, turns) of (conv_id, turn, role, text) without a conv_id: a
    conversation of one turn for each row.  Equal rows are counted, not gathered."""
    content = F.concat_ws("\n", F.coalesce(F.col("turn").cast("string"), F.lit("")), F.length("role").cast("string"), F.concat("role", "text"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("first"))
    copies = blocks.select("*", F.explode(F.sequence("first", F.least(F.col("first") + COPIES, "n") - 1)).alias("copy"))
    lone = F.concat_ws("-", F.sha2(content, 256), F.col("copy").cast("string"))
    return copies.select("conv_id", lone.alias("lone"), F.array(F.struct("turn", "role", "text")).alias("turns"))


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, lone, example, formatted, loss_start, loss_length): offsets in
    code points, loss_length 0 where nothing is trainable.  (conv_id, lone) is the
    conversation; lone is null where there is a conv_id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turns = rows.filter("conv_id is not null").select("conv_id", F.struct("turn", "role", "text").alias("t"))
    named = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    named = named.select("conv_id", F.lit(None).cast("string").alias("lone"), "turns")
    whole = named.unionByName(lone_turns(rows.filter("conv_id is null")))
    pieces = F.transform("turns", lambda t: F.struct(formatted_turn(t["role"], t["text"]).alias("s"), (t["role"] == ASSISTANT).alias("reply"), F.length(escaped(t["text"])).alias("n")))
    whole = whole.select("conv_id", "lone", pieces.alias("pieces"))
    last = F.size("pieces")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("pieces", i)["reply"] | (i == last))
    each = whole.select("conv_id", "lone", "pieces", F.posexplode(ends).alias("example", "end"))
    target = F.element_at("pieces", F.col("end"))
    text = F.array_join(F.transform(F.slice("pieces", F.lit(1), F.col("end")), lambda p: p["s"]), "")
    loss = F.when(target["reply"], target["n"]).otherwise(0)
    rows = each.select("conv_id", "lone", "example", text.alias("formatted"), loss.cast("long").alias("loss_length"))
    return rows.select("conv_id", "lone", "example", "formatted", (F.length("formatted") - len(END) - F.col("loss_length")).cast("long").alias("loss_start"), "loss_length")


def parsed_turns(formatted: Column) -> Column:
    """Array of (role, text) of a formatted example."""

    def turn(s: Column) -> Column:
        body = F.substr(s, F.lit(len(BEGIN) + 1))
        other = F.contains(body, F.lit(OPEN))
        role = F.when(other, F.substring_index(body, OPEN, 1)).otherwise(F.substring_index(body, CLOSE, 1))
        text = F.substr(body, F.length(role) + F.when(other, len(OPEN)).otherwise(len(CLOSE)) + 1)
        text = F.when(other, F.substr(text, F.lit(1), F.length(text) - len(CLOSE))).otherwise(text)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    pieces = F.split(formatted, END)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def trainable(formatted: Column, start: Column, length: Column) -> Column:
    return unescaped(F.substr(formatted, (start + 1).cast("int"), length.cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    of every conversation, from its formatted examples; a row for each one without
    a conv_id."""
    nth = Window.partitionBy("conv_id", "lone")
    rows = examples.withColumn("last", F.max("example").over(nth) == F.col("example"))
    turns = parsed_turns(F.col("formatted"))
    all_turns = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = rows.select(
        "conv_id",
        "lone",
        F.length("formatted").cast("long").alias("chars"),
        F.struct("example", trainable(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("text")).alias("loss"),
        F.when(F.col("last"), F.size(turns)).cast("long").alias("n_turns"),
        F.when(F.col("last"), F.sha2(all_turns, 256)).alias("turns_sha256"),
    )
    loss = F.array_join(F.transform(F.array_sort(F.collect_list("loss")), lambda x: x["text"]), "")
    out = rows.groupBy("conv_id", "lone").agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
