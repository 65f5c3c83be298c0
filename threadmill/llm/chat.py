"""Chat formatting by quotation linking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .frames import text_of, written

#: Marks of quotation at the start of a line.
QUOTED = r"^[ \t]*>[ \t>]*"
#: A line that introduces a quotation.
INTRO = r"(?i)^[ \t]*(on .{3,120} wrote|le .{3,120} a écrit|am .{3,120} schrieb .{0,80}|el .{3,120} escribió|.{1,80} (wrote|writes|said)) ?:[ \t]*$"


def normal(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def lines_of(text: Column) -> Column:
    return F.split(text, r"\r\n|\n|\r")


def own_text(text: Column) -> Column:
    """A message without its quoted lines and the lines that introduce them, trimmed."""
    lines = lines_of(text)
    with_next = F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.coalesce(F.get(lines, i + 1), F.lit("")).alias("n")))
    kept = F.filter(with_next, lambda s: ~s["x"].rlike(QUOTED) & ~(s["x"].rlike(INTRO) & s["n"].rlike(QUOTED)))
    quoted = F.exists(lines, lambda x: x.rlike(QUOTED))
    return F.when(quoted, F.trim(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))).otherwise(text)


def passages(messages: DataFrame) -> DataFrame:
    """Quoted passages of messages(message, conv, turn, text): message, conv, turn, level, passage (number), line (number), body.

    A passage is a run of neighbouring lines of one quote level; lines that only hold marks don't end one.
    """
    quoted = messages.where(F.exists(lines_of(F.col("text")), lambda x: x.rlike(QUOTED)))
    lines = quoted.select("message", "conv", "turn", F.posexplode(lines_of(F.col("text"))).alias("line", "raw"))
    marks = F.regexp_extract("raw", QUOTED, 0)
    parsed = lines.select(
        "message", "conv", "turn", "line", F.length(F.regexp_replace(marks, r"[^>]", "")).alias("level"), normal(F.regexp_replace("raw", QUOTED, "")).alias("body")
    ).where((F.col("level") == 0) | (F.col("body") != ""))
    along = Window.partitionBy("message").orderBy("line")
    change = (F.col("level") != F.lag("level", 1, 0).over(along)).cast("int")
    return parsed.withColumn("change", change).withColumn("passage", F.sum("change").over(along)).where("level > 0").drop("change")


def link_quotes(messages: DataFrame) -> DataFrame:
    """The original of each quoting message(message, conv, turn, own, text): message, parent, levels, linked.

    Digests of whole normalised passages and of their lines, however short, are joined to the digests of the messages' own whole texts and lines.
    The original of a hash is the earliest message of the conversation that has it (found by partial minima, so a line that everyone writes is one
    row before it is joined). A message's parent is the original that has most of its passages' characters, first those of the outermost quote level, then the
    earlier one; it must come before the message.
    """
    whole = messages.select("conv", "turn", normal(F.col("own")).alias("body"))
    single = messages.select("conv", "turn", F.explode(lines_of(F.col("own"))).alias("x")).select("conv", "turn", normal(F.col("x")).alias("body"))
    originals = (
        whole.where("body != ''")
        .unionByName(single.where("body != ''"))
        .groupBy("conv", F.sha2("body", 256).alias("hash"), F.length("body").alias("size"))
        .agg(F.min("turn").alias("original"))
    )
    lines = passages(messages)
    joined = (
        lines.groupBy("message", "conv", "turn", "level", "passage")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "body"))), lambda s: s["body"]), " ").alias("body"))
        .drop("passage")
    )
    units = (
        joined.unionByName(lines.drop("passage", "line"))
        .select("message", "conv", "turn", "level", F.sha2("body", 256).alias("hash"), F.length("body").alias("size"))
    )
    found = units.join(originals, ["conv", "hash", "size"]).where("original < turn")
    best = (
        found.groupBy("message", "level", "original")
        .agg(F.sum("size").alias("held"))
        .groupBy("message")
        .agg(F.max(F.struct(-F.col("level"), "held", -F.col("original"))).alias("best"), F.count(F.lit(1)).alias("linked"))
    )
    levels = units.groupBy("message").agg(F.max("level").alias("levels"))
    return levels.join(best, "message", "left").select("message", (-F.col("best.col3")).alias("parent"), "levels", F.coalesce("linked", F.lit(0)).alias("linked"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root, steps) of linked turns (conv, turn, parent): the turn that a chain of replies starts from.

    Every round looks at the ancestor's ancestor, so the rounds are the logarithm of the longest chain.
    """
    up = written(links.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).alias("steps")), "threads")
    while True:
        far = up.select("conv", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("steps").alias("more"))
        new = written(
            up.join(far, ["conv", "root"], "left").select(
                "conv", "turn", F.coalesce("next", "root").alias("root"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("next").isNotNull().alias("moved")
            ),
            "threads",
        )
        up = new.drop("moved")
        if new.where("moved").limit(1).count() == 0:
            return up


def reply_order(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations without quotations, in reply order: conv_id, thread, turn, reply_depth, parent_turn, role, body, quote_levels, linked_passages.

    Quote levels are parsed, quoted passages hashed and joined to the messages that wrote them, and quotes and the lines that introduce them are removed. A conversation's rows
    come by thread (the turn that a chain of replies starts from; a message that quotes no earlier one starts its own) and turn, so that each reply follows its original and
    threads stay together. The order is that of one range sort, so a very long conversation is split among tasks.

    A row per row of df. Conversations may have ids of any type that can be sorted; a turn that is no number counts as null. Null texts are empty. Rows with a null conversation form one conversation, and so on with turns: null turns come first and link to nothing. Rows that repeat a
    conversation and turn are messages of the same place; a quote of either links to that turn, and the parent is the earliest of those their quotes name. A very long message is parsed whole, in one row. Other columns
    of df aren't carried, so their names can't clash. An empty table gives an empty table.
    """
    base = df.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").try_cast("long").alias("turn"), F.col(f"`{role_col}`").alias("role"), text_of(text_col).alias("text")
    )
    named = base.withColumns({"own": own_text(F.col("text")), "message": F.sha2(F.to_json(F.struct("conv", "turn", "role", "text")), 256)})
    # Only conversations that hold a quotation have anything to link.
    quoting = named.where(F.exists(lines_of(F.col("text")), lambda x: x.rlike(QUOTED)) & F.col("conv").isNotNull() & F.col("turn").isNotNull())
    talks = written(quoting.select("conv").distinct(), "quoting")
    talk = named.join(talks, "conv", "left_semi").where("turn is not null").dropDuplicates(["message", "conv", "turn"])
    linked = written(link_quotes(talk), "links")
    places = (
        linked.where("parent is not null")
        .join(talk.select("message", "conv", "turn"), "message")
        .groupBy("conv", "turn")
        .agg(F.min("parent").alias("parent"))
    )
    places = written(places, "places")
    roots = threads(places).join(places, ["conv", "turn"])
    rows = named.join(roots, ["conv", "turn"], "left").join(linked.drop("parent"), "message", "left")
    return rows.select(
        F.col("conv").alias("conv_id"),
        F.coalesce("root", "turn").alias("thread"),
        "turn",
        F.coalesce("steps", F.lit(0)).alias("reply_depth"),
        F.col("parent").alias("parent_turn"),
        "role",
        F.col("own").alias("body"),
        F.coalesce("levels", F.lit(0)).alias("quote_levels"),
        F.coalesce("linked", F.lit(0)).cast("long").alias("linked_passages"),
    ).orderBy("conv_id", "thread", "turn")
