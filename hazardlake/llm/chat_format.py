"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation = turn*
    turn         = "### " role ": " text "\\n</turn>\\n"

A role is URL encoded, so it holds neither space nor colon. Text that contains "### " or "</turn>" may
conflict with the grammar; a backslash before each of them (after those already there) makes it
plain content, and the parser takes one away again. Every turn is rendered as it is, parsed, and
escaped only if the parsed turn differs from the source; the whole conversation is then parsed
once more and must equal its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake.llm.common import column

OPEN, COLON, CLOSE = "### ", ": ", "\n</turn>\n"
CONTROL = r"(\\*)(### |</turn>)"
CONTROL_ESCAPED = r"\\(\\*)(### |</turn>)"
TURN_END = r"(?<!\\)</turn>\n"
HEADER = "^### ([^ ]*): "
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_ESCAPED, "$1$2")


def rendered(role: Column, content: Column) -> Column:
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit(COLON), content, F.lit(CLOSE))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text, as structs of role, text and content (the text as it stands)."""
    segments = F.filter(F.split(formatted, TURN_END, -1), lambda s: s != "")

    def turn(segment: Column) -> Column:
        header = F.regexp_extract(segment, HEADER, 0)
        content = F.substring(segment, F.length(header) + 1, F.length(segment) - F.length(header) - 1)
        return F.struct(F.url_decode(F.regexp_extract(segment, HEADER, 1)).alias("role"),
                        unescaped(content).alias("text"), content.alias("content"))

    return F.transform(segments, turn)


def plain(turns: Column) -> Column:
    """Roles and texts alone, for comparison."""
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def formatted(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """One row per conversation: the formatted text, its turns and its loss mask.

    Turns stand in the order of ``turn`` (null first), ties in the order of role and text; repeated rows
    stay. Null roles and texts count as empty, a null conversation id names one conversation.
    ``turns`` is read back from ``formatted``; ``mask`` has the spans of assistant content in it as
    offsets in code points, ``loss_text`` what lies under them, unescaped. A conversation is one
    value by definition, so its rows meet in one row; only that row must fit in memory. A
    conversation that cannot be read back raises. An empty table gives no rows.
    """
    role, text = (F.coalesce(column(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(column(conv_col).alias("conv_id"), column(turn_col).alias("turn"),
                                role.alias("role"), text.alias("text"))
    raw = rendered(F.col("role"), F.col("text"))
    source = F.array(F.struct("role", "text"))
    # control strings are never left bare, even where the parser would cope
    fits = ~F.col("text").rlike("### |</turn>") & (plain(parsed(raw)) == source)
    turns = rows.withColumn("piece", F.when(fits, raw).otherwise(rendered(F.col("role"), escaped(F.col("text")))))
    grouped = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "piece"))).alias("source"))
    joined = grouped.select("conv_id", plain(F.col("source")).alias("source"),
                            F.array_join(F.transform("source", lambda t: t["piece"]), "").alias("formatted"))
    read = joined.withColumn("turns", parsed(F.col("formatted")))
    lost = F.raise_error(F.lit("a conversation differs from its source after parsing"))
    checked = read.withColumn("formatted", F.when(plain(F.col("turns")) == F.col("source"), F.col("formatted"))
                              .otherwise(lost.cast("string")))
    lengths = F.transform("turns", lambda t: F.struct(
        (t["role"] == TRAINED_ROLE).alias("trained"),
        (F.length(F.url_encode(t["role"])) + len(OPEN) + len(COLON)).alias("head"), F.length(t["content"]).alias("body")))
    # offsets as running sums: fold the turns once, keeping the end of the last one
    spans = F.aggregate(
        lengths, F.struct(F.lit(0).cast("bigint").alias("end"), F.expr(
            "CAST(array() AS array<struct<start:bigint,stop:bigint>>)").alias("spans")),
        lambda acc, t: F.struct(
            (acc["end"] + t["head"] + t["body"] + len(CLOSE)).alias("end"),
            F.when(t["trained"], F.array_append(acc["spans"], F.struct(
                (acc["end"] + t["head"]).alias("start"), (acc["end"] + t["head"] + t["body"]).alias("stop"))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    trained = F.filter("turns", lambda t: t["role"] == TRAINED_ROLE)
    return checked.select(
        "conv_id", "formatted", plain(F.col("turns")).alias("turns"), spans.alias("mask"),
        F.array_join(F.transform(trained, lambda t: unescaped(t["content"])), "").alias("loss_text"))


def digests(conversations: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from the formatted conversations."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted(conversations).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
