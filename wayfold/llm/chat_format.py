r"""Chat formatting by a grammar that is read back: conversations become one text each, with a loss mask.

    conversation := turn*
    turn         := "### " role ":\n" text "\n</turn>\n"

A role is written URL-encoded, so it holds neither ``:`` nor a line end. The control strings are ``### ``
and ``</turn>``. The parser is deterministic: a control string ends or begins a turn, unless a backslash
stands before it; then it is part of the text, without that one backslash. A text is first written as it
is. The turn is parsed again, and as long as it does not come back identical, the next kind of control
string in it is escaped, each occurrence by one backslash. After the last kind every text comes back: all its
control strings have one backslash more than the source, and the parser takes one from each. Most texts
hold none and are not changed.

Everything is DataFrame functions. Texts are escaped before the shuffle; a conversation is one row.

Defined cases: rows are ordered by turn (null first), then role, then text; equal rows are all kept. A null
text or role is as an empty one; rows without conv_id are one conversation, of null id; an empty table gives
no rows; other columns are not looked at. A conversation is one value, so its text must fit into a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "### ", "</turn>"
CONTROL = f"{OPEN}|{CLOSE}"
#: The role whose texts are learned.
LEARNED = "assistant"
#: One turn; the text ends at the first closing line, as those inside it are escaped.
TURN = rf"(?s){OPEN}([^:\n]*):\n(.*?)\n{CLOSE}\n"


def written(role: Column, text: Column) -> Column:
    """A turn by the grammar."""
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit(":\n"), text, F.lit(f"\n{CLOSE}\n"))


def escaped(text: Column, kind: str) -> Column:
    return F.regexp_replace(text, f"({kind})", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROL})", "$1")


def parsed_turn(turn: Column) -> Column:
    """{role, text} of a turn; the text is null if a control string stands in it that is not escaped."""
    text = F.regexp_extract(turn, TURN, 2)
    return F.struct(
        F.url_decode(F.regexp_extract(turn, TURN, 1)).alias("role"),
        F.when(~text.rlike(rf"(?<!\\)(?:{CONTROL})"), unescaped(text)).alias("text"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a conversation. What does not follow the grammar gives one turn of nulls."""
    turns = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    broken = F.array(F.struct(F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")))
    return F.when(F.array_join(turns, "") == formatted, F.transform(turns, parsed_turn)).otherwise(broken)


def identical(role: Column, text: Column, content: Column) -> Column:
    """Whether the turn written with ``content`` is read back as the source turn, and as that alone."""
    back = parsed(written(role, content))
    return F.coalesce((F.size(back) == 1) & (back[0]["role"] == role) & (back[0]["text"] == text), F.lit(False))


def safe(role: Column, text: Column) -> Column:
    """The text as it is written: escaped kind by kind until the turn comes back identical."""
    content = text
    for kind in (CLOSE, OPEN):
        content = F.when(identical(role, text, content), content).otherwise(escaped(content, kind))
    # Only a text with a control string can come back changed; the others skip the rounds.
    return F.when(text.rlike(CONTROL), content).otherwise(text)


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask, n_turns, round_trip). ``mask`` cuts ``formatted`` into runs of {chars, loss};
    the runs with ``loss`` are the learned texts as written, without header, closing line or line end.
    ``round_trip`` tells whether the whole conversation was read back identical; it always is."""
    filled = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    content = safe(F.col("role"), F.col("text"))
    rows = filled.withColumn("content", F.when(F.col("text").rlike(CONTROL), content))  # null: as the text
    turn = F.struct("turn", "role", "text", "content")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("rows"))
    body = F.transform("rows", lambda t: written(t["role"], F.coalesce(t["content"], t["text"])))
    whole = whole.select("conv_id", "rows", F.array_join(body, "").alias("formatted"))
    source = F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return whole.select(
        "conv_id", "formatted", mask_of(F.col("formatted")).alias("mask"), F.size("rows").cast("bigint").alias("n_turns"),
        (parsed(F.col("formatted")) == source).alias("round_trip"),
    )


def mask_of(formatted: Column) -> Column:
    """Run lengths in code points of what is learned and what is not, read from the formatted text."""

    def runs(turn: Column) -> Column:
        role, text = F.regexp_extract(turn, TURN, 1), F.char_length(F.regexp_extract(turn, TURN, 2))
        head = F.char_length(role) + F.lit(len(OPEN) + len(":\n"))
        run = lambda chars, loss: F.struct(chars.alias("chars"), loss.alias("loss"))
        learned = F.url_decode(role) == LEARNED
        tail = F.lit(len(CLOSE) + 2)
        return F.when(learned, F.array(run(head, F.lit(False)), run(text, F.lit(True)), run(tail, F.lit(False)))).otherwise(
            F.array(run(F.char_length(turn), F.lit(False)))
        )

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), runs))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, learned, formatted_chars) from (conv_id, formatted): the parsed turns {role, text} and the
    learned texts in order."""
    rows = formatted.select("conv_id", parsed(F.col("formatted")).alias("turns"), F.char_length("formatted").cast("bigint").alias("formatted_chars"))
    learned = F.transform(F.filter("turns", lambda t: t["role"] == LEARNED), lambda t: t["text"])
    return rows.select("conv_id", "turns", learned.alias("learned"), "formatted_chars")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what is read back from (conv_id, formatted)."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )
