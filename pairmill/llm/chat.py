"""Chat formatting: conversations with typed content parts as one training text, and back.

Everything is built-in column expressions. A message is an array of parts (kind, text, ref,
tokens). ``flatten_parts`` visits them: every kind but text becomes a placeholder in the same place, and its
reference is recorded; text is escaped as it stands joined, so a control string that begins in one part
and ends in another is escaped too. ``format_conversations`` puts the flattened turns
of a conversation together; ``read_back`` recovers roles, texts and the text under the loss mask
from the formatted text and the mask alone.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside texts and roles a ``<`` followed
by any backslashes and ``|`` gets one backslash more, so ``<|`` stands only in control strings and
taking one away restores the text. A line feed in a role is the control string ``<|n|>``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|n|>"
# Marks places while texts are joined; followed by t it stands for itself, by b and e for the
# beginning and end of a placeholder.
MARK = "\x01"
TEXT = "text"
# Tokens that one placeholder stands for in the model, where the part does not say.
EXPANDED = {"image": 256, "audio": 128, "document": 512}
PARTS = "array<struct<kind:string,text:string,ref:string,tokens:bigint>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """One text part; null is empty."""
    part = F.struct(
        F.lit(TEXT).alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("tokens"),
    )
    return F.array(part).cast(PARTS)


def flatten_parts(parts: Column, expanded: Mapping[str, int] = EXPANDED) -> Column:
    """Struct (content, attachments) of one message.

    ``content`` is the text with a placeholder ``<|kind|>`` for every other part, in order.
    ``attachments`` holds (part, kind, ref, tokens) of those, with the part's own token count or
    else the one ``expanded`` gives its kind (0 for a kind it lacks). Null parts, texts and kinds
    are empty text.
    """
    parts = F.coalesce(parts, F.array().cast(PARTS))
    default = F.lit(0).cast("bigint")

    def is_text(part):
        return F.coalesce(part["kind"], F.lit(TEXT)) == TEXT

    def shown(part):
        kind = F.regexp_replace(part["kind"], "[^A-Za-z0-9_]", "_")
        text = F.replace(F.coalesce(part["text"], F.lit("")), F.lit(MARK), F.lit(f"{MARK}t"))
        return F.when(is_text(part), text).otherwise(
            F.concat(F.lit(f"{MARK}b"), kind, F.lit(f"{MARK}e"))
        )

    def tokens(part):
        found = F.coalesce(part["tokens"], default)
        for kind, count in expanded.items():
            found = F.when(
                part["tokens"].isNull() & (part["kind"] == kind), F.lit(count).cast("bigint")
            ).otherwise(found)
        return found

    numbered = F.transform(parts, lambda part, i: F.struct(i.alias("part"), part.alias("of")))
    attached = F.filter(numbered, lambda x: ~is_text(x["of"]))
    attachments = F.transform(
        attached,
        lambda x: F.struct(
            x["part"].alias("part"), x["of"]["kind"].alias("kind"), x["of"]["ref"].alias("ref"),
            tokens(x["of"]).alias("tokens"),
        ),
    )
    content = escape(F.array_join(F.transform(parts, shown), ""))
    for marked, meant in (("b", "<|"), ("e", "|>"), ("t", MARK)):
        content = F.replace(content, F.lit(MARK + marked), F.lit(meant))
    return F.struct(content.alias("content"), attachments.alias("attachments"))


def format_conversations(
    messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",),
    expanded: Mapping[str, int] = EXPANDED, id_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", parts_column: str = "parts",
) -> DataFrame:
    """One row per conversation: (id, n_turns, formatted, loss_spans, attachments, expanded_tokens).

    ``loss_spans`` are (begin, length) in code points of ``formatted``: the content of every turn
    of a ``loss_roles`` role. ``attachments`` are (turn_no, part, kind, ref, tokens) in order and
    ``expanded_tokens`` is their sum.

    Turns go by turn number, nulls first; ties by role, then content. Repeated rows are turns of
    their own. A null role is empty; rows without a conversation id form one conversation. An
    empty table gives an empty table; other columns are not read. A conversation is one training
    text, so its rows meet in one row; nothing larger than a conversation does.
    """
    flat = messages.select(
        F.col(id_column).alias("_id"), F.col(turn_column).alias("_turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("_role"),
        flatten_parts(F.col(parts_column), expanded).alias("_flat"),
    )
    pieces = flat.select(
        "_id", "_turn", "_role", F.col("_flat.content").alias("_content"),
        F.col("_flat.attachments").alias("_attachments"),
        F.concat(F.lit(BEGIN), escape_role(F.col("_role")), F.lit("\n")).alias("_head"),
    )
    in_order = Window.partitionBy("_id").orderBy(
        F.col("_turn").asc_nulls_first(), "_role", "_content", F.to_json("_attachments")
    )
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("_head") + F.length("_content") + len(END)
    placed = pieces.select(
        "_id", "_role", "_content", "_attachments", "_head",
        F.row_number().over(in_order).alias("_no"),
        F.coalesce(F.sum(size).over(before), F.lit(0)).cast("bigint").alias("_begin"),
    )
    turn = F.struct(
        "_no", F.concat("_head", "_content", F.lit(END)).alias("piece"),
        F.col("_role").isin(*loss_roles).alias("learned"),
        (F.col("_begin") + F.length("_head")).alias("begin"),
        F.length("_content").cast("bigint").alias("length"), F.col("_attachments").alias("attached"),
    )
    whole = placed.groupBy("_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    spans = F.transform(
        F.filter("_turns", lambda t: t["learned"]),
        lambda t: F.struct(t["begin"].alias("begin"), t["length"].alias("length")),
    )
    attachments = F.flatten(
        F.transform(
            "_turns",
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct(
                    (t["_no"] - 1).alias("turn_no"), a["part"].alias("part"),
                    a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return whole.select(
        F.col("_id").alias(id_column), F.size("_turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"), attachments.alias("attachments"),
    ).withColumn(
        "expanded_tokens",
        F.aggregate(
            F.transform("attachments", lambda a: a["tokens"]), F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        ),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text), unescaped, and ``loss_text``, both read from the output.

    ``loss_text`` is all text under the mask: each masked answer once, in order.
    """
    literal = END.replace("|", r"\|")
    turns = F.filter(
        F.split(F.col("formatted"), literal), lambda piece: piece.startswith(BEGIN)
    )

    def parsed(piece):
        head = F.substring_index(piece, "\n", 1)
        role = F.substring(head, len(BEGIN) + 1, 1 << 30)
        text = F.substring(piece, F.length(head) + 2, F.lit(1 << 30))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    learned = F.transform(
        "loss_spans",
        lambda s: unescape(
            F.substring(F.col("formatted"), (s["begin"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return formatted.withColumns(
        {"turns": F.transform(turns, parsed), "loss_text": F.array_join(learned, "")}
    )


def format_digest(formatted: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """What training needs to check an output without holding its texts: counts and digests."""
    back = read_back(formatted)
    listed = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return back.select(
        id_column, F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
