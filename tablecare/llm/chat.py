"""Chat formatting: turns with typed content parts become one training text per conversation, in DataFrame functions.

A turn is ``<|turn|>role<|text|>content<|end|>``. Content parts are visited in order: text is escaped, an image, audio or document part
becomes a placeholder such as ``<|image|>`` and is recorded with its reference, its place and the number of tokens it expands to.
Texts and roles are escaped: backslashes are doubled and a backslash follows every letter that opens a control string, so no control
string can stand in them and every text can be read back. The loss mask is a list of pieces that together are the formatted text; those of the trained roles are marked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

PART_TOKENS = {"image": 256, "audio": 25, "document": 512}
"""Tokens that a unit of a part expands to: an image tile, a second of sound, a page."""

OPENERS = "<["
"""Every control string, and those of other common templates (``<s>``, ``[INST]``), starts with one of these letters."""

PARTS = "array<struct<kind string, text string, ref string, units int>>"
"""The type of a content column; ``kind`` is text, image, audio or document. Another kind counts as text."""


def escape(text: Column) -> Column:
    """The text without control strings, also where texts are joined; ``unescape`` gives it back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c + "\\")), OPENERS, doubled)


def unescape(text: Column) -> Column:
    """The text that was escaped."""
    opened = reduce(lambda t, c: F.replace(t, F.lit(c + "\\"), F.lit(c)), OPENERS, text)
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def _one_of(kind: Column, visits: dict[str, Column], otherwise: Column) -> Column:
    return reduce(lambda rest, k: F.when(kind == k, visits[k]).otherwise(rest), visits, otherwise)


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, pieces, attachments, attachment_tokens.

    ``content`` is a string or of type :data:`PARTS`. ``pieces`` (array of struct(text, loss)) joins to ``formatted``; only the contents of
    trained roles are under the loss. ``attachments`` lists (turn_at, part, kind, ref, tokens) in order of appearance.
    Turns follow ``turn`` (nulls first), equal ones by role and content; repeated rows are repeated turns. A null text or role is
    empty, a null list has no parts, a null or negative number of units is one. Rows of a null conversation id form one conversation. A
    conversation is one text, so the rows of one conversation meet in one task; its turns are rendered before that.
    """
    kinds = dict(turns.dtypes)
    as_parts = F.array(F.struct(F.lit("text").alias("kind"), turns[content].alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))
    parts = F.coalesce(turns[content] if kinds[content].startswith("array") else as_parts, F.array().cast(PARTS)).cast(PARTS)
    rows = turns.select(turns[conv_id].alias("conv_id"), turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), parts.alias("parts"))

    show = lambda p: _one_of(p["kind"], {k: F.lit(f"<|{k}|>") for k in PART_TOKENS}, escape(F.coalesce(p["text"], F.lit(""))))
    units = lambda p: F.when(p["units"] >= 0, p["units"]).otherwise(F.lit(1))
    size = lambda p: (units(p).cast("long") * _one_of(p["kind"], {k: F.lit(n) for k, n in PART_TOKENS.items()}, F.lit(0)))
    attached = F.filter(F.transform("parts", lambda p, i: F.struct(i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), size(p).alias("tokens"))), lambda a: a["kind"].isin(list(PART_TOKENS)))
    rows = rows.select(
        "conv_id",
        F.struct(
            "turn",
            F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
            F.array_join(F.transform("parts", show), "").alias("body"),
            F.col("role").isin(list(trained)).alias("loss"),
            attached.alias("attached"),
        ).alias("turn"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    piece = lambda t: F.array(F.struct(t["head"].alias("text"), F.lit(False).alias("loss")), F.struct(t["body"].alias("text"), t["loss"].alias("loss")), F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    about = lambda t, i: F.transform(t["attached"], lambda a: F.struct(i.alias("turn_at"), a["part"], a["kind"], a["ref"], a["tokens"]))
    whole = whole.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.flatten(F.transform("turns", piece)).alias("pieces"), F.flatten(F.transform("turns", about)).alias("attachments"))
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return whole.select("conv_id", "n_turns", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces", "attachments", total.alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn of a formatted conversation, unescaped; placeholders stay as they are."""
    turns = F.filter(F.split(formatted, "\\Q" + TURN + "\\E"), lambda t: t != "")
    fields = F.transform(turns, lambda t: F.split(F.replace(t, F.lit(END), F.lit("")), "\\Q" + TEXT + "\\E"))
    return F.transform(fields, lambda f: F.struct(unescape(f[0]).alias("role"), unescape(f[1]).alias("text")))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
