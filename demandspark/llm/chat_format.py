"""Chat formatting of conversations with typed parts, as DataFrame functions only.

A turn is a list of typed parts (kind, value): text, image, audio or document.
They are given as a column, or read from a text that holds media as
``![kind](reference)``. A visitor flattens the parts in order: text is escaped,
so that control strings inside it stay text; every other part becomes one
placeholder and is recorded as an attachment with the number of tokens that its
placeholder expands to. The output can be read back exactly, as parts or text.

A turn is written ``<|turn|>role<|text|>text<|end|>``. In roles and texts ``&``
and ``<`` are escaped, so ``<|`` only ever begins a mark. The loss mask is kept
with the output as its segments: formatted is their concatenation, and the text
under the mask is that of the segments with loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens that a placeholder of each kind expands to.
PART_TOKENS = {"image": 576, "audio": 750, "document": 1024}
# The marks, and a part before and after flattening.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART = "!\\[(image|audio|document)\\]\\(([^()\\s]*)\\)"
PARTS = "array<struct<kind:string,value:string>>"
FLAT = "<\\|(image|audio|document)\\|>([^<]*)<\\|part\\|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _typed(text: Column, media: str) -> Column:
    """The parts of a text whose media parts match ``media`` (kind, value), in order; empty texts are left out."""
    def part(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), value.alias("value"))

    texts = F.split(text, media, -1)          # one more than there are media parts
    found = F.zip_with(F.regexp_extract_all(text, F.lit(media), 1), F.regexp_extract_all(text, F.lit(media), 2), part)
    mixed = F.flatten(F.zip_with(texts, found, lambda t, m: F.array(part(F.lit("text"), t), m)))
    return F.filter(mixed, lambda p: (p["kind"] != "text") | (p["value"] != "")).cast(PARTS)


def parse_parts(text: Column) -> Column:
    """array<struct<kind, value>>: the typed parts of a text with media as ``![kind](reference)``."""
    return _typed(text, PART)


def clean_parts(parts: Column) -> Column:
    """Given parts as they are formatted: a null list is empty, a null part or value is an empty
    text or reference, and a part of any kind but the known ones is text."""
    known = list(PART_TOKENS)
    return F.transform(F.coalesce(parts, F.array().cast(PARTS)), lambda p: F.struct(
        F.when(p["kind"].isin(known), p["kind"]).otherwise(F.lit("text")).alias("kind"),
        F.coalesce(p["value"].cast("string"), F.lit("")).alias("value")))


def visit(part: Column) -> Column:
    """One part of the flattened text."""
    body = escape(part["value"])
    return F.when(part["kind"] == "text", body).otherwise(
        F.concat(F.lit("<|"), part["kind"], F.lit("|>"), body, F.lit("<|part|>")))


def flatten(parts: Column) -> Column:
    """The escaped text of typed parts, with a placeholder for each that isn't text."""
    return F.array_join(F.transform(parts, visit), "")


def unflatten(text: Column) -> Column:
    """A flattened text with its media as ``![kind](reference)``."""
    return unescape(F.regexp_replace(text, FLAT, "!\\[$1\\]\\($2\\)"))


def read_parts(text: Column) -> Column:
    """The typed parts of a flattened text; neighbouring texts come back as one."""
    return F.transform(_typed(text, FLAT), lambda p: F.struct(
        p["kind"].alias("kind"), unescape(p["value"]).alias("value")))


def attachments(parts: Column) -> Column:
    """The parts that aren't text, in order: kind, ref, tokens."""
    tokens = F.create_map(*[F.lit(x) for kv in PART_TOKENS.items() for x in kv])
    return F.transform(F.filter(parts, lambda p: p["kind"] != "text"), lambda p: F.struct(
        p["kind"].alias("kind"), p["value"].alias("ref"), tokens[p["kind"]].alias("tokens")))


def format_conversations(rows: DataFrame, parts: Column | None = None) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text; other columns
    are ignored): conv_id, formatted, segments (text, loss), attachments (turn,
    kind, ref, tokens), expanded_tokens (of all placeholders).

    parts: a column of rows, array<struct<kind, value>>, to be formatted in place
    of text (which need not be there then); see clean_parts for what isn't known.

    Turns stand in the order of turn, then role, then text (nulls first), and
    repeated rows stay; a null role or text is empty; a null conv_id is a
    conversation of its own; no rows, no conversations. Only assistant texts
    are under the loss. A conversation is one output row, so its turns meet in
    one task.
    """
    typed = parse_parts(F.coalesce(F.col("text"), F.lit(""))) if parts is None else clean_parts(parts)
    role = F.coalesce(F.col("role"), F.lit(""))
    turns = rows.select("conv_id", "turn", role.alias("role"), typed.alias("typed")).select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.col("role").alias("role"), flatten(F.col("typed")).alias("body"),
        attachments(F.col("typed")).alias("parts")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("text"), F.lit(False).alias("loss")),
        F.struct(t["body"].alias("text"), (t["role"] == "assistant").alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))))
    parts = F.flatten(F.transform("turns", lambda t: F.transform(t["parts"], lambda p: F.struct(
        t["turn"].alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))))
    out = grouped.select("conv_id", segments.alias("segments"), parts.alias("attachments"))
    return out.select(
        "conv_id", F.array_join("segments.text", "").alias("formatted"), "segments", "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    parts = F.filter(F.split(formatted, "<\\|turn\\|>"), lambda x: x != "")

    def turn(x: Column) -> Column:
        halves = F.split(x, "<\\|text\\|>")
        return F.struct(unescape(halves[0]).alias("role"),
                        unflatten(F.split(halves[1], "<\\|end\\|>")[0]).alias("text"))

    return F.transform(parts, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unflatten(s["text"])), "")
