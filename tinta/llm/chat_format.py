"""Chat formatting with typed content parts, as column expressions only.

A message holds ordered parts. A visitor turns text parts into escaped text and image, audio and document
parts into placeholders, and records their references and expanded token counts.

Template of a turn: ``<|im_start|>role NEWLINE content<|im_end|>NEWLINE``. Every control string starts with
``<|``. Inside a text, a backslash is put between ``<`` and the bar (after any backslashes that are there),
so ``<|`` never occurs in content and the change is undone exactly. Roles are percent-encoded for ``%``,
line ends and ``<``.

Defined results: a NULL text, role or part list is empty; turns of one conversation are ordered by turn, role
and content (NULL turns first), repeated rows stay as turns of their own; NULL ids form one conversation; an empty table
gives no rows. Columns other than the named ones are ignored. Unknown kinds become ``attachment`` placeholders with no tokens.
One conversation is one output string by definition; its turns are gathered in the one task that writes it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PART = "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,seconds:double,pages:bigint>"
PLACEHOLDER = r"<\|(image|audio|document|attachment)\|>"


@dataclass(frozen=True)
class Expansion:
    """How many model tokens an attachment takes once it is expanded."""

    patch: int = 14
    audio_tokens_per_second: float = 25.0
    tokens_per_page: int = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def encode_role(role: Column) -> Column:
    for plain, coded in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def decode_role(role: Column) -> Column:
    for plain, coded in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def text_part(text: Column) -> Column:
    """A list with one text part."""
    fields = [F.lit("text").alias("kind"), text.alias("text")]
    fields += [F.lit(None).cast(kind).alias(name) for name, kind in (
        ("ref", "string"), ("width", "bigint"), ("height", "bigint"), ("seconds", "double"), ("pages", "bigint")
    )]
    return F.array(F.struct(*fields))


class PartVisitor:
    """Column expressions for one part, by kind."""

    def __init__(self, expansion: Expansion = Expansion()):
        self.expansion = expansion

    def is_text(self, part: Column) -> Column:
        return F.coalesce(part["kind"] == "text", F.lit(False))

    def kind(self, part: Column) -> Column:
        return F.when(part["kind"].isin("image", "audio", "document"), part["kind"]).otherwise("attachment")

    def render(self, part: Column) -> Column:
        text = F.coalesce(part["text"], F.lit(""))
        return F.when(self.is_text(part), escape(text)).otherwise(F.concat(F.lit("<|"), self.kind(part), F.lit("|>")))

    def tokens(self, part: Column) -> Column:
        e = self.expansion
        grid = F.ceil(part["width"] / e.patch) * F.ceil(part["height"] / e.patch)
        count = (
            F.when(part["kind"] == "image", grid)
            .when(part["kind"] == "audio", F.ceil(part["seconds"] * e.audio_tokens_per_second))
            .when(part["kind"] == "document", part["pages"] * e.tokens_per_page)
        )
        return F.coalesce(count, F.lit(0)).cast("bigint")

    def flatten(self, parts: Column) -> Column:
        """Text of a message with placeholders in order."""
        return F.array_join(F.transform(parts, self.render), "")

    def attachments(self, parts: Column) -> Column:
        return F.transform(
            F.filter(parts, lambda p: ~self.is_text(p)),
            lambda p: F.struct(self.kind(p).alias("kind"), p["ref"].alias("ref"), self.tokens(p).alias("tokens")),
        )


def format_conversations(messages: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """``conv_id, formatted, loss_spans, attachments, expanded_tokens`` from ``conv_id, turn, role, parts``.

    ``loss_spans`` has one entry per turn: ``start`` and ``length`` of its content in code points of
    ``formatted`` and ``trained``, which is true for assistant turns. Attachments name their turn, from 0.
    """
    visitor = PartVisitor(expansion)
    role = F.coalesce(F.col("role"), F.lit(""))
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    turns = messages.select(
        "conv_id",
        "turn",
        (role == "assistant").alias("trained"),
        F.concat(F.lit(OPEN), encode_role(role), F.lit("\n")).alias("head"),
        visitor.flatten(parts).alias("content"),
        visitor.attachments(parts).alias("attached"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "head", "content")
    tail = F.lit(CLOSE + "\n")
    turns = turns.withColumn("line", F.concat("head", "content", tail))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.row_number().over(order) - 1).withColumn(
        "start", F.coalesce(F.sum(F.char_length("line")).over(before), F.lit(0)) + F.char_length("head")
    )
    turn = F.struct("at", "start", F.char_length("content").alias("length"), "trained", "line", "attached")
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    located = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct(t["at"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
            ),
        )
    )
    span = lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"), t["trained"].alias("trained"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"),
        F.transform("turns", span).alias("loss_spans"),
        located.alias("attachments"),
        F.aggregate(located, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, content>>``; content is still escaped."""
    segments = F.split(formatted, r"<\|im_start\|>")

    def turn(segment: Column) -> Column:
        head = F.substring_index(segment, "\n", 1)
        skipped = F.char_length(head) + 1
        length = F.char_length(segment) - skipped - len(CLOSE) - 1
        return F.struct(
            decode_role(head).alias("role"), F.substring(segment, skipped + 1, length).alias("content")
        )

    return F.transform(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), turn)


def plain_text(content: Column) -> Column:
    """Text of a turn's content: no placeholders, nothing escaped."""
    return unescape(F.regexp_replace(content, PLACEHOLDER, ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations hold, read from their strings and loss spans alone."""
    # a generator keeps the parsed turns from being computed once per use
    read = formatted.select("conv_id", "formatted", "loss_spans", F.explode(F.array(read_turns(F.col("formatted")))).alias("turns"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), plain_text(t["content"]), F.lit("\n")))
    under_mask = F.zip_with(
        "turns", "loss_spans", lambda t, s: F.when(s["trained"], plain_text(t["content"])).otherwise("")
    )
    read = read.select(
        "conv_id", "formatted", F.size("turns").cast("bigint").alias("n_turns"), said.alias("said"),
        F.explode(F.array(F.array_join(under_mask, ""))).alias("loss"),
    )
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("said", "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def messages_of(conversations: DataFrame) -> DataFrame:
    """Messages of the table of conversations: each text is one text part."""
    return conversations.select("conv_id", "turn", "role", text_part(F.coalesce(F.col("text"), F.lit(""))).alias("parts"))


def chat_format_digest(conversations: DataFrame) -> DataFrame:
    return read_back(format_conversations(messages_of(conversations)))
