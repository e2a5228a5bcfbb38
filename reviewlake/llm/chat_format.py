"""Chat formatting of typed content parts, by column functions only.

A message's content is an array of parts (kind, text, ref, size). A text part
contributes its text; image, audio and document parts become placeholders in
their place, and are recorded as attachments with the tokens they expand to.
Turns become ``<|im_start|>role\\n...<|im_end|>\\n``; ``<|`` can't occur inside
text or role, because a backslash is put into it (and backslashes are
doubled), so everything can be read back.

The loss mask has, for each segment - a piece of the formatted text that begins
with ``<|im_start|>`` - the spans inside it, so that reading a span costs its
segment, not the conversation before it. It covers the texts of assistant
turns, without placeholders and markers.

A conversation is one output row, gathered whole: its digest needs all of it
in order. Only that grouping shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
KINDS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens that one unit of size (image tile, audio second, document page) expands to.
TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,ref:string,size:int>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    """Between < and | an escaped text has an even number of backslashes, or the one put there."""
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    c = F.replace(c, F.lit("<\\|"), F.lit("<|"))
    plain = F.transform(F.split(c, r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(plain, "\\")


def text_part(c: Column) -> Column:
    """The parts of a plain text message."""
    return F.array(F.struct(F.lit("text").alias("kind"), c.cast("string").alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("size")))


def _visit(parts: Column, tokens: dict[str, int]) -> tuple[Column, Column]:
    """(pieces of the message in order, attachments in order): one case per kind."""
    def shown(p: Column) -> Column:
        out = escape(F.coalesce(p["text"], F.lit("")))
        for kind, mark in KINDS.items():
            out = F.when(p["kind"] == kind, F.lit(mark)).otherwise(out)
        return F.struct((~F.coalesce(p["kind"], F.lit("text")).isin(*KINDS)).alias("is_text"), out.alias("out"))

    def attached(p: Column) -> Column:
        cost = F.lit(0)
        for kind in KINDS:
            cost = F.when(p["kind"] == kind, F.lit(tokens[kind])).otherwise(cost)
        return F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"),
                        (cost.cast("long") * F.greatest(F.coalesce(p["size"], F.lit(1)), F.lit(0))).alias("tokens"))

    some = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    some = F.filter(some, lambda p: p.isNotNull())
    return F.transform(some, shown), F.transform(F.filter(some, lambda p: p["kind"].isin(*KINDS)), attached)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", *, loss_role: str = "assistant",
                 tokens: dict[str, int] | None = None) -> DataFrame:
    """One row per conversation: formatted, loss_spans, attachments, expanded_tokens, n_turns.

    Turns are ordered by number (null first), then role, then content, so
    repeated turns keep a defined order and all of them. A null role is empty;
    null parts, null content and null texts are empty; an unknown kind counts
    as text. Rows of null conversation form one. Other columns are not
    carried. ``loss_spans`` has one array of (start, length) in code points per
    segment, ``attachments`` is an array of (segment, kind, ref, tokens).
    """
    pieces, attached = _visit(F.col(f"`{parts_col}`"), tokens or TOKENS)
    role = escape_role(F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")))

    def spans(head: Column) -> Column:
        """The text pieces of a turn, by the lengths of what comes before."""
        def step(acc: Column, p: Column) -> Column:
            n = F.length(p["out"])
            add = F.when(p["is_text"] & (n > 0), F.array(F.struct(acc["at"].alias("start"), n.alias("length")))).otherwise(
                F.array().cast("array<struct<start:int,length:int>>"))
            return F.struct((acc["at"] + n).alias("at"), F.concat(acc["spans"], add).alias("spans"))
        zero = F.struct(head.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
        return F.aggregate(F.col("pieces"), zero, step, lambda acc: acc["spans"])

    one = turns.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
        pieces.alias("pieces"), attached.alias("attached"),
        F.coalesce(F.col(f"`{role_col}`").cast("string") == loss_role, F.lit(False)).alias("lossy"))
    head = F.length(F.lit(START)) + F.length("role") + 1
    one = one.select(
        "conv", "turn", "role",
        F.concat(F.lit(START), F.col("role"), F.lit("\n"),
                 F.array_join(F.transform("pieces", lambda p: p["out"]), ""), F.lit(END + "\n")).alias("segment"),
        F.when(F.col("lossy"), spans(head)).otherwise(F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        "attached")
    # struct order is the sort order: turn, role, segment
    convs = one.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "segment", "spans", "attached"))).alias("t"))
    return convs.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"),
        F.transform("t", lambda x: x["spans"]).alias("loss_spans"),
        F.flatten(F.transform("t", lambda x, i: F.transform(x["attached"], lambda a: F.struct(
            i.alias("segment"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"),
        F.aggregate(F.flatten(F.transform("t", lambda x: x["attached"])), F.lit(0).cast("long"),
                    lambda acc, a: acc + a["tokens"]).alias("expanded_tokens"),
        F.size("t").cast("long").alias("n_turns"))


def segments(formatted: Column) -> Column:
    """The turns of a formatted text, each from its start marker on."""
    cut = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0))), lambda x: F.concat(F.lit(START), x))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back; placeholders stay in the text as they are."""
    def one(seg: Column) -> Column:
        body = F.substring(seg, F.lit(len(START) + 1), F.length(seg) - F.lit(len(START) + len(END) + 1))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))
    return F.transform(segments(formatted), one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, one span after the other."""
    cut = lambda seg, some: F.array_join(F.transform(
        some, lambda s: unescape(F.substring(seg, s["start"] + 1, s["length"]))), "")
    return F.array_join(F.zip_with(segments(formatted), spans, cut), "")
