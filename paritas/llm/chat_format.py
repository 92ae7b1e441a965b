"""Chat formatting with typed content parts.

A turn's content is a list of parts (type ``text``, ``image``, ``audio`` or ``document``). A visitor goes through them in order:
text is escaped, each attachment becomes the placeholder of its type, and its reference and the number of tokens it expands to
are recorded in the same order, so the k-th placeholder of a conversation belongs to its k-th attachment.

A turn is written ``<|turn|>role<|text|>body<|end|>`` with the body's parts on lines of their own. Control strings
inside roles and texts (those of this template and of two common ones) get a backslash after their first
character, one more if there are some already; taking one away again gives back the text. The loss mask is the
``loss`` flag of the pieces whose concatenation is the formatted text; it holds for bodies of assistant turns.

Defined results: null role, text or part text is empty; null parts are no parts; a part of an unknown type counts
as text; turns are ordered by turn, role and content, null turns first; rows without conv_id are one conversation;
an empty table gives an empty result. Other columns of the input are ignored.

The formatted text of one conversation is one value, so its turns meet in one row; everything else is per turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH, AUDIO_PER_SECOND, PER_PAGE = 14, 25, 1024
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
#: What follows the first character of a control string: the openers of ``<|...|>``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``.
_REST = r"(\||/?s>|/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([<\[])(\\*)" + _REST, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + _REST, "$1$2$3")


def text_part(text: Column) -> Column:
    """A text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text")))


def _field(part: Column, name: str, known: list[str]) -> Column:
    return part[name] if name in known else F.lit(None)


def _expanded(part: Column, known: list[str]) -> Column:
    def number(name: str) -> Column:
        return F.greatest(F.coalesce(_field(part, name, known).cast("double"), F.lit(0.0)), F.lit(0.0))

    return F.when(part["type"] == "image", F.ceil(number("width") / PATCH) * F.ceil(number("height") / PATCH)) \
        .when(part["type"] == "audio", F.ceil(number("seconds") * AUDIO_PER_SECOND)) \
        .when(part["type"] == "document", number("pages").cast("long") * PER_PAGE).cast("long")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, pieces, attachments, expanded_tokens of ``turns(conv_id, turn, role, parts)``."""
    known = turns.schema["parts"].dataType.elementType.fieldNames()
    attached = F.col("parts").isNotNull()
    kinds = ("image", "audio", "document")
    body = F.array_join(F.transform("parts", lambda p: F.when(
        p["type"].isin(*kinds), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escaped(_field(p, "text", known)))), "\n")
    files = F.transform(F.filter("parts", lambda p: p["type"].isin(*kinds)), lambda p: F.struct(
        p["type"].alias("type"), _field(p, "ref", known).cast("string").alias("ref"), _expanded(p, known).alias("tokens")))
    none = F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>")
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.when(attached, body).otherwise("").alias("body"),
        F.when(attached, files).otherwise(none).alias("files")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    pieces = F.flatten(F.transform("ts", lambda t: F.array(
        F.struct(F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT)).alias("piece"), F.lit(False).alias("loss")),
        F.struct(t["body"].alias("piece"), (t["role"] == LOSS_ROLE).alias("loss")),
        F.struct(F.lit(END).alias("piece"), F.lit(False).alias("loss")))))
    whole = whole.select("conv_id", pieces.alias("pieces"), F.flatten(F.col("ts.files")).alias("attachments"))
    return whole.select(
        "conv_id", F.array_join("pieces.piece", "").alias("formatted"), "pieces", "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + F.coalesce(a["tokens"], F.lit(0))).alias("expanded_tokens"))


def read_back(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text: parsed from the ``formatted`` text and the loss mask of its ``pieces``."""
    turns = F.transform(F.slice(F.split("formatted", r"<\|turn\|>"), 2, F.size(F.split("formatted", r"<\|turn\|>"))), lambda turn: F.struct(
        unescaped(F.substring_index(turn, TEXT, 1)).alias("role"),
        unescaped(F.substring_index(F.substring_index(turn, TEXT, -1), END, 1)).alias("text")))
    masked = F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: unescaped(p["piece"]))
    return conversations.select("conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"),
                                F.length("formatted").cast("long").alias("formatted_chars"), "attachments", "expanded_tokens")


def digest(turns: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted(turns)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
        F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens")
