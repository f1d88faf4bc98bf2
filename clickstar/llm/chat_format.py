"""Chat formatting with typed content parts, reversible.

A turn is a list of parts of kind ``text``, ``image``, ``audio`` or ``document``. A visitor
walks the parts in order: text is escaped and appended, any other part leaves a numbered
placeholder, an attachment record (its reference and its original spelling) and the count
of tokens it expands to. A template marks the turns:

    <turn ROLE>BODY</turn>\\n

Inside roles and texts ``\\`` becomes ``\\b``, ``<`` becomes ``\\l`` and ``>`` becomes
``\\g``, so ``<`` and ``>`` in the output belong to the template alone and everything can
be read back. ``loss`` lists the code-point spans of the assistant's bodies.

Defined cases: null text is empty, a null role is empty; turns are ordered by turn (null
first), then role, then text, so repeated rows are repeated turns; rows without conv_id
form one conversation; an unknown kind of part is kept as text by its ``raw`` spelling; an
empty table gives an empty result. Turns are formatted row by row; a conversation is one
row of the result, and its turns meet only for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens that a unit of an attachment expands to: an image tile, a second of sound, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,ref:string,units:bigint,raw:string>"
# ![image 4](ref): an attachment written inside a text, with an optional number of units.
INLINE = r"!\[(image|audio|document)(?: (\d{1,6}))?\]\(([^()\s]{1,2000})\)"
PLACEHOLDER = r"<(?:image|audio|document) \d+>"
END = "</turn>\n"


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def part(kind: Column, text: Column, ref: Column, units: Column, raw: Column) -> Column:
    return F.struct(kind.alias("kind"), text.alias("text"), ref.alias("ref"),
                    units.alias("units"), raw.alias("raw")).cast(PART)


def parts_of(text: Column) -> Column:
    """Typed parts of a text: inline attachments and the texts between them."""
    none = F.lit(None).cast("string")
    marks = F.regexp_extract_all(text, F.lit(INLINE), F.lit(0))

    def pair(between: Column, mark: Column) -> Column:
        before = part(F.lit("text"), between, none, F.lit(0), between)
        units = F.coalesce(F.nullif(F.regexp_extract(mark, INLINE, 2), F.lit("")), F.lit("1"))
        there = part(F.regexp_extract(mark, INLINE, 1), none,
                     F.regexp_extract(mark, INLINE, 3), units, mark)
        return F.when(mark.isNull(), F.array(before)).otherwise(F.array(before, there))

    plain = F.array(part(F.lit("text"), text, none, F.lit(0), text))
    return F.when(~text.contains("!["), plain).otherwise(
        F.flatten(F.zip_with(F.split(text, INLINE, -1), marks, pair)))


def visit(parts: Column, first: Column) -> Column:
    """Body, attachments and expanded tokens of a turn; placeholders count from ``first``."""
    start = F.struct(F.lit("").alias("body"),
                     F.array().cast("array<struct<kind:string,ref:string,raw:string,tokens:bigint>>")
                     .alias("attachments"))

    def step(state: Column, p: Column) -> Column:
        per_unit = F.coalesce(*[F.when(p.kind == k, F.lit(n)) for k, n in TOKENS_PER_UNIT.items()])
        number = (first + F.size(state.attachments)).cast("string")
        mark = F.concat(F.lit("<"), p.kind, F.lit(" "), number, F.lit(">"))
        found = F.struct(p.kind.alias("kind"), p.ref.alias("ref"),
                         F.coalesce(p.raw, F.lit("")).alias("raw"),
                         (F.coalesce(p.units, F.lit(1)) * per_unit).alias("tokens"))
        text = F.coalesce(F.when(p.kind == "text", p.text).otherwise(p.raw), F.lit(""))
        return F.when(per_unit.isNull(), F.struct(
            F.concat(state.body, escape(text)).alias("body"),
            state.attachments.alias("attachments"))).otherwise(F.struct(
                F.concat(state.body, mark).alias("body"),
                F.concat(state.attachments, F.array(found)).alias("attachments")))

    plain = F.struct(escape(F.coalesce(F.get(parts, F.lit(0)).text, F.lit(""))).alias("body"),
                     start.attachments.alias("attachments"))
    one_text = (F.size(parts) == 1) & (F.get(parts, F.lit(0)).kind == "text")
    return F.when(one_text, plain).otherwise(F.aggregate(parts, start, step))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) to one formatted piece per row; no shuffle.

    Placeholders are numbered inside their turn.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    seen = turns.select("conv_id", "turn", role.alias("role"),
                        visit(F.col("parts"), F.lit(0)).alias("v"))
    return seen.select("conv_id", "turn", "role", F.col("v.body").alias("body"),
                       F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">")).alias("head"),
                       F.col("v.attachments").alias("attachments"))


def conversations(pieces: DataFrame) -> DataFrame:
    """One row per conversation: formatted text, loss spans, attachments, expanded tokens."""
    listed = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "role", "body", "head", "attachments"))).alias("t"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        head, body = F.length(t["head"]), F.length(t.body)
        span = F.struct((state.at + head).alias("start"), body.cast("bigint").alias("length"))
        return F.struct((state.at + head + body + len(END)).cast("bigint").alias("at"),
                        F.when(t.role == "assistant", F.concat(state.spans, F.array(span)))
                        .otherwise(state.spans).alias("spans"))

    flat = F.flatten(F.transform("t", lambda t: t.attachments))
    return listed.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t.body, F.lit(END))), "")
        .alias("formatted"),
        F.aggregate("t", start, step).spans.alias("loss"),
        F.transform("t", lambda t: t.attachments).alias("attachments"),
        F.aggregate(flat, F.lit(0).cast("bigint"), lambda s, a: s + a.tokens)
        .alias("expanded_tokens"))


def restore(body: Column, attachments: Column) -> Column:
    """The text that a body was made from."""
    texts = F.split(body, PLACEHOLDER, -1)
    woven = F.zip_with(texts, attachments, lambda text, a: F.concat(
        unescape(text), F.coalesce(a.raw, F.lit(""))))
    return F.when(F.size(attachments) == 0, unescape(body)).otherwise(F.array_join(woven, ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns (role, text) and the texts under the loss mask, from the output alone."""
    pieces = F.split("formatted", END, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column, attachments: Column) -> Column:
        close = F.instr(piece, F.lit(">"))
        return F.struct(unescape(F.substring(piece, F.lit(7), close - 7)).alias("role"),
                        restore(F.substring(piece, close + 1, F.length(piece)), attachments)
                        .alias("text"))

    role_of = F.transform("attachments", lambda a: a)
    turns = F.zip_with(pieces, role_of, turn)
    with_turns = formatted.withColumn("turns", turns)
    spoken = F.filter(F.zip_with("turns", "attachments", lambda t, a: F.struct(
        t.role.alias("role"), a.alias("attachments"))), lambda x: x.role == "assistant")
    texts = F.zip_with("loss", spoken, lambda span, s: restore(
        F.substring(F.col("formatted"), (span.start + 1).cast("int"), span.length.cast("int")),
        s.attachments))
    return with_turns.withColumn("loss_text", F.array_join(texts, ""))
