"""Operator 11: chat formatting with typed content parts, in DataFrame functions only.

A turn is a role and an ordered list of parts: text, image, audio, document,
or any other kind of attachment.  A visitor (:class:`PartVisitor`, one method
per kind) turns a part into leaves: escaped text, or a placeholder with the
attachment's reference and the number of tokens the placeholder stands for.  A
document gives an opening placeholder, the leaves of its own parts in order,
and a closing one.  The formatted text of a turn is

    <|turn|>ROLE<|body|>LEAVES<|end|>

and a line feed.  Every control string starts with ``<|``, and inside roles
and texts a backslash is put before each backslash, each ``|`` after a ``<``,
and a ``|`` that starts a part; so no text holds ``<|`` any more, texts of
adjacent parts cannot form one, and taking the backslashes out again gives the
text back.

Turns are formatted where they are read; one shuffle brings a conversation's
turns together, a window adds up their lengths (it streams the turns, also of
a very long conversation) and the result is one row per conversation, which
holds its whole text by definition.

Defined results: a null text is empty, a null role is the empty role, a null
list of parts or null part adds nothing; rows without a conversation id are
one conversation with a null id; turns come by number (nulls first), ties by
role, then formatted text, and repeated rows stay; other columns, also
``role`` or ``parts`` of another meaning, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>\n"

_LEAF = "kind string, text string, ref string, width int, height int, seconds double, pages int"
#: Type of a turn's list of parts; a document's own parts are one level deep.
PARTS = f"array<struct<{_LEAF}, parts: array<struct<{_LEAF}>>>>"

# one backslash before: a backslash, a bar after "<", a bar at the start
_HIDDEN = r"\\|(?<=<)\||^\|"


def escaped(text: Column) -> Column:
    """``text`` (null: empty) without any ``<|``; :func:`unescaped` gives it back."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _HIDDEN, r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def control(name: str) -> Column:
    return F.lit(f"<|{name}|>")


@dataclass(frozen=True)
class PartVisitor:
    """What each kind of part becomes; override a method to change a kind.

    A method returns an array of leaves ``(text, kind, ref, tokens)``: plain
    text has null ``kind``, an attachment's text is its placeholder.  An image
    stands for one token per patch of ``patch`` x ``patch`` pixels, audio for
    ``audio_rate`` tokens a second, a document for ``page_tokens`` a page and
    what its parts stand for; each at least one, also when its size is null.
    """

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 256
    kinds: tuple[str, ...] = field(default=("text", "image", "audio", "document"))

    @staticmethod
    def leaf(text: Column, kind: Column | None = None, ref: Column | None = None,
             tokens: Column | None = None) -> Column:
        null = F.lit(None)
        return F.struct(text.alias("text"), (null if kind is None else kind).cast("string").alias("kind"),
                        (null if ref is None else ref).cast("string").alias("ref"),
                        (F.lit(0) if tokens is None else F.greatest(F.lit(1), F.coalesce(tokens, F.lit(1))))
                        .cast("long").alias("tokens"))

    def text(self, part: Column) -> Column:
        return F.array(self.leaf(escaped(part["text"])))

    def image(self, part: Column) -> Column:
        tiles = F.ceil(part["width"] / F.lit(self.patch)) * F.ceil(part["height"] / F.lit(self.patch))
        return F.array(self.leaf(control("image"), F.lit("image"), part["ref"], tiles))

    def audio(self, part: Column) -> Column:
        return F.array(self.leaf(control("audio"), F.lit("audio"), part["ref"],
                                 F.ceil(part["seconds"] * F.lit(self.audio_rate))))

    def document(self, part: Column) -> Column:
        """The document itself; :meth:`visit` puts the leaves of its parts and the closing placeholder after it."""
        return F.array(self.leaf(control("document"), F.lit("document"), part["ref"],
                                 part["pages"].cast("long") * self.page_tokens))

    def other(self, part: Column) -> Column:
        return F.array(self.leaf(control("attachment"), F.lit("attachment"), part["ref"], F.lit(1)))

    def simple(self, part: Column) -> Column:
        """Leaves of a part without regard to parts inside it; a part of no kind with a text is text."""
        kind = F.coalesce(part["kind"], F.when(part["text"].isNotNull(), F.lit("text")))
        chosen = F.when(part.isNull(), F.array().cast(
            "array<struct<text: string, kind: string, ref: string, tokens: bigint>>"))
        for name in self.kinds:
            chosen = chosen.when(kind == name, getattr(self, name)(part))
        return chosen.otherwise(self.other(part))

    def visit(self, part: Column) -> Column:
        inner = F.flatten(F.transform(F.coalesce(part["parts"], F.array().cast(f"array<struct<{_LEAF}>>")),
                                      self.simple))
        closed = F.concat(self.simple(part), inner, F.array(self.leaf(control("/document"))))
        return F.when(part["kind"] == "document", closed).otherwise(self.simple(part))


def text_parts(text: Column) -> Column:
    """A turn's parts when it is a plain text."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *(
        F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"),
                                                  ("seconds", "double"), ("pages", "int"))),
        F.lit(None).cast(f"array<struct<{_LEAF}>>").alias("parts"))).cast(PARTS)


def format_chats(turns: DataFrame, parts: Column, visitor: PartVisitor = PartVisitor(), conv: str = "conv_id",
                 turn: str = "turn", role: str = "role", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv, formatted, n_turns, loss, attachments, expanded_tokens: one row per conversation.

    ``parts`` is a column of type ``PARTS`` over ``turns``.  ``loss`` lists the
    spans to train on, the bodies of the ``trained`` roles: ``turn`` (from 0),
    ``turn_start``, ``start``, ``end``, in code points of ``formatted``.
    ``attachments`` lists the placeholders in order: ``turn``, ``at`` (where
    the placeholder starts), ``kind``, ``ref``, ``tokens``.
    """
    head = F.concat(F.lit(TURN), escaped(F.col(role)), F.lit(BODY))
    leaves = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        head.alias("head"), F.flatten(F.transform(F.coalesce(parts, F.array().cast(PARTS)), visitor.visit))
        .alias("leaves"))
    # where each attachment's placeholder starts inside its body: a message's own list of parts, folded in order
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(
        "array<struct<at: bigint, kind: string, ref: string, tokens: bigint>>").alias("found"))

    def step(acc: Column, leaf: Column) -> Column:
        mark = F.struct(acc["at"].alias("at"), leaf["kind"].alias("kind"), leaf["ref"].alias("ref"),
                        leaf["tokens"].alias("tokens"))
        return F.struct((acc["at"] + F.length(leaf["text"])).alias("at"),
                        F.when(leaf["kind"].isNull(), acc["found"]).otherwise(
                            F.concat(acc["found"], F.array(mark))).alias("found"))

    formed = leaves.select(
        "conv", "turn", "role", "head", F.array_join(F.transform("leaves", lambda x: x["text"]), "").alias("body"),
        F.when(F.exists("leaves", lambda x: x["kind"].isNotNull()),
               F.aggregate("leaves", start, step)["found"]).otherwise(start["found"]).alias("marks"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "head", "body")
    size = F.length("head") + F.length("body") + len(END)
    placed = formed.withColumns({
        "n": F.row_number().over(order) - 1,
        "begin": F.coalesce(F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)).cast("long")})
    placed = placed.withColumn("first", F.col("begin") + F.length("head"))
    chats = placed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
        "n", F.concat("head", "body", F.lit(END)).alias("text"), F.col("role").isin(list(trained)).alias("trained"),
        "begin", "first", (F.col("first") + F.length("body")).alias("last"), "marks"))).alias("t"))
    loss = F.transform(F.filter("t", lambda x: x["trained"]), lambda x: F.struct(
        x["n"].alias("turn"), x["begin"].alias("turn_start"), x["first"].alias("start"), x["last"].alias("end")))
    attachments = F.flatten(F.transform("t", lambda x: F.transform(x["marks"], lambda m: F.struct(
        x["n"].alias("turn"), (x["first"] + m["at"]).alias("at"), m["kind"].alias("kind"), m["ref"].alias("ref"),
        m["tokens"].alias("tokens")))))
    return chats.select(
        F.col("conv").alias(conv), F.array_join(F.transform("t", lambda x: x["text"]), "").alias("formatted"),
        F.size("t").cast("long").alias("n_turns"), loss.alias("loss"), attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda s, m: s + m["tokens"]).alias("expanded_tokens"))


def turns_of(formatted: Column) -> Column:
    """The formatted turns, read from the text: an array of strings without their end marks."""
    found = F.split(formatted, r"<\|end\|>\n", -1)
    return F.slice(found, 1, F.size(found) - 1)


def read_turn(turn: Column) -> Column:
    """(role, body) of one element of :func:`turns_of`; the role is unescaped, the body as formatted."""
    halves = F.split(F.substr(turn, F.lit(len(TURN) + 1)), r"<\|body\|>", 2)
    return F.struct(unescaped(F.get(halves, F.lit(0))).alias("role"), F.get(halves, F.lit(1)).alias("body"))


def read_parts(body: Column) -> Column:
    """A body's texts and placeholders in order, (kind, text): adjacent texts as one, empty ones left out."""
    pieces = F.split(body, r"(?=<\|)", -1)  # each but a leading text starts with a placeholder

    def halves(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^<\|(/?[a-z]+)\|>", 1)
        rest = F.when(name == "", piece).otherwise(F.substr(piece, F.length(name) + 5))
        return F.filter(F.array(F.struct(F.nullif(name, F.lit("")).alias("kind"), F.lit("").alias("text")),
                                F.struct(F.lit(None).cast("string").alias("kind"), unescaped(rest).alias("text"))),
                        lambda x: x["kind"].isNotNull() | (x["text"] != ""))

    found = F.flatten(F.transform(pieces, halves))
    return F.transform(found, lambda x: F.struct(F.coalesce(x["kind"], F.lit("text")).alias("kind"),
                                                 x["text"].alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order (each cut out of its own turn, so the cost is linear)."""
    turns = turns_of(formatted)
    return F.transform(loss, lambda s: unescaped(F.substr(
        F.get(turns, s["turn"]), (s["start"] - s["turn_start"] + 1).cast("int"),
        (s["end"] - s["start"]).cast("int"))))
