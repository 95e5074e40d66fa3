"""Chat formatting of typed content parts, with DataFrame functions only.

A message's content is a list of parts: text, image, audio or document. A visitor for each type
flattens them in order: text is escaped, any other part becomes its type's placeholder, and its
reference and the number of tokens that the placeholder expands to are recorded in the same order.
Adjacent texts are joined by a line break.

The template marks turns with control strings. Where a text holds one, a backslash is put after its
opening bracket, and one more where there are some already, so that no text can end or begin a turn and the
escape is undone exactly. Turns of the assistant are learned: the loss mask covers their text, not
the strings around it.

Turns are sorted by number (null first), then role, then content; repeated rows are turns of their
own. Null role is the empty one, null text empty, null content no parts; a part of unknown type
with no placeholder counts as a file. Roles other than system, user and assistant are kept by name. A
null conv_id is a conversation of its own. A conversation becomes one row, so its turns meet in one
task, as its text must. Other columns are ignored; an empty table gives an empty result.
"""

from pyspark.sql import functions as F

BEGIN = "<s>"
#: Role: what stands before and after its text.
FRAMES = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
#: Any other role: before its name, between name and text, after the text.
NAMED = ("[TURN] ", " [TEXT] ", " [/TURN]")
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]", "file": "[FILE]"}
CONTROL = r"(?:/?s>|/?SYS\]|/?INST\]|/?TURN\]|TEXT\]|IMG\]|AUDIO\]|DOC\]|FILE\])"
ENDS = r"(?<=</s>|\[/SYS\]|\[/INST\]|\[/TURN\])"
AROUND_PLACEHOLDERS = r"(?=\[(?:IMG|AUDIO|DOC|FILE)\])|(?<=\[(?:IMG|AUDIO|DOC|FILE)\])"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
IMAGE_PATCH = 28
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 768
LEARNED = "assistant"


def escaped(text):
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescaped(text):
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def kind(part):
    """The part's type; a part with no type is text."""
    known = F.coalesce(part["type"], F.lit("text"))
    return F.when(known.isin("text", *PLACEHOLDERS), known).otherwise("file")


#: Tokens that a part's placeholder expands to, at least one.
EXPANSIONS = {
    "image": lambda p: F.ceil(p["width"] / IMAGE_PATCH) * F.ceil(p["height"] / IMAGE_PATCH),
    "audio": lambda p: F.ceil(p["seconds"] * AUDIO_TOKENS_A_SECOND),
    "document": lambda p: p["pages"].cast("long") * DOCUMENT_TOKENS_A_PAGE,
}


def by_kind(part, visits, otherwise):
    chosen = None
    for name, visit in visits.items():
        chosen = (F if chosen is None else chosen).when(kind(part) == name, visit(part))
    return chosen.otherwise(otherwise)


def flat_text(content):
    """The parts as one escaped text with placeholders."""
    def visit(part, at):
        follows_text = (at > 0) & (kind(F.get(content, at - 1)) == "text")
        text = F.concat(F.when(follows_text, "\n").otherwise(""), escaped(F.coalesce(part["text"], F.lit(""))))
        return by_kind(part, {k: lambda _, mark=mark: F.lit(mark) for k, mark in PLACEHOLDERS.items()}, text)
    return F.array_join(F.transform(content, visit), "")


def attachments_of(content):
    def recorded(part):
        tokens = by_kind(part, EXPANSIONS, F.lit(1).cast("long"))
        return F.struct(kind(part).alias("type"), part["ref"].alias("ref"),
                        F.greatest(F.coalesce(tokens, F.lit(1).cast("long")), F.lit(1).cast("long")).alias("tokens"))
    return F.transform(F.filter(content, lambda p: kind(p) != "text"), recorded)


def text_messages(conversations):
    """Rows of conv_id, turn, role and text as messages of one text part each."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"),
                    *[F.lit(None).alias(c) for c in ("ref", "width", "height", "seconds", "pages")])
    return conversations.select("conv_id", "turn", "role", F.array(part.cast(PART)).alias("content"))


def framed(turn):
    """A turn's segments: the strings around its text, and the text, with the loss mask."""
    before, after = F.concat(F.lit(NAMED[0]), escaped(turn["role"]), F.lit(NAMED[1])), F.lit(NAMED[2])
    for role, (opening, closing) in FRAMES.items():
        before = F.when(turn["role"] == role, opening).otherwise(before)
        after = F.when(turn["role"] == role, closing).otherwise(after)
    return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in (
        (before, F.lit(False)), (turn["flat"], turn["role"] == LEARNED), (after, F.lit(False)))])


def chat_formatted(messages):
    """One row per conversation: conv_id, formatted, segments, attachments, attachment_tokens.

    ``messages`` has conv_id, turn, role and content, a list of PART. ``segments`` are the pieces of
    ``formatted`` in order, each with its flag of the loss mask; the n-th of ``attachments``
    (type, ref, tokens) belongs to the n-th placeholder.
    """
    content = F.filter(F.coalesce("content", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    turns = messages.withColumn("content", content).select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), flat_text(F.col("content")).alias("flat"),
                            attachments_of(F.col("content")).alias("attached")).alias("turn"))
    held = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    start = F.array(F.struct(F.lit(BEGIN).alias("text"), F.lit(False).alias("loss")))
    pieces = held.select("conv_id", F.concat(start, F.flatten(F.transform("turns", framed))).alias("segments"),
                         F.flatten("turns.attached").alias("attachments"))
    tokens = F.aggregate("attachments.tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    return pieces.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments", "attachments",
                         tokens.alias("attachment_tokens"))


def read_parts(flat):
    """The typed parts of an escaped text, placeholders by their type."""
    def read(piece):
        return F.struct(
            by_kind_of_mark(piece).alias("type"),
            F.when(by_kind_of_mark(piece) == "text", unescaped(piece)).otherwise("").alias("text"))
    return F.transform(F.filter(F.split(flat, AROUND_PLACEHOLDERS), lambda p: p != ""), read)


def by_kind_of_mark(piece):
    found = F.lit("text")
    for name, mark in PLACEHOLDERS.items():
        found = F.when(piece == mark, name).otherwise(found)
    return found


def inner(piece, opening, closing):
    return F.substring(piece, F.lit(len(opening) + 1), F.length(piece) - len(opening) - len(closing))


def read_back(formatted):
    """The turns of a formatted conversation: role and typed parts."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))

    def read(piece):
        named = F.split(inner(piece, NAMED[0], NAMED[2]), r" \[TEXT\] ", 2)
        role, flat = unescaped(named[0]), named[1]
        for name, (opening, closing) in FRAMES.items():
            is_name = piece.startswith(opening) & piece.endswith(closing)
            role = F.when(is_name, name).otherwise(role)
            flat = F.when(is_name, inner(piece, opening, closing)).otherwise(flat)
        return F.struct(role.alias("role"), read_parts(flat).alias("parts"))
    return F.transform(F.filter(F.split(body, ENDS), lambda p: p != ""), read)


def digests(formatted):
    """What the formatted conversations hold, read back from them."""
    turns = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
                             F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                                      lambda s: unescaped(s["text"])), "").alias("learned"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), F.array_join(t["parts"]["text"], ""), F.lit("\n")))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)({CONTROL})', '\1\\\2\3', 'g')) + CASE role
            WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
            ELSE 23 + length(regexp_replace(role, '([<\[])(\\*)({CONTROL})', '\1\\\2\3', 'g')) END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""
