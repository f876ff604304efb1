"""Chat formatting: records of any declared layout become turns, a text with marks and a loss mask."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"

#: Names under which layouts know the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """How one layout gives turns.

    ``examples`` are records of the layout; the fingerprints of their field paths select it. ``parts``
    are taken in order: (role, path) is one turn, left out where the path holds nothing if the
    path is in ``optional``; (path of a list, role field, text field) is a turn for each element.
    """

    name: str
    examples: Sequence[str]
    parts: Sequence[tuple[str, ...]]
    optional: frozenset[str] = field(default_factory=frozenset)
    rename: bool = True


LAYOUTS = (
    # A single turn: roles are kept as they are.
    Layout("row", ['{"role":"r","text":"t"}'], [("$", "role", "text")], rename=False),
    Layout(
        "messages",
        ['{"messages":[{"role":"r","content":"t"}]}', '{"messages":[]}'],
        [("$.messages", "role", "content")],
    ),
    Layout(
        "conversations",
        ['{"conversations":[{"from":"r","value":"t"}]}', '{"conversations":[]}'],
        [("$.conversations", "from", "value")],
    ),
    Layout(
        "nested_dialogue",
        ['{"dialogue":{"turns":[{"speaker":"r","utterance":"t"}]}}'],
        [("$.dialogue.turns", "speaker", "utterance")],
    ),
    Layout(
        "instruction",
        ['{"instruction":"i","output":"o"}', '{"instruction":"i","input":"x","output":"o"}',
         '{"system":"s","instruction":"i","input":"x","output":"o"}'],
        [("system", "$.system"), ("user", "$.instruction", "$.input"), ("assistant", "$.output")],
        frozenset({"$.system", "$.input"}),
    ),
    Layout("prompt_completion", ['{"prompt":"p","completion":"c"}'],
           [("user", "$.prompt"), ("assistant", "$.completion")]),
    Layout("prompt_response", ['{"prompt":"p","response":"c"}',
                               '{"system":"s","prompt":"p","response":"c"}'],
           [("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response")],
           frozenset({"$.system"})),
    Layout("question_answer", ['{"question":"p","answer":"c"}'],
           [("user", "$.question"), ("assistant", "$.answer")]),
)

_SCALARS = r"\b(STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DATE|BINARY|DECIMAL\(\d+, ?\d+\))(?=[,>]|$)"


def field_paths(record: Column) -> Column:
    """The nested field paths of a JSON record, in order of name, without the types of values."""
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), _SCALARS, "_")


def fingerprint(record: Column) -> Column:
    """The hash of a record's field paths; null if the record is no JSON."""
    return F.xxhash64(field_paths(record))


def _text(variant: Column, path: str) -> Column:
    return F.try_variant_get(variant, path, "string")


def _named(role: str, text: str) -> Callable[[Column], Column]:
    """A list's element as a turn."""
    return lambda x: F.struct(
        F.coalesce(x[role], F.lit("")).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")
    )


def _turns(layout: Layout, variant: Column) -> Column:
    """The turns of a record of ``layout``."""
    made = []
    for part in layout.parts:
        if part[0].startswith("$"):
            path, role, text = part
            element = f"struct<{role}:string,{text}:string>"
            if path == "$":
                items = F.array(F.try_variant_get(variant, path, element))
            else:
                items = F.try_variant_get(variant, path, f"array<{element}>")
            made.append(F.transform(items, _named(role, text)))
        else:
            role, *paths = part
            texts = F.filter(F.array(*[_text(variant, p) for p in paths]), lambda x: x.isNotNull())
            turn = F.array(F.struct(F.lit(role).alias("role"),
                                    F.array_join(texts, "\n").alias("text")))
            empty = F.array().cast(TURNS)
            left_out = F.size(texts) == 0 if layout.optional & set(paths) else F.lit(False)
            made.append(F.when(left_out, empty).otherwise(turn))
    turns = F.concat(*made).cast(TURNS)
    if not layout.rename:
        return turns
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.transform(turns, lambda x: F.struct(
        F.coalesce(F.try_element_at(names, x["role"]), x["role"]).alias("role"),
        x["text"].alias("text"),
    ))


def canonical_turns(
    df: DataFrame, record_col: str, layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """``df`` with ``layout`` (its name, null if none is declared) and ``turns`` (role, text).

    A record is a JSON text. The hash of its nested field paths selects the layout, whose
    declared mapping gives the turns; null roles and texts become empty. A record that is null, no JSON
    or of no declared layout keeps its row with null turns; ``undeclared`` lists what to declare. JSON with
    a string of more than 20,000,000 characters, or of more bytes than a variant holds (128 MiB), counts as no JSON.
    """
    record = F.col(f"`{record_col}`")
    variant = F.try_parse_json(record)
    shape = fingerprint(record)
    name = turns = None
    for layout in layouts:
        known = shape.isin(*[fingerprint(F.lit(e)) for e in layout.examples])
        if name is None:
            name, turns = F.when(known, layout.name), F.when(known, _turns(layout, variant))
        else:
            name, turns = name.when(known, layout.name), turns.when(known, _turns(layout, variant))
    return df.withColumns({"layout": name, "turns": turns})


def undeclared(df: DataFrame, record_col: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The field paths of records that no layout fits, with their number."""
    return (
        canonical_turns(df, record_col, layouts).filter("layout is null")
        .groupBy(field_paths(F.col(f"`{record_col}`")).alias("field_paths"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def escaped(text: Column) -> Column:
    """``text`` in which no mark can occur: every ``<|`` is followed by one more ``|``."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<|n|>"))


def formatted(turns: Column) -> Column:
    """``<|im_start|>role``, a line break, the text and ``<|im_end|>`` for each turn; null: empty."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(
            F.lit(START), _escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(END)
        )),
        "",
    )


def loss_spans(turns: Column) -> Column:
    """Where the assistant's texts stand in the formatted text: code points, end exclusive."""
    state = "struct<at:int,spans:array<struct<start:int,end:int>>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(state)

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(_escaped_role(t["role"])) + len(START) + 1
        end = start + F.char_length(escaped(t["text"]))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], span))
        return F.struct(
            (end + len(END)).alias("at"), spans.otherwise(acc["spans"]).alias("spans")
        ).cast(state)

    return F.aggregate(turns, empty, step)["spans"]


def format_chat(df: DataFrame, turns_col: str = "turns") -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans``; null or no turns give an empty text and no span."""
    turns = F.coalesce(F.col(f"`{turns_col}`"), F.array().cast(TURNS))
    return df.withColumns({"formatted": formatted(turns), "loss_spans": loss_spans(turns)})


def read_back(text: Column) -> Column:
    """The turns of a formatted text, as they were before."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda x: x != "")
    head = F.substring_index

    def turn(x: Column) -> Column:
        role = head(x, "\n", 1)
        body = F.substring(x, F.char_length(role) + 2, F.char_length(x))
        role = F.substring(role, F.lit(len(START) + 1), F.char_length(role))
        return F.struct(
            unescaped(F.replace(role, F.lit("<|n|>"), F.lit("\n"))).alias("role"),
            unescaped(body).alias("text"),
        )

    return F.transform(parts, turn)


def conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Formatted conversations of a table with a row for each turn: ``conv_id, turns, formatted, loss_spans``.

    Each row is a record of its own; its turns are put together in order of the turn
    number, nulls first, then role and text, so that repeated rows have a defined place. A null id is one conversation.
    A row too long to be parsed as a record gives its turn from the columns themselves.
    """
    record = F.to_json(
        F.struct(F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text")),
        {"ignoreNullFields": "false"},
    )
    records = rows.select(
        F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        record.alias("record"),
        F.struct(*[
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
            for c, name in ((role_col, "role"), (text_col, "text"))
        ]).alias("own"),
    )
    said = F.coalesce(F.col("turns")[0], "own")
    single = canonical_turns(records, "record").select(
        "conv_id", F.struct("turn", said.alias("said")).alias("item")
    )
    whole = single.groupBy("conv_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    turns = whole.select("conv_id", F.col("items.said").alias("turns"))
    return format_chat(turns)
