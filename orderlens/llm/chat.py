"""Chat formatting: heterogeneous layouts to canonical turns, turns to marked text with a loss mask.

A layout is recognised by its schema: the nested field paths a mapping needs are hashed into its
fingerprint, the paths a record has are cut to those the mapping speaks of, and where both hashes
agree the mapping applies. Mappings are plain declarations (``MAPPINGS``, most paths first), used
alike on frames, whose schema is known, and on JSON text, where each row has a layout of its own.

The template marks the start of a turn, the end of its role and the end of its text. Control strings
inside roles and texts, its own and those of other common templates, get a backslash after their
first character (one more, if they have some), so no text can forge a mark, and taking one away
restores the text. The output is a list of segments with their loss flag: the text under the mask is
exactly the assistant's texts.

Defined results: a null role or text is an empty one; turns are ordered by turn number (null first),
then role and text; repeated rows stay; a null conversation id is a conversation. Records of unknown
layout have null turns. Extra columns are ignored; a frame that fits no mapping is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: How control strings of common templates begin and go on.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
TURN = "struct<role:string,text:string>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: from rows, from a list of messages or from single fields."""

    name: str
    paths: tuple[str, ...]
    #: (conversation, turn, role, text) columns of a table with one row per turn.
    rows: tuple[str, str, str, str] | None = None
    #: (list, role field, text field)
    messages: tuple[str, str, str] | None = None
    #: (role, fields whose texts are joined by a line break)
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


OTHER_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("turn rows", ("conv_id", "role", "text", "turn"), rows=("conv_id", "turn", "role", "text")),
    Mapping("messages", ("messages", "messages[].content", "messages[].role"),
            messages=("messages", "role", "content"), roles=OTHER_ROLES),
    Mapping("conversations", ("conversations", "conversations[].from", "conversations[].value"),
            messages=("conversations", "from", "value"), roles=OTHER_ROLES),
    Mapping("instruction with input and system", ("input", "instruction", "output", "system"),
            fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("instruction with input", ("input", "instruction", "output"),
            fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("instruction", ("instruction", "output"), fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("prompt and completion", ("completion", "prompt"),
            fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt and response", ("prompt", "response"), fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question and answer", ("answer", "question"), fields=(("user", ("question",)), ("assistant", ("answer",)))),
)


def schema_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; list elements are marked ``[]``."""
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, prefix + "[]")
    if not isinstance(schema, T.StructType):
        return []
    found = []
    for f in schema:
        path = f"{prefix}.{f.name}" if prefix else f.name
        found += [path, *schema_paths(f.dataType, path)]
    return found


def mapping_for(paths: Sequence[str], mappings: Sequence[Mapping] = MAPPINGS) -> Mapping | None:
    """The first mapping whose fingerprint is that of the paths it speaks of."""
    return next((m for m in mappings if fingerprint(set(paths) & set(m.paths)) == m.fingerprint), None)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(
        F.coalesce(role.cast("string"), F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _known_role(mapping: Mapping, role: Column) -> Column:
    if not mapping.roles:
        return role
    names = F.create_map(*[F.lit(x) for pair in mapping.roles.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.coalesce(role, F.lit(""))), role)


def _from_fields(mapping: Mapping, value) -> Column:
    """Turns of the fields that are there; ``value`` gives a field's column."""
    turns = [
        F.when(F.coalesce(*[value(n) for n in names]).isNotNull(),
               _turn(F.lit(role), F.concat_ws("\n", *[F.when(value(n) != "", value(n)) for n in names])))
        for role, names in mapping.fields
    ]
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def from_frame(df: DataFrame, key: str = "conv_id", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """conv_id and its turns, by the mapping that the frame's schema selects."""
    mapping = mapping_for(schema_paths(df.schema), mappings)
    if mapping is None:
        raise ValueError(f"no mapping has the fingerprint of {sorted(schema_paths(df.schema))}")
    if mapping.rows:
        conversation, turn, role, text = mapping.rows
        each = df.select(
            df[conversation].alias("conv_id"),
            F.struct(df[turn].alias("turn"), _turn(df[role], df[text]).alias("said")).alias("row"))
        gathered = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
        return gathered.select("conv_id", F.transform("rows", lambda r: r["said"]).alias("turns"))
    if mapping.messages:
        list_, role, text = mapping.messages
        turns = F.transform(df[list_], lambda m: _turn(_known_role(mapping, m[role]), m[text]))
    else:
        turns = _from_fields(mapping, lambda n: df[n].cast("string"))
    return df.select(df[key].alias("conv_id"), turns.alias("turns"))


def from_json_text(df: DataFrame, record: str, key: str = "conv_id", mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """conv_id, layout and turns of JSON records, each by the mapping its own paths select."""
    usable = [m for m in mappings if not m.rows]
    json = df[record]
    lists = sorted({m.messages[0] for m in usable if m.messages})
    paths = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    for name in lists:
        items = F.from_json(F.get_json_object(json, f"$.{name}"), "array<map<string,string>>")
        keys = F.flatten(F.transform(F.filter(items, lambda i: i.isNotNull()), F.map_keys))
        paths = F.concat(paths, F.coalesce(_prefixed(keys, name), F.array().cast("array<string>")))

    layout, turns = None, None
    for m in usable:
        own = F.array_sort(F.array_intersect("paths__", F.array(*[F.lit(p) for p in m.paths])))
        fits = F.sha2(F.array_join(own, "\n").cast("binary"), 256) == m.fingerprint
        made = _json_turns(m, F.col("record__"))
        layout = F.when(fits, m.name) if layout is None else layout.when(fits, m.name)
        turns = F.when(fits, made) if turns is None else turns.when(fits, made)
    read = df.select(df[key].alias("conv_id"), json.alias("record__"), paths.alias("paths__"))
    return read.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def _prefixed(keys: Column, name: str) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(f"{name}[]."), k))


def _json_turns(mapping: Mapping, record: Column) -> Column:
    if mapping.messages:
        name, role, text = mapping.messages
        items = F.from_json(F.get_json_object(record, f"$.{name}"), f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(items, lambda m: _turn(_known_role(mapping, m[role]), m[text]))
    return _from_fields(mapping, lambda n: F.get_json_object(record, f"$.{n}"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render(conversations: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """conv_id and ``segments``: the formatted text in pieces, each with its loss flag."""
    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        piece(F.concat(F.lit(START), escape(t["role"]), F.lit(SEPARATOR)), no),
        piece(escape(t["text"]), t["role"].isin(*loss_roles)),
        piece(F.lit(END), no))))
    return conversations.select("conv_id", segments.alias("segments"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_turns(formatted: Column) -> Column:
    """Turns back from a formatted text."""
    parts = F.split(formatted, END.replace("|", r"\|"), -1)
    marked = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, SEPARATOR, 1)
        return F.struct(
            unescape(F.substring(role, len(START) + 1, 2**31 - 1)).alias("role"),
            unescape(F.substring_index(part, SEPARATOR, -1)).alias("text"))

    return F.transform(marked, turn)
