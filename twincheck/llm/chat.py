"""Chat formatting: fingerprints of nested field paths select a declarative mapping into canonical turns."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Goes after the first character of whatever could be read as a control string, or as one with such marks.
_MARK = "\\"

#: Layouts by name: the field paths that make them up, and the turns they give as (role path or =fixed role, text path).
#: Paths through lists end in []; a layout with a list path gives a turn for each element.
LAYOUTS: dict[str, tuple[tuple[str, str], ...]] = {
    "turn rows": (("role", "text"),),
    "messages": (("messages[].role", "messages[].content"),),
    "messages with text": (("messages[].role", "messages[].text"),),
    "conversation pairs": (("conversations[].from", "conversations[].value"),),
    "prompt and completion": (("=user", "prompt"), ("=assistant", "completion")),
    "prompt and response": (("=user", "prompt"), ("=assistant", "response")),
    "system, prompt and response": (("=system", "system"), ("=user", "prompt"), ("=assistant", "response")),
    "question and answer": (("=user", "question"), ("=assistant", "answer")),
    "instruction": (("=user", "instruction"), ("=assistant", "output")),
    "instruction with input": (("=user", "instruction"), ("=user", "input"), ("=assistant", "output")),
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _paths(layout: tuple[tuple[str, str], ...]) -> set[str]:
    return {p for pair in layout for p in pair if not p.startswith("=")}


KNOWN_PATHS = frozenset().union(*(_paths(layout) for layout in LAYOUTS.values()))


def fingerprint(paths: Iterable[str]) -> str:
    """A hash of the field paths that any layout knows; others say nothing about the layout."""
    return hashlib.sha256("\n".join(sorted(KNOWN_PATHS.intersection(paths))).encode()).hexdigest()


MAPPINGS = {fingerprint(_paths(layout)): layout for layout in LAYOUTS.values()}
#: A field that any layout without one like it may have beside its own; it gives a turn before all others.
PREFACE = ("=system", "system")
_found: dict[str, tuple[tuple[str, str], ...] | None] = {}


def mapping(paths: Iterable[str]) -> tuple[tuple[str, str], ...] | None:
    """The layout of some field paths: that of their fingerprint, else the one with the most paths that are all there, the
    first of several; with the preface if its field is there too. Found once for each fingerprint."""
    paths = KNOWN_PATHS.intersection(paths)
    key = fingerprint(paths)
    if key in MAPPINGS:
        return MAPPINGS[key]
    if key not in _found:
        held = [layout for layout in LAYOUTS.values() if _paths(layout) <= paths]
        layout = max(held, key=lambda layout: len(_paths(layout))) if held else None
        if layout is not None and PREFACE[1] in paths - _paths(layout) and layout != LAYOUTS["turn rows"]:
            layout = (PREFACE, *layout)
        _found[key] = layout
    return _found[key]


def schema_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """The paths of all leaves of a schema."""
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from schema_paths(field.dataType, f"{at}.{field.name}" if at else field.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def value_paths(value, at: str = "") -> Iterator[str]:
    """The paths of all leaves of a parsed JSON value; null is a leaf."""
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from value_paths(inner, f"{at}.{key}" if at else key)
    elif isinstance(value, list):
        for inner in value:
            yield from value_paths(inner, f"{at}[]")
    else:
        yield at


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def record_turns(record) -> list[tuple[str, str]] | None:
    """The turns of a parsed record by its own fingerprint, None if no layout has it. A preface that is null is no turn."""
    layout = mapping(value_paths(record)) if isinstance(record, dict) else None
    if layout is None:
        return None
    if layout[0] == PREFACE and layout not in LAYOUTS.values() and record[PREFACE[1]] is None:
        layout = layout[1:]
    found = []
    for role, text in layout:
        if "[]" in text:
            key, inner_role, inner_text = text.split("[]")[0], role.split(".")[-1], text.split(".")[-1]
            for element in record[key]:
                name = _text(element.get(inner_role)) if isinstance(element, dict) else ""
                name = ROLES.get(name, name) if inner_role == "from" else name
                found.append((name, _text(element.get(inner_text) if isinstance(element, dict) else element)))
        else:
            name = role[1:] if role.startswith("=") else _text(record[role])
            found.append((name, _text(record[text])))
    return found


TURNS = "conv_id long, turn long, role string, text string, formed boolean"


def turns_from_json(records: DataFrame) -> DataFrame:
    """``records`` (conv_id: long, record: JSON text of any layout) to conv_id, turn, role, text, formed.

    Each record is mapped by its own fingerprint. A record that is null, not JSON or of no known layout gives one row
    with null turn, role and text and ``formed`` false, so nothing vanishes. Null texts are empty; other values are
    written as JSON.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, record in zip(batch.column("conv_id").to_pylist(), batch.column("record").to_pylist()):
                try:
                    turns = record_turns(json.loads(record or ""))
                except ValueError:
                    turns = None
                if turns is None:
                    rows.append((conv_id, None, None, None, False))
                else:
                    rows += [(conv_id, i, role, text, True) for i, (role, text) in enumerate(turns)]
            yield _rows(rows, TURNS)

    return records.selectExpr("cast(conv_id AS bigint) AS conv_id", "cast(record AS string) AS record").mapInArrow(
        run, TURNS
    )


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields]
    )


def turns_from_columns(df: DataFrame) -> DataFrame:
    """The turns of a table whose own schema is one of the layouts: conv_id, turn, role, text, formed.

    Rows by turn keep their ``turn`` column. A schema of no known layout is an error. Extra columns are ignored.
    """
    layout = mapping(schema_paths(df.schema))
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(schema_paths(df.schema))}")
    prefaced = layout[0] == PREFACE and layout not in LAYOUTS.values()
    if prefaced:
        layout = layout[1:]
    (first_role, first_text), *_ = layout

    def named(role, path):
        known = [F.when(role == old, new) for old, new in ROLES.items()] if path.endswith(".from") else []
        return F.coalesce(*known, role, F.lit(""))

    if "[]" in first_text:
        name, inner_role, inner_text = first_text.split("[]")[0], first_role.split(".")[-1], first_text.split(".")[-1]
        rows = df.select("conv_id", F.posexplode(name).alias("turn", "each"))
        role, text = F.col(f"each.{inner_role}"), F.col(f"each.{inner_text}")
        rows = rows.select("conv_id", "turn", named(role, first_role).alias("role"), text.alias("text"))
    elif not first_role.startswith("="):
        rows = df.select("conv_id", "turn", named(F.col(first_role), first_role).alias("role"), F.col(first_text).alias("text"))
    else:
        pairs = F.array(*[F.struct(F.lit(r[1:]).alias("role"), F.col(t).alias("text")) for r, t in layout])
        rows = df.select("conv_id", F.posexplode(pairs).alias("turn", "each")).select("conv_id", "turn", "each.*")
    if prefaced:
        first = df.filter(F.col(PREFACE[1]).isNotNull()).select(
            "conv_id", F.lit(0).alias("turn"), F.lit(PREFACE[0][1:]).alias("role"), F.col(PREFACE[1]).alias("text")
        )
        rows = rows.withColumn("turn", F.col("turn") + 1).unionByName(first)
    return rows.selectExpr(
        "cast(conv_id AS bigint) AS conv_id", "cast(turn AS bigint) AS turn", "role",
        "coalesce(cast(text AS string), '') AS text", "true AS formed",
    )


def escape(text: str) -> str:
    """No control string is left, and :func:`unescape` gives the text back."""
    return text.replace("<" + _MARK, "<" + _MARK * 2).replace("<|im_", f"<{_MARK}|im_")


def unescape(text: str) -> str:
    return text.replace(f"<{_MARK}|im_", "<|im_").replace("<" + _MARK * 2, "<" + _MARK)


def escape_role(role: str) -> str:
    """Like :func:`escape`, and without line breaks."""
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<|im_", "<\\|im_")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], role)


@dataclass(frozen=True)
class Template:
    """A turn is ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break. Loss is on the escaped
    text of ``loss_role``'s turns."""

    loss_role: str = "assistant"

    def head(self, role: str) -> str:
        return f"{START}{escape_role(role)}\n"


def unformed(turns: DataFrame) -> DataFrame:
    """conv_id of each record that :func:`turns_from_json` could not map; a row for each such record."""
    return turns.filter("NOT formed").select("conv_id")


FORMATTED = "conv_id long, place long, formatted string, loss_start long, loss_end long"


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Turns (conv_id, turn, role, text) to conv_id, place, formatted, loss_start, loss_end, one row for each turn.

    The rows of a conversation in the order of ``place`` make up its formatted text; loss_start and loss_end are code
    point offsets in that whole text, equal where a turn has no loss. Conversations are sorted, never gathered: a task
    holds one batch of turns, however long a conversation is. Equal turn numbers are ordered by role and text; null
    turn numbers come first; a null conv_id is a conversation of its own; null roles and texts are empty. Rows that are not
    ``formed`` stand for records without turns and are left out; :func:`unformed` lists them.
    """
    if "formed" in turns.columns:
        turns = turns.filter("formed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, offset = object(), 0, 0
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != current:
                    current, place, offset = conv_id, 0, 0
                role, text = role or "", escape(text or "")
                head = template.head(role)
                piece = f"{head}{text}{END}\n"
                start = offset + len(head)
                end = start + len(text) if role == template.loss_role else start
                rows.append((conv_id, place, piece, start, end))
                place, offset = place + 1, offset + len(piece)
            yield _rows(rows, FORMATTED)

    ordered = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """The digests of :func:`format_chats`' rows, parsed from the formatted text and the loss spans alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The rows of a conversation must be in order within a task, as ``format_chats`` leaves them; digests are carried
    from batch to batch.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def close():
            conv_id, turns, all_turns, loss, chars, length = state
            return conv_id, turns, all_turns.hexdigest(), chars, loss.hexdigest(), length

        for batch in batches:
            rows = []
            columns = ("conv_id", "formatted", "loss_start", "loss_end")
            for conv_id, piece, start, end in zip(*(batch.column(c).to_pylist() for c in columns)):
                if state is None or state[0] != conv_id:
                    if state is not None:
                        rows.append(close())
                    state = [conv_id, 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                loss = unescape(piece[start - state[5] : end - state[5]])
                for role, text in parse(piece):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                state[3].update(loss.encode())
                state[4] += len(loss)
                state[5] += len(piece)
            yield _rows(rows, schema)
        if state is not None:
            yield _rows([close()], schema)

    return formatted.mapInArrow(run, schema)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted text."""
    for piece in formatted.split(END + "\n")[:-1]:
        role, _, text = piece.removeprefix(START).partition("\n")
        yield unescape_role(role), unescape(text)
