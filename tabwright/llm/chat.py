"""Chat formatting: records of many layouts become canonical turns, and those one text.

A record is a JSON object. Its schema is the set of its nested field paths, with ``[]`` for
the elements of a list; the hash of the sorted paths is its fingerprint. A ``Layout`` says
declaratively which paths it consists of and where roles and texts are, so the fingerprints
it accepts are worked out once, and a record finds its layout by one lookup.

A ``Template`` marks each turn. Inside roles and texts a backslash follows the first
character of every control string, and backslashes are doubled: no control string is left
there, and taking one backslash off each ``\\x`` restores the text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.support import prepare

TURN_FIELDS = "conv_id string, at long, ordinal int, role string, text string, layout string, fingerprint string"
DIGEST_FIELDS = (
    "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of all scalars and empty containers in a JSON value."""
    if isinstance(value, dict) and value:
        return set().union(*[field_paths(v, f"{at}.{_quoted(k)}" if at else _quoted(k)) for k, v in value.items()])
    if isinstance(value, list) and value:
        return set().union(*[field_paths(v, f"{at}[]") for v in value])
    return {at + ("{}" if isinstance(value, dict) else "[]" if isinstance(value, list) else "")}


def _quoted(name: str) -> str:
    return name if re.fullmatch(r"\w+", name) else json.dumps(name)


def fingerprint(paths: set[str]) -> str:
    return xxhash.xxh3_64_hexdigest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"))


@dataclass(frozen=True)
class Part:
    """One turn from a field: its text, under a fixed role or the role of another field."""

    text: str
    role: str | None = None
    role_path: str | None = None


@dataclass(frozen=True)
class Listed:
    """Turns from a list of objects with a role and a text field; roles may be renamed."""

    path: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its conversation, its place in it, and its turns.

    Fields of ``parts`` that are in ``optional`` may be missing, as may ``conversation`` and
    ``at``. A part whose text field is in ``joined`` is continued by that field's text.
    """

    name: str
    conversation: str
    at: str
    parts: tuple[Part | Listed, ...]
    optional: frozenset[str] = frozenset()
    joined: tuple[tuple[str, str], ...] = ()

    def path_sets(self) -> Iterator[set[str]]:
        """Every set of paths that a record of the layout may have."""
        needed: list[set[str]] = [set()]
        for part in self.parts:
            if isinstance(part, Listed):
                filled = {f"{part.path}[].{part.role}", f"{part.path}[].{part.text}"}
                needed = [s | more for s in needed for more in (filled, {f"{part.path}[]"})]
            else:
                own = {part.text, part.role_path} - {None} - self.optional
                needed = [s | own for s in needed]
        maybe = sorted({self.conversation, self.at} | self.optional)
        subsets = list(chain.from_iterable(combinations(maybe, n) for n in range(len(maybe) + 1)))
        texts = {p.text for p in self.parts if isinstance(p, Part)} | {p.path for p in self.parts if isinstance(p, Listed)}
        for paths in needed:
            for more in subsets:
                found = paths | set(more)
                if any(p.split("[]")[0] in texts for p in found):
                    yield found

    def turns(self, record: dict) -> list[tuple[str, str]] | None:
        """(role, text) of each turn; None where a value is not of the kind the layout has there."""
        out = []
        for part in self.parts:
            if isinstance(part, Listed):
                for each in _get(record, part.path):
                    if not isinstance(each, dict):
                        return None
                    role = _string(_get(each, part.role))
                    out.append((part.roles.get(role, role), _string(_get(each, part.text))))
            elif _has(record, part.text):
                more = [_string(_get(record, b)) for a, b in self.joined if a == part.text and _has(record, b)]
                text = "\n\n".join([_string(_get(record, part.text)), *[m for m in more if m]])
                out.append((part.role if part.role_path is None else _string(_get(record, part.role_path)), text))
        return out


def _has(record: dict, path: str) -> bool:
    *outer, last = path.split(".")
    for name in outer:
        record = record.get(name) if isinstance(record, dict) else None
    return isinstance(record, dict) and last in record


def _get(record: dict, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _string(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


LAYOUTS = (
    Layout("turn", "conv_id", "turn", (Part("text", role_path="role"),)),
    Layout("messages", "id", "index", (Listed("messages", "role", "content"),)),
    Layout(
        "conversations", "id", "index",
        (Listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),),
    ),
    Layout(
        "prompt", "id", "index", (Part("system", "system"), Part("prompt", "user"), Part("response", "assistant")),
        frozenset({"system", "prompt", "response"}),
    ),
    Layout("completion", "id", "index", (Part("prompt", "user"), Part("completion", "assistant"))),
    Layout(
        "instruction", "id", "index", (Part("system", "system"), Part("instruction", "user"), Part("output", "assistant")),
        frozenset({"system", "input"}), (("instruction", "input"),),
    ),
    Layout("nested", "meta.id", "meta.index", (Listed("chat.turns", "author.role", "body"),)),
)


def layout_table(layouts: Sequence[Layout] = LAYOUTS) -> dict[str, Layout]:
    """Layout by fingerprint; two layouts that share one cannot be told apart."""
    table: dict[str, Layout] = {}
    for layout in layouts:
        for paths in layout.path_sets():
            if table.setdefault(fingerprint(paths), layout) is not layout:
                raise ValueError(f"layouts {layout.name} and {table[fingerprint(paths)].name} share {sorted(paths)}")
    return table


def converted(text: str | None, table: dict[str, Layout]) -> tuple[str | None, str | None, tuple | None]:
    """Fingerprint, layout and (conversation, place, turns) of a record; None where unknown."""
    try:
        record = json.loads(text) if text is not None else None
    except ValueError:
        return None, None, None
    mark = fingerprint(field_paths(record))
    layout = table.get(mark) if isinstance(record, dict) else None
    if layout is None:
        return mark, None, None
    conversation, at, turns = _get(record, layout.conversation), _get(record, layout.at), layout.turns(record)
    known = at is None or isinstance(at, int) and not isinstance(at, bool) and -(2**63) <= at < 2**63
    if turns is None or not known:
        return mark, None, None
    try:
        "".join(chain.from_iterable(turns)).encode()
    except UnicodeEncodeError:
        return mark, None, None
    return mark, layout.name, (None if conversation is None else _string(conversation), at, turns)


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, at, ordinal, role, text, layout and fingerprint of every turn of JSON records.

    ``at`` is the record's place in its conversation and ``ordinal`` the turn's place in the
    record. Null roles and texts are empty, other values count as their JSON text. A record
    that is null, no JSON, of an unknown layout or with values of another kind is one row
    with a null layout and its whole text, so nothing is lost; its fingerprint says what
    layout to add. Repeated records repeat. Other columns are not read; an empty table gives
    no rows.
    """
    prepare(records.sparkSession)
    table = layout_table(layouts)
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
    names = [f.split()[0] for f in TURN_FIELDS.split(", ")]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                mark, layout, found = converted(text, table)
                if found is None:
                    rows.append((None, None, None, None, text, None, mark))
                else:
                    conversation, at, turns = found
                    rows += [(conversation, at, i, role, said, layout, mark) for i, (role, said) in enumerate(turns)]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return records.select(F.col(record_col).cast("string")).mapInArrow(convert, TURN_FIELDS)


@dataclass(frozen=True)
class Template:
    """A turn is opening + role + head_end + text + closing, role and text escaped."""

    opening: str = "<turn "
    head_end: str = ">\n"
    closing: str = "</turn>\n"
    reserved: tuple[str, ...] = ("<turn", "</turn")

    def controls(self) -> tuple[str, ...]:
        """What no escaped role or text contains."""
        return tuple(dict.fromkeys([*self.reserved, self.head_end, self.closing]))

    def __post_init__(self) -> None:
        for control in self.controls():
            # A text's last characters must not make a mark with the first ones behind them.
            read = control in (self.head_end, self.closing)
            borders = [i for i in range(1, len(control)) if read and control[:i] == control[-i:]]
            if len(control) < 2 or "\\" in control or borders:
                raise ValueError(f"{control!r} must have two characters or more, no backslash and, if read, no border")

    def _pattern(self) -> str:
        return "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls())

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({self._pattern()})", r"$1\\")

    def escape(self, text: str) -> str:
        return re.sub(f"({self._pattern()})", r"\1\\", text.replace("\\", "\\\\"))

    def read(self, piece: str) -> list[tuple[str, str]]:
        """(role, text) of the turns in a formatted text."""
        turns, at = [], 0
        while at < len(piece):
            head = piece.index(self.head_end, at)
            end = piece.index(self.closing, head)
            turns.append((unescape(piece[at + len(self.opening) : head]), unescape(piece[head + len(self.head_end) : end])))
            at = end + len(self.closing)
        return turns


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def format_turns(
    turns: DataFrame, template: Template = Template(), loss_roles: Sequence[str] = ("assistant",), keep: Sequence[str] = ()
) -> DataFrame:
    """conv_id, at, ordinal, piece, loss_start and loss_length of every known turn.

    The pieces of a conversation, by at (null first), ordinal and piece, joined without
    anything between, are its formatted text. The loss mask covers ``loss_length`` code
    points of the piece from ``loss_start`` on: the escaped text of turns whose role is in
    ``loss_roles``, nothing (0, 0) of others. Rows without a layout are left out.
    """
    known = turns.filter("layout is not null")
    role, text = template.escaped(F.col("role")), template.escaped(F.col("text"))
    parts = known.select("conv_id", "at", "ordinal", "role", role.alias("head"), text.alias("body"), *keep)
    piece = F.concat(F.lit(template.opening), "head", F.lit(template.head_end), "body", F.lit(template.closing))
    start = F.length("head") + len(template.opening) + len(template.head_end)
    learnt = F.col("role").isin(list(loss_roles))
    return parts.select(
        "conv_id", "at", "ordinal", piece.alias("piece"),
        F.when(learnt, start).otherwise(0).alias("loss_start"),
        F.when(learnt, F.length("body")).otherwise(0).alias("loss_length"), *keep,
    )


class Digest:
    """Running digests of one conversation, read back from its formatted pieces."""

    def __init__(self, conv_id: str | None) -> None:
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def take(self, template: Template, piece: str, start: int, length: int) -> None:
        for role, text in template.read(piece):
            self.turns += 1
            self.turn_digest.update(f"{role}\n{text}\n".encode())
        learnt = unescape(piece[start : start + length])
        self.loss_digest.update(learnt.encode())
        self.loss_chars += len(learnt)
        self.chars += len(piece)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.turn_digest.hexdigest(), self.loss_chars, self.loss_digest.hexdigest(), self.chars
        )


def formatted_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """A row per conversation of formatted pieces, with digests of what is read back from them.

    Pieces stream past sorted, so a conversation of any length needs the memory of a piece.
    Null ids are one conversation.
    """
    prepare(formatted.sparkSession)
    schema = pa.schema(
        [(c, pa.string() if c in ("conv_id", "turns_sha256", "loss_sha256") else pa.int64())
         for c in (f.split()[0] for f in DIGEST_FIELDS.split(", "))]
    )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for conv_id, *piece in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.row())
                    now = Digest(conv_id)
                now.take(template, *piece)
            yield table(out)
        if now is not None:
            yield table([now.row()])

    order = ["conv_id", F.asc_nulls_first("at"), "ordinal", "piece"]
    dealt = formatted.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "piece", "loss_start", "loss_length").mapInArrow(digests, DIGEST_FIELDS)
