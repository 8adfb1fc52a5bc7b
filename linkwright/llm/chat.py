"""Chat formatting with built-in functions only: schema fingerprints choose declarative mappings to canonical turns.

A record is a variant (parsed JSON, or a struct turned into one). Its nested field paths, sorted and without scalar
types, are hashed; the hash selects a mapping that says where turns, roles and texts lie. Turns are joined by a template
whose marks all begin with ``<``; texts and roles are escaped so that no ``<`` is left in them, and unescaped by the
reverse.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template.
BEGIN, SAYS, END = "<turn>", "<says>", "</turn>"


@dataclass(frozen=True)
class Said:
    """A turn at a fixed place: its role (a word, or the path of one) and the path of its text."""

    text: str
    role: str = ""
    role_path: str = ""


@dataclass(frozen=True)
class Listed:
    """Turns in a list: the path of the list, the field of role and text in each, and other names of roles."""

    path: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Mapping:
    """The layouts (sets of field paths) that a rule holds for, and the turns it makes, in order.

    Paths are written as in ``a.b`` and ``list[].field``. A ``Said`` without a text in a record makes no turn, unless
    it is the only one.
    """

    name: str
    layouts: tuple[tuple[str, ...], ...]
    turns: tuple[Said, ...] | Listed


_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))


def _listed(name: str, path: str, role: str, text: str, names: tuple[tuple[str, str], ...]) -> Mapping:
    """A list of turns; an empty or missing list has layouts of its own."""
    return Mapping(name, ((f"{path}[].{text}", f"{path}[].{role}"), (f"{path}[]",), (path,)), Listed(path, role, text, names))


#: Layouts that data sets for chat and instructions have.
MAPPINGS = (
    Mapping("message", (("role", "text"), ("role",), ("text",)), (Said("text", role_path="role"),)),
    Mapping("prompt", (("completion", "prompt"), ("prompt",)), (Said("prompt", "user"), Said("completion", "assistant"))),
    Mapping("prompt-response", (("prompt", "response"), ("prompt", "response", "system")),
            (Said("system", "system"), Said("prompt", "user"), Said("response", "assistant"))),
    Mapping("question", (("answer", "question"),), (Said("question", "user"), Said("answer", "assistant"))),
    Mapping("instruction", (("input", "instruction", "output"), ("instruction", "output")),
            (Said("instruction", "user"), Said("input", "user"), Said("output", "assistant"))),
    _listed("messages", "messages", "role", "content", _ROLES),
    _listed("conversations", "conversations", "from", "value", _ROLES),
)


def shape_text(paths: Iterable[str]) -> str:
    """The nested field paths of a layout as one text, sorted, as ``shape`` writes those of a record."""
    tree: dict = {}
    for path in paths:
        spot = tree
        for name in path.split("."):
            spot = spot.setdefault(name, {})

    def inside(fields: dict) -> str:
        parts = []
        for name in sorted(fields, key=lambda name: name.removesuffix("[]")):
            leaf = inside(fields[name]) if fields[name] else "?"
            parts.append(f"{name.removesuffix('[]')}: " + (f"ARRAY<{leaf}>" if name.endswith("[]") else leaf))
        return f"OBJECT<{', '.join(parts)}>"

    return inside(tree)


def shape(record: Column) -> Column:
    """The nested field paths of a variant as one text; scalar types are written as ``?``."""
    return F.regexp_replace(F.schema_of_variant(record), r"(?<=: |ARRAY<)[A-Z_]+(\([0-9,]+\))?(?=[,>]|$)", "?")


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant."""
    return F.sha2(shape(record), 256)


def fingerprints(mapping: Mapping) -> list[str]:
    """Hashes of the layouts that a mapping holds for."""
    return [hashlib.sha256(shape_text(paths).encode()).hexdigest() for paths in mapping.layouts]


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "string")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _turns(record: Column, mapping: Mapping) -> Column:
    how = mapping.turns
    if isinstance(how, Listed):
        def said(item: Column) -> Column:
            role = _text(item, how.role)
            named = reduce(lambda rest, pair: F.when(role == pair[0], pair[1]).otherwise(rest), how.names, role)
            return _turn(named, _text(item, how.text))

        listed = F.try_variant_get(record, f"$.{how.path}", "array<variant>")
        return F.coalesce(F.transform(listed, said), _no_turns())
    made = [_turn(_text(record, s.role_path) if s.role_path else F.lit(s.role), _text(record, s.text)) for s in how]
    if len(how) == 1:
        return F.array(*made)
    there = [F.when(_text(record, s.text).isNotNull(), F.array(turn)).otherwise(_no_turns())
             for s, turn in zip(how, made, strict=True)]
    return F.concat(*there)


def _no_turns() -> Column:
    return F.expr("cast(array() AS array<struct<role: string, text: string>>)")


def canonical_turns(records: DataFrame, record: str, mappings: Iterable[Mapping] = MAPPINGS) -> DataFrame:
    """``records`` with ``layout`` (name of the mapping that the fingerprint of variant column ``record`` selects) and ``turns``.

    ``turns`` is an array of (role, text); a missing role or text is empty. A record of an unknown layout, or a null one,
    keeps its row with a null ``layout`` and null ``turns``: count by ``shape`` to see what to declare. Columns named
    ``layout`` or ``turns`` are replaced, others pass through.
    """
    marked = records.drop("layout", "turns").withColumn("_print", fingerprint(F.col(record)))
    name, turns = F.lit(None).cast("string"), F.lit(None)
    for mapping in mappings:
        mine = F.col("_print").isin(fingerprints(mapping))
        name = F.when(mine, mapping.name).otherwise(name)
        turns = F.when(mine, _turns(F.col(record), mapping)).otherwise(turns)
    return marked.withColumn("layout", name).withColumn("turns", turns).drop("_print")


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\s`` and ``<`` becomes ``\l``, so that no mark of the template is left in the text."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The reverse of ``escape``."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def segments(turns: Column, loss_roles: Iterable[str] = ("assistant",)) -> Column:
    """The formatted conversation as an array of (text, loss); loss marks the texts of ``loss_roles`` and nothing else."""
    def pieces(turn: Column) -> Column:
        head = F.concat(F.lit(BEGIN), escape(turn["role"]), F.lit(SAYS))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), turn["role"].isin(*loss_roles).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))

    return F.flatten(F.transform(turns, pieces))


def formatted(of_segments: Column) -> Column:
    """All segments as one text."""
    return F.array_join(F.transform(of_segments, lambda s: s["text"]), "")


def loss_text(of_segments: Column) -> Column:
    """The texts under the loss mask, unescaped, one after the other."""
    masked = F.filter(of_segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def parsed(text: Column) -> Column:
    """The turns of a formatted text, read back."""
    bodies = F.slice(F.split(text, END), 1, F.size(F.split(text, END)) - 1)

    def turn(body: Column) -> Column:
        parts = F.split(F.substring(body, len(BEGIN) + 1, 2_147_483_647), SAYS)
        return F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(bodies, turn)


def conversations(messages: DataFrame, mappings: Iterable[Mapping] = MAPPINGS) -> DataFrame:
    """One row per conversation from rows by turn (conv_id, turn, record): conv_id, turns, segments, formatted.

    Records may hold one turn or several; they are ordered by ``turn``, rows of one turn number by their own turns. Records
    of unknown layouts give no turns. Rows with a null conv_id are one conversation. A conversation becomes one text, so it
    is gathered in one row; a row may take up to 2 GB.
    """
    made = canonical_turns(messages, "record", mappings)
    grouped = made.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "turns"))).alias("rows"))
    turns = F.flatten(F.transform("rows", lambda r: F.coalesce(r["turns"], _no_turns())))
    return (grouped.select("conv_id", turns.alias("turns"))
            .withColumn("segments", segments(F.col("turns"))).withColumn("formatted", formatted(F.col("segments"))))


def message_records(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, record) from a table of role and text by turn."""
    record = F.to_variant_object(F.struct(F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")))
    return rows.select("conv_id", "turn", record.alias("record"))


def report(rows: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations of a table (conv_id, turn, role, text).

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of every turn), loss_chars and loss_sha256 (code points
    and digest of all text under the loss mask, unescaped), formatted_chars. A null role or text is empty; equal rows count
    as often as they come; other columns are not read; an empty table gives no rows.
    """
    talks = conversations(message_records(rows))
    back = F.transform(parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = loss_text(F.col("segments"))
    return talks.select(
        "conv_id", F.size(parsed(F.col("formatted"))).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(back, ""), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("bigint").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))
