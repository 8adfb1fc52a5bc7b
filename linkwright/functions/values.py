"""Typed casts, timestamps, property maps and JSON record access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkwright.functions.text import blank_to_null


def typed(value: Column, kind: str) -> Column:
    """Cast a raw text; blank or unreadable text gives null."""
    return blank_to_null(value).try_cast(kind)


def real_change(old: Column, new: Column) -> Column:
    """Different values, where null and the empty text are the same."""
    blank = F.lit("")
    return F.coalesce(old.cast("string"), blank) != F.coalesce(new.cast("string"), blank)


def utc_text(stamp: Column) -> Column:
    """``2023-10-27T10:30:00Z``, shorter and undashed forms of it and two forms without ``Z`` as ``2023-10-27 10:30:00 UTC``; other text unchanged.

    With a ``Z`` the text is an ISO moment in UTC; without one, a fraction is cut off and the rest
    must be a plain date and time. Parsed without a zone, so the session zone does not matter.
    """
    plain = r"\A\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\z"
    zulu = r"\A\d{4}-\d{2}-\d{2}.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?Z\z"
    basic = r"\A(\d{4})(\d{2})(\d{2}).(\d{2})(\d{2})?(\d{2})?(?:[.,]\d+)?Z\z"
    dashed = F.concat_ws("-", *[F.regexp_extract(stamp, basic, k) for k in (1, 2, 3)])
    timed = F.concat_ws(":", *[F.coalesce(F.nullif(F.regexp_extract(stamp, basic, k), F.lit("")), F.lit("00")) for k in (4, 5, 6)])
    cut = F.split_part(stamp, F.lit("."), F.lit(1))
    moment = (
        F.when(F.contains(stamp, F.lit("Z")),
               F.when(stamp.rlike(zulu), F.concat(F.left(stamp, F.lit(10)), F.lit(" "),
                                                  F.left(F.concat(F.regexp_extract(stamp, r"\A.{11}([0-9:]+)", 1), F.lit(":00:00")), F.lit(8))))
               .when(stamp.rlike(basic), F.concat(dashed, F.lit(" "), timed)))
        .when(cut.rlike(plain), F.replace(cut, F.lit("T"), F.lit(" ")))
    )
    read = moment.try_cast("timestamp_ntz").cast("string")
    return F.coalesce(F.concat(F.left(read, F.lit(19)), F.lit(" UTC")), stamp)


def property_map(columns: Sequence[str], null_text: str | None = None) -> Column:
    """Map of column name to text value. Null values are left out, or stored as ``null_text``."""
    pairs: list[Column] = []
    for name in columns:
        text = F.col(name).cast("string")
        pairs += [F.lit(name), text if null_text is None else F.coalesce(text, F.lit(null_text))]
    if not pairs:
        return F.create_map().cast("map<string,string>")
    built = F.create_map(*pairs)
    return built if null_text is not None else F.map_filter(built, lambda _, v: v.isNotNull())


def map_lines(props: Column) -> Column:
    """``key: value`` lines of a map, keys sorted."""
    entries = F.sort_array(F.map_entries(props))  # compares without an expression per comparison
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


# --- JSON records -------------------------------------------------------------------------------
# JSON texts that count as false when a flag is tested.
FALSE_TOKENS = ["false", "null", "0", "-0", "0.0", '""', "[]", "{}"]


def json_record(document: Column) -> Column:
    """The fields of a JSON object in order, each as value and as written; null for broken text and for anything but an object.

    A present null field differs from a missing one. The document is parsed for the values and for the texts, once each, however
    many fields are asked for; keep the record in a column.
    """
    values = F.map_entries(F.from_json(document, "map<string,variant>"))
    texts = F.map_entries(F.from_json(document, "map<string,string>"))
    return F.zip_with(values, texts, lambda v, t: F.struct(v["key"].alias("key"), v["value"].alias("value"), t["value"].alias("text")))


def has_key(record: Column, *names: str) -> Column:
    listed = F.transform(record, lambda f: f["key"])
    found = F.lit(True)
    for name in names:
        found = found & F.array_contains(listed, name)
    return found


def field(record: Column, name: str) -> Column:
    """The value of a field; of repeated names the last one counts."""
    return _entry(record, name)["value"]


def _entry(record: Column, name: str) -> Column:
    return F.try_element_at(F.filter(record, lambda f: f["key"] == name), F.lit(-1))


def flag(record: Column, name: str) -> Column:
    """Whether a field is present and not empty, zero, false or null."""
    return ~F.coalesce(F.to_json(field(record, name)), F.lit("null")).isin(*FALSE_TOKENS)


def field_text(record: Column, name: str) -> Column:
    """The printed value of a present field: text as it is, ``None`` for null, ``True``/``False``, lists as ``[1, 'a']``.

    Numbers, also those in lists, are printed as the document has them, which tells 1.0 from 1.
    """
    value, written = field(record, name), _entry(record, name)["text"]
    return _printed(value, F.coalesce(F.to_json(value), F.lit("null")), written)


def _printed(value: Column, json: Column, written: Column) -> Column:
    return (F.when(json.startswith('"'), value.cast("string")).when(json == "null", "None")
            .when(json.isin("true", "false"), F.initcap(json))
            .when(json.startswith("[") | json.startswith("{"), nested_text(written)).otherwise(written))


def printed_fields(record: Column, names: Sequence[str]) -> Column:
    """The named fields of a record, in order, each with its JSON text (``json``) and its printed value (``text``).

    Every value is turned to JSON and printed once, however often it is asked for; keep the result in a column.
    """
    asked = F.filter(record, lambda f: f["key"].isin(*names))
    judged = F.transform(asked, lambda f: F.struct(
        f["key"].alias("key"), f["value"].alias("value"), f["text"].alias("text"), F.coalesce(F.to_json(f["value"]), F.lit("null")).alias("json")))
    return F.transform(judged, lambda f: F.struct(
        f["key"].alias("key"), f["json"].alias("json"), _printed(f["value"], f["json"], f["text"]).alias("text")))


def printed_flag(printed: Column, name: str) -> Column:
    """``flag`` of a field of ``printed_fields``."""
    return ~F.coalesce(_entry(printed, name)["json"], F.lit("null")).isin(*FALSE_TOKENS)


def first_printed(printed: Column, names: Sequence[str], default: str) -> Column:
    """``first_present`` from ``printed_fields``."""
    choice = F.lit(default)
    for name in reversed(names):
        entry = _entry(printed, name)
        choice = F.when(entry.isNotNull(), entry["text"]).otherwise(choice)
    return choice


def nested_text(json: Column) -> Column:
    """A JSON list or object in the way of ``[1, 'a', None, {'k': True}]``."""
    marks = F.regexp_extract_all(json, F.lit(r'"(?:[^"\\]|\\.)*"|true|false|null|[,:]|[^",:tfn]+'), F.lit(0))

    def printed(token: Column) -> Column:
        inner = F.replace(F.substring(token, F.lit(2), F.length(token) - 2), F.lit('\\"'), F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(inner, F.lit("'"), F.lit("\\'")), F.lit("'"))
        double = F.concat(F.lit('"'), inner, F.lit('"'))
        quoted = F.when(F.contains(inner, F.lit("'")) & ~F.contains(inner, F.lit('"')), double).otherwise(
            F.when(F.contains(inner, F.lit("'")), single).otherwise(F.concat(F.lit("'"), inner, F.lit("'"))))
        return (F.when(token.startswith('"'), quoted).when(token.isin("true", "false"), F.initcap(token))
                .when(token == "null", "None").when(token.isin(",", ":"), F.concat(token, F.lit(" "))).otherwise(token))

    return F.array_join(F.transform(marks, printed), "")


def first_present(record: Column, names: Sequence[str], default: str) -> Column:
    """Printed value of the first field that is present, even if null; else the default."""
    choice = F.lit(default)
    for name in reversed(names):
        choice = F.when(has_key(record, name), field_text(record, name)).otherwise(choice)
    return choice
