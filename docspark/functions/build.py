"""Building XML and JSON documents from delimited rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The XML 1.1 name character ranges (W3C recommendation, productions 4 and 4a).
_NAME_START = (
    ":A-Z_a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02ff\u0370-\u037d\u037f-\u1fff\u200c-\u200d"
    "\u2070-\u218f\u2c00-\u2fef\u3001-\ud7ff\uf900-\ufdcf\ufdf0-\ufffd"
)
_NAME_REST = _NAME_START + "\\-.0-9\u00b7\u0300-\u036f\u203f-\u2040"


def valid_name(name: str) -> str:
    """An element name for a header: bad first character gets ``_`` before it, other bad ones become ``_``."""
    if not name:
        return name
    body = re.sub(f"[^{_NAME_REST}]", "_", name)
    return body if re.match(f"[{_NAME_START}]", name) else "_" + body


def xml_valid_name(name: Column) -> Column:
    """Column form of :func:`valid_name`."""
    body = F.regexp_replace(name, f"[^{_NAME_REST}]", "_")
    return F.when(name.rlike(f"^[{_NAME_START}]") | (name == ""), body).otherwise(F.concat(F.lit("_"), body))


def row_to_xml(columns: Mapping[str, Column], root: str = "root") -> Column:
    """``<root><name><![CDATA[value]]></name>...</root>``; columns with a blank name are left out."""
    parts: list[Column] = [F.lit(f"<{root}>")]
    for name, value in columns.items():
        if not name.strip():
            continue
        tag = valid_name(name)
        parts += [F.lit(f"<{tag}><![CDATA["), F.coalesce(value.cast("string"), F.lit("")), F.lit(f"]]></{tag}>")]
    return F.concat(*parts, F.lit(f"</{root}>"))


def pairs_to_xml(names: str, values: str, root: str = "root") -> Column:
    """:func:`row_to_xml` of an array of element names and one of values."""
    each = F.zip_with(names, values, lambda n, v: F.concat(F.lit("<"), n, F.lit("><![CDATA["), F.coalesce(v, F.lit("")), F.lit("]]></"), n, F.lit(">")))
    return F.concat(F.lit(f"<{root}>"), F.array_join(each, ""), F.lit(f"</{root}>"))


def _type_option(option: str | Mapping[str, str] | None) -> Mapping[str, str]:
    if isinstance(option, str):
        flat = [p.strip() for p in option.split(",")]
        if len(flat) % 2:
            raise ValueError("data types need pairs of column name and type")
        option = dict(zip(flat[::2], flat[1::2]))
    return option or {}


def parse_data_types(option: str | Mapping[str, str] | None, fields: Sequence[str]) -> dict[str, str]:
    """``zip,Number,sold,Boolean`` to a type per field, default String."""
    types = {f: "string" for f in fields}
    for name, kind in _type_option(option).items():
        if name not in types:
            raise ValueError(f"Column name {name} not found.")
        if kind.lower() not in ("string", "number", "boolean"):
            raise ValueError(f"no such kind of column: {kind}")
        types[name] = kind.lower()
    return types


_NUMBER = r"^-?(?:[0-9][0-9,]*\.?[0-9]*|\.[0-9]+)(?:E-?[0-9]+)?"


def number_text(value: Column, lenient: bool = False) -> Column:
    """JSON number for a locale-formatted number, null when it is none.

    Grouping commas are accepted; ``lenient`` also accepts trailing text after a numeric prefix.
    Integral numbers are written without a fraction.
    """
    found = F.regexp_extract(value, _NUMBER if lenient else _NUMBER + "$", 0)
    plain = F.replace(found, F.lit(","), F.lit(""))
    as_double = plain.try_cast("double")
    as_long = F.when(plain.rlike(r"^-?[0-9]+$"), plain.try_cast("bigint"))
    integral = (as_double == F.floor(as_double)) & (F.abs(as_double) < F.lit(9.0e18))
    return F.when(found == "", F.lit(None).cast("string")).otherwise(
        F.coalesce(
            as_long.cast("string"),
            F.when(integral, as_double.cast("bigint").cast("string")),
            as_double.cast("string"),
        )
    )


def type_error(value: Column, kind: str, lenient: bool = False) -> Column:
    """``Value v is not type T`` or null; an empty value is no error, its key is left out."""
    if kind == "number":
        bad = (value != "") & number_text(value, lenient).isNull()
    elif kind == "boolean":
        bad = (value != "") & ~F.lower(value).isin("true", "false")
    else:
        return F.lit(None).cast("string")
    return F.when(bad, F.concat(F.lit("Value "), value, F.lit(f" is not type {kind.upper()}")))


def row_to_json(
    columns: Mapping[str, Column], types: Mapping[str, str] | str | None = None, lenient: bool = False
) -> tuple[Column, Column]:
    """(JSON object text, skip reason) for a row of strings and a type per column."""
    kinds = parse_data_types(types, list(columns))
    fields, errors = [], []
    for name, value in columns.items():
        if not name.strip():
            continue
        value = F.coalesce(value.cast("string"), F.lit(""))
        kind = kinds[name]
        if kind == "number":
            # a VARIANT keeps 98 and 98.5 as written inside one struct
            fields.append(F.try_parse_json(number_text(value, lenient)).alias(name))
        elif kind == "boolean":
            fields.append(F.when(value != "", F.lower(value).try_cast("boolean")).alias(name))
        else:
            fields.append(value.alias(name))
        errors.append(type_error(value, kind, lenient))
    return F.to_json(F.struct(*fields)), F.coalesce(*errors)


def pairs_to_json(
    names: str, values: str, types: Mapping[str, str] | str | None = None, lenient: bool = False
) -> tuple[Column, Column]:
    """:func:`row_to_json` of an array of names and one of values; a type that does not fit the names is a skip reason."""
    null = F.lit(None).cast("string")
    try:
        option = _type_option(types)
    except ValueError as e:
        return null, F.lit(str(e))
    wrong = [null]
    for name, kind in option.items():
        missing = ~F.array_contains(names, F.lit(name))
        wrong.append(F.when(missing, F.lit(f"Column name {name} not found.")))
        if kind.lower() not in ("string", "number", "boolean"):
            wrong.append(F.lit(f"no such kind of column: {kind}"))
    of = {k: [n for n, kind in option.items() if kind.lower() == k] for k in ("number", "boolean")}

    def inner(value: Column) -> Column:
        """The JSON text of a value, null if it has none."""
        whole = F.to_json(F.struct(value.alias("v")))
        return F.when(whole != "{}", F.substring(whole, 6, F.char_length(whole) - 6))

    def typed(name: Column, other: Column, number: Column, boolean: Column) -> Column:
        for kind, column in (("number", number), ("boolean", boolean)):
            if of[kind]:
                other = F.when(name.isin(of[kind]), column).otherwise(other)
        return other

    def field(name: Column, value: Column) -> Column:
        value = F.coalesce(value, F.lit(""))
        number = inner(F.try_parse_json(number_text(value, lenient)))
        boolean = F.when(value != "", F.lower(value).try_cast("boolean").cast("string"))
        return F.concat(inner(name), F.lit(":"), typed(name, inner(value), number, boolean))

    def error(name: Column, value: Column) -> Column:
        return typed(name, null, type_error(value, "number", lenient), type_error(value, "boolean"))

    fields = F.array_join(F.zip_with(names, values, field), ",")
    errors = F.get(F.filter(F.zip_with(names, values, error), lambda e: e.isNotNull()), F.lit(0))
    return F.concat(F.lit("{"), fields, F.lit("}")), F.coalesce(*wrong, errors)
