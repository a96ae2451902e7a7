"""Rendering of records to text, and digests of that text.

Two rows are equal when the MD5 of their rendered text is equal, so the exact
text matters. There are three renderings:

``labelled``  ``Id:1|Name:a|Val:x`` from plain columns; null prints ``null``.
``json``      the JSON text of each field followed by ``|``. Strings keep their
              quotes, so ``1`` and ``"1"`` differ; a missing field and a JSON
              null both print ``null``.
``text``      the text of string fields followed by ``|``; anything that is not
              a string prints nothing.

JSON records are held as two columns: the text as received and the same parsed
once to a variant, which is null if the text is malformed. All functions return plain column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE = "value"
VARIANT = "v"


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _check_name(name: str) -> str:
    if not name or any(mark in name for mark in "'\"?\\"):
        raise ValueError(f"field name cannot be addressed by a JSON path: {name!r}")
    return name


def _part(name: str, variant: str) -> str:
    return f"try_variant_get({_quoted(variant)}, '$[\"{_check_name(name)}\"]', 'variant')"


def _raw(name: str, value: str) -> str:
    """JSON text of a field, strings unquoted; null when missing or null."""
    return f"get_json_object({_quoted(value)}, '$[\\'{_check_name(name)}\\']')"


def _malformed(value: str) -> str:
    """What a record that is no JSON prints for any field: its whole text, marked.

    So two of them agree only if their texts do. No JSON text begins like this.
    """
    return f"concat('malformed:', coalesce({_quoted(value)}, ''))"


def parse_record(value: str | Column = VALUE, strict: bool = True) -> Column:
    """Parse JSON text to a variant; malformed text fails or gives null."""
    return F.parse_json(value) if strict else F.try_parse_json(value)


def json_field(name: str, value: str = VALUE, variant: str = VARIANT) -> Column:
    """JSON text of one field of a record, ``null`` when missing.

    A variant drops trailing zeros and reorders object keys, so only the kinds it
    prints unchanged are taken from it. The others are cut from the text.
    """
    part = _part(name, variant)
    return F.expr(
        f"""case when {_quoted(variant)} is null then {_malformed(value)}
            when schema_of_variant({part}) in ('STRING', 'BIGINT', 'BOOLEAN')
              then to_json({part})
            when coalesce(schema_of_variant({part}), 'VOID') = 'VOID' then 'null'
            else coalesce({_raw(name, value)}, 'null') end"""
    )


def _sorted_maps(c: str, kind: T.DataType, depth: int = 0) -> str:
    """The value with the entries of its maps in order of their keys, nested ones too.

    A map keeps its entries as they came, so equal maps could print differently.
    """
    if isinstance(kind, T.MapType):
        e = f"e{depth}"
        value = _sorted_maps(f"{e}.value", kind.valueType, depth + 1)
        entries = f"transform(array_sort(map_keys({c})), {e}k -> struct({e}k as key, {c}[{e}k] as value))"
        return f"map_from_entries(transform({entries}, {e} -> struct({e}.key as key, {value} as value)))"
    if isinstance(kind, T.ArrayType):
        value = _sorted_maps(f"e{depth}", kind.elementType, depth + 1)
        return c if value == f"e{depth}" else f"transform({c}, e{depth} -> {value})"
    if isinstance(kind, T.StructType):
        parts = [(f.name, f"{c}.{_quoted(f.name)}", f.dataType) for f in kind.fields]
        sorted_parts = [(n, p, _sorted_maps(p, k, depth)) for n, p, k in parts]
        if all(p == s for _, p, s in sorted_parts):
            return c
        inner = ", ".join(f"{s} as {_quoted(n)}" for n, _, s in sorted_parts)
        return f"if({c} is null, null, struct({inner}))"
    return c


def column_field(name: str, kind: T.DataType) -> Column:
    """The same rendering for a typed column: quoted text, bare numbers."""
    c = _quoted(name)
    if isinstance(kind, T.StringType):
        # Only text with a quote, a backslash or a control character needs escapes.
        escaped = f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)"
        special = r"""'["\\\\\\x00-\\x1f]'"""
        text = f"if({c} rlike {special}, {escaped}, concat('\"', {c}, '\"'))"
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        text = f"cast({c} as string)"
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = f"to_json({_sorted_maps(c, kind)})"
    else:
        text = f"concat('\"', cast({c} as string), '\"')"
    return F.expr(f"if({c} is null, 'null', {text})")


def is_records(df: DataFrame) -> bool:
    """Whether a frame holds JSON records: its column ``v`` is a variant."""
    return any(f.name == VARIANT and isinstance(f.dataType, T.VariantType) for f in df.schema.fields)


def field_texts(df: DataFrame, fields: Sequence[str]) -> list[Column]:
    """``json`` rendering of each field of a JSON record frame or a plain table."""
    if is_records(df):
        return [json_field(name) for name in fields]
    # Names are resolved as the session resolves them.
    own = [df.select(df[_quoted(name)]).schema[0] for name in fields]
    return [column_field(f.name, f.dataType) for f in own]


def render_json(texts: Sequence[Column]) -> Column:
    """Each rendered field followed by a bar."""
    return F.concat(*[part for text in texts for part in (text, F.lit("|"))])


def render_labelled(columns: Mapping[str, str | Column]) -> Column:
    """``Label:value`` joined by bars, from label to column."""
    return F.concat_ws(
        "|",
        *[
            F.concat(
                F.lit(f"{label}:"),
                F.coalesce(
                    (F.col(c) if isinstance(c, str) else c).cast("string"),
                    F.lit("null"),
                ),
            )
            for label, c in columns.items()
        ],
    )


def render_text(
    fields: Sequence[str], key: bool = False, value: str = VALUE, variant: str = VARIANT
) -> Column:
    """Text of string fields only.

    With ``key`` the field name comes before its text, and a field that is
    present without being a string prints ``null`` instead of nothing.
    """
    parts: list[Column] = []
    for name in fields:
        kind = f"schema_of_variant({_part(name, variant)})"
        other = f"when {kind} is not null then 'null' else ''" if key else "else ''"
        text = F.expr(
            f"case when {_quoted(variant)} is null then {_malformed(value)} "
            f"when {kind} = 'STRING' then {_raw(name, value)} {other} end"
        )
        parts += [F.lit(f"{name}|"), text] if key else [text]
        parts.append(F.lit("|"))
    return F.concat(*parts)


def key_text(df: DataFrame, key_fields: Sequence[str]) -> Column:
    """Key values as plain text joined by bars, for display."""
    if is_records(df):
        texts = [
            f"if({_quoted(VARIANT)} is null, {_malformed(VALUE)}, {_raw(name, VALUE)})"
            for name in key_fields
        ]
    else:
        texts = [f"cast({_quoted(name)} as string)" for name in key_fields]
    return F.expr(f"concat_ws('|', {', '.join(f'coalesce({t}, \'null\')' for t in texts)})")


def digest(text: Column) -> Column:
    """Lower-case MD5 hex of a rendered record.

    A rendering is never null. Saying so keeps a join on the digest from testing
    it for null, and so from rendering every record once more.
    """
    return F.coalesce(F.md5(text), F.lit(""))


def record_text(columns: Sequence[str | Column]) -> Column:
    """A record as one output line: ``(a,b,c)``, null prints ``null``."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null"))
        for c in columns
    ]
    return F.concat(F.lit("("), F.concat_ws(",", *texts), F.lit(")"))
