"""JSON text: validity, tolerant typed parsing and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json_object(text: Column) -> Column:
    """True for exactly one well-formed JSON object.

    White space around it and repeated keys are well-formed. The parser ignores what
    follows the first value, so the text is parsed as the only element of an array and
    as the only field of an object: no trailing text fits both.
    """
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    listed = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", strict
    )
    named = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), "map<string,string>", strict
    )
    alone = (F.size(listed) == 1) & listed[0].isNotNull() & named.isNotNull()
    braces = text.rlike(r"(?s)^[ \t\r\n]*\{.*\}[ \t\r\n]*$")
    return F.coalesce(alone & braces, F.lit(False))


def text_schema(kind: T.DataType) -> T.DataType:
    """The same shape with every scalar read as text, to be cast by :func:`typed`."""
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(f.name, text_schema(f.dataType), True) for f in kind]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(text_schema(kind.elementType), True)
    if isinstance(kind, (T.MapType, T.VariantType)):
        return kind
    return T.StringType()


def typed(col: Column, kind: T.DataType) -> Column:
    """Cast a text-scalar value to ``kind``; unreadable scalars become null."""
    if isinstance(kind, T.StructType):
        fields = [typed(col[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        if text_schema(kind) == kind:
            return col
        return F.transform(col, lambda item: typed(item, kind.elementType))
    if isinstance(kind, (T.StringType, T.MapType, T.VariantType)):
        return col
    return col.try_cast(kind)


def to_json_row(*cols: str | Column) -> Column:
    return F.to_json(F.struct(*(cols or ("*",))))
