"""Names, texts and types as SQL text, whatever characters they hold."""

from __future__ import annotations

from pyspark.sql import types as T


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_type(kind: T.DataType) -> str:
    """The type with every nested field name quoted, which ``simpleString`` leaves bare."""
    if isinstance(kind, T.StructType):
        fields = (f"{quoted_name(f.name)}: {sql_type(f.dataType)}" for f in kind.fields)
        return f"STRUCT<{', '.join(fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{sql_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{sql_type(kind.keyType)}, {sql_type(kind.valueType)}>"
    return kind.simpleString()
