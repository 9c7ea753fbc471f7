"""JSON text to typed columns.

Binding is lenient: "2" reads as the number 2 and 7 as the text "7", unknown
fields are ignored, a missing number is 0 and a missing text is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


_UNREADABLE = "_unreadable"


def json_fields(text: Column) -> Column:
    """Fields of a JSON object as map<string,string>; NULL for any other text."""
    return F.from_json(text, "map<string,string>")


def parse_once(rows: DataFrame, parsed: Column, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns and a parsed text.

    Generated from a one-element array: filters on the parsed fields then stay
    above the parser. On a plain column the optimizer would push them below,
    and every text would be parsed once for the filter and once for the result.
    """
    return rows.select(*keep, F.explode(F.array(parsed)).alias(name))


def typed_field(fields: Column, name: str, kind: str) -> Column:
    """One field cast to its type; a number that is absent is 0, an unreadable one NULL."""
    text = fields[name]
    if kind == "string":
        return text
    return F.when(text.isNull(), F.lit(0).cast(kind)).otherwise(text.try_cast(kind))


def parse_records(records: DataFrame, columns: dict[str, str], value: str = "value",
                  keep: tuple[str, ...] = (), written: bool = False) -> DataFrame:
    """Typed columns from a JSON text column; texts that hold no object are left out.

    ``written`` says that the texts are likely such as ``to_records`` writes: they are read by
    their types first, which is faster, and bound leniently only if that fails.
    """
    def typed(fields: Column) -> Column:
        return F.when(fields.isNotNull(), F.struct(*(
            typed_field(fields, name, kind).alias(name) for name, kind in columns.items())))

    # Typed within a higher-order function: as plain columns, the many lookups in the map become one
    # long generated method, which was measured to be several times slower.
    row = F.get(F.transform(F.array(json_fields(F.col(value))), typed), F.lit(0))
    if written:
        row = F.coalesce(_read_as_written(F.col(value), columns), row)
    return parse_once(records, row, "_row", keep).where("_row IS NOT NULL").select("_row.*", *keep)


def _read_as_written(text: Column, columns: dict[str, str]) -> Column:
    """The fields of a JSON object whose values have the columns' types; NULL for any other text."""
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in (*columns.items(), (_UNREADABLE, "string")))
    fields = F.from_json(text, kinds, {"columnNameOfCorruptRecord": _UNREADABLE})

    def filled(found: Column) -> Column:
        return F.when(found.isNotNull() & found[_UNREADABLE].isNull(), F.struct(*(
            (found[name] if kind == "string" else F.coalesce(found[name], F.lit(0).cast(kind))).alias(name)
            for name, kind in columns.items())))

    row = F.get(F.transform(F.array(fields), filled), F.lit(0))
    return F.when(F.startswith(text, F.lit("{")), row)  # a list of one object would be read as the object
