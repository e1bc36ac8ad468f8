"""JSON text to a typed record, as Column expressions.

Binding rules: field names match whatever their case, unknown fields are
dropped, a repeated field takes its last value, whole numbers may be written as
text, and any value that does not fit its field spoils the whole record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parsed_body(body: Column) -> Column:
    """The JSON object as a map; NULL for everything that is not an object."""
    return F.from_json(body, "map<string,string>")


def lowered_names(parsed: Column) -> Column:
    """Field names in lower case, last one first."""
    return F.reverse(F.transform(F.map_keys(parsed), F.lower))


def last_values(parsed: Column) -> Column:
    """Field values in the order of ``lowered_names``."""
    return F.reverse(F.map_values(parsed))


def _is_nested(body: Column, raw: Column, at: Column) -> Column:
    # In the map an object and a string holding the same text look alike. Only
    # for values that start like one is the body parsed again with types kept.
    typed = F.from_json(body, "map<string,variant>")
    kind = F.schema_of_variant(F.try_element_at(F.reverse(F.map_values(typed)), at))
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(raw.startswith("{") | raw.startswith("["), nested).otherwise(False)


def bound_record(body: Column, names: Column, values: Column, schema: T.StructType) -> Column:
    """A struct of ``schema``, or NULL when the body cannot be bound to it."""
    fields, faults = [], [names.isNull()]
    for field in schema.fields:
        at = F.array_position(names, field.name.lower()).cast("int")
        raw = F.when(at > 0, F.try_element_at(values, at))
        if isinstance(field.dataType, T.StringType):
            fields.append(raw.alias(field.name))
            faults.append(_is_nested(body, raw, at))
        else:
            value = raw.try_cast(field.dataType)
            fields.append(value.alias(field.name))
            # Present but not convertible, an explicit null included.
            faults.append((at > 0) & value.isNull())
    bad = reduce(lambda a, b: a | b, (F.coalesce(f, F.lit(False)) for f in faults))
    return F.when(~bad, F.struct(*fields))


def filled_record(record: Column, schema: T.StructType) -> Column:
    """Missing numbers become 0; missing strings stay NULL, and so does a NULL record."""
    parts = []
    for field in schema.fields:
        value = record[field.name]
        if isinstance(field.dataType, T.NumericType):
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        parts.append(value.alias(field.name))
    return F.when(record.isNotNull(), F.struct(*parts))
