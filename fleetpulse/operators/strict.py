"""Strictly typed heartbeats out of JSON documents, by way of VARIANT.

The rules of a statically typed reader: a body is one JSON document; text takes a string, a whole
number takes a number without point or exponent that fits 64 bits, a number takes any number, and null or an
absent key leaves the empty value; keys match without regard to case, an exact one first. Anything else makes
the document malformed, and so does a key given twice in one spelling. Unknown keys are ignored.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse import schema

OBJECT = "map<string,variant>"
#: Kinds of JSON values, by ``schema_of_variant``, that a column type takes.
TAKES = {
    T.StringType: "^STRING$",
    T.LongType: "^BIGINT$",
    T.DoubleType: "^(BIGINT|DOUBLE|FLOAT|DECIMAL)",
}


def enclosed(text):
    """The body as field ``doc`` of a larger VARIANT document, null where that is malformed.

    Its last field is the body's own hash: text after the body breaks the larger document or closes
    it before that field, which the parser alone would not notice.
    """
    return F.try_parse_json(F.concat(F.lit('{"doc":'), text, F.lit(',"end":'), F.xxhash64(text).cast("string"), F.lit("}")))


def holds(parsed, text):
    """Whether ``parsed``, of ``enclosed``, is the one document that ``text`` consists of."""
    return F.coalesce(F.try_variant_get(parsed, "$.end", "bigint") == F.xxhash64(text), F.lit(False))


def bound(value, use):
    """``use`` of a value that is computed once however often it is named there."""
    return F.get(F.transform(F.array(value), use), 0)


def fields(value):
    """An object's fields; none for null, null for any other value."""
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
    return F.when(is_null(value), nothing).otherwise(F.try_variant_get(value, "$", OBJECT))


def field(found, name):
    """The value under a key, in any case; null when absent."""
    others = F.filter(F.map_entries(found), lambda e: F.lower(e["key"]) == name)
    return F.coalesce(F.try_element_at(found, F.lit(name)), F.get(others, 0)["value"])


def is_null(value):
    return value.isNull() | F.is_variant_null(value)


def typed(value, shape=schema.HEARTBEAT):
    """A struct of ``shape``'s columns, empty values for absent ones; null if a value has the wrong type."""
    def of_values(values):
        fits, columns = F.lit(True), []
        for place, column in enumerate(shape.fields):
            inner = F.get(values, place)
            got = F.try_variant_get(inner, "$", column.dataType.simpleString())
            takes = F.schema_of_variant(inner).rlike(TAKES[type(column.dataType)])
            if isinstance(column.dataType, T.DoubleType):
                takes = takes & (F.abs(got) < float("inf"))
            fits = fits & (is_null(inner) | takes)
            empty = "" if isinstance(column.dataType, T.StringType) else 0
            columns.append(F.coalesce(got, F.lit(empty).cast(column.dataType)).alias(column.name))
        return F.when(fits, F.struct(*columns))

    def of_fields(found):
        return F.when(found.isNotNull(), bound(F.array(*[field(found, n) for n in shape.fieldNames()]), of_values))
    return bound(fields(value), of_fields)


def listed(value, key="heartbeats"):
    """The values of the list under ``key``: empty when null or absent, null where there is no such list."""
    nothing = F.array().cast("array<variant>")

    def of_inner(inner):
        return F.when(is_null(inner), nothing).otherwise(F.try_variant_get(inner, "$", "array<variant>"))
    return bound(fields(value), lambda found: F.when(found.isNotNull(), bound(field(found, key), of_inner)))
