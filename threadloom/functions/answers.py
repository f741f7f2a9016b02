"""Reading JSON objects out of free-form model answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: an object inside a code fence.
FENCED_OBJECT = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"


def balanced_object(text: Column) -> Column:
    """First ``{...}`` whose braces balance; braces in strings count as braces.

    The text from the first brace on is cut into brace and non-brace pieces, so
    the fold has one step per piece and not one per character.
    """
    start = F.instr(text, "{")
    tail = F.substr(text, start)
    pieces = F.regexp_extract_all(tail, F.lit(r"[{}]|[^{}]+"), F.lit(0))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(False).alias("closed"))

    def step(state: Column, piece: Column) -> Column:
        depth = (
            state["depth"]
            + F.when(piece == "{", 1).when(piece == "}", -1).otherwise(0)
        )
        return F.when(state["closed"], state).otherwise(
            F.struct(
                depth.alias("depth"),
                (state["taken"] + F.length(piece)).alias("taken"),
                ((piece == "}") & (depth == 0)).alias("closed"),
            )
        )

    end = F.aggregate(pieces, zero, step)
    return F.when((start > 0) & end["closed"], F.substr(tail, F.lit(1), end["taken"]))


def object_text(text: Column) -> Column:
    """JSON text of an answer that is not itself JSON: fence first, then braces."""
    fenced = F.regexp_extract(text, FENCED_OBJECT, 1)
    return F.when(fenced != "", fenced).otherwise(balanced_object(text))


def parse_object(text: Column, schema: T.StructType) -> Column:
    """Struct read from an answer, null when no object can be read.

    Order: the whole answer, else the fenced object, else the balanced one.
    Fields are read one by one: a field of another type is cast, or null, and
    costs no other field.
    """

    def read(source: Column) -> Column:
        parsed = F.try_parse_json(source)
        fields = [F.try_variant_get(parsed, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
        return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.struct(*fields))

    whole = F.when(F.trim(text).startswith("{"), text)
    return F.coalesce(read(whole), read(object_text(text)))
