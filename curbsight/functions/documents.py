"""Decoding of typed documents: ``{"pm25": {"N": "12.5"}}`` becomes ``pm25 = 12.5``.

A document of a known schema is parsed once with ``from_json`` into its wire form and read back by
plain field access, so the decode stays in generated code. The recursion below runs over the
*schema* while the plan is built, never over rows.

Attributes that no schema declares are kept beside it, as a variant in plain form (``decode_open_documents``): whatever the
typed struct has no place for, down to members of declared structs, values of another kind than declared, and tags that
nobody knows. What is nested deeper than ``OPEN_DEPTH`` keeps its tags, so nothing is lost there either.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = T.StringType()
_SCALARS = (
    T.StructField("S", _TEXT),
    T.StructField("N", _TEXT),
    T.StructField("BOOL", T.BooleanType()),
)


def wire_type(target: T.DataType) -> T.DataType:
    """The tagged form that a value of type ``target`` arrives in."""
    if isinstance(target, T.StructType):
        return T.StructType([T.StructField("M", wire_fields(target))])
    if isinstance(target, T.MapType):
        return T.StructType([T.StructField("M", T.MapType(_TEXT, wire_type(target.valueType)))])
    if isinstance(target, T.ArrayType):
        members = T.ArrayType(_TEXT)
        return T.StructType(
            [T.StructField("L", T.ArrayType(wire_type(target.elementType)))]
            + [T.StructField(tag, members) for tag in ("SS", "NS", "BS")]
        )
    return T.StructType(list(_SCALARS))


def wire_fields(target: T.StructType) -> T.StructType:
    """A whole document: every attribute in tagged form."""
    return T.StructType([T.StructField(f.name, wire_type(f.dataType)) for f in target.fields])


def _scalar(wire: Column, target: T.DataType) -> Column:
    flag = wire["BOOL"]
    if isinstance(target, T.BooleanType):
        return F.coalesce(flag, wire["S"].try_cast("boolean"))
    text = F.coalesce(wire["S"], wire["N"], flag.cast("string"))
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, (T.IntegerType, T.LongType)):
        # Whole numbers may carry a fraction on the wire, and doubles lose digits beyond 2^53.
        return F.coalesce(text.try_cast(target), text.try_cast("double").try_cast(target))
    return text.try_cast(target)


def _plain(wire: Column, target: T.DataType) -> Column:
    if isinstance(target, T.StructType):
        return F.when(wire["M"].isNotNull(), plain_document(wire["M"], target))
    if isinstance(target, T.MapType):
        return F.transform_values(wire["M"], lambda _, v: _plain(v, target.valueType))
    if isinstance(target, T.ArrayType):
        element = target.elementType
        members = [F.transform(wire["L"], lambda v: _plain(v, element))]
        members += [F.transform(wire[tag], lambda v: v.try_cast(element)) for tag in ("SS", "NS", "BS")]
        return F.coalesce(*members)
    return _scalar(wire, target)


def plain_document(wire: Column, target: T.StructType) -> Column:
    """Read a parsed document back as a plain struct of type ``target``."""
    return F.struct(*(_plain(wire[f.name], f.dataType).alias(f.name) for f in target.fields))


def decode_documents(frame: DataFrame, targets: Mapping[str, T.StructType]) -> DataFrame:
    """Replace columns of typed JSON text by plain structs; NULL text stays NULL.

    Parsing is a projection of its own, so that every document is parsed once however many of its
    fields are read.
    """
    return _typed(frame.withColumns({c: F.from_json(c, wire_fields(target)) for c, target in targets.items()}), targets)


def _typed(parsed: DataFrame, targets: Mapping[str, T.StructType]) -> DataFrame:
    return parsed.withColumns({
        c: F.when(F.col(c).isNotNull(), plain_document(F.col(c), target)) for c, target in targets.items()
    })


# --- open attributes ------------------------------------------------------------------------

#: Levels of maps and lists below an undeclared attribute that are read back as plain values.
OPEN_DEPTH = 3

_OPEN = "map<string,variant>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _members(value: Column) -> Column:
    """The members of a variant object; NULL for anything else."""
    return F.try_variant_get(value, "$", _OPEN)


def _number(text: Column) -> Column:
    """Whole numbers exactly, up to 38 digits; others as doubles; what is no number stays text."""
    whole = F.coalesce(text.try_cast("bigint").cast("variant"), text.try_cast("decimal(38,0)").cast("variant"))
    return F.coalesce(F.when(text.contains("."), text.try_cast("double").cast("variant")).otherwise(whole),
                      text.cast("variant"))


def open_value(wire: Column, depth: int = OPEN_DEPTH) -> Column:
    """A tagged value of any kind as a plain variant; an unknown tag, or one too deep down, stays as it is."""
    def plain(members: Column) -> Column:
        tag, value = F.map_keys(members)[0], F.map_values(members)[0]
        texts = F.try_variant_get(value, "$", "array<string>")
        read = (
            F.when(tag == "S", F.try_variant_get(value, "$", "string").cast("variant"))
            .when(tag == "N", _number(F.try_variant_get(value, "$", "string")))
            .when(tag == "BOOL", F.try_variant_get(value, "$", "boolean").cast("variant"))
            .when(tag == "NULL", F.parse_json(F.lit("null")))
            .when(tag.isin("SS", "BS"), F.to_variant_object(texts))
            .when(tag == "NS", F.to_variant_object(F.transform(texts, _number)))
        )
        if depth > 0:
            inside = F.when(tag == "M", _members(value))
            items = F.when(tag == "L", F.try_variant_get(value, "$", "array<variant>"))
            below = F.transform(F.coalesce(items, F.map_values(inside)), lambda v: open_value(v, depth - 1))
            read = read.otherwise(_let(below, lambda found: F.when(
                tag == "M", F.to_variant_object(F.map_from_arrays(F.map_keys(inside), found))
            ).otherwise(F.to_variant_object(found))))
        return F.when(F.size(members) == 1, read)

    return F.coalesce(_let(_members(wire), plain), wire)


def _has_gap(typed: Column, target: T.DataType) -> Column:
    """Whether a declared value, or some part of it, could not be read."""
    if isinstance(target, T.ArrayType):
        return typed.isNull() | F.exists(typed, lambda x: _has_gap(x, target.elementType))
    if isinstance(target, T.MapType):
        return typed.isNull() | F.exists(F.map_values(typed), lambda x: _has_gap(x, target.valueType))
    return typed.isNull()


def _with_rest(frame: DataFrame, wire: str, typed: Column, target: T.StructType, name: str) -> DataFrame:
    """Add column ``name``: what the members in column ``wire`` have beyond the struct ``typed``, NULL if nothing.

    Every level is a projection of its own, so no part of a document is read more than once.
    """
    inner = []
    for field in target.fields:
        if isinstance(field.dataType, T.StructType):
            column = f"{name}_{field.name}"
            below = F.try_variant_get(F.try_element_at(wire, F.lit(field.name)), "$.M", _OPEN)
            frame = _with_rest(frame.withColumn(f"{column}_wire", below), f"{column}_wire", typed[field.name],
                               field.dataType, column)
            inner.append((field.name, column))

    def unread(key: Column, value: Column) -> Column:
        gaps = [(key == f.name) & _has_gap(typed[f.name], f.dataType) for f in target.fields]
        is_null = F.coalesce(F.try_variant_get(value, "$.NULL", "boolean"), F.lit(False))
        return ~key.isin(target.names) | (reduce(lambda a, b: a | b, gaps) & ~is_null)

    own = F.transform_values(F.map_filter(wire, unread), lambda _, v: open_value(v))
    nested = F.map_from_entries(F.array_compact(F.array(*(
        F.when(F.col(column).isNotNull(), F.struct(F.lit(field).alias("k"), F.col(column).alias("v"))) for field, column in inner))))
    frame = frame.withColumn(f"{name}_all", F.map_concat(own, nested) if inner else own)
    rest = F.when(F.size(f"{name}_all") > 0, F.to_variant_object(f"{name}_all"))
    return frame.withColumn(name, rest).drop(
        wire, f"{name}_all", *(column for _, column in inner))


# Text without escapes, so that every quote in a document is one that its form has.
_BARE = r'"[^"\\\x00-\x1F]*+"'
_TAGGED_NULL = r'\{"NULL":true\}'


def _form(target: T.DataType) -> str:
    """Regular expression of a tagged value that the typed form holds as a whole; only NULL of kinds it doesn't tell."""
    if isinstance(target, T.StructType):
        return rf'(?:\{{"M":{_closed_form(target)}\}}|{_TAGGED_NULL})'
    kinds = [rf'\{{"[SN]":{_BARE}\}}'] if isinstance(target, T.StringType) else []
    if isinstance(target, (T.StringType, T.BooleanType)):
        kinds.append(r'\{"BOOL":(?:true|false)\}')
    return f"(?:{'|'.join([*kinds, _TAGGED_NULL])})"


def _closed_form(target: T.StructType) -> str:
    """Regular expression of a document in compact JSON, without escapes, whose members are all declared, in any order."""
    names: dict[str, list[str]] = {}
    for f in target.fields:
        if re.fullmatch(r"\w+", f.name, re.ASCII):
            names.setdefault(_form(f.dataType), []).append(f.name)
    member = "|".join(rf'"(?:{"|".join(own)})":{form}' for form, own in names.items())
    return rf"\{{(?:(?:{member})(?:,(?:{member}))*+)?+\}}"


def _quotes(wire: Column, target: T.StructType) -> Column:
    """How many quotes a document has that is of the closed form and names no attribute twice."""
    def of(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            inside = F.coalesce(_quotes(value["M"], kind), F.lit(0))
        elif isinstance(kind, (T.StringType, T.BooleanType)):
            inside = F.when(value["S"].isNotNull() | value["N"].isNotNull(), 2).otherwise(0)
        else:
            inside = F.lit(0)
        return F.when(value.isNotNull(), inside + 4).otherwise(0)

    return F.when(wire.isNotNull(), reduce(lambda a, b: a + b, (of(wire[f.name], f.dataType) for f in target.fields), F.lit(0)))


def _is_closed(text: Column, wire: Column, target: T.StructType) -> Column:
    """Whether a document has surely nothing beyond its typed form, told from its text without reading all values again.

    The form admits only what the typed form holds; an attribute that is named twice, which is no document to a variant, shows
    in the number of quotes. Any other document may or may not have a rest.
    """
    closed = text.rlike(rf"\A{_closed_form(target)}\z")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    return F.coalesce(closed & (quotes == _quotes(wire, target)), F.lit(False))


def decode_open_documents(frame: DataFrame, targets: Mapping[str, T.StructType]) -> DataFrame:
    """``decode_documents``, and beside each of these columns one named ``<column>_rest``: the attributes beyond the typed
    form as a variant object in plain form, NULL if there are none. Text that is no document at all is kept as text.

    Most documents have no rest. Those of a form that leaves none are told by one pass over their text; all others are read
    once more as variants.
    """
    parsed = frame.withColumns({f"_{c}_text": F.col(c) for c in targets}).withColumns(
        {c: F.from_json(c, wire_fields(target)) for c, target in targets.items()})
    open_texts = {
        f"_{c}_text": F.when(~_is_closed(F.col(f"_{c}_text"), F.col(c), target), F.col(f"_{c}_text"))
        for c, target in targets.items()
    }
    frame = _typed(parsed.withColumns(open_texts), targets)
    for c, target in targets.items():
        frame = frame.withColumn(f"_{c}_wire", _members(F.try_parse_json(f"_{c}_text")))
        broken = F.when(F.col(f"_{c}_text").isNotNull() & F.col(f"_{c}_wire").isNull(), F.col(f"_{c}_text").cast("variant"))
        frame = frame.withColumn(f"_{c}_broken", broken)
        frame = _with_rest(frame, f"_{c}_wire", F.col(c), target, f"{c}_rest")
        frame = frame.withColumn(f"{c}_rest", F.coalesce(f"_{c}_broken", f"{c}_rest")).drop(f"_{c}_text", f"_{c}_broken")
    return frame


def attribute_report(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Undeclared attributes in ``<column>_rest`` columns: how often each occurs, and the one type that holds its values."""
    found = [frame.select(F.lit(c).alias("document"), F.explode(_members(F.col(f"{c}_rest"))).alias("attribute", "value"))
             for c in columns]
    return reduce(DataFrame.unionByName, found).groupBy("document", "attribute").agg(
        F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("value").alias("kind"))
