"""Raw JSON documents against a schema, with a reason for each fault.

A schema is compiled to one expression over the variant type: for every field a
test of what stands there, so numbers are told from texts and absent fields from
nulls, which a parse into the schema would hide. A fault has the path of the value
(``$.order_details.items[2].price``) and a reason:

``not_json``, ``absent``, ``null``, ``unexpected`` (a field that the schema does not
name), ``not_text``, ``not_number``, ``not_whole`` (a fraction where a whole number
is asked for), ``out_of_range``, ``not_boolean``, ``not_object``, ``not_array``,
``not_a_date``, ``not_a_time``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators.events import Valid

FAULT = "struct<path:string,reason:string>"
# Least and greatest values of whole-number types.
_RANGES = {
    T.ByteType: 7,
    T.ShortType: 15,
    T.IntegerType: 31,
    T.LongType: 63,
}


def _none() -> Column:
    return F.array().cast(f"array<{FAULT}>")


def _fault(path: Column, reason: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(reason).alias("reason")))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _kind(value: Column) -> Column:
    """The JSON type of a variant: STRING, BIGINT, DECIMAL(..), OBJECT<..>, VOID ..."""
    return F.schema_of_variant(value)


def _number(value: Column, path: Column, kind: T.DataType) -> Column:
    told = _kind(value)
    whole = (told == "BIGINT") | told.rlike(r"^DECIMAL\(\d+,0\)$")
    is_number = whole | (told == "DOUBLE") | told.startswith("DECIMAL")
    faults = F.when(~is_number, _fault(path, "not_number"))
    if type(kind) in _RANGES:
        bound = 1 << _RANGES[type(kind)]
        number = F.try_variant_get(value, "$", "decimal(38,0)")
        outside = number.isNull() | (number < F.lit(-bound).cast("decimal(38,0)"))
        outside = outside | (number > F.lit(bound - 1).cast("decimal(38,0)"))
        faults = faults.when(~whole, _fault(path, "not_whole"))
        faults = faults.when(outside, _fault(path, "out_of_range"))
    elif isinstance(kind, T.DecimalType):
        narrow = F.try_variant_get(value, "$", kind.simpleString()).isNull()
        faults = faults.when(narrow, _fault(path, "out_of_range"))
    return faults.otherwise(_none())


def _text(value: Column, path: Column, kind: T.DataType) -> Column:
    faults = F.when(_kind(value) != "STRING", _fault(path, "not_text"))
    text = F.try_variant_get(value, "$", "string")
    if isinstance(kind, T.DateType):
        faults = faults.when(text.try_cast("date").isNull(), _fault(path, "not_a_date"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        faults = faults.when(text.try_cast(kind).isNull(), _fault(path, "not_a_time"))
    return faults.otherwise(_none())


def _object(value: Column, path: Column, kind: T.StructType, strict: bool, needed: frozenset, at: str) -> Column:
    every = []
    for field in kind.fields:
        quote = "'" if '"' in field.name else '"'
        if quote in field.name:
            raise ValueError(f"a field name has both kinds of quotes: {field.name}")
        child = F.try_variant_get(value, f"$[{quote}{field.name}{quote}]", "variant")
        where = F.concat(path, F.lit(f".{field.name}"))
        inside = f"{at}.{field.name}" if at else field.name
        required = not field.nullable or inside in needed
        every.append(_value(child, where, field.dataType, required, strict, needed, inside))
    if strict:
        keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        others = F.array_except(keys, F.array(*[F.lit(n) for n in kind.names]))
        unexpected = F.transform(
            F.array_sort(others),
            lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.lit("unexpected").alias("reason")),
        )
        every.append(unexpected)
    wrong = ~_kind(value).startswith("OBJECT")
    return F.when(wrong, _fault(path, "not_object")).otherwise(F.concat(*every, _none()))


def _array(value: Column, path: Column, kind: T.ArrayType, strict: bool, needed: frozenset, at: str) -> Column:
    elements = F.try_variant_get(value, "$", "array<variant>")

    def element(child: Column, index: Column) -> Column:
        where = F.concat(path, F.lit("["), index.cast("string"), F.lit("]"))
        return _value(child, where, kind.elementType, not kind.containsNull, strict, needed, f"{at}[]")

    wrong = ~_kind(value).startswith("ARRAY")
    inside = F.flatten(F.transform(elements, element))
    return F.when(wrong, _fault(path, "not_array")).otherwise(inside)


def _value(
    value: Column, path: Column, kind: T.DataType, required: bool, strict: bool, needed: frozenset, at: str
) -> Column:
    """Faults of one value; SQL null is an absent field, VOID a JSON null."""
    absent = _fault(path, "absent") if required else _none()
    null = _fault(path, "null") if required else _none()

    def found(value: Column) -> Column:
        if isinstance(kind, T.StructType):
            return _object(value, path, kind, strict, needed, at)
        if isinstance(kind, T.ArrayType):
            return _array(value, path, kind, strict, needed, at)
        if isinstance(kind, T.BooleanType):
            wrong = _kind(value) != "BOOLEAN"
            return F.when(wrong, _fault(path, "not_boolean")).otherwise(_none())
        if isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            return _text(value, path, kind)
        if isinstance(kind, T.NumericType):
            return _number(value, path, kind)
        raise ValueError(f"no JSON value stands for {kind.simpleString()}")

    def judge(value: Column) -> Column:
        told = F.when(value.isNull(), absent).when(_kind(value) == "VOID", null)
        return told.otherwise(found(value))

    return _bound(value, judge)


def document_faults(
    schema: T.StructType, *, required: Iterable[str] = (), strict: bool = False
) -> Callable[[Column], Column]:
    """Compile a schema: a function from a JSON text column to an array of faults.

    Fields that the schema says are never null have to be there, and so have those
    of ``required``: dotted paths, with ``[]`` for the elements of an array
    (``order_details.items[].product_id``). ``strict`` reports fields that the
    schema does not name.
    """
    needed = frozenset(required)
    unknown = needed - _paths(schema)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")

    def faults(json: Column) -> Column:
        # The parser stops behind the first value. What stands there would have to close
        # an array and an object alike to go unseen.
        listed = F.try_parse_json(F.concat(F.lit("["), json, F.lit("]")))
        named = F.try_parse_json(F.concat(F.lit('{"a":'), json, F.lit("}")))
        alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
        value = F.when(named.isNotNull() & alone, F.try_variant_get(listed, "$[0]", "variant"))

        def judge(value: Column) -> Column:
            found = _object(value, F.lit("$"), schema, strict, needed, "")
            return F.when(value.isNull(), _fault(F.lit("$"), "not_json")).otherwise(found)

        return _bound(value, judge)

    return faults


def _paths(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.ArrayType):
        return _paths(kind.elementType, f"{at}[]")
    found = set()
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            inside = f"{at}.{field.name}" if at else field.name
            found |= {inside} | _paths(field.dataType, inside)
    return found


def validate_documents(
    records: DataFrame,
    json: str,
    schema: T.StructType,
    *,
    required: Iterable[str] = (),
    strict: bool = False,
) -> Valid:
    """Part records whose JSON text fits a schema from those with faults.

    The accepted have the parsed ``document``, the rejected an array ``faults``
    beside their own columns. Works on streams too.
    """
    faults = document_faults(schema, required=required, strict=strict)(F.col(json))
    judged = records.withColumn("faults", faults)
    document = F.from_json(F.col(json), schema).alias("document")
    accepted = judged.where(F.size("faults") == 0).select(*records.columns, document)
    return Valid(accepted, judged.where(F.size("faults") > 0))
