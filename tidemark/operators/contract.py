"""Strict validation of JSON events against a declared contract.

A contract is data, read from a JSON Schema document: fields with type, bounds, choices and
format, and objects inside objects. Every rule becomes a column expression over the
parsed VARIANT, so types are inspected as sent ("75" and true are not integers)
and the whole check stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text, times
from tidemark.operators.once import computed_once


@dataclass(frozen=True)
class Field:
    """One property. ``name`` is its path, with dots; an object holds ``fields`` of its own."""

    name: str
    kind: str  # "string", "integer", "number", "boolean" or "object"
    required: bool = True
    min_length: int | None = None
    max_length: int | None = None
    minimum: float | None = None
    maximum: float | None = None
    choices: tuple[str | int | float | bool, ...] | None = None
    form: str | None = None  # "uuid" or "date-time", checked once all else passed
    fields: tuple[Field, ...] = ()
    allow_unknown: bool = False

    @property
    def key(self) -> str:
        return self.name.rpartition(".")[2]


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    allow_unknown: bool = False

    def every(self) -> list[Field]:
        """All fields, those of objects after the object."""
        def below(fields: tuple[Field, ...]) -> list[Field]:
            return [f for field in fields for f in (field, *below(field.fields))]

        return below(self.fields)

    def leaves(self) -> list[Field]:
        """Fields that become typed columns."""
        return [f for f in self.every() if f.kind != "object"]

    def with_max_length(self, name: str, limit: int) -> Contract:
        """Also refuse longer text, for sinks with bounded columns."""
        fields = tuple(replace(f, max_length=limit) if f.name == name else f for f in self.fields)
        return replace(self, fields=fields)


#: Keywords that are rules here, and those that say nothing about an event's validity.
_RULES = {"type", "format", "minLength", "maxLength", "minimum", "maximum", "enum", "properties", "required",
          "additionalProperties"}
_NOTES = {"$schema", "$id", "title", "description", "default", "examples"}


def from_schema(document: Mapping) -> Contract:
    """The contract that a JSON Schema document of an object states.

    Takes type, required, additionalProperties, minLength, maxLength, minimum, maximum, enum,
    format and nested objects; any other keyword is refused, as it would go unchecked.
    """
    root = _field("", document, True)
    if root.kind != "object":
        raise ValueError("the document must describe an object")
    return Contract(root.fields, root.allow_unknown)


def _field(path: str, document: Mapping, required: bool) -> Field:
    unknown = set(document) - _RULES - _NOTES
    if unknown:
        raise ValueError(f"unsupported keywords at {path or 'the root'}: {sorted(unknown)}")
    wanted = document.get("required", [])
    fields = tuple(
        _field(f"{path}.{name}" if path else name, inner, name in wanted)
        for name, inner in document.get("properties", {}).items()
    )
    missing = sorted(set(wanted) - {f.key for f in fields})
    if missing:
        raise ValueError(f"required but not described at {path or 'the root'}: {missing}")
    return Field(
        path, document["type"], required, document.get("minLength"), document.get("maxLength"),
        document.get("minimum"), document.get("maximum"), tuple(document["enum"]) if "enum" in document else None,
        document.get("format"), fields, document.get("additionalProperties", True) is not False,
    )


# The reading contract.
READING_SCHEMA = {
    "type": "object",
    "additionalProperties": False,
    "required": ["event_id", "customer_id", "heart_rate", "event_time"],
    "properties": {
        "event_id": {"type": "string", "format": "uuid"},
        "customer_id": {"type": "string", "minLength": 1},
        "heart_rate": {"type": "integer", "minimum": 20, "maximum": 250},
        "event_time": {"type": "string", "format": "date-time"},
    },
}
READING = from_schema(READING_SCHEMA)

DECODE_ERROR = "DECODE_ERROR"
VALIDATION_ERROR = "VALIDATION_ERROR"

def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode message bytes: the text, the parsed VARIANT and its top-level keys.

    ``doc`` is NULL when the bytes are not UTF-8 or not exactly one JSON document;
    a repeated key counts as undecodable. ``doc_keys`` is NULL unless the document
    is an object.

    The parser stops after the first value, so text after it would go unnoticed.
    The payload is therefore parsed as the only element of an array and as the
    only member of an object: no trailing text fits inside both.
    """
    payload = F.col(value).cast("string")
    checked = F.try_validate_utf8(payload)
    member = F.json_object_keys(F.concat(F.lit('{"v":'), checked, F.lit("}")))
    parsed = computed_once(messages, {
        "original_event": payload,
        "__list": F.try_parse_json(F.concat(F.lit("["), checked, F.lit("]"))),
        # Text without a closing bracket cannot end the array: no second look.
        "__alone": ~F.contains(payload, F.lit("]")) | (F.size(member) == 1),
    })
    elements = F.size(F.try_variant_get("__list", "$", "array<variant>"))
    doc = F.when(F.col("__alone") & (elements == 1), F.try_variant_get("__list", "$[0]", "variant"))
    parsed = computed_once(parsed, {"doc": doc}).drop("__list", "__alone")
    keys = F.map_keys(F.try_variant_get("doc", "$", "map<string,variant>"))
    return computed_once(parsed, {"doc_keys": keys})


def skip_blank(messages: DataFrame, value: str = "value") -> DataFrame:
    return messages.where(F.length(text.strip(F.col(value).cast("string"))) > 0)


# A rule is a condition that breaks the contract and the message for it.
Rule = tuple[Column, Column]


def _raw(name: str) -> Column:
    return F.col(f"`__{name}`")


def _kind(name: str) -> Column:
    return F.col(f"`__{name}_kind`")


def _text(name: str) -> Column:
    return F.try_variant_get(_raw(name), "$", "string")


def _number(name: str) -> Column:
    # DOUBLE keeps values of any size comparable with the bounds.
    return F.try_variant_get(_raw(name), "$", "double")


def _is_number(name: str) -> Column:
    return _kind(name).isin("BIGINT", "DOUBLE", "FLOAT") | _kind(name).startswith("DECIMAL")


def _shown(value: Column, kind: Column) -> Column:
    """A value as it appears in an error message."""
    plain = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "STRING", text.quoted(plain))
        .when(kind == "BOOLEAN", F.initcap(plain))
        .when(kind == "VOID", F.lit("None"))
        .when(kind.startswith("DECIMAL") & ~F.contains(plain, F.lit(".")),
              F.concat(plain, F.lit(".0")))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(value))
        .otherwise(plain)
    )


def _has_kind(field: Field) -> Column:
    name = field.name
    if field.kind == "string":
        return _kind(name) == "STRING"
    if field.kind == "boolean":
        return _kind(name) == "BOOLEAN"
    if field.kind == "object":
        return _kind(name).startswith("OBJECT")
    if field.kind == "number":
        return _is_number(name)
    whole = _number(name) == F.floor(_number(name))
    return (_kind(name) == "BIGINT") | (_is_number(name) & whole)


def _is_choice(field: Field) -> Column:
    """The value is one of the choices, of the same JSON type."""
    words = [c for c in field.choices if isinstance(c, str)]
    flags = [c for c in field.choices if isinstance(c, bool)]
    numbers = [float(c) for c in field.choices if isinstance(c, (int, float)) and not isinstance(c, bool)]
    return (
        ((_kind(field.name) == "STRING") & _text(field.name).isin(words))
        | (_is_number(field.name) & _number(field.name).isin(numbers))
        | ((_kind(field.name) == "BOOLEAN") & F.try_variant_get(_raw(field.name), "$", "boolean").isin(flags))
    )


def _field_rules(field: Field) -> list[Rule]:
    """The rules of one field, in reporting order; bounds apply to any number."""
    name = field.name
    present, is_text, is_number = _raw(name).isNotNull(), _kind(name) == "STRING", _is_number(name)
    shown = _shown(_raw(name), _kind(name))
    length, number = F.char_length(_text(name)), _number(name)
    rules: list[tuple[Column, str]] = [(~_has_kind(field), f" is not of type '{field.kind}'")]
    if field.min_length is not None:
        words = " should be non-empty" if field.min_length == 1 else " is too short"
        rules.append((is_text & (length < field.min_length), words))
    if field.max_length is not None:
        rules.append((is_text & (length > field.max_length), " is too long"))
    if field.minimum is not None:
        rules.append((is_number & (number < field.minimum),
                      f" is less than the minimum of {field.minimum}"))
    if field.maximum is not None:
        rules.append((is_number & (number > field.maximum),
                      f" is greater than the maximum of {field.maximum}"))
    if field.choices is not None:
        rules.append((~F.coalesce(_is_choice(field), F.lit(False)), f" is not one of {list(field.choices)!r}"))
    found = [(present & broken, F.concat(F.lit(f"{name}: "), shown, F.lit(words)))
             for broken, words in rules]
    if field.kind == "object":
        keys = F.map_keys(F.try_variant_get(_raw(name), "$", "map<string,variant>"))
        found += _object_rules(name, keys, field.fields, field.allow_unknown)
    return found


def _object_rules(label: str, keys: Column, fields: tuple[Field, ...], allow_unknown: bool) -> list[Rule]:
    """What an object must and must not hold; ``keys`` is NULL where there is none."""
    is_object = keys.isNotNull()
    rules = []
    if not allow_unknown:
        known = F.array(*[F.lit(f.key) for f in fields]).cast("array<string>")
        extra = F.array_sort(F.array_except(keys, known))
        verb = F.when(F.size(extra) == 1, F.lit("was")).otherwise(F.lit("were"))
        # Counting is cheaper than comparing: more keys than known ones present.
        present = reduce(add, [_raw(f.name).isNotNull().cast("int") for f in fields], F.lit(0))
        rules.append((is_object & (F.size(keys) > present), F.concat(
            F.lit(f"{label}: Additional properties are not allowed ("),
            F.array_join(F.transform(extra, text.quoted), ", "),
            F.lit(" "), verb, F.lit(" unexpected)"),
        )))
    return rules + [
        (is_object & _raw(field.name).isNull(),
         F.lit(f"{label}: '{field.key}' is a required property"))
        for field in fields if field.required
    ]


def _root_rules(contract: Contract) -> list[Rule]:
    keys = F.col("doc_keys")
    shown = _shown(F.col("doc"), F.schema_of_variant("doc"))
    broken = (keys.isNull(), F.concat(F.lit("event: "), shown, F.lit(" is not of type 'object'")))
    return [broken, *_object_rules("event", keys, contract.fields, contract.allow_unknown)]


def _form_error(field: Field) -> Column:
    parsed = F.col(f"`__{field.name}_typed`")
    return F.when(_raw(field.name).isNotNull() & parsed.isNull(), F.lit(f"Invalid {field.name}"))


def typed(field: Field) -> Column:
    """The field's typed value, NULL when it cannot be read as declared."""
    if field.kind != "string":
        return F.try_variant_get(
            _raw(field.name), "$", {"integer": "int", "number": "double", "boolean": "boolean"}[field.kind])
    plain = _text(field.name)
    if field.form == "uuid":
        return text.canonical_uuid(plain)
    if field.form == "date-time":
        return times.parse_iso_with_offset(plain)
    return plain


def validate(decoded: DataFrame, contract: Contract = READING) -> DataFrame:
    """Add errors, error_type, error_message, is_valid and the typed fields.

    All contract errors are listed, root first and then by field name. Formats
    are judged only when the contract holds, and only the first is reported.
    Typed fields are NULL on invalid rows; those of inner objects are named with an underscore
    for each dot.
    """
    columns = decoded.columns
    fields, leaves = contract.every(), contract.leaves()
    raw = computed_once(decoded, {
        f"__{f.name}": F.try_variant_get("doc", f"$.{f.name}", "variant") for f in fields
    })
    kinds = computed_once(raw, {
        f"__{f.name}_kind": F.schema_of_variant(_raw(f.name)) for f in fields
    })
    by_name = sorted(fields, key=lambda f: f.name.split("."))
    rules = [*_root_rules(contract), *[r for f in by_name for r in _field_rules(f)]]
    decodable = F.col("doc").isNotNull()
    any_broken = F.coalesce(reduce(or_, [broken for broken, _ in rules]), F.lit(False))
    judged = computed_once(kinds, {"__clean": decodable & ~any_broken})
    # Messages are built for broken events only, typed values for clean ones only.
    clean = F.col("__clean")
    found = F.array_compact(F.array(*[F.when(broken, message) for broken, message in rules]))
    judged = computed_once(judged, {
        "__errors": F.when(clean, F.array().cast("array<string>"))
        .when(decodable, found).otherwise(F.array(F.lit("Undecodable JSON"))),
        **{f"__{f.name}_typed": F.when(clean, typed(f)) for f in leaves},
    })
    # Formats are judged on otherwise clean events; the first to fail is reported.
    first_form = F.coalesce(*[_form_error(f) for f in leaves if f.form],
                            F.lit(None).cast("string"))
    judged = computed_once(judged, {
        "errors": F.when(clean & first_form.isNotNull(), F.array(first_form))
        .otherwise(F.col("__errors"))
    })
    is_valid = F.size("errors") == 0
    named = [f.name for f in leaves]
    raw_customer = F.lit(None).cast("string")
    if "customer_id" in named:
        raw_customer = F.when(
            _kind("customer_id") == "STRING", _text("customer_id")
        )
    return judged.select(
        *columns,
        "errors",
        is_valid.alias("is_valid"),
        F.when(~decodable, F.lit(DECODE_ERROR))
        .when(~is_valid, F.lit(VALIDATION_ERROR)).alias("error_type"),
        F.when(~is_valid, F.array_join("errors", "; ")).alias("error_message"),
        raw_customer.alias("raw_customer_id"),
        *[F.when(is_valid, F.col(f"`__{name}_typed`")).alias(name.replace(".", "_")) for name in named],
    )


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid)."""
    return validated.where("is_valid"), validated.where(~F.col("is_valid"))


def to_readings(valid: DataFrame, contract: Contract = READING) -> DataFrame:
    """Typed rows with the message position that orders arrivals.

    Messages are taken the way a consumer polls them: second by second of broker
    time, within a second partition by partition, within a partition by offset.
    A message without a broker time counts as the earliest.
    """
    taken = F.coalesce(F.col("timestamp"), F.timestamp_seconds(F.lit(0)))
    return valid.select(
        *[f.name for f in contract.fields],
        F.date_trunc("SECOND", taken).alias("src_slice"),
        F.col("topic").alias("src_topic"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
    )
