"""Fields of a JSON error payload, with JavaScript's notion of "first truthy"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field names of the payload documents, first match wins.
MESSAGE_FIELDS = ("error_message", "message", "error")
STACK_FIELDS = ("stack_trace", "stackTrace")
CONTEXT_FIELD = "context"


def _seal(body: Column) -> Column:
    return F.xxhash64(body)


def sealed_document(body: Column) -> Column:
    """VARIANT array of the body's value and a number taken from its hash.

    The parser stops at the end of the first value, so ``{} xyz`` would pass by
    itself. In front of that number, anything but one whole value moves or
    loses the number.
    """
    return F.try_parse_json(
        F.concat(F.lit("["), body, F.lit(","), _seal(body).cast("string"), F.lit("]"))
    )


def document(sealed: Column, body: Column) -> Column:
    """The document, NULL when the body is not one whole non-null JSON value."""
    value = F.try_variant_get(sealed, "$[0]", "variant")
    whole = F.try_variant_get(sealed, "$[1]", "bigint") == _seal(body)
    return F.when(whole & ~F.is_variant_null(value), value)


# A JSON reader without the limits of the VARIANT parser on nesting and on the
# length of strings and numbers. It skips what no field asks for.
_LIFTED = {
    "maxNestingDepth": str(2**31 - 1),
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# Types that a field is read as: only a fitting value gives one, but any short value has a text.
_KINDS = {
    "text": "STRING",
    "number": "DOUBLE",
    "flag": "BOOLEAN",
    "listed": "ARRAY<STRING>",
    "nested": "STRUCT<none: STRING>",
}


def _lifted(body: Column, wanted: str = "", before: str = "", after: str = "") -> Column:
    """The body as the first of two objects, sealed by the second."""
    seal = _seal(body).cast("string")
    text = F.concat(F.lit('[{"d":' + before), body, F.lit(after + '},{"seal":"'), seal, F.lit('"}]'))
    return F.from_json(text, f"ARRAY<STRUCT<{wanted}seal: STRING>>", _LIFTED)


def _sealed(found: Column, body: Column) -> Column:
    return F.coalesce(F.get(found, F.lit(1))["seal"] == _seal(body).cast("string"), F.lit(False))


def is_whole_value(body: Column) -> Column:
    """Whether a text is one JSON value, however deep or long.

    As an object's value a text may bring further members along, and as a
    list's element further elements; one that is read as both is one value.
    """
    return _sealed(_lifted(body), body) & _sealed(_lifted(body, "", "[", "]"), body)


def second_reading(body: Column) -> Column:
    """The fields of a JSON value by kind; NULL for what is no JSON value.

    For texts that the VARIANT parser refuses: ``sealed`` tells whether all
    kinds were read. A field that is a list or an object is read as such
    however large it is, unless it is itself nested too deep.
    """
    names = [*MESSAGE_FIELDS, *STACK_FIELDS]
    reads = {}
    for name, kind in _KINDS.items():
        wanted = "d: STRUCT<" + ", ".join(f"{field}: {kind}" for field in names) + ">, "
        reads[name] = _lifted(body, wanted)
    kinds = [F.get(read, F.lit(0))["d"].alias(name) for name, read in reads.items()]
    every = F.lit(True)
    for read in reads.values():
        every = every & _sealed(read, body)
    # A list that is nested too deep has no kind at all, like null.
    hidden = F.struct(*[F.rlike(body, F.lit(rf'"{field}"\s*:\s*\[')).alias(field) for field in names])
    return F.when(is_whole_value(body), F.struct(*kinds, every.alias("sealed"), hidden.alias("hidden")))


def was_read(again: Column) -> Column:
    """Whether a second reading tells the kind of every field."""
    known = F.lit(True)
    for name in [*MESSAGE_FIELDS, *STACK_FIELDS]:
        told = again["text"][name].isNotNull() | again["listed"][name].isNotNull()
        known = known & (told | ~again["hidden"][name])
    return again["sealed"] & known


def _chosen(again: Column, name: str) -> Column:
    """(text, other) of a truthy field, NULL for others; ``other`` is set for what is no string."""
    nested = again["listed"][name].isNotNull() | again["nested"][name].isNotNull()
    number, flag, text = (again[kind][name] for kind in ("number", "flag", "text"))
    other = nested | F.coalesce(number != 0, F.lit(False)) | F.coalesce(flag, F.lit(False))
    string = ~nested & number.isNull() & flag.isNull() & (text != "")
    return F.when(other, F.struct(F.lit("").alias("text"), F.lit(True).alias("other"))).when(
        string, F.struct(text.alias("text"), F.lit(False).alias("other"))
    )


def first_truthy_again(again: Column, names: tuple[str, ...]) -> Column:
    """(text, other) of the first truthy field of a second reading."""
    return F.coalesce(*[_chosen(again, name) for name in names])


def context_again(body: Column) -> Column:
    """The truthy context of a text that the VARIANT parser refuses, as a VARIANT; NULL without one."""
    reads = {
        name: F.get(_lifted(body, f"d: STRUCT<{CONTEXT_FIELD}: {kind}>, "), F.lit(0))["d"][CONTEXT_FIELD]
        for name, kind in _KINDS.items()
    }
    value = F.try_parse_json(reads["text"])
    string = ~(reads["listed"].isNotNull() | reads["nested"].isNotNull())
    string = string & reads["number"].isNull() & reads["flag"].isNull()
    found = F.when(string, reads["text"].cast("variant")).otherwise(value)
    return F.when(is_whole_value(body), _truthy(found))


def field(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "variant")


def _is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _truthy(value: Column) -> Column:
    """NULL, null, false, zero and the empty string become NULL."""
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    falsy = F.is_variant_null(value) | F.when(_is_string(value), text == "").otherwise(
        F.coalesce(number == 0, F.lit(False))
    )
    return F.when(~falsy, value)


def first_truthy(values: list[Column]) -> Column:
    """The first truthy VARIANT, NULL when there is none."""
    return F.coalesce(*[_truthy(value) for value in values])


def is_text_or_absent(value: Column) -> Column:
    """False for a truthy value that is not a string; such payloads are rejected."""
    return F.coalesce(_is_string(value), F.lit(True))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(""))


def payload_context(doc: Column) -> Column:
    """The document's context field, else the whole document, as a VARIANT."""
    return F.coalesce(_truthy(field(doc, CONTEXT_FIELD)), doc)
