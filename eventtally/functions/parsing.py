"""Reading event text: JSON, numbers, actions and instants.

Every function takes and returns columns. Nothing here raises on bad text except
`required_instant`, which is for request bounds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the instant grammar of the wire format, in upper or lower case.
INSTANT_PATTERN = r"(?i)^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.]\d{1,9})?Z$"

UNKNOWN_ACTION = "UNKNOWN"


def parsed_json(raw: Column) -> Column:
    """The JSON value of a text, or NULL where it cannot be read.

    Scalars, `null` and arrays are readable. Empty and blank texts are not.
    """
    return F.try_parse_json(raw)


def field(value: Column, name: str) -> Column:
    """A field as it stands, NULL where the value is no object or has no such field."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def field_text(field: Column) -> Column:
    """A field as text: NULL if absent or null, empty for objects and arrays."""
    kind = F.schema_of_variant(field)
    return (
        F.when(kind == "STRING", F.try_variant_get(field, "$", "string"))
        .when(field.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(""))
        # A number with a fraction keeps its point, so 5.0 reads "5.0" and not "5".
        .when(
            kind.startswith("DECIMAL") | (kind == "DOUBLE"),
            F.try_variant_get(field, "$", "double").cast("string"),
        )
        .otherwise(F.try_variant_get(field, "$", "string"))
    )


def scalar_text(value: Column, name: str) -> Column:
    """A field as text where only well-formed text matters, as with instants."""
    return F.try_variant_get(value, f"$.{name}", "string")


def double_field(value: Column, name: str, default: float = 0.0) -> Column:
    """A field as a number; numeric text counts, anything else gives the default."""
    return F.coalesce(F.try_variant_get(value, f"$.{name}", "double"), F.lit(default))


def instant(text: Column) -> Column:
    """An ISO instant in milliseconds, or NULL where the text is not one.

    Date-only, zone-less and offset texts are not instants.
    """
    return F.date_trunc("millisecond", exact_instant(text))


def exact_instant(text: Column) -> Column:
    """The same with all the digits that a timestamp holds."""
    return F.when(text.rlike(INSTANT_PATTERN), F.try_to_timestamp(F.upper(text)))


def event_time(text: Column, ingest_time: Column) -> Column:
    """The instant of an event, or the time it was landed where it names none."""
    return F.coalesce(instant(text), ingest_time)


def required_instant(text: Column) -> Column:
    """The instant of a request bound; a bound that is not one fails the job."""
    message = F.concat(F.lit("not an instant: "), F.coalesce(text, F.lit("null")))
    return F.coalesce(exact_instant(text), F.raise_error(message).cast("timestamp"))


def action_or_unknown(action: Column, activity: Column) -> Column:
    """First of the two that is present; an empty text is present."""
    return F.coalesce(action, activity, F.lit(UNKNOWN_ACTION))


def normalised_action(action: Column) -> Column:
    """Letters, digits and underscores only, in upper case."""
    return F.upper(F.regexp_replace(action, "[^A-Za-z0-9_]", "_"))


def iso_instant(at: Column) -> Column:
    """An instant as text, with as many groups of three fraction digits as it needs."""
    seconds = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(at, "SSSSSS")
    digits = (
        F.when(fraction == "000000", F.lit(""))
        .when(fraction.endswith("000"), F.concat(F.lit("."), F.substring(fraction, 1, 3)))
        .otherwise(F.concat(F.lit("."), fraction))
    )
    return F.concat(seconds, digits, F.lit("Z"))
