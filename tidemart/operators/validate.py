"""Parsing, the two rule sets, coercion and routing.

Both rule sets turn Bronze rows into the same shape: Bronze coordinates, the typed event fields,
``validation_errors`` and ``event_date``. They differ in what they accept:

* stream rules judge the payload after a typed parse, so text where a number belongs is null;
* contract rules judge the payload's own values, so absent, blank and unreadable stay apart.

A filter on parsed fields would be pushed below the parse and repeat it once per field. Emitting
the parsed struct through ``inline`` keeps the parse to one evaluation per row, because filters
on a generator's output stay above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.columns import (
    AROUND,
    LARGEST_AMOUNT,
    NUMBER,
    ONE_BRACE,
    compact_errors,
    is_blank,
    is_purchase,
    parse_instant,
)
from tidemart.operators.ingest import event_date_fallback
from tidemart.schema import (
    EVENT_FIELDS,
    EVENT_SCHEMA,
    FIELD_NAMES,
    FUNNEL_STAGES,
    PURCHASE,
    REQUIRED_FIELDS,
    TIME_FIELDS,
)

COORDINATES = ("raw_payload", "topic", "partition", "offset", "kafka_timestamp")
CARRIED = COORDINATES + ("stream_ingest_time",)
MALFORMED = "malformed_json"
ALLOWED_TYPES = ", ".join(f"'{stage}'" for stage in sorted(FUNNEL_STAGES))


def _once(frame: DataFrame, struct: Column, *keep: str) -> DataFrame:
    """``keep`` plus the fields of ``struct``, which is evaluated exactly once per row."""
    return frame.select(*keep, F.inline(F.array(struct)))


def parse_payload(bronze: DataFrame) -> DataFrame:
    """Bronze with the payload as 13 typed columns; unreadable values are null."""
    return _once(bronze, F.from_json("raw_payload", EVENT_SCHEMA), *CARRIED)


# Stream rules


def stream_errors() -> Column:
    """Error codes of the typed parse, in rule order."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(f"{name}_missing")) for name in REQUIRED_FIELDS
    ]
    no_order = (
        F.col("order_id").isNull()
        | F.col("order_amount").isNull()
        | (F.col("order_amount") <= 0)
    )
    return compact_errors(
        [
            F.when(F.col("event_id").isNull(), F.lit(MALFORMED)),
            *missing,
            F.when(~F.col("event_type").isin(*FUNNEL_STAGES), F.lit("invalid_event_type")),
            F.when(is_purchase() & no_order, F.lit("purchase_missing_order_fields")),
        ]
    )


def validate_stream_rules(bronze: DataFrame) -> DataFrame:
    """Parsed rows with the error codes of the stream rules."""
    return parse_payload(bronze).select(
        "*",
        stream_errors().alias("validation_errors"),
        event_date_fallback().alias("event_date"),
    )


# Contract rules
#
# Every field is read as text, so that absent, blank and unreadable values stay apart. Text alone
# does not tell 1.0 from "1.0"; where that matters, the value's JSON type is looked up, inside a
# branch that ordinary rows do not take, because the lookup parses the payload a second time.

_CORRUPT = "corrupt_payload"
_TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*FIELD_NAMES, _CORRUPT)]
)
_TEXT_OPTIONS = {
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _text_values(bronze: DataFrame) -> DataFrame:
    """Bronze with every payload field as text, and the payload itself where it is no object."""
    return _once(bronze, F.from_json("raw_payload", _TEXT_SCHEMA, _TEXT_OPTIONS), *CARRIED)


def _malformed() -> Column:
    """Whether the payload is not one JSON object; an empty payload leaves no corrupt text.

    ``from_json`` stops after the first value. Only where a brace closes before the payload's end, or
    none at its end, is there anything behind it to be judged, and the whole payload parsed again.
    """
    text = F.coalesce(F.col("raw_payload"), F.lit(""))
    # Without its last byte: most payloads end in their only closing brace, and need no pattern match.
    before = F.substring(text.cast("binary"), F.lit(1), F.octet_length(text) - 1).cast("string")
    more = F.when(text.endswith("}"), before.contains("}")).otherwise(~text.rlike(ONE_BRACE))
    return F.col(_CORRUPT).isNotNull() | is_blank(text) | F.when(more, ~_is_one_value(text)).otherwise(F.lit(False))


def _is_one_value(text: Column) -> Column:
    """Whether nothing follows a JSON value: then it can stand in an array and in an object. Text behind
    it would have to begin with the closing bracket of both."""
    in_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _TEXT_OPTIONS)
    in_object = F.from_json(
        F.concat(F.lit('{"value":'), text, F.lit("}")), f"value string, {_CORRUPT} string", _TEXT_OPTIONS
    )
    return F.coalesce((F.size(in_array) == 1) & in_object[_CORRUPT].isNull(), F.lit(False))


def _json_type(name: str) -> Column:
    member = F.try_variant_get(F.try_parse_json("raw_payload"), f"$.{name}", "variant")
    return F.schema_of_variant(member)


def _is_json_text(name: str) -> Column:
    """Whether the payload gives the field as a JSON string. Only text that could also be a bare
    JSON value needs the lookup."""
    text = F.col(name)
    could_be_bare = (
        text.try_cast("double").isNotNull()
        | text.isin("true", "false")
        | text.startswith("[")
        | text.startswith("{")
    )
    return F.when(could_be_bare, _json_type(name) == "STRING").otherwise(text.isNotNull())


def _version() -> Column:
    """``schema_version`` as an integer: text must be an integer, numbers are cut to one."""
    text = F.col("schema_version")
    kind = _json_type("schema_version")
    flag = F.when(text == "true", F.lit(1)).otherwise(F.lit(0))
    bare = F.when(kind == "BOOLEAN", flag).when(
        kind != "STRING", text.try_cast("double").try_cast("int")
    )
    whole = text.try_cast("int")
    return F.when(text.isNull() | whole.isNotNull(), whole).otherwise(bare)


def _amount() -> Column:
    """``order_amount`` as a finite number, from a JSON number or from number text."""
    text = F.regexp_replace("order_amount", AROUND, "")
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    flag = F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0))
    # Nested, not joined by AND: a null on the left of AND would still evaluate the lookup.
    from_flag = F.when(_json_type("order_amount") == "BOOLEAN", flag)
    return F.when(F.abs(number) < F.lit(float("inf")), number).when(
        text.isin("true", "false"), from_flag
    )


def _order_id_given() -> Column:
    """Whether ``order_id`` holds something: not null, not empty, not a bare zero or false."""
    text = F.col("order_id")
    looks_empty = text.isin("0", "0.0", "-0", "-0.0", "false", "[]", "{}")
    given = F.when(looks_empty, _is_json_text("order_id")).otherwise(text != "")
    return F.coalesce(given, F.lit(False))


def _typed_values(texts: DataFrame) -> DataFrame:
    """Text values plus their typed readings under a ``typed_`` prefix."""
    readings = {
        **{name: parse_instant(F.col(name)) for name in TIME_FIELDS},
        "order_id": F.when(_order_id_given(), F.col("order_id")),
        "order_amount": _amount(),
        "schema_version": _version(),
    }
    return texts.select("*", *(column.alias(f"typed_{name}") for name, column in readings.items()))


# The texts of the contract rules, and their order, are part of the result.
def contract_errors() -> Column:
    """Error texts of the data contract, in rule order."""
    checks = [
        F.when(
            F.col(name).isNull() | is_blank(F.col(name)), F.lit(f"{name} is required")
        )
        for name in REQUIRED_FIELDS
    ]
    event_type = F.col("event_type")
    checks.append(
        F.when(
            (event_type != "") & ~event_type.isin(*FUNNEL_STAGES),
            F.lit(f"event_type must be one of [{ALLOWED_TYPES}]"),
        )
    )
    for name in TIME_FIELDS:
        shown = F.when(
            _is_json_text(name),
            F.concat(
                F.lit("Invalid isoformat string: '"),
                F.replace(F.col(name), F.lit("Z"), F.lit("+00:00")),
                F.lit("'"),
            ),
        ).otherwise(F.concat(F.lit("unsupported timestamp value: "), F.col(name)))
        checks.append(
            F.when(
                F.col(name).isNotNull() & F.col(f"typed_{name}").isNull(),
                F.concat(F.lit(f"{name} is invalid: "), shown),
            )
        )
    version = F.col("typed_schema_version")
    checks.append(
        F.when(
            F.col("schema_version").isNotNull(),
            F.when(version.isNull(), F.lit("schema_version must be an integer")).when(
                version < 1, F.lit("schema_version must be >= 1")
            ),
        )
    )
    purchase = event_type == PURCHASE
    checks.append(
        F.when(
            purchase & F.col("typed_order_id").isNull(),
            F.lit("order_id is required for purchase events"),
        )
    )
    amount = F.col("typed_order_amount")
    checks.append(
        F.when(
            purchase,
            F.when(
                F.col("order_amount").isNull() | (amount <= 0),
                F.lit("order_amount must be > 0 for purchase events"),
            ).when(amount.isNull(), F.lit("order_amount must be numeric for purchase events")),
        )
    )
    # Other events may go without an amount, but one that is given must be kept.
    given = F.col("order_amount").isNotNull()
    checks.append(
        F.when(
            ~F.coalesce(purchase, F.lit(False)) & given & amount.isNull(),
            F.lit("order_amount must be numeric"),
        )
    )
    checks.append(F.when(F.abs(amount) >= LARGEST_AMOUNT, F.lit("order_amount is too large")))
    return F.when(_malformed(), F.array(F.lit(MALFORMED))).otherwise(compact_errors(checks))


_TYPED = (*TIME_FIELDS, "order_id", "order_amount", "schema_version")


def _coerced_fields() -> list[Column]:
    return [
        F.col(f"typed_{name}" if name in _TYPED else name).cast(dtype).alias(name)
        for name, dtype in EVENT_FIELDS
    ]


def judged_payloads(bronze: DataFrame) -> DataFrame:
    """Coerced fields, error texts, and the id where the payload gives it as text."""
    return _typed_values(_text_values(bronze)).select(
        *CARRIED,
        *_coerced_fields(),
        contract_errors().alias("validation_errors"),
        F.when(_is_json_text("event_id"), F.col("event_id")).alias("text_event_id"),
    )


def validate_contract_rules(bronze: DataFrame) -> DataFrame:
    """Coerced rows with the error texts of the data contract.

    Tightenings over a bare parse: amounts must be finite, versions must fit 32 bits, and times
    must be extended ISO-8601 (basic forms such as ``20250101T100000`` are rejected).
    """
    return judged_payloads(bronze).select(
        *CARRIED,
        *FIELD_NAMES,
        "validation_errors",
        event_date_fallback().alias("event_date"),
    )


RULE_SETS = {"contract": validate_contract_rules, "stream": validate_stream_rules}


# Routing and coercion


def route_quarantine(validated: DataFrame) -> DataFrame:
    """Rows with at least one error, all columns kept."""
    return validated.filter(F.size("validation_errors") > 0)


def route_valid(validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows without errors, as Silver rows; ``keep`` names coordinates to hold on to."""
    dropped = [name for name in COORDINATES if name not in keep]
    return validated.filter(F.size("validation_errors") == 0).drop("validation_errors", *dropped)


def coerce_events(bronze: DataFrame, fail_fast: bool = False) -> DataFrame:
    """Contract-valid events with typed fields and their topic position.

    ``fail_fast`` raises on the first bad row instead of leaving bad rows out.
    """
    validated = validate_contract_rules(bronze)
    shown = [*FIELD_NAMES, "partition", "offset"]
    if not fail_fast:
        return validated.filter(F.size("validation_errors") == 0).select(*shown)
    # A filter, which unlike a column no later select can prune.
    text = F.concat_ws("; ", "validation_errors")
    refuse = F.raise_error(text).cast("boolean")
    checked = F.when(F.size("validation_errors") > 0, refuse).otherwise(F.lit(True))
    return validated.filter(checked).select(*shown)
