"""Small column expressions: money, time, text and error lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.schema import PURCHASE

# Wide enough that summing never loses a cent: sums are decimal(38,6).
EXACT_AMOUNT = "decimal(28,6)"
# Amounts from here on do not fit; the contract rules report them.
LARGEST_AMOUNT = 1e22

# Fixed value: text that counts as blank; (?U) takes in every Unicode space.
BLANK = r"(?U)^[\s\x1c-\x1f]*\z"
# The ISO-8601 profile that event times must follow, in full (or a bare date), and
# with seconds, or minutes and seconds, left out.
ISO_FULL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}([.]\d{1,9})?(Z|[+-]\d{2}(:\d{2})?)?)?\z"
ISO_SHORT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}(:\d{2})?(Z|[+-]\d{2}(:\d{2})?)?\z"
UP_TO_HOUR = r"^(.{13})(Z|[+-].*)?\z"
UP_TO_MINUTE = r"^(.{16})(Z|[+-].*)?\z"
# The other forms of ISO-8601, each rewritten to the full one: basic dates, times and
# offsets, and commas before fractions. Week dates are rewritten by their calendar.
ISO_OTHER = (
    r"^(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}-\d|\d{4}W\d{3})"
    r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?\z"
)
REWRITES = (
    (r"^(\d{4})(\d{2})(\d{2})(?=[T ]|\z)", "$1-$2-$3"),
    (r"^(.{10}[T ]\d{2})(\d{2})", "$1:$2"),
    (r"^(.{10}[T ]\d{2}:\d{2})(\d{2})", "$1:$2"),
    (r",", "."),
    (r"([+-]\d{2})(\d{2})\z", "$1:$2"),
)
WEEK_DATE = r"^(\d{4})-?W(\d{2})-?(\d)(.*)\z"
# Fixed value: text whose only closing brace ends it, but for white space of JSON.
ONE_BRACE = r"\A[^}]*+[}][ \t\r\n]*+\z"
# Fixed value: decimal number text, as accepted for an amount.
NUMBER = r"^[+-]?(\d+([.]\d*)?|[.]\d+)([eE][+-]?\d+)?\z"
# Fixed value: white space around number text.
AROUND = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def is_purchase() -> Column:
    return F.col("event_type") == F.lit(PURCHASE)


def exact_amount(amount: Column) -> Column:
    """The amount as a decimal; null when it is missing or not finite.

    One of LARGEST_AMOUNT and more raises: it would be lost from a sum. The contract rules keep such
    events out of Silver; events that came in by looser rules have to be corrected first.
    """
    size = F.abs(amount)
    too_large = (size >= F.lit(LARGEST_AMOUNT)) & (size < F.lit(float("inf")))
    refused = F.raise_error(F.concat(F.lit("order_amount is too large to be summed: "), amount.cast("string")))
    return F.when(too_large, refused.cast(EXACT_AMOUNT)).otherwise(amount.try_cast(EXACT_AMOUNT))


def _zero() -> Column:
    return F.lit(0).cast(EXACT_AMOUNT)


def amount_or_zero() -> Column:
    """An event's exact amount, whatever its type; 0 when it has none."""
    return F.coalesce(exact_amount(F.col("order_amount")), _zero())


def purchase_amount() -> Column:
    """An event's exact amount when it is a purchase, else 0."""
    return F.when(is_purchase(), exact_amount(F.col("order_amount"))).otherwise(_zero())


def as_money(total: Column) -> Column:
    """A decimal total rounded half-up to cents and shown as a double."""
    return F.round(total, 2).cast("double")


def is_blank(text: Column) -> Column:
    # Text that starts with a visible ASCII character needs no pattern match.
    unsure = (text < F.lit("!")) | (text >= F.lit("\x7f"))
    return unsure & text.rlike(BLANK)


def parse_instant(text: Column) -> Column:
    """ISO-8601 text as a UTC instant, null when it does not follow the profile."""
    # The patterns keep out what a bare cast would take, such as '2025' or '10:00'.
    return (
        F.when(text.rlike(ISO_FULL), text.try_cast("timestamp"))
        .when(text.rlike(ISO_SHORT), _with_seconds(text).try_cast("timestamp"))
        .when(text.rlike(ISO_OTHER), _with_seconds(_extended(text)).try_cast("timestamp"))
    )


def _with_seconds(text: Column) -> Column:
    to_minute = F.regexp_replace(text, UP_TO_HOUR, "$1:00$2")
    return F.regexp_replace(to_minute, UP_TO_MINUTE, "$1:00$2")


def _extended(text: Column) -> Column:
    """Basic, comma and week forms as the extended calendar form; null for a week that is not."""
    year, week, day = (F.regexp_extract(text, WEEK_DATE, k).try_cast("int") for k in (1, 2, 3))
    # The week that holds January 4 is the first.
    monday = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    date = F.date_add(monday, (week - 1) * 7 + day - 1)
    real = week.between(1, 53) & day.between(1, 7) & (F.weekofyear(date) == week)
    from_week = F.when(real, F.concat(date.cast("string"), F.regexp_extract(text, WEEK_DATE, 4)))
    found = F.when(text.rlike(WEEK_DATE), from_week).otherwise(text)
    for pattern, form in REWRITES:
        found = F.regexp_replace(found, pattern, form)
    return found


def compact_errors(checks: Iterable[Column]) -> Column:
    """The codes that fired, in order. Codes of one rule set are unique by construction."""
    return F.array_except(F.array(*checks), F.array(F.lit(None).cast("string")))
