"""Column-level cleaning and formatting rules.

Every rule is a pure function ``Column -> Column`` built from Spark's
built-in functions, so it stays inside whole-stage codegen (no Python UDF,
no per-row Python). Raw values are text; casts use the ``try_`` variants so
one malformed value yields NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from .lookups import EMPLOYER_DEFAULT, OFFICE_LABELS, STATE_NAMES

# Characters removed from list text such as "[2024, 2026]" or "['2024']"
# before it is split on commas.
_LIST_NOISE = r"[\[\]\s'\"]"

# The time of an ISO date-time, with or without fraction and offset.
_TIME_OF_DAY = r"(?<=\d)[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"

# Amounts of this size or more (and non-finite ones) are taken for garbage:
# their multiples of 1e12 would not leave room to add up in a LONG.
AMOUNT_LIMIT = 1e27

# Sums of money have three parts, see ``money_parts``; amounts from WIDE on are
# split as decimals.
WIDE = 1e9
MONEY_PARTS = ("_amt", "_tera", "_micro")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_date(c: Column | str) -> Column:
    """Two-format date text to ISO ``yyyy-MM-dd`` text.

    * text containing ``-`` is read as year-month-day (one-digit month and
      day accepted; the time of an ISO date-time is left out);
    * text with exactly 8 digits (after dropping non-digits) is read as
      ``MMddyyyy``;
    * everything else, and every unparsable value, becomes NULL (counted by
      ``rejected_date``).
    """
    raw = _c(c)
    s = F.regexp_replace(F.trim(raw), _TIME_OF_DAY, "")
    digits = F.length(F.regexp_replace(raw, "[^0-9]", ""))
    return (
        F.when(raw.contains("-"), F.date_format(F.try_to_date(s, "yyyy-M-d"), "yyyy-MM-dd"))
        .when(digits == 8, F.date_format(F.try_to_date(s, "MMddyyyy"), "yyyy-MM-dd"))
        .otherwise(F.lit(None).cast("string"))
    )


def normalize_amount(c: Column | str) -> Column:
    """Amount text to DOUBLE; NULL, unparsable text, NaN, infinities and
    amounts of ``AMOUNT_LIMIT`` or more become 0.0 (all but NULL and blank
    text are counted by ``rejected_amount``)."""
    v = _c(c).cast("string").try_cast("double")
    return F.when(F.abs(v) < AMOUNT_LIMIT, v).otherwise(F.lit(0.0))


def rejected_date(c: Column | str) -> Column:
    """True where non-blank date text could not be read."""
    return (F.trim(_c(c)) != "") & normalize_date(c).isNull()


def rejected_amount(c: Column | str) -> Column:
    """True where non-blank amount text was replaced by 0.0."""
    raw = _c(c).cast("string")
    v = raw.try_cast("double")
    return (F.trim(raw) != "") & ~F.coalesce(F.abs(v) < AMOUNT_LIMIT, F.lit(False))


def sub_cent(c: Column | str) -> Column:
    """True where an accepted amount has digits below the cent, which sums
    carry in their own part (``micro``)."""
    v = normalize_amount(c) * 100
    return F.abs(v - F.rint(v)) > F.lit(1e-6) * F.greatest(F.lit(1.0), F.abs(v) * 1e-9)


def normalize_id(c: Column | str) -> Column:
    """Identifier: NULL -> '', upper-cased, outer blanks removed."""
    return F.trim(F.upper(F.coalesce(_c(c).cast("string"), F.lit(""))))


def normalize_label(c: Column | str, default: str = EMPLOYER_DEFAULT) -> Column:
    """Label (e.g. employer): NULL -> default, upper-cased, trimmed."""
    return F.trim(F.upper(F.coalesce(_c(c).cast("string"), F.lit(default))))


def normalize_text(c: Column | str) -> Column:
    """Other text: NULL -> ''."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def null_tokens(c: Column | str, tokens=("nan", "None")) -> Column:
    """Stringified missing values of snapshot files (``nan``/``None``) -> NULL."""
    x = _c(c).cast("string")
    return F.when(x.isin(*tokens), F.lit(None).cast("string")).otherwise(x)


def strip_list_text(c: Column | str) -> Column:
    """Remove brackets, quotes and whitespace from list text."""
    return F.regexp_replace(_c(c), _LIST_NOISE, "")


def is_non_blank(c: Column | str) -> Column:
    x = _c(c)
    return x.isNotNull() & (x != "")


def is_even(c: Column | str) -> Column:
    return (_c(c) % 2) == 0


def floor_at_zero(c: Column | str) -> Column:
    """``GREATEST(COALESCE(x, 0.0), 0.0)``."""
    return F.greatest(F.coalesce(_c(c), F.lit(0.0)), F.lit(0.0))


def _wide(v: Column) -> tuple[Column, Column]:
    """True for amounts whose parts are taken from their shortest decimal
    form (a DOUBLE of 1e9 has few digits to spare), and that form."""
    return (F.abs(v) >= WIDE) & (F.abs(v) < AMOUNT_LIMIT), v.try_cast("decimal(38,6)")


def cents(c: Column | str) -> Column:
    """The whole cents of an amount without its multiples of 1e12
    (LongType); 0 for what ``normalize_amount`` would reject."""
    v = _c(c).cast("double")
    wide, d = _wide(v)
    whole = (d % F.lit(Decimal(10 ** 12)) * F.lit(Decimal(100))).cast("long")
    return (F.when(wide, whole).when(F.abs(v) >= WIDE, F.lit(0).cast("long"))
            .otherwise(F.rint(v * 100).cast("long")))


def tera(c: Column | str) -> Column:
    """The multiples of 1e12 in an amount (LongType; 0 for nearly all)."""
    wide, d = _wide(_c(c).cast("double"))
    one = F.lit(Decimal(10 ** 12))
    return F.when(wide, ((d - d % one) / one).cast("long")).otherwise(F.lit(0).cast("long"))


def micro(c: Column | str) -> Column:
    """What ``cents`` leaves of an amount, in millionths (LongType; 0 for nearly all)."""
    v = _c(c).cast("double")
    wide, d = _wide(v)
    rest = F.rint((v - F.rint(v * 100) / F.lit(100)) * 1e6).cast("long")
    return (F.when(wide, (d % F.lit(Decimal("0.01")) * F.lit(Decimal(10 ** 6))).cast("long"))
            .when(F.abs(v) < WIDE, rest).otherwise(F.lit(0).cast("long")))


def money_parts(c: Column | str) -> list[Column]:
    """An amount as three integers that add up to it, named ``MONEY_PARTS``.

    Money is summed in these parts: integer addition is exact and
    associative, so totals do not depend on the order rows reach an
    aggregate, and LONG sum buffers stay on the fast primitive path (a
    DECIMAL buffer wider than 18 digits falls back to BigDecimal arithmetic
    per row). Together they hold the shortest decimal form of every amount
    below ``AMOUNT_LIMIT``, to the millionth. A part
    that leaves a LONG ends the job (ANSI); it takes 9.2e16 of money in
    amounts below 1e12, 9.2e18 multiples of it, or 1e15 rows.
    """
    return [f(c).alias(name) for f, name in zip((cents, tera, micro), MONEY_PARTS)]


def from_cents(c: Column | str) -> Column:
    """Integer cents back to a DOUBLE amount (exact for |x| < 2^53 cents)."""
    return _c(c) / F.lit(100)


def exact_cents(amt: Column | str = "_amt", teras: Column | str = "_tera", micros: Column | str = "_micro") -> Column:
    """Summed money parts as one exact number of cents (DECIMAL)."""
    whole = _c(teras).cast("decimal(20,0)") * F.lit(Decimal(100 * 10 ** 12)) + _c(amt).cast("decimal(20,0)")
    return whole + _c(micros).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))


def from_parts(amt: Column | str = "_amt", teras: Column | str = "_tera", micros: Column | str = "_micro") -> Column:
    """Summed money parts as the DOUBLE nearest to their total."""
    plain = (_c(teras) == 0) & (_c(micros) == 0)
    total = (_c(teras).cast("decimal(20,0)") * F.lit(Decimal(10 ** 12))
             + _c(amt).cast("decimal(20,0)") * F.lit(Decimal("0.01"))
             + _c(micros).cast("decimal(20,0)") * F.lit(Decimal("0.000001")))
    return F.when(plain, from_cents(amt)).otherwise(total.cast("double"))


def sum_money(c: Column | str, window: WindowSpec | None = None) -> Column:
    """Order-independent exact sum of amounts, as the nearest DOUBLE."""
    sums = (F.sum(f(c)) for f in (cents, tera, micro))
    return from_parts(*(s.over(window) if window is not None else s for s in sums))


def lookup(c: Column | str, mapping: Mapping[str, str], fallback_to_key: bool = True) -> Column:
    """Map lookup done JVM-side through a literal map column."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(m, _c(c))
    return F.coalesce(hit, _c(c)) if fallback_to_key else hit


def state_full(c: Column | str, mapping: Mapping[str, str] = STATE_NAMES) -> Column:
    """Postal code -> full state name; unknown codes fall back to the code."""
    return lookup(c, mapping, fallback_to_key=True)


def office_label(c: Column | str, mapping: Mapping[str, str] = OFFICE_LABELS) -> Column:
    """Office code -> label; unknown codes fall back to the code."""
    return lookup(c, mapping, fallback_to_key=True)


def format_currency(c: Column | str) -> Column:
    """``$1,234.50`` (negative: ``$-1,234.50``)."""
    return F.concat(F.lit("$"), F.format_number(_c(c), 2))


def format_count(c: Column | str) -> Column:
    """``1,234``."""
    return F.format_number(_c(c), 0)
