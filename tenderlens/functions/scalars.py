"""Column expressions. Every function takes and returns Columns and stays inside code generation."""

from functools import reduce

from pyspark.sql import Column, functions as F

from tenderlens.schema import EUR_RATES, SIZE_ORDINALS, TIME_FORMAT


def col(name: str) -> Column:
    """A column by its literal name; dots and hyphens are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def currency_code(text: Column) -> Column:
    """The first known code that occurs in the text, in rate-table order; EUR otherwise."""
    return F.coalesce(*[F.when(text.contains(code), F.lit(code)) for code in EUR_RATES], F.lit("EUR"))


def money(text: Column) -> Column:
    """A number from money text: decimal commas to points, all but digits and points dropped, else null."""
    digits = F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), "[^0-9.]", "")
    return digits.try_cast("double")


def rate_map() -> Column:
    return F.create_map(*[F.lit(part) for pair in EUR_RATES.items() for part in pair])


def to_eur(value: Column, currency: Column) -> Column:
    return value * F.coalesce(F.try_element_at(rate_map(), currency), F.lit(1.0))


def capped(value: Column, limit: float | None) -> Column:
    """``value`` limited to ``limit``; null stays null."""
    bound = F.lit(limit).cast("double")
    return F.when(value < bound, value).when(value.isNotNull(), bound)


def above(value: Column, limit: float | None) -> Column:
    return F.coalesce(value > F.lit(limit).cast("double"), F.lit(False))


def log_value(value: Column) -> Column:
    """log(1 + value), with missing and infinite values counted as 0."""
    finite = F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.lit(0.0))
    return F.log1p(finite)


def _size_missing(text: Column) -> Column:
    return text.isNull() | text.isin("nan", "None")


def bidder_count(text: Column) -> Column:
    return F.when(_size_missing(text), F.lit(0)).otherwise(F.size(F.split(text, "[|]")))


def primary_size(text: Column) -> Column:
    return F.when(~_size_missing(text), F.split(text, "[|]").getItem(0))


def size_ordinal(size: Column) -> Column:
    pairs = [F.lit(part) for pair in SIZE_ORDINALS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), size)


def equals_flag(value: Column, wanted: str) -> Column:
    return F.coalesce((value == F.lit(wanted)).cast("int"), F.lit(0))


def status_label(flag: Column) -> Column:
    return F.when(flag, F.lit("OUTLIER")).otherwise(F.lit("NORMAL"))


def round_score(score: Column) -> Column:
    return F.bround(score, 4)


def stamp(as_of: str | None = None) -> Column:
    """A prediction time as text; ``as_of`` fixes it."""
    return F.date_format(F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp(), TIME_FORMAT)


def _tenths(y: Column) -> Column:
    """``y`` in whole tenths, rounded half to even on its exact binary value.

    10*y is a sum plus the sum's exact rounding error. Rounding cannot carry the sum past
    the midpoint of two integers, only onto it; there the error's sign decides.
    """
    total = y * 8.0 + y * 2.0
    error = y * 2.0 - (total - y * 8.0)
    midpoint = F.abs(total - F.rint(total)) == 0.5
    return F.rint(F.when(midpoint, total + F.signum(error) * 0.25).otherwise(total))


def currency_label(value: Column) -> Column:
    """Short euro text: billions, millions and thousands with one decimal, else whole euro."""
    unit = F.when(value >= 1e9, 1e9).when(value >= 1e6, 1e6).otherwise(1e3)
    suffix = F.when(value >= 1e9, "B").when(value >= 1e6, "M").otherwise("K")
    tenths = (_tenths(value / unit) / 10.0).cast("decimal(20,1)").cast("string")
    whole = F.concat(F.lit("€"), F.rint(value).cast("bigint").cast("string"))
    return F.when(value >= 1e3, F.concat(F.lit("€"), tenths, suffix)).otherwise(whole)


def parameters_text(parameters: Column) -> Column:
    return F.to_json(parameters)


def parameters_map(text: Column) -> Column:
    """The map held in JSON text, or null where the text is not a JSON object."""
    return F.from_json(text, "map<string,string>")


def text_or_unknown(columns, names) -> Column:
    """Per row the first non-null of the present columns as text, else 'unknown'."""
    present = [col(name).cast("string") for name in names if name in columns]
    return F.coalesce(*present, F.lit("unknown"))


def number_or_zero(columns, names) -> Column:
    """Per row the first value that reads as a number, else 0."""
    present = [col(name).try_cast("double") for name in names if name in columns]
    return F.coalesce(*present, F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def distance(left: list[Column], right: list[Column]) -> Column:
    squares = [(a - b) * (a - b) for a, b in zip(left, right)]
    return F.sqrt(reduce(lambda a, b: a + b, squares))
