"""Text expressions: names, e-mail users, cron text, classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters that become "_" in an identifier.
NOT_IN_IDENTIFIER = " -'.,;:!?()[]{}/\\|&@#%+=$^~"


def _character_class(characters: str) -> str:
    return "[" + "".join("\\" + c if not c.isalnum() and c != " " else c for c in characters) + "]"


def identifier(value: Column) -> Column:
    """The value as a lower-case identifier."""
    return F.lower(F.regexp_replace(value, _character_class(NOT_IN_IDENTIFIER), "_"))


def underscore_names(df: DataFrame) -> DataFrame:
    """All column names with ``_`` for spaces."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def email_user(email: Column) -> Column:
    """The part before ``@`` with ``_`` for dots; NULL where nothing stands before an ``@``."""
    user = F.regexp_extract(email, "^([^@]+)@", 1)
    return F.when(user != "", F.translate(user, ".", "_"))


def name_part(name: Column, index: int) -> Column:
    """Part of a dotted name counted from 0, NULL when the name is shorter."""
    return F.get(F.split(name, r"\."), F.lit(index))


def name_parts(name: Column, prefix: str = "") -> list[Column]:
    """Catalog, schema and table of a three-part name."""
    return [
        name_part(name, i).alias(f"{prefix}{part}")
        for i, part in enumerate(("catalog", "schema", "table"))
    ]


def classify(text: Column, labels: Mapping[str, Sequence[str]], default: str) -> Column:
    """The first label one of whose LIKE patterns fits; the default also for NULL."""
    result = F
    for label, patterns in labels.items():
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | text.like(pattern)
        result = result.when(hit, F.lit(label))
    return result.otherwise(F.lit(default))


# Payment text patterns per category.
PAYMENT_CATEGORIES = {
    "Payroll": ("%salary%", "%Salary%"),
    "Education": ("%training%", "%Training%"),
    "Office Expenses": ("%office%", "%Office%"),
}


def translate_by(value: Column, table: Mapping[str, str]) -> Column:
    """Dictionary translation; NULL for a value the dictionary lacks."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), value)


def cron_text(cron: Column) -> Column:
    """Readable form of ``second minute hour day-of-month month day-of-week``; NULL stays NULL."""
    part = F.split(F.trim(cron), r"\s+")
    second, minute, hour, day, weekday = (F.get(part, F.lit(i)) for i in (0, 1, 2, 3, 5))
    at = F.concat(F.lit("At "), hour, F.lit(":"), minute, F.lit(":"), second)
    when = (
        F.when((day == "*") & (weekday == "?"), F.lit(" every day"))
        .when(day == "*", F.concat(F.lit(" on every "), weekday))
        .when(weekday == "?", F.concat(F.lit(" on day "), day, F.lit(" of the month")))
        .otherwise(F.lit(""))
    )
    return F.concat(at, when)


def hash_key(*values: Column) -> Column:
    """SHA-256 over the values joined by ``||``; NULL values are left out."""
    return F.sha2(F.concat_ws("||", *values), 256)
