"""Text expressions: labels, rules, natural order, spreadsheet-safe cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.grains import as_column

# Fixed values.
NULL_LABEL = "<NULL>"
EMPTY_LABEL = "<empty string>"
LABEL_SEPARATOR = ", "
FORMULA_STARTS = ("-", "@", "+", "|", "=", "%")


def label_by_rules(col: Column | str, rules: Sequence[tuple[str, object]], default: object) -> Column:
    """PR9: the value of the first rule whose text occurs in ``col`` (case-sensitive)."""
    text, result = as_column(col), None
    for needle, value in rules:
        hit = text.contains(needle)
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def first_word(col: Column | str) -> Column:
    """PR10."""
    return F.concat(F.lit("designed by "), F.regexp_extract(as_column(col), r"(\w+)", 1))


def guard_cell(col: Column | str) -> Column:
    """SC15: neutralise text a spreadsheet would run as a formula; negative numbers pass."""
    text = as_column(col)
    bare = F.regexp_replace(text, r'^(?:""|\s+)', "")
    starts = F.substring(bare, 1, 1).isin(*FORMULA_STARTS)
    number = text.startswith("-") & (F.length(text) > 1) & (F.translate(F.substring(text, 2, 2**30), "0123456789.", "") == "")
    risky = starts & ~number
    return F.when(risky, F.concat(F.lit("'"), F.replace(text, F.lit("|"), F.lit("\\|")))).otherwise(text)


def natural_key(col: Column | str) -> Column:
    """SL7: sort key in which digit runs of any length compare as numbers.

    The text is cut into runs of digits and of other characters; a digit run compares by the number of its digits
    without leading zeros, then by these. Against other text it stands where the digit 0 stands.
    """
    runs = F.regexp_extract_all(as_column(col).cast("string"), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))

    def part(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+", "")
        number = run.rlike("^[0-9]")
        return F.struct(
            F.when(number, F.lit("0")).otherwise(run).alias("text"),
            F.when(number, F.length(digits)).otherwise(F.lit(0)).alias("size"),
            F.when(number, digits).otherwise(F.lit("")).alias("digits"),
        )

    return F.transform(runs, part)


def escape_label(text: str) -> str:
    """AG9: a comma inside a value does not separate levels."""
    return text.replace(",", "\\,")


def unescape_label(text: str) -> str:
    return text.replace("\\,", ",")


def join_label(parts: Sequence[object]) -> str:
    """AG9: ``metric, value1, value2``; null parts are skipped."""
    return LABEL_SEPARATOR.join(escape_label(str(p)) for p in parts if p is not None)
