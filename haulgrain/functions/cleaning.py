"""Cleaning and safe-typing rules.

Each rule maps a SQL expression to a SQL expression, so a whole staging table is one
``selectExpr`` of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain import contracts

MONEY = "decimal(18,2)"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def text(x: str) -> str:
    """Trimmed text; blank becomes null."""
    return f"nullif(trim(string({x})), '')"


def upper(x: str) -> str:
    return f"upper({text(x)})"


def lower(x: str) -> str:
    return f"lower({text(x)})"


def code(x: str) -> str:
    """Matching form of a customer code. Blank stays blank, so blanks match each other."""
    return f"upper(translate(trim(string({x})), '- ', ''))"


def country(x: str) -> str:
    return f"if({upper(x)} IN ({_quoted(contracts.US_SPELLINGS)}), 'US', {upper(x)})"


def to_double(x: str) -> str:
    # Java reads a trailing f or d as a number suffix; in source text it is no number.
    t = f"trim(string({x}))"
    return (
        f"if(lower(right({t}, 1)) IN ('f', 'd') AND lower(right({t}, 3)) <> 'inf', NULL,"
        f" try_cast({t} AS double))"
    )


def to_int(x: str) -> str:
    """Whole number, rounding text such as '10.7' half away from zero."""
    return f"try_cast(round({to_double(x)}) AS int)"


def to_money(x: str) -> str:
    return f"try_cast(string({x}) AS {MONEY})"


def _day_text(x: str) -> str:
    """Trimmed text with dashes; null unless it has year, month and day parts.

    Spark alone would read '2024' as January 1st. Plain string tests keep this cheap: the
    regular expression runs only for text with slashes.
    """
    t = f"trim(string({x}))"
    s = f"if(contains({t}, '/'), regexp_replace({t}, '^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})', '$1-$2-$3'), {t})"
    return f"if(substring_index({s}, '-', 2) <> {s} AND NOT startswith({s}, '-'), {s}, NULL)"


def to_date(x: str) -> str:
    """Date, or null unless the text is a day or a full timestamp."""
    s = _day_text(x)
    return (
        f"if(contains({s}, ' ') OR contains({s}, 'T'),"
        f" date(try_cast({s} AS timestamp_ntz)), try_cast({s} AS date))"
    )


def to_ts(x: str) -> str:
    """Wall-clock timestamp without zone."""
    return f"try_cast({_day_text(x)} AS timestamp_ntz)"


def to_tri(x: str) -> str:
    """Boolean that stays null when it cannot be read; padded text is not readable."""
    s = f"string({x})"
    return f"if(trim({s}) = {s}, try_cast({s} AS boolean), NULL)"


def to_flag(x: str) -> str:
    return f"coalesce({to_tri(x)}, false)"


RULES = {
    "text": text,
    "upper": upper,
    "lower": lower,
    "code": code,
    "country": country,
    "int": to_int,
    "double": to_double,
    "money": to_money,
    "date": to_date,
    "ts": to_ts,
    "tri": to_tri,
    "flag": to_flag,
}


def cleaned(rule: str, column: str) -> Column:
    """One rule applied to one column."""
    return F.expr(RULES[rule](f"`{column}`"))


def typed_select(raw: DataFrame, table: str) -> DataFrame:
    """Clean and type every contracted column of a staging table in one projection."""
    cols = contracts.staged_columns(table)
    contracts.require_columns(raw, {src for _, _, src in cols}, f"input of {table}")
    return raw.selectExpr(*[f"{RULES[rule](f'`{src}`')} AS {dst}" for dst, rule, src in cols])


def bucket_by_words(x: str, buckets, otherwise: str) -> Column:
    """First bucket one of whose words occurs in ``x``."""
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains({x}, '{w}')" for w in words) + f" THEN '{label}'"
        for label, words in buckets
    )
    return F.expr(f"CASE {arms} ELSE {otherwise} END")
