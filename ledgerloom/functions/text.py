"""Identifiers, names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import round_half_even

NBSP = "\u00a0"


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros after any sign; longer text is kept whole."""
    signed = text.rlike("^[+-]")
    body = F.regexp_replace(text, "^[+-]", "")
    sign = F.when(signed, F.substring(text, 1, 1)).otherwise(F.lit(""))
    room = F.lit(width) - F.length(sign)
    padded = F.concat(sign, F.repeat(F.lit("0"), room - F.length(body)), body)
    return F.when(F.length(text) >= width, text).otherwise(padded)


def normal_cik(raw: Column) -> Column:
    """Ten-digit filer id; '320193.0' parses, unreadable ids become all zeros."""
    number = F.coalesce(raw.cast("string").try_cast("double").try_cast("bigint"), F.lit(0))
    return zero_fill(number.cast("string"), 10)


def bare_cik(raw: Column) -> Column:
    """Filer id without its leading zeros."""
    return F.regexp_replace(raw.cast("string"), "^0+", "")


def spreadsheet_id(raw: Column) -> Column:
    """Text formula that stops a spreadsheet from dropping leading zeros."""
    return F.concat(F.lit('="'), zero_fill(raw.cast("string"), 10), F.lit('"'))


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, also after apostrophes and ampersands."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    raised = F.transform(
        runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substring(run, 2, 2**31 - 1))
    )
    return F.array_join(raised, "")


def tidy_company(text: Column) -> Column:
    """Literal and real non-breaking spaces to blanks, trimmed, title case."""
    spaced = F.replace(F.replace(text, F.lit("\\xa0"), F.lit(" ")), F.lit(NBSP), F.lit(" "))
    return title_case(F.trim(spaced))


def tidy_ticker(text: Column) -> Column:
    return F.upper(F.trim(text))


# Form suffixes and marks that tell share classes apart.
FOREIGN_SUFFIXES = ("YF", "SF", "XF", "OF", "FF")
WARRANT_SUFFIXES = ("WT", "WS")
PREFERRED_MARKS = ("-PA", "-PB", "-PC")
CLASS_ENDINGS = ("A", "B", "C", "PA", "PB", "PC")


def ticker_class(raw: Column) -> Column:
    """FOREIGN_OTC, WARRANT, PREFERRED, CLASS_SHARE or PRIMARY, first rule wins."""
    ticker = tidy_ticker(raw)
    size = F.length(ticker)
    foreign = (ticker.rlike(f"({'|'.join(FOREIGN_SUFFIXES)})$") & (size > 4)) | (
        ticker.endswith("F") & (size > 5)
    )
    ending = F.substring_index(ticker, "-", -1)
    return (
        F.when(foreign, F.lit("FOREIGN_OTC"))
        .when(ticker.rlike(f"({'|'.join(WARRANT_SUFFIXES)})$"), F.lit("WARRANT"))
        .when(ticker.rlike("|".join(PREFERRED_MARKS)), F.lit("PREFERRED"))
        .when(ticker.contains("-") & (size <= 6) & ending.isin(*CLASS_ENDINGS), F.lit("CLASS_SHARE"))
        .otherwise(F.lit("PRIMARY"))
    )


def ticker_quality(raw: Column) -> Column:
    """Struct that sorts the likeliest common-stock ticker first."""
    ticker = tidy_ticker(raw)
    size = F.length(ticker)
    odd_line = (size > 3) & ticker.rlike("[WUR]$") & ~ticker.endswith("OR")
    return F.struct(
        ticker.contains("-").cast("int").alias("hyphen"),
        odd_line.cast("int").alias("odd_line"),
        size.alias("size"),
    )


def nested_text(path: str, default: str = "") -> Column:
    """A field of a document, or the default where it or anything above it is missing."""
    return F.coalesce(F.col(path), F.lit(default))


def first_or_blank(items: Column) -> Column:
    return F.coalesce(F.get(items, F.lit(0)), F.lit(""))


def lists_item(items: Column, item: str) -> Column:
    """Exact membership; a missing list holds nothing."""
    return F.coalesce(F.array_contains(items, item), F.lit(False))


def join_present(items: Column, separator: str = ",") -> Column:
    kept = F.filter(items, lambda item: item.isNotNull() & (item != ""))
    return F.coalesce(F.array_join(kept, separator), F.lit(""))


def money_label(amount: Column) -> Column:
    size = F.abs(amount)
    billions = F.format_string("$%.1fB", round_half_even(amount / 1e9, 1))
    millions = F.format_string("$%.0fM", F.rint(amount / 1e6))
    plain = F.concat(F.lit("$"), F.format_number(F.rint(amount), 0))
    return (
        F.when(amount.isNull() | (amount == 0), F.lit("N/A"))
        .when(size >= 1e9, billions)
        .when(size >= 1e6, millions)
        .otherwise(plain)
    )


def percent_label(share: Column) -> Column:
    label = F.format_string("%.0f%%", F.rint(share * 100))
    return F.when(share.isNotNull(), label).otherwise(F.lit("N/A"))
