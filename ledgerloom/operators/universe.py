"""Building and cleaning the list of companies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.text import bare_cik, normal_cik, ticker_class, ticker_quality, tidy_ticker, zero_fill
from ledgerloom.operators.dedupe import keep_first
from ledgerloom.operators.quality import require_columns
from ledgerloom.operators.ranks import numbered_by_sort

REQUIRED = ("ticker", "cik", "company")
OPTIONAL = ("sic_code", "sic_description", "target_sector")


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows with a NULL required value, or a blank ticker or company, go."""
    return df.dropna(subset=list(required)).where((F.trim("ticker") != "") & (F.trim("company") != ""))


def clean_universe(df: DataFrame, order: str = "row_id") -> DataFrame:
    """Standard ids and names, then one row per ticker and after that one per cik, in file order."""
    whole = drop_incomplete(df).withColumns(
        {
            "ticker": tidy_ticker(F.col("ticker")),
            "company": F.trim("company"),
            "cik": normal_cik(F.col("cik")),
        }
    )
    by_ticker = keep_first(whole, ["ticker"], [order])
    by_cik = keep_first(by_ticker, ["cik"], [order])
    optional = [
        F.col(name) if name in df.columns else F.lit("").alias(name) for name in OPTIONAL
    ]
    return by_cik.select("ticker", "cik", "company", *optional)


def company_list(df: DataFrame, order: str = "row_id") -> DataFrame:
    """Validated and cleaned universe."""
    return clean_universe(require_columns(df, REQUIRED), order)


def matched_only(universe: DataFrame, filers: DataFrame, on: str = "cik_key") -> DataFrame:
    """Universe rows whose filer is known."""
    keyed = universe.withColumn(on, bare_cik(F.col("cik")))
    return keyed.join(filers.select(on).distinct(), on, "left_semi").drop(on)


def with_filer_lookup(universe: DataFrame, categories: DataFrame) -> DataFrame:
    """Industry columns by bare cik; unmatched companies get '' and 'Unknown'.

    Of several categories for one company the least counts. Unreadable ids match nothing.
    """
    industry = ["sic_code", "sic_description", "target_sector"]
    keyed = categories.select(bare_cik(F.col("cik")).alias("cik_key"), *industry).where(F.col("cik_key") != "")
    side = keep_first(keyed, ["cik_key"], industry)
    joined = universe.drop(*OPTIONAL).withColumn("cik_key", bare_cik(F.col("cik"))).join(side, "cik_key", "left")
    return joined.withColumns(
        {
            "sic_code": F.coalesce("sic_code", F.lit("")),
            "sic_description": F.coalesce("sic_description", F.lit("Unknown")),
            "target_sector": F.coalesce("target_sector", F.lit("Unknown")),
        }
    ).drop("cik_key")


def with_profiles(universe: DataFrame, profiles: DataFrame) -> DataFrame:
    """Filer profile columns; NULL where no submission document was found."""
    keyed = universe.withColumn("cik_key", bare_cik(F.col("cik")))
    return keyed.join(profiles, "cik_key", "left").drop("cik_key")


def is_domestic_filer() -> Column:
    """An operating company that files annual reports as a domestic issuer and has an industry."""
    sic = F.col("sic_code").cast("string")
    return (
        F.col("files_10k")
        & ~F.col("files_20f_or_40f")
        & (F.lower("entity_type") == "operating")
        & sic.isNotNull()
        & (sic != "")
    )


def domestic_filers(df: DataFrame) -> DataFrame:
    return df.where(is_domestic_filer())


def pick_sector(df: DataFrame, sector: str | None = None, max_rows: int | None = None) -> DataFrame:
    """Optional restriction to one sector, and to the first rows by company name."""
    kept = df if sector is None else df.where(F.col("target_sector") == sector)
    return kept if max_rows is None else kept.orderBy("company", "cik").limit(max_rows)


def in_listing_order(df: DataFrame, order: Sequence[Column | str] = ("company", "cik")) -> DataFrame:
    """All rows with their ``position`` in a list sorted by name (or ticker), sorted in ranges without a limit."""
    return numbered_by_sort(df, order, name="position")


def drop_shells(
    df: DataFrame, shell_codes: Sequence[int] = rules.SHELL_SIC, keep_shells: bool = False
) -> DataFrame:
    """Leave out blank-check and pooled vehicles; a missing industry code stays."""
    return df if keep_shells else df.where(is_no_shell(shell_codes))


def is_no_shell(shell_codes: Sequence[int] = rules.SHELL_SIC) -> Column:
    code = F.col("sic_code").cast("string").try_cast("double")
    return code.isNull() | ~code.isin(*[float(c) for c in shell_codes])


def one_ticker_per_cik(df: DataFrame, cik: str = "cik") -> DataFrame:
    """The likeliest common-stock ticker of every company."""
    return keep_first(df, [cik], [ticker_quality(F.col("ticker")), F.col("ticker")])


def shortest_primary(df: DataFrame, cik: str = "cik", ties: Sequence[Column | str] = ()) -> DataFrame:
    """The shortest ticker per company, then one company per ticker."""
    by_cik = keep_first(df, [cik], [F.length("ticker"), F.col("ticker"), *ties])
    return keep_first(by_cik, ["ticker"], [F.length("ticker"), F.col(cik), *ties])


def with_ticker_type(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"ticker": tidy_ticker(F.col("ticker")), "ticker_type": ticker_class(F.col("ticker"))}
    )


def split_primary(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a primary ticker, and all others."""
    typed = df if "ticker_type" in df.columns else with_ticker_type(df)
    primary = F.col("ticker_type") == "PRIMARY"
    return typed.where(primary), typed.where(~primary)


def primary_listing(df: DataFrame) -> DataFrame:
    """One primary ticker per company with standard ids."""
    primary, _ = split_primary(df)
    padded = primary.withColumn("_cik", zero_fill(F.col("cik").cast("string"), 10))
    chosen = shortest_primary(padded, "_cik", ["company"])
    optional = [F.col(name) if name in df.columns else F.lit("").alias(name) for name in OPTIONAL]
    return chosen.select("ticker", normal_cik(F.col("cik")).alias("cik"), "company", *optional)


def distinct_listings(df: DataFrame) -> DataFrame:
    """Ids, tickers and codes in one spelling, then every different row once."""
    return df.withColumns(
        {
            "cik": zero_fill(F.trim(F.col("cik").cast("string")), 10),
            "ticker": tidy_ticker(F.col("ticker")),
            "sic_code": F.col("sic_code").cast("string").try_cast("double"),
        }
    ).dropDuplicates()


def research_universe(
    df: DataFrame, shell_codes: Sequence[int] = rules.SHELL_SIC, keep_shells: bool = False
) -> DataFrame:
    """Tidy, drop exact copies, one ticker per company, no shells, tagged with the annual form."""
    kept = drop_shells(one_ticker_per_cik(distinct_listings(df)), shell_codes, keep_shells)
    rest = [name for name in kept.columns if name not in ("cik", "ticker")]
    return kept.select("cik", F.lit("10-K").alias("filing_tag"), "ticker", *rest)
