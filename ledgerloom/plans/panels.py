"""From fact documents or stored long facts to the quarterly and the annual panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.operators import annual, facts, features, statements
from ledgerloom.session import intermediates
from ledgerloom.sources import documents as docs
from ledgerloom.sources.tables import write_panel

# A document's ticker is its file name, so the ticker alone makes a filer's rows unique.
ENTITY = ("ticker", "cik", "company")


def _tags(*groups: dict) -> list[str]:
    return sorted({tag for fields in groups for tags in fields.values() for tag in tags})


def quarterly_facts(documents: DataFrame) -> DataFrame:
    tags = _tags(rules.BALANCE_SHEET, rules.INCOME_STATEMENT, rules.CASH_FLOW)
    return docs.flatten_facts(documents, tags, rules.QUARTERLY_UNITS)


def annual_facts(documents: DataFrame) -> DataFrame:
    tags = _tags(rules.ANNUAL_GAAP, rules.ANNUAL_DEI)
    return docs.flatten_facts(documents, tags, rules.ANNUAL_UNITS, any_unit=True)


def in_one_unit(
    long_facts: DataFrame, forms: Sequence[str], units: Sequence[str], any_unit: bool = False
) -> DataFrame:
    """Each tag's accepted facts in the first listed unit it has at all, latest filing per period.

    Facts with a ``unit_pos`` may hold a tag in several units, whose values must not compete. With
    ``any_unit`` other units follow in the document's order. Facts without it were flattened with a
    unit preference: the choice is made, and nothing has to be shuffled for it.
    """
    if "unit_pos" not in long_facts.columns:
        return facts.accepted(long_facts, forms)
    others = F.col("unit_pos") if any_unit else None
    accepted = F.col("form").isin(*forms) & F.col("period_end").isNotNull() & F.col("val").isNotNull()
    return facts.latest_in_preferred_unit(
        long_facts,
        [*ENTITY, "taxonomy", "tag"],
        "period_end",
        facts.unit_rank(F.col("unit"), units, others),
        accepted,
        ["val", "pos"],
    )


def quarterly_panel(long_facts: DataFrame, universe: DataFrame, join_on: str = "filing") -> DataFrame:
    """One row per filer and period end, with industry and identity check.

    Two shuffles over facts whose units are chosen: one to the winning value per field and period,
    which combines on the map side, and one of those winners to the filer, where the statements meet.
    Facts in several units are first reduced to the latest value per tag, unit and period.
    """
    kept = in_one_unit(long_facts, rules.QUARTERLY_FORMS, rules.QUARTERLY_UNITS)
    tagged = facts.with_fields(kept, rules.quarterly_rules(long_facts.sparkSession))
    resolved = facts.resolve_by_period(tagged, ENTITY)
    merged = statements.merge_statements(resolved, ENTITY, join_on=join_on)
    checked = statements.identity_check(statements.with_metadata(merged, universe))
    return statements.in_order(
        checked,
        [*rules.METADATA, *rules.QUARTERLY_FIELDS, "balance_sheet_difference", "balance_sheet_valid"],
    )


def quarterly_dataset(long_facts: DataFrame, universe: DataFrame, join_on: str = "filing") -> DataFrame:
    """The quarterly panel with its ratios."""
    return features.with_ratios(quarterly_panel(long_facts, universe, join_on))


def annual_panel(long_facts: DataFrame, universe: DataFrame, first_year: int = rules.FIRST_ANNUAL_YEAR) -> DataFrame:
    """One row per filer and fiscal year with at least three fields."""
    chosen = in_one_unit(long_facts, rules.ANNUAL_FORMS, rules.ANNUAL_UNITS, any_unit=True)
    kept = facts.with_calendar(chosen).where(F.col("fiscal_year") >= first_year)
    tagged = facts.with_fields(kept, rules.annual_rules(long_facts.sparkSession))
    resolved = facts.resolve_by_entity(tagged, ENTITY)
    collapsed = annual.collapse_year(resolved, ENTITY)
    full = annual.cross_fill(annual.drop_sparse_rows(collapsed))
    return statements.in_order(
        statements.with_metadata(full, universe), [*rules.METADATA, *rules.ANNUAL_FIELDS]
    )


def build_quarterly(
    spark: SparkSession, documents_path: str, universe: DataFrame, target: str, only_listed: bool = False
) -> None:
    """The quarterly panel of all documents; ``only_listed`` leaves those of companies outside the universe unread."""
    documents = docs.read_fact_documents(spark, documents_path, universe if only_listed else None)
    with intermediates(spark):
        write_panel(quarterly_dataset(quarterly_facts(documents), universe), target)


def build_annual(
    spark: SparkSession, documents_path: str, universe: DataFrame, target: str, only_listed: bool = False
) -> None:
    documents = docs.read_fact_documents(spark, documents_path, universe if only_listed else None)
    with intermediates(spark):
        write_panel(annual_panel(annual_facts(documents), universe), target)
