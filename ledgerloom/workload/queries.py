"""One callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import text as tx
from ledgerloom.functions.numbers import clip
from ledgerloom.operators import (
    analyses,
    annual,
    clean,
    dedupe,
    features,
    fold,
    quality,
    scoring,
    segments,
    statements,
    universe,
)
from ledgerloom.operators import facts as fx
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.operators.ranks import percent_ranks
from ledgerloom.plans import panels
from ledgerloom.plans.cleaning import clean_panel
from ledgerloom.session import cut_lineage, intermediates, shared_folder, small_side
from ledgerloom.sources import documents, landing, stored, tables, variants
from ledgerloom.workload import views as v

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
RATIOS = ("current_ratio", "debt_to_assets", "net_margin", "roa")


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def panel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel, written out once for operators that read it several times."""
    return cut_lineage(v.panel(spark, sf_dir))


def target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(v.target_snapshot(spark, sf_dir))


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(scoring.with_composite(scoring.with_scores(target_table(spark, sf_dir))))


# --- facts -----------------------------------------------------------------------------------


@query
def latest_filing(spark, sf_dir):
    return v.latest(spark, sf_dir)


@query
def latest_filing_in_batches(spark, sf_dir):
    """The latest filings as a stored state that took in one year of filings after the other, newest first."""
    facts, rows = small_side(v.accepted_facts(spark, sf_dir).select("cik", "tag", "period_end", "filed", "val", "pos"))
    buckets = stored.bucket_count(rows)
    table = fold.FoldTable(spark, f"latest_{uuid.uuid4().hex}", ["cik", "tag", "period_end"], ["val"], buckets)
    for row in facts.select(F.year("filed").alias("year")).distinct().orderBy(F.desc("year")).collect():
        table.merge(facts.where(F.year("filed").eqNullSafe(F.lit(row["year"]))))
    latest = cut_lineage(table.latest())
    table.drop()
    return latest


@query
def ffill_from_buckets(spark, sf_dir):
    """Forward fill of a panel stored in buckets by filer: its window reads them without a shuffle."""
    name = f"panel_{uuid.uuid4().hex}"
    panel, rows = small_side(v.panel(spark, sf_dir))
    stored.store_bucketed(panel, name, ["cik"], buckets=stored.bucket_count(rows), sort=["period_end"])
    filled = clean.forward_fill(spark.table(name), entity="cik")
    names = [column for column in rules.CARRY_FORWARD if column in filled.columns]
    kept = cut_lineage(filled.select("cik", "period_end", *names))
    stored.drop_stored(spark, name)
    return kept


@query
def preferred_unit(spark, sf_dir):
    """Quarterly units only; the unit of a tag is chosen over all forms."""
    rank = fx.unit_rank(F.col("unit"), rules.QUARTERLY_UNITS)
    return fx.latest_in_preferred_unit(
        v.facts(spark, sf_dir, 1), ["cik", "tag"], "period_end", rank,
        F.col("form") != v.REJECTED_FORM, ["val"], position=v.POSITION,
    )


@query
def any_unit(spark, sf_dir):
    """Preferred units first, then whatever unit a tag has."""
    rank = fx.unit_rank(F.col("unit"), ("shares",), F.when(F.col("unit") == "USD", 0).otherwise(1))
    return fx.latest_in_preferred_unit(
        v.facts(spark, sf_dir, 1), ["cik", "tag"], "period_end", rank,
        F.col("form") != v.REJECTED_FORM, ["val"], position=v.POSITION,
    )


@query
def latest_filing_by_year(spark, sf_dir):
    """Latest filing per year, from a first year on, with the quarter its period code names."""
    kept = fx.accepted(v.facts(spark, sf_dir), ("1-URGENT", "2-HIGH"), min_year=1997)
    quarter = fx.reported_quarter(F.col("fp"), F.col("period_end"), {"F": 4, "P": 1})
    dated = fx.with_calendar(kept).withColumn("reported_quarter", quarter)
    return fx.latest_filing(
        dated, ["cik", "tag", "fiscal_year"], ["val", "period_end", "reported_quarter"], position=v.POSITION
    )


@query
def fallback_period(spark, sf_dir):
    tagged = fx.with_fields(v.accepted_facts(spark, sf_dir), v.statement_rules(spark), ["tag"])
    return fx.resolve_by_period(tagged, ["cik"], position=v.POSITION)


@query
def fallback_entity(spark, sf_dir):
    tagged = fx.with_fields(fx.with_calendar(v.accepted_facts(spark, sf_dir, 1)), v.year_rules(spark), ["tag"])
    return fx.resolve_by_entity(tagged, ["cik"], position=v.POSITION)


def _resolved(spark, sf_dir, facts=v.accepted_facts):
    tagged = fx.with_fields(facts(spark, sf_dir), v.statement_rules(spark), ["tag"])
    return fx.resolve_by_period(tagged, ["cik"], position=v.POSITION)


@query
def statement_pivot(spark, sf_dir):
    return statements.statement_frame(_resolved(spark, sf_dir), v.STATEMENT_FIELDS["balance"], ["cik"])


@query
def three_statement_join(spark, sf_dir):
    return statements.merge_statements(_resolved(spark, sf_dir), ["cik"], v.STATEMENT_FIELDS)


@query
def statement_join_by_period(spark, sf_dir):
    return statements.merge_statements(
        _resolved(spark, sf_dir), ["cik"], v.STATEMENT_FIELDS, join_on="period"
    )


@query
def statement_base_fallback(spark, sf_dir):
    """Orders as filers: many lack a balance sheet, some lack an income statement too."""
    return statements.merge_statements(_resolved(spark, sf_dir, v.order_facts), ["cik"], v.STATEMENT_FIELDS)


@query
def annual_panel(spark, sf_dir):
    kept = fx.with_calendar(v.facts(spark, sf_dir, 1).where(F.col("form").isin("1-URGENT", "2-HIGH")))
    tagged = fx.with_fields(kept, v.year_rules(spark), ["tag"])
    resolved = fx.resolve_by_entity(tagged, ["cik"], position=v.POSITION)
    fields = list(v.YEAR_TAGS)
    return annual.cross_fill(annual.drop_sparse_rows(annual.collapse_year(resolved, ["cik"], fields), fields))


# --- joins -----------------------------------------------------------------------------------


@query
def metadata_join(spark, sf_dir):
    listed = universe.clean_universe(v.raw_universe(spark, sf_dir))
    listed = listed.withColumns(
        {"sic_description": F.lit("n/a"), "target_sector": rules.sector_of_sic(F.col("sic_code"))}
    )
    rows = v.panel(spark, sf_dir).select(tx.normal_cik(F.col("cik")).alias("cik"), "period_end", "total_assets")
    return statements.with_metadata(rows, listed)


@query
def lookup_default(spark, sf_dir):
    """Industries are known of the customers whose number is a supplier's too, of some under two rows."""
    known = v.listed(spark, sf_dir).select(
        F.col("cik_num").cast("string").alias("cik"),
        F.coalesce(F.col("sic_code").cast("string"), F.lit("")).alias("sic_code"),
        F.lit("listed").alias("sic_description"),
        rules.sector_of_sic(F.col("sic_code")).alias("target_sector"),
    )
    base = v.universe(spark, sf_dir).select(
        "row_id", tx.zero_fill(F.col("cik_num").cast("string"), 10).alias("cik"), "ticker"
    )
    return universe.with_filer_lookup(base, known)


@query
def profile_join(spark, sf_dir):
    """Every customer with the profile of the first ordering customer of its company."""
    first = dedupe.keep_first(v.ordering(spark, sf_dir), ["cik_num"], ["row_id"])
    profiles = first.select(F.col("cik_num").cast("string").alias("cik_key"), "entity_type", "files_10k")
    base = v.universe(spark, sf_dir).select(
        "row_id", tx.zero_fill(F.col("cik_num").cast("string"), 10).alias("cik"), "ticker"
    )
    return universe.with_profiles(base, profiles)


@query
def external_join(spark, sf_dir):
    """Panel with a yearly outside series: mean order value per year."""
    macro = v.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("fiscal_year")).agg(
        F.round(F.avg("o_totalprice"), 4).alias("mean_order")
    )
    rows = v.panel(spark, sf_dir).select("cik", "period_end", "fiscal_year", "revenue")
    return analyses.join_external(rows, macro, ["fiscal_year"])


@query
def market_values(spark, sf_dir):
    """Market value ratios after joining a price per filer and year."""
    priced = (
        v.facts(spark, sf_dir)
        .groupBy("cik", F.year("period_end").alias("fiscal_year"))
        .agg(F.round(F.avg("price") / 1000, 4).alias("stock_price"))
    )
    rows = v.panel(spark, sf_dir).select(
        "cik", "period_end", "fiscal_year", F.col("market_value").alias("shares_outstanding"), "long_term_debt", "cash"
    )
    joined = analyses.join_external(rows, priced, ["cik", "fiscal_year"])
    return v.rounded(
        features.with_ratios(joined, rules.MARKET_RATIOS).select(
            "cik", "period_end", "market_cap", "enterprise_value"
        ),
        4,
    )


@query
def membership_semi(spark, sf_dir):
    filers = v.universe(spark, sf_dir).where(F.col("files_10k")).select(
        F.col("cik_num").cast("string").alias("cik_key")
    )
    base = v.universe(spark, sf_dir).select(
        "row_id", tx.zero_fill(F.col("cik_num").cast("string"), 10).alias("cik")
    )
    return universe.matched_only(base, filers)


@query
def fetch_worklist(spark, sf_dir):
    """Companies whose ticker no customer with an order has."""
    listed = v.universe(spark, sf_dir).select("row_id", "ticker")
    landed = v.ordering(spark, sf_dir).select("ticker")
    return landing.fetch_worklist(listed, landed)


@query
def orphans(spark, sf_dir):
    listed = v.listed(spark, sf_dir).select("ticker")
    landed = v.universe(spark, sf_dir).select("row_id", F.lower("ticker").alias("ticker"))
    return landing.orphans(landed, listed)


@query
def concat_frames(spark, sf_dir):
    """Stack two statement frames that do not have the same columns."""
    resolved = _resolved(spark, sf_dir)
    balance = statements.statement_frame(resolved, ["assets"], ["cik"])
    income = statements.statement_frame(resolved, ["sales"], ["cik"])
    return statements.concat_panels(balance, income)


# --- documents -------------------------------------------------------------------------------

LONG = ["ticker", "cik", "company", "taxonomy", "tag", "unit", "pos", "period_end", "val", "form", "fp", "filed"]


@query
def flatten_facts(spark, sf_dir):
    """Every reported value of every facts document."""
    return documents.flatten_facts(v.fact_documents(spark, sf_dir)).select(*LONG)


@query
def flatten_listed(spark, sf_dir):
    """Values of the companies whose number is a supplier's, too: the other documents are left closed."""
    tickers = v.table(spark, sf_dir, "supplier").select(F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ticker"))
    return documents.flatten_facts(documents.only_listed(v.fact_documents(spark, sf_dir), tickers)).select(*LONG)


@query
def flatten_variants(spark, sf_dir):
    """The same values from documents read as variants."""
    return variants.flatten_variants(variants.parse_variants(v.fact_texts(spark, sf_dir))).select(*LONG)


@query
def odd_documents(spark, sf_dir):
    """Values of documents of unknown shape: order states as taxonomies, values as numbers, texts and objects."""
    long = variants.flatten_variants(variants.parse_variants(v.odd_fact_texts(spark, sf_dir)))
    return long.select("ticker", "cik", "taxonomy", "tag", "unit", "unit_pos", "pos", "period_end", "val", "form", "raw_val")


@query
def odd_document_units(spark, sf_dir):
    """Each tag in the first unit that holds a list."""
    long = variants.flatten_variants(variants.parse_variants(v.odd_fact_texts(spark, sf_dir)), unit_preference=("none", "shares", "USD"))
    return long.select("ticker", "taxonomy", "tag", "unit", "pos", "period_end", "val")


@query
def document_units(spark, sf_dir):
    """Each tag in the first of the quarterly units it has."""
    return documents.flatten_facts(v.fact_documents(spark, sf_dir), unit_preference=rules.QUARTERLY_UNITS).select(*LONG)


@query
def rejected_documents(spark, sf_dir):
    return documents.rejected_documents(v.fact_documents(spark, sf_dir))


DOCUMENT_PANEL = [
    "ticker", "cik", "company", "target_sector", "period_end", "filing_date", "fiscal_year", "fiscal_quarter",
    "total_assets", "total_liabilities", "equity", "long_term_debt", "inventory", "revenue", "cost_of_revenue",
    "gross_profit", "net_income", "balance_sheet_valid",
]


@query
def quarterly_from_documents(spark, sf_dir):
    """The quarterly panel from documents whose units were chosen while they were read."""
    long = panels.quarterly_facts(v.fact_documents(spark, sf_dir))
    return panels.quarterly_panel(long, v.filers(spark, sf_dir)).select(*DOCUMENT_PANEL)


@query
def quarterly_from_stored_facts(spark, sf_dir):
    """The same panel from long facts that hold every unit."""
    long = cut_lineage(documents.flatten_facts(v.fact_documents(spark, sf_dir)))
    return panels.quarterly_panel(long, v.filers(spark, sf_dir)).select(*DOCUMENT_PANEL)


ANNUAL_DOCUMENT_PANEL = [
    "ticker", "cik", "company", "target_sector", "fiscal_year", "fiscal_quarter", "period_end", "filing_date",
    "cost_of_goods_sold", "inventory", "net_income", "net_sales", "total_assets", "long_term_debt", "gross_profit",
    "total_revenue", "total_liabilities",
]


@query
def annual_from_documents(spark, sf_dir):
    """The annual panel from documents; the given orders are older than the usual first year."""
    long = panels.annual_facts(v.fact_documents(spark, sf_dir))
    return panels.annual_panel(long, v.filers(spark, sf_dir), first_year=1990).select(*ANNUAL_DOCUMENT_PANEL)


@query
def filer_profiles(spark, sf_dir):
    return documents.filer_profiles(v.submissions(spark, sf_dir))


@query
def filer_categories(spark, sf_dir):
    return documents.filer_categories(v.submissions(spark, sf_dir))


# --- scalar functions ------------------------------------------------------------------------


@query
def ticker_index(spark, sf_dir):
    """Index documents built from the customers of each nation, read back as JSON."""
    entry = F.struct(
        F.col("c_custkey").alias("cik_str"), F.upper(F.substring("c_mktsegment", 1, 4)).alias("ticker"),
        F.col("c_name").alias("title"),
    )
    texts = v.table(spark, sf_dir, "customer").select(
        F.to_json(F.create_map(F.col("c_custkey").cast("string"), entry)).alias("text")
    )
    return documents.ticker_index(texts)


@query
def props_json(spark, sf_dir):
    parsed = v.table(spark, sf_dir, "events").withColumn("doc", F.from_json("props", "k int, note struct<text: string>"))
    return parsed.groupBy(F.col("doc.k").alias("k"), tx.nested_text("doc.note.text").alias("note")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def cik_normalize(spark, sf_dir):
    rows = v.raw_universe(spark, sf_dir)
    cik = tx.normal_cik(F.col("cik"))
    return rows.select(
        "row_id", cik.alias("cik"), tx.bare_cik(cik).alias("bare"), tx.spreadsheet_id(F.col("cik")).alias("sheet_id")
    )


@query
def text_clean(spark, sf_dir):
    rows = v.universe(spark, sf_dir).withColumns(
        {"company": F.replace("company", F.lit("#"), F.lit(tx.NBSP)), "ticker": F.lower("ticker")}
    )
    return clean.tidy_text(rows.select("row_id", "ticker", "company"))


@query
def title_case(spark, sf_dir):
    return v.table(spark, sf_dir, "part").select("p_partkey", tx.title_case(F.col("p_name")).alias("title"))


@query
def sector_map(spark, sf_dir):
    return v.universe(spark, sf_dir).select(
        "row_id", "sic_code", rules.sector_of_sic(F.col("sic_code")).alias("target_sector")
    )


@query
def ticker_classes(spark, sf_dir):
    return universe.with_ticker_type(v.universe(spark, sf_dir).select("row_id", "ticker"))


@query
def ticker_quality(spark, sf_dir):
    return v.universe(spark, sf_dir).select("row_id", "ticker", tx.ticker_quality(F.col("ticker")).alias("q")).select(
        "row_id", "ticker", "q.*"
    )


@query
def array_flags(spark, sf_dir):
    """Form lists per customer: first one, exact membership, joined distinct ones."""
    lists = v.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_set("o_orderpriority")).alias("forms")
    )
    return lists.select(
        "o_custkey",
        tx.first_or_blank(F.col("forms")).alias("first_form"),
        tx.lists_item(F.col("forms"), "1-URGENT").alias("files_urgent"),
        tx.join_present(F.col("forms")).alias("all_forms"),
    )


@query
def date_parts(spark, sf_dir):
    """Text dates, some unreadable, to date, year and quarter."""
    raw = F.when(F.col("o_orderkey") % 10 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    dated = v.table(spark, sf_dir, "orders").select("o_orderkey", raw.try_cast("date").alias("period_end"))
    return fx.with_calendar(dated)


@query
def cross_fill(spark, sf_dir):
    rows = v.panel(spark, sf_dir).select(
        "cik", "period_end", F.col("revenue").alias("total_revenue"), F.col("gross_profit").alias("net_sales")
    )
    return annual.cross_fill(rows)


@query
def money_format(spark, sf_dir):
    amount = F.col("total_revenue") * F.when(F.col("total_assets").isNull(), 1).otherwise(100_000)
    return v.target_snapshot(spark, sf_dir).select(
        "ticker", tx.money_label(amount).alias("revenue"), tx.percent_label(F.col("revenue_growth")).alias("growth")
    )


# --- universe --------------------------------------------------------------------------------


@query
def universe_clean(spark, sf_dir):
    return universe.clean_universe(v.raw_universe(spark, sf_dir))


@query
def universe_filter(spark, sf_dir):
    return universe.domestic_filers(v.universe(spark, sf_dir))


@query
def universe_sector_pick(spark, sf_dir):
    rows = v.universe(spark, sf_dir).withColumnRenamed("cik_num", "cik").withColumn(
        "target_sector", rules.sector_of_sic(F.col("sic_code"))
    )
    return universe.pick_sector(rows.select("row_id", "cik", "company", "target_sector"), "Retail", 25)


@query
def universe_by_company(spark, sf_dir):
    """The whole list in the order of its names."""
    rows = v.universe(spark, sf_dir).select("row_id", "cik_num", "ticker", F.trim("company").alias("company"))
    return universe.in_listing_order(rows, ["company", "cik_num", "row_id"])


@query
def universe_by_ticker(spark, sf_dir):
    """The list sorted by ticker; many companies share one."""
    return universe.in_listing_order(v.universe(spark, sf_dir).select("row_id", "ticker"), ["ticker", "row_id"])


@query
def universe_distinct(spark, sf_dir):
    """Copies of the list with differently written ids and tickers: every company is left once."""
    rows = v.universe(spark, sf_dir).select("cik_num", "ticker", "sic_code")
    plain = rows.select(F.col("cik_num").cast("string").alias("cik"), "ticker", F.col("sic_code").cast("string").alias("sic_code"))
    spaced = plain.select(F.concat(F.lit(" 0"), "cik", F.lit(" ")).alias("cik"), F.lower("ticker").alias("ticker"), "sic_code")
    coded = plain.select("cik", F.concat("ticker", F.lit(" ")).alias("ticker"), F.concat("sic_code", F.lit(".0")).alias("sic_code"))
    return universe.distinct_listings(plain.unionByName(spaced).unionByName(coded))


@query
def universe_no_shells(spark, sf_dir):
    return universe.drop_shells(v.universe(spark, sf_dir).select("row_id", "sic_code"))


@query
def universe_one_per_cik(spark, sf_dir):
    rows = v.universe(spark, sf_dir).select(F.col("cik_num").alias("cik"), "ticker", "sic_code")
    return universe.research_universe(rows)


@query
def universe_shortest(spark, sf_dir):
    rows = v.universe(spark, sf_dir).select(F.col("cik_num").alias("cik"), "ticker", "company", "sic_code")
    return universe.primary_listing(rows.withColumns({"sic_code": F.col("sic_code").cast("string")}))


@query
def universe_dropped_tickers(spark, sf_dir):
    _, dropped = universe.split_primary(v.universe(spark, sf_dir).select("row_id", "ticker"))
    return dropped


@query
def universe_repeated_ciks(spark, sf_dir):
    primary, _ = universe.split_primary(v.universe(spark, sf_dir).select("cik_num", "ticker"))
    return dedupe.repeated_keys(primary, ["cik_num"])


@query
def universe_match_summary(spark, sf_dir):
    """All companies, those with an order and a submission document, and those kept as domestic filers."""
    rows = v.universe(spark, sf_dir).withColumn("cik", F.col("row_id").cast("string"))
    profiles = documents.filer_profiles(v.submissions(spark, sf_dir)).select("cik_key", F.col("country"))
    found = universe.with_profiles(rows, profiles.join(v.ordering(spark, sf_dir).select(F.col("row_id").cast("string").alias("cik_key")), "cik_key"))
    kept = universe.is_domestic_filer() & universe.is_no_shell()
    return quality.match_summary(found, {"started": F.lit(True), "matched": F.col("country").isNotNull(), "kept": kept})


# --- ratios and features ---------------------------------------------------------------------


@query
def ratios_quarterly(spark, sf_dir):
    rated = features.with_ratios(v.panel(spark, sf_dir))
    return v.rounded(rated.select("cik", "period_end", *rules.QUARTERLY_RATIOS))


@query
def ratios_annual(spark, sf_dir):
    rated = features.with_ratios(v.annual_names(v.panel(spark, sf_dir)), rules.ANNUAL_RATIOS)
    return v.rounded(rated.select("cik", "period_end", *rules.ANNUAL_RATIOS))


@query
def lag1(spark, sf_dir):
    lagged = features.with_lags(v.panel(spark, sf_dir), entity="cik")
    return lagged.select("cik", "period_end", *[f"{name}_lag1" for name in rules.LAGGED])


@query
def growth_qoq(spark, sf_dir):
    grown = features.with_growth(features.with_lags(v.panel(spark, sf_dir), entity="cik"))
    return v.rounded(grown.select("cik", "period_end", *[f"{name}_growth_qoq" for name in rules.GROWN]))


@query
def pct_change(spark, sf_dir):
    rows = v.panel(spark, sf_dir).withColumns(
        {
            "change1": features.pct_change("revenue", 1, "cik", "period_end"),
            "change1_no_pad": features.pct_change("revenue", 1, "cik", "period_end", pad=False),
            "change3": features.pct_change("revenue", 3, "cik", "period_end") / 3,
        }
    )
    names = ["change1", "change1_no_pad", "change3"]
    clipped = rows.select("cik", "period_end", *[clip(F.col(name), -0.9, 2.0).alias(name) for name in names])
    return v.rounded(clipped)


@query
def derived_fields(spark, sf_dir):
    rows = v.annual_names(v.panel(spark, sf_dir))
    featured = features.with_target_features(rows, "cik", "period_end")
    return v.rounded(
        featured.select(
            "cik", "period_end", "net_margin", "debt_to_equity", "current_ratio", "revenue_growth",
            "revenue_growth_3yr", "equity",
        )
    )


@query
def derived_report(spark, sf_dir):
    rows = v.annual_names(v.panel(spark, sf_dir))
    featured = cut_lineage(features.with_target_features(rows, "cik", "period_end"))
    names = ["net_margin", "debt_to_equity", "current_ratio", "revenue_growth", "revenue_growth_3yr", "equity"]
    return v.rounded(scoring.feature_report(featured, names))


# --- cleaning --------------------------------------------------------------------------------


@query
def identity_check_1pct(spark, sf_dir):
    checked = statements.identity_check(v.panel(spark, sf_dir))
    return v.rounded(checked.select("cik", "period_end", "balance_sheet_difference", "balance_sheet_valid"), 2)


@query
def identity_check_2pct(spark, sf_dir):
    checked = statements.identity_check(v.panel(spark, sf_dir), rules.IDENTITY_PCT_CLEAN, floor=1000.0)
    return v.rounded(checked.select("cik", "period_end", "balance_sheet_difference", "balance_sheet_valid"), 2)


@query
def identity_valid_counts(spark, sf_dir):
    return statements.identity_counts(statements.identity_check(v.panel(spark, sf_dir), 0.02, floor=1000.0))


@query
def impossible_values(spark, sf_dir):
    fixed = clean.drop_impossible(v.panel(spark, sf_dir))
    return fixed.select("cik", "period_end", *rules.NOT_NEGATIVE)


@query
def impossible_value_counts(spark, sf_dir):
    return clean.impossible_counts(v.panel(spark, sf_dir))


@query
def dedupe_first(spark, sf_dir):
    """First panel row per filer and year."""
    rows = v.panel(spark, sf_dir).select("cik", "fiscal_year", "fiscal_quarter", "period_end", "total_assets")
    return dedupe.keep_first(rows, ["cik", "fiscal_year"], ["fiscal_quarter", "period_end"])


@query
def dedupe_last(spark, sf_dir):
    rows = v.panel(spark, sf_dir).select("cik", "fiscal_year", "fiscal_quarter", "period_end", "total_assets")
    return dedupe.keep_first(rows, ["cik", "fiscal_year"], [F.desc("fiscal_quarter"), F.desc("period_end")])


@query
def dedupe_complete(spark, sf_dir):
    """Most complete panel row per filer and year, later filings first among equals."""
    return dedupe.keep_most_complete(
        v.panel(spark, sf_dir), ["cik", "fiscal_year"], [F.desc("filing_date"), F.desc("period_end")]
    )


@query
def distinct_rows(spark, sf_dir):
    return v.facts(spark, sf_dir).select("cik", "tag", "unit", "form").dropDuplicates()


@query
def ffill(spark, sf_dir):
    filled = clean.forward_fill(v.panel(spark, sf_dir), entity="cik")
    names = [name for name in rules.CARRY_FORWARD if name in filled.columns]
    return filled.select("cik", "period_end", *names)


@query
def ffill_long(spark, sf_dir):
    """Forward fill along whole sectors, of any length; rows without a sector are a series, too."""
    rows = v.sector_panel(spark, sf_dir).select("target_sector", "cik", "period_end", *v.PANEL_FIELDS)
    return segments.forward_fill_long(rows, v.PANEL_FIELDS, ["target_sector"], ["period_end", "cik"])


@query
def lag_long(spark, sf_dir):
    """Earlier rows of the whole sector."""
    rows = v.sector_panel(spark, sf_dir).select("target_sector", "cik", "period_end", "revenue", "cash")
    lags = {"revenue_1": ("revenue", 1), "revenue_3": ("revenue", 3), "cash_2": ("cash", 2)}
    return segments.lag_long(rows, lags, ["target_sector"], ["period_end", "cik"])


@query
def median_impute(spark, sf_dir):
    filled = clean.fill_group_median(panel_table(spark, sf_dir))
    names = [name for name in rules.MEDIAN_FILLED if name in filled.columns]
    return v.rounded(filled.select("cik", "period_end", *names), 4)


@query
def winsorize(spark, sf_dir):
    clipped = clean.winsorize(panel_table(spark, sf_dir))
    return v.rounded(clipped.select("cik", "period_end", *v.PANEL_FIELDS), 4)


@query
def winsorize_counts(spark, sf_dir):
    rows = panel_table(spark, sf_dir)
    return clean.outside_counts(rows, clean.quantile_bounds(rows))


@query
def drop_sparse(spark, sf_dir):
    """The names that are left when measures below 15 % coverage go; which ones depends on the data."""
    rows = panel_table(spark, sf_dir).withColumns(
        {f"q{n}_{name}": F.when((F.col("fiscal_quarter") == n) & (F.col("fiscal_year") % 2 == 0), F.col(name))
         for n in (1, 2) for name in ("cash", "revenue", "inventory")}
    ).withColumn("always", F.col("cik") * 1.0)
    left = clean.drop_sparse_columns(rows, 0.15)
    cells = [F.struct(F.lit(name).alias("column"), F.col(f"n_{name}").alias("present")) for name in left.columns]
    counted = left.agg(*[F.count(F.col(name)).alias(f"n_{name}") for name in left.columns])
    return counted.select(F.inline(F.array(*cells)))


@query
def clean_panel_full(spark, sf_dir):
    cleaned = clean_panel(v.panel(spark, sf_dir), entity="cik")
    lags = [f"{name}_lag1" for name in rules.LAGGED]
    growth = [f"{name}_growth_qoq" for name in rules.GROWN]
    return v.rounded(
        cleaned.panel.select(
            "cik", "period_end", *v.PANEL_FIELDS, "balance_sheet_difference", "balance_sheet_valid", *lags, *growth
        )
    )


@query
def clean_panel_counts(spark, sf_dir):
    """Counters of the job over a panel in which every fourth filer stands twice, with one sparse measure."""
    rows = v.panel(spark, sf_dir).withColumn("rarely", F.when(F.col("fiscal_year") == 1995, F.col("cash") * 0.0))
    doubled = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("cik") % 4 == 0, 2).otherwise(1)))).drop("_copy")
    return clean_panel(doubled, entity="cik").counters


# --- quality ---------------------------------------------------------------------------------


@query
def coverage(spark, sf_dir):
    return v.rounded(quality.coverage(v.panel(spark, sf_dir), v.PANEL_FIELDS))


@query
def stored_profile(spark, sf_dir):
    """Coverage and ranges of a written panel, from the footers of its files."""
    with intermediates(spark):
        folder = f"{shared_folder(spark)}/profiled/{uuid.uuid4().hex}"
        tables.write_panel(v.panel(spark, sf_dir), folder, order=("cik", "period_end"))
        found = stored.footer_profile(spark, folder, ["cik", "fiscal_quarter", *v.PANEL_FIELDS])
        stored.delete_folder(spark, folder)
    return found


@query
def missing_counts(spark, sf_dir):
    return quality.missing_counts(v.panel(spark, sf_dir))


@query
def distinct_counts(spark, sf_dir):
    return quality.distinct_counts(v.sector_panel(spark, sf_dir), ["cik", "target_sector", "fiscal_year"])


@query
def value_counts(spark, sf_dir):
    return quality.value_counts(v.panel(spark, sf_dir), "fiscal_year")


@query
def ticker_type_counts(spark, sf_dir):
    return quality.value_counts(universe.with_ticker_type(v.universe(spark, sf_dir)), "ticker_type")


@query
def schema_report(spark, sf_dir):
    required = ("cik", "period_end", "company", "total_assets")
    return v.rounded(quality.schema_report(v.panel(spark, sf_dir).drop("filing_date"), "cik", required=required), 1)


@query
def describe_numbers(spark, sf_dir):
    return v.rounded(quality.describe_numbers(panel_table(spark, sf_dir), v.PANEL_FIELDS), 4)


@query
def describe_texts(spark, sf_dir):
    return quality.describe_texts(v.facts(spark, sf_dir), ["tag", "unit", "form", "fp"])


@query
def cleaning_report(spark, sf_dir):
    """Report on the whole cleaning job, over a panel in which every fourth filer stands twice."""
    copies = F.sequence(F.lit(1), F.when(F.col("cik") % 4 == 0, 2).otherwise(1))
    raw = cut_lineage(v.panel(spark, sf_dir).withColumn("_copy", F.explode(copies)).drop("_copy"))
    return v.rounded(quality.cleaning_report(raw, cut_lineage(clean_panel(raw, entity="cik").panel), "cik"), 1)


# --- snapshot, ranks and scores ---------------------------------------------------------------


@query
def snapshot_latest_row(spark, sf_dir):
    return features.latest_values(v.panel(spark, sf_dir), "cik", "period_end", mode="latest_row")


@query
def snapshot_last_non_null(spark, sf_dir):
    latest = features.latest_values(v.panel(spark, sf_dir), "cik", "period_end")
    return features.with_some_data(latest, ["total_assets", "revenue"])


@query
def sector_percent_rank(spark, sf_dir):
    rows = cut_lineage(v.target_snapshot(spark, sf_dir))
    names = ["total_assets", "net_margin", "current_ratio"]
    return v.rounded(percent_ranks(rows, "ticker", "target_sector", {name: F.col(name) for name in names}))


@query
def panel_percent_rank(spark, sf_dir):
    """Rank of every panel value within its fiscal year: large groups, many values."""
    rows = cut_lineage(v.panel(spark, sf_dir).withColumn("key", F.concat_ws("|", "cik", "period_end")))
    names = ["total_assets", "revenue"]
    return v.rounded(percent_ranks(rows, "key", "fiscal_year", {name: F.col(name) for name in names}))


@query
def year_quantiles(spark, sf_dir):
    """Exact 1st, 50th and 99th percentile of every field per fiscal year."""
    found = exact_quantiles(
        panel_table(spark, sf_dir), v.PANEL_FIELDS, {"p01": 0.01, "p50": 0.5, "p99": 0.99}, by=["fiscal_year"]
    )
    return v.rounded(found, 4)


def _score_query(name: str) -> None:
    def run(spark, sf_dir):
        return v.rounded(scoring.with_scores(target_table(spark, sf_dir)).select("ticker", name))

    REGISTRY[f"score_{name.removesuffix('_score').replace('mv', 'float')}"] = run


def _composite_query(preset: str) -> None:
    def run(spark, sf_dir):
        scored = scoring.with_scores(target_table(spark, sf_dir))
        return v.rounded(scoring.with_composite(scored, preset).select("ticker", scoring.COMPOSITE))

    REGISTRY[f"composite_{preset}"] = run


for _name in scoring.SCORES.values():
    _score_query(_name)
for _preset in rules.WEIGHTS:
    _composite_query(_preset)


@query
def thesis(spark, sf_dir):
    scored = scoring.with_scores(target_table(spark, sf_dir))
    return scored.select("ticker", scoring.thesis_label().alias("thesis"))


@query
def ranked_targets(spark, sf_dir):
    scored = scoring.with_scores(target_table(spark, sf_dir))
    return v.rounded(scoring.export_columns(scoring.rank_targets(scored)))


@query
def top50(spark, sf_dir):
    return v.rounded(
        scoring.top_targets(scored_table(spark, sf_dir), 50).select("ticker", "target_sector", scoring.COMPOSITE)
    )


@query
def top3_profile(spark, sf_dir):
    return v.rounded(scoring.dimension_profile(scoring.top_targets(scored_table(spark, sf_dir), 3)))


@query
def sector_summary(spark, sf_dir):
    return v.rounded(scoring.sector_summary(scored_table(spark, sf_dir)))


@query
def sector_matrix(spark, sf_dir):
    return v.rounded(scoring.dimension_matrix(scoring.sector_summary(scored_table(spark, sf_dir))))


@query
def score_stats(spark, sf_dir):
    return v.rounded(scoring.score_stats(scored_table(spark, sf_dir)))


@query
def score_histogram(spark, sf_dir):
    counted = scoring.score_histogram(scored_table(spark, sf_dir))
    return v.rounded(counted.select("column", "bin", "lo", "hi", "mean", "median", "companies"))


@query
def sector_companies(spark, sf_dir):
    return scoring.companies_per_sector(v.sector_panel(spark, sf_dir), entity="cik")


# --- analyses --------------------------------------------------------------------------------


@query
def sector_trend(spark, sf_dir):
    return v.rounded(analyses.group_mean(v.ratio_panel(spark, sf_dir), "net_margin"))


@query
def volatility(spark, sf_dir):
    return v.rounded(analyses.group_volatility(v.ratio_panel(spark, sf_dir), "net_margin"))


@query
def best_in_sector(spark, sf_dir):
    best = analyses.best_in_group(v.ratio_panel(spark, sf_dir), "roa", ties=["cik", "period_end"])
    return v.rounded(best.select("target_sector", "fiscal_year", "cik", "period_end", "roa"))


@query
def screens(spark, sf_dir):
    grown = v.panel(spark, sf_dir).withColumn(
        "revenue_growth", features.pct_change("revenue", 1, "cik", "period_end")
    )
    return analyses.with_screens(grown).select("cik", "period_end", *analyses.SCREENS)


@query
def profit_stall(spark, sf_dir):
    quarters = v.panel(spark, sf_dir).withColumn("step", F.col("fiscal_year") * 4 + F.col("fiscal_quarter"))
    return analyses.loss_runs(quarters, "cik", "step")


@query
def cash_burn(spark, sf_dir):
    filled = clean.forward_fill(
        v.panel(spark, sf_dir), ["current_assets", "current_liabilities", "net_income"], entity="cik"
    )
    return analyses.cash_burners(filled, "cik", "period_end")


@query
def event_study(spark, sf_dir):
    return v.rounded(
        analyses.event_study(v.ratio_panel(spark, sf_dir), "revenue", (1995, 1997), (1999, 2001)), 4
    )


@query
def quintiles(spark, sf_dir):
    classed = analyses.size_quintiles(v.panel(spark, sf_dir), ties=["cik", "period_end"])
    return classed.select("cik", "period_end", "quintile")


@query
def benchmarks(spark, sf_dir):
    rated = features.with_ratios(v.sector_panel(spark, sf_dir), {k: rules.QUARTERLY_RATIOS[k] for k in RATIOS})
    return v.rounded(analyses.sector_benchmarks(cut_lineage(rated.select("target_sector", *RATIOS)), RATIOS))


@query
def outliers(spark, sf_dir):
    rated = features.with_ratios(v.sector_panel(spark, sf_dir), {k: rules.QUARTERLY_RATIOS[k] for k in RATIOS})
    rows = cut_lineage(rated.select("cik", "period_end", "target_sector", *RATIOS))
    return v.rounded(analyses.outliers(rows, RATIOS))


@query
def peers(spark, sf_dir):
    """Five closest companies, by margin and leverage, of each sector's largest company."""
    rows = cut_lineage(
        v.target_snapshot(spark, sf_dir).select(
            "ticker", "target_sector", "total_assets", "net_margin", "debt_to_equity"
        )
    )
    picked = analyses.best_in_group(rows, "total_assets", ["target_sector"])
    return v.rounded(
        analyses.closest_peers(rows, picked, ["net_margin", "debt_to_equity"], ["target_sector"])
    )


@query
def healthy_summary(spark, sf_dir):
    flagged = analyses.with_health_flag(v.annual_names(v.sector_panel(spark, sf_dir)))
    return v.rounded(analyses.healthy_summary(flagged, 1998))
