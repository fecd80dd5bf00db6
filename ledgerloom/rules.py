"""Fixed values of the domain, kept as data and turned into Spark frames or expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: statement fields and the public us-gaap tags that may report them, best first.
BALANCE_SHEET = {
    "cash": (
        "CashAndCashEquivalentsAtCarryingValue",
        "Cash",
        "CashCashEquivalentsRestrictedCash",
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
    ),
    "short_term_investments": (
        "AvailableForSaleSecuritiesCurrent",
        "ShortTermInvestments",
        "MarketableSecuritiesCurrent",
    ),
    "receivables": ("AccountsReceivableNetCurrent", "ReceivablesNetCurrent"),
    "inventory": ("InventoryNet", "InventoryCurrent", "InventoryFinishedGoods", "InventoryGross"),
    "current_assets": ("AssetsCurrent",),
    "ppe": ("PropertyPlantAndEquipmentNet", "PropertyPlantAndEquipmentGross"),
    "goodwill": ("Goodwill",),
    "intangible_assets": ("FiniteLivedIntangibleAssetsNet", "IntangibleAssetsNetExcludingGoodwill"),
    "total_assets": ("Assets",),
    "accounts_payable": ("AccountsPayableCurrent",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "long_term_debt": ("LongTermDebtNoncurrent", "LongTermDebt", "LongTermBorrowings"),
    "total_liabilities": ("Liabilities",),
    "equity": (
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ),
}

INCOME_STATEMENT = {
    "revenue": (
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "SalesRevenueNet",
        "Revenues",
    ),
    "cost_of_revenue": ("CostOfGoodsSold", "CostOfRevenue"),
    "gross_profit": ("GrossProfit",),
    "operating_income": ("OperatingIncomeLoss",),
    "pretax_income": (
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeBeforeTaxExpenseBenefit",
    ),
    "income_tax": ("IncomeTaxExpenseBenefit",),
    "net_income": ("NetIncomeLoss",),
    "interest_expense": ("InterestExpense",),
    "basic_eps": ("EarningsPerShareBasic",),
    "diluted_eps": ("EarningsPerShareDiluted",),
}

CASH_FLOW = {
    "operating_cash_flow": (
        "NetCashProvidedByUsedInOperatingActivities",
        "NetCashProvidedByOperatingActivities",
    ),
    "investing_cash_flow": ("NetCashProvidedByUsedInInvestingActivities",),
    "financing_cash_flow": ("NetCashProvidedByUsedInFinancingActivities",),
    "capital_expenditure": (
        "PaymentsToAcquirePropertyPlantAndEquipment",
        "CapitalExpendituresIncurredButNotYetPaid",
    ),
    "depreciation": ("Depreciation", "DepreciationAndAmortization"),
    "amortization": ("AmortizationOfIntangibleAssets",),
}

ANNUAL_GAAP = {
    "current_assets": ("AssetsCurrent",),
    "cost_of_goods_sold": ("CostOfGoodsAndServicesSold", "CostOfGoodsSold", "CostOfRevenue"),
    "depreciation_amortization": (
        "DepreciationDepletionAndAmortization",
        "DepreciationAndAmortization",
        "Depreciation",
        "AmortizationOfIntangibleAssets",
    ),
    "inventory": ("InventoryNet", "InventoryCurrent", "InventoryFinishedGoods", "InventoryGross"),
    "net_income": ("NetIncomeLoss", "NetIncomeLossAvailableToCommonStockholdersBasic"),
    "total_receivables": (
        "AccountsReceivableNetCurrent",
        "ReceivablesNetCurrent",
        "AccountsReceivableNet",
    ),
    "net_sales": (
        "SalesRevenueNet",
        "SalesRevenueGoodsNet",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
    ),
    "total_assets": ("Assets",),
    "long_term_debt": ("LongTermDebtNoncurrent", "LongTermDebt", "LongTermBorrowings"),
    "gross_profit": ("GrossProfit",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "retained_earnings": ("RetainedEarningsAccumulatedDeficit", "RetainedEarnings"),
    "total_revenue": (
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "SalesRevenueNet",
        "Revenues",
    ),
    "total_liabilities": ("Liabilities",),
    "total_operating_expenses": (
        "OperatingExpenses",
        "OperatingCostsAndExpenses",
        "CostsAndExpenses",
    ),
}

ANNUAL_DEI = {
    "market_value": ("EntityPublicFloat",),
    "shares_outstanding": ("EntityCommonStockSharesOutstanding",),
}

# --- Fixed values: accepted forms, unit preferences, thresholds.
QUARTERLY_FORMS = ("10-Q", "10-K", "10-K/A", "10-Q/A", "20-F", "20-F/A", "40-F")
ANNUAL_FORMS = ("10-K", "10-K/A")
QUARTERLY_UNITS = ("USD", "USD/shares")
ANNUAL_UNITS = ("USD", "USD/shares", "shares")
FIRST_ANNUAL_YEAR = 2016
MIN_ANNUAL_FIELDS = 3
IDENTITY_FLOOR = 1_000_000.0
IDENTITY_PCT_RAW = 0.01
IDENTITY_PCT_CLEAN = 0.02
MIN_COVERAGE = 0.05
SHELL_SIC = (6770, 6726, 6221, 6189, 9995)
FISCAL_QUARTERS = {"Q1": 1, "Q2": 2, "Q3": 3, "Q4": 4, "FY": 4}

# --- Fixed values: SIC ranges per sector, first match wins; 8742 is left out of Healthcare.
SECTOR_RANGES = (
    ("Technology", ((7370, 7379), (3570, 3577))),
    ("Healthcare", ((2833, 2836), (3840, 3849), (8000, 8741), (8743, 8999))),
    ("Energy", ((1311, 1389), (2911, 2999), (4911, 4939))),
    ("Retail", ((5200, 5999),)),
    ("Industrials", ((3500, 3599), (3600, 3699), (3711, 3799))),
    ("Consumer Goods", ((2000, 2399), (2500, 2599), (3940, 3949))),
    ("Manufacturing", ((2000, 3999),)),
)
SECTOR_DEFAULT = "Other / Financial / Services"
SECTOR_UNKNOWN = "Unknown"

# --- Fixed values: column groups of the quarterly panel.
METADATA = (
    "company", "ticker", "cik", "sic_code", "sic_description", "target_sector",
    "filing_date", "period_end", "fiscal_year", "fiscal_quarter",
)
QUARTERLY_FIELDS = (*BALANCE_SHEET, *INCOME_STATEMENT, *CASH_FLOW)
ANNUAL_FIELDS = (*ANNUAL_GAAP, *ANNUAL_DEI)
NOT_NEGATIVE = ("revenue", "total_assets", "current_assets", "cost_of_revenue")
CARRY_FORWARD = tuple(BALANCE_SHEET)
MEDIAN_FILLED = (
    "current_assets", "current_liabilities", "total_assets", "total_liabilities", "equity",
    "cash", "receivables", "inventory", "ppe", "accounts_payable",
)
LAGGED = (
    "revenue", "net_income", "operating_cash_flow", "total_assets", "equity", "current_assets",
)
GROWN = ("revenue", "net_income", "total_assets", "equity")
PANEL_REQUIRED = (
    "company", "ticker", "cik", "period_end", "fiscal_year", "fiscal_quarter",
    "total_assets", "total_liabilities", "equity",
)
NOT_MEASURES = ("cik", "fiscal_year", "fiscal_quarter", "sic_code")

# --- Fixed values: ratio definitions as (numerator, denominator); no denominator = a difference.
QUARTERLY_RATIOS = {
    "working_capital": ("current_assets - current_liabilities", None),
    "current_ratio": ("current_assets", "current_liabilities"),
    "cash_ratio": ("cash", "current_liabilities"),
    "debt_to_equity": ("total_liabilities", "equity"),
    "debt_to_assets": ("total_liabilities", "total_assets"),
    "interest_coverage": ("operating_income", "interest_expense"),
    "gross_margin": ("gross_profit", "revenue"),
    "operating_margin": ("operating_income", "revenue"),
    "net_margin": ("net_income", "revenue"),
    "roa": ("net_income", "total_assets"),
    "roe": ("net_income", "equity"),
    "asset_turnover": ("revenue", "total_assets"),
    "receivables_turnover": ("revenue", "receivables"),
    "inventory_turnover": ("cost_of_revenue", "inventory"),
    "ocf_to_net_income": ("operating_cash_flow", "net_income"),
    "free_cash_flow": ("operating_cash_flow - capital_expenditure", None),
    "accruals_ratio": ("net_income - operating_cash_flow", "total_assets"),
    "capex_to_revenue": ("capital_expenditure", "revenue"),
    "depreciation_to_revenue": ("depreciation", "revenue"),
}
ANNUAL_RATIOS = {
    "gross_margin": ("gross_profit", "total_revenue"),
    "operating_margin": ("total_revenue - total_operating_expenses", "total_revenue"),
    "net_margin": ("net_income", "total_revenue"),
    "roa": ("net_income", "total_assets"),
    "roe": ("net_income", "total_assets - total_liabilities"),
    "current_ratio": ("current_assets", "current_liabilities"),
    "working_capital": ("current_assets - current_liabilities", None),
    "debt_to_equity": ("total_liabilities", "total_assets - total_liabilities"),
    "debt_to_assets": ("total_liabilities", "total_assets"),
    "long_term_debt_ratio": ("long_term_debt", "total_assets"),
    "asset_turnover": ("total_revenue", "total_assets"),
    "inventory_turnover": ("cost_of_goods_sold", "inventory"),
    "receivables_turnover": ("total_revenue", "total_receivables"),
}
MARKET_RATIOS = {
    "market_cap": ("shares_outstanding * stock_price", None),
    "enterprise_value": ("shares_outstanding * stock_price + long_term_debt - cash", None),
}

# --- Fixed values: weights of the composite score, each profile sums to one.
WEIGHTS = {
    "balanced": {"size": 0.25, "profit": 0.20, "growth": 0.20, "health": 0.20, "mv": 0.15},
    "pe_buyout": {"size": 0.30, "profit": 0.25, "growth": 0.10, "health": 0.25, "mv": 0.10},
    "strategic_growth": {"size": 0.15, "profit": 0.15, "growth": 0.35, "health": 0.20, "mv": 0.15},
    "distressed": {"size": 0.20, "profit": 0.05, "growth": 0.10, "health": 0.05, "mv": 0.60},
    "micro_cap": {"size": 0.35, "profit": 0.20, "growth": 0.20, "health": 0.15, "mv": 0.10},
}

TAG_SCHEMA = "taxonomy string, tag string, statement string, field string, field_order int, priority int"


def tag_rules(
    spark: SparkSession, groups: Sequence[tuple[str, str, Mapping[str, Sequence[str]]]]
) -> DataFrame:
    """One row per (field, tag): which statement field a tag may feed and with what priority.

    ``groups`` holds (taxonomy, statement, {field: tags}); field order runs through all groups.
    """
    rows, order = [], 0
    for taxonomy, statement, fields in groups:
        for name, tags in fields.items():
            rows += [(taxonomy, tag, statement, name, order, rank) for rank, tag in enumerate(tags)]
            order += 1
    return spark.createDataFrame(rows, TAG_SCHEMA)


def quarterly_rules(spark: SparkSession) -> DataFrame:
    return tag_rules(
        spark,
        [
            ("us-gaap", "balance", BALANCE_SHEET),
            ("us-gaap", "income", INCOME_STATEMENT),
            ("us-gaap", "cash", CASH_FLOW),
        ],
    )


def annual_rules(spark: SparkSession) -> DataFrame:
    return tag_rules(spark, [("us-gaap", "annual", ANNUAL_GAAP), ("dei", "annual", ANNUAL_DEI)])


def sector_of_sic(sic: Column) -> Column:
    """Research sector of an industry code; blank, NULL and non-integer codes are Unknown."""
    code = sic.cast("string").try_cast("int")
    sector = F.when(code.isNull(), F.lit(SECTOR_UNKNOWN))
    for name, ranges in SECTOR_RANGES:
        inside = F.lit(False)
        for low, high in ranges:
            inside = inside | code.between(low, high)
        sector = sector.when(inside, F.lit(name))
    return sector.otherwise(F.lit(SECTOR_DEFAULT))
