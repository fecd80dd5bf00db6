"""Facts, panels, snapshots and a universe derived from the given star-schema tables.

Order lines play the reported values: a customer group is a filer, return flag and line number
make the tag, order priority the form, quarter ends of order dates the periods and ship dates
the filing dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.numbers import safe_divide
from ledgerloom.functions.text import normal_cik
from ledgerloom.operators.dedupe import keep_first
from ledgerloom.operators.facts import latest_filing, with_calendar
from ledgerloom.operators.features import with_target_features
from ledgerloom.rules import tag_rules
from ledgerloom.sources.documents import parse_texts

# Order, line and part in one number: a filer reports no line twice with the same part.
POSITION = ["pos"]
REJECTED_FORM = "5-LOW"

PANEL_TAGS = {
    "A1": "cash", "A2": "receivables", "A3": "inventory", "A4": "current_assets",
    "A5": "total_assets", "A6": "current_liabilities", "A7": "total_liabilities",
    "N1": "equity", "N2": "revenue", "N3": "cost_of_revenue", "N4": "gross_profit",
    "N5": "operating_income", "N6": "net_income", "N7": "interest_expense",
    "R1": "operating_cash_flow", "R2": "capital_expenditure", "R3": "depreciation",
    "R4": "long_term_debt", "R5": "retained_earnings", "R6": "market_value",
    "R7": "total_operating_expenses",
}
PANEL_FIELDS = tuple(PANEL_TAGS.values())

# Statement fields with fallbacks for the queries about tags; N6 and R1 feed two fields each.
STATEMENT_TAGS = {
    "balance": {"assets": ("A5", "N1"), "cash_held": ("A1",)},
    "income": {"sales": ("N2", "N6"), "profit": ("N6", "R1")},
    "cash": {"operating_flow": ("R1", "R7")},
}
STATEMENT_FIELDS = {name: tuple(fields) for name, fields in STATEMENT_TAGS.items()}
YEAR_TAGS = {
    "total_assets": ("A5", "N1"), "total_revenue": ("N2", "N6"), "net_income": ("N6", "R1"),
    "net_sales": ("N3", "A4"), "market_value": ("R6",), "shares_outstanding": ("R7", "R5"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str, customers_per_filer: int = 10) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    unit = (
        F.when(F.col("l_linestatus") == "F", "USD")
        .when(F.col("l_suppkey") % 2 == 0, "USD/shares")
        .otherwise("shares")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.floor(F.col("o_custkey") / customers_per_filer).cast("long").alias("cik"),
        F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("tag"),
        unit.alias("unit"),
        F.col("o_orderpriority").alias("form"),
        F.col("o_orderstatus").alias("fp"),
        F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2)).alias("period_end"),
        F.col("l_shipdate").cast("date").alias("filed"),
        (F.col("l_extendedprice") - 5000).alias("val"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * (1 << 24) + F.col("l_partkey")).cast("long").alias("pos"),
        F.col("l_extendedprice").alias("price"),
    )


def accepted_facts(spark: SparkSession, sf_dir: str, customers_per_filer: int = 10) -> DataFrame:
    return facts(spark, sf_dir, customers_per_filer).where(F.col("form") != REJECTED_FORM)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted facts with every order as a filer of its own: few lines each, so that statements are missing."""
    return accepted_facts(spark, sf_dir).withColumn("cik", F.expr(f"pos div {1 << 27}"))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_filing(
        accepted_facts(spark, sf_dir), ["cik", "tag", "period_end"], ["val"], position=POSITION
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly panel, unique by (cik, period_end).

    The latest values, at most one per tag and period, are partitioned by filer once; the panel
    rows and all windows per filer follow without another shuffle.
    """
    wide = latest(spark, sf_dir).repartition("cik").groupBy("cik", "period_end").agg(
        F.max("filed").alias("filing_date"),
        *[F.max(F.when(F.col("tag") == tag, F.col("val"))).alias(name) for tag, name in PANEL_TAGS.items()],
    )
    return with_calendar(wide).select(
        "cik", "period_end", "fiscal_year", "fiscal_quarter", "filing_date", *PANEL_FIELDS
    )


def annual_names(df: DataFrame) -> DataFrame:
    """The panel under the annual panel's column names."""
    return df.withColumnsRenamed(
        {
            "revenue": "total_revenue",
            "cost_of_revenue": "cost_of_goods_sold",
            "receivables": "total_receivables",
        }
    )


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector and name of every filer: those of the first customer of its group."""
    return table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 10").alias("cik")).agg(
        F.min_by("c_mktsegment", "c_custkey").alias("target_sector"),
        F.min_by("c_name", "c_custkey").alias("company"),
    )


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe rows whose number is also a supplier's; the others stay without a match."""
    numbers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("row_id"))
    return universe(spark, sf_dir).join(numbers, "row_id", "left_semi")


def ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe rows of all customers that have an order, of any date."""
    numbers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("row_id"))
    return universe(spark, sf_dir).join(numbers, "row_id", "left_semi")


def sector_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).join(sectors(spark, sf_dir), "cik", "left")


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest panel row of every filer with its sector."""
    newest = keep_first(panel(spark, sf_dir), ["cik"], [F.desc("period_end")])
    return newest.join(sectors(spark, sf_dir).drop("company"), "cik", "left")


def target_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring input: features over the whole panel, then each filer's latest row."""
    featured = with_target_features(
        annual_names(panel(spark, sf_dir)), entity="cik", order="period_end"
    )
    newest = keep_first(featured, ["cik"], [F.desc("period_end")])
    return (
        newest.join(sectors(spark, sf_dir), "cik", "left")
        .withColumn("ticker", F.concat(F.lit("T"), F.col("cik").cast("string")))
        .select(
            "ticker", "company", "target_sector", "fiscal_year", "total_assets", "total_revenue",
            "net_income", "retained_earnings", "market_value", "net_margin", "debt_to_equity",
            "current_ratio", "revenue_growth", "revenue_growth_3yr",
        )
    )


def ratio_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector panel with two plain ratios."""
    return sector_panel(spark, sf_dir).withColumns(
        {
            "net_margin": safe_divide(F.col("net_income"), F.col("revenue")),
            "roa": safe_divide(F.col("net_income"), F.col("total_assets")),
        }
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    stem = F.upper(F.substring(F.md5(F.col("c_name").cast("binary")), F.lit(1), (2 + key % 3).cast("int")))
    endings = {0: "W", 1: "-B", 2: "YF", 3: "WS", 4: "-PA"}
    ending = F.lit("")
    for place, text in endings.items():
        ending = F.when(key % 8 == place, F.lit(text)).otherwise(ending)
    return table(spark, sf_dir, "customer").select(
        key.alias("row_id"),
        F.floor(key / 2).cast("long").alias("cik_num"),
        F.concat(stem, ending).alias("ticker"),
        F.when(key % 13 == 0, F.concat(F.lit("  "), "c_name", F.lit(" "))).otherwise(F.col("c_name")).alias("company"),
        F.when(key % 17 == 0, F.lit(None).cast("long"))
        .when(key % 19 == 0, F.lit(6770))
        .otherwise(1000 + (key * 37) % 8000)
        .alias("sic_code"),
        F.when(key % 5 == 0, "other").otherwise("Operating").alias("entity_type"),
        (key % 7 != 0).alias("files_10k"),
        (key % 11 == 0).alias("files_20f_or_40f"),
    )


def raw_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe with string ids in the shapes that files hold, some unreadable."""
    number = F.col("cik_num").cast("string")
    text = (
        F.when(F.col("row_id") % 23 == 0, "n/a")
        .when(F.col("row_id") % 3 == 0, F.concat(number, F.lit(".0")))
        .otherwise(number)
    )
    return universe(spark, sf_dir).withColumn("cik", text).withColumn("sic_code", F.col("sic_code").cast("string"))


def statement_rules(spark: SparkSession) -> DataFrame:
    return tag_rules(spark, [("", name, fields) for name, fields in STATEMENT_TAGS.items()]).drop("taxonomy")


def year_rules(spark: SparkSession) -> DataFrame:
    return tag_rules(spark, [("", "annual", YEAR_TAGS)]).drop("taxonomy")


def rounded(df: DataFrame, digits: int = 6, keep: Sequence[str] = ()) -> DataFrame:
    """Round all double columns, so that two engines agree to the last shown digit."""
    doubles = [name for name, kind in df.dtypes if kind == "double" and name not in keep]
    return df.withColumns({name: F.round(name, digits) + F.lit(0.0) for name in doubles})


# Tags under which the order lines' codes stand in documents; some feed the same field.
DOCUMENT_TAGS = {
    "A1": "Assets", "A2": "Liabilities", "A3": "StockholdersEquity", "A4": "LongTermDebt",
    "A5": "LongTermDebtNoncurrent", "N1": "Revenues", "N2": "SalesRevenueNet", "N3": "NetIncomeLoss",
    "N4": "CostOfRevenue", "N5": "CostOfGoodsSold", "R1": "GrossProfit", "R2": "InventoryNet", "R3": "InventoryGross",
}
DOCUMENT_FORMS = {"1-URGENT": "10-K", "2-HIGH": "10-Q", "3-MEDIUM": "10-K", "4-NOT SPECIFIED": "10-Q", "5-LOW": "8-K"}


def renamed(column: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for old, new in names.items():
        out = F.when(column == old, F.lit(new)).otherwise(out)
    return out


def fact_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One facts document per filer as JSON text; every seventh customer group has one without facts."""
    lines = facts(spark, sf_dir).withColumns(
        {"tag": renamed(F.col("tag"), DOCUMENT_TAGS), "form": renamed(F.col("form"), DOCUMENT_FORMS)}
    ).where(F.col("tag").isNotNull())
    record = F.struct(
        "pos", F.date_format("period_end", "yyyy-MM-dd").alias("end"), "val", "fp", "form",
        F.date_format("filed", "yyyy-MM-dd").alias("filed"),
    )
    by_unit = lines.groupBy("cik", "tag", "unit").agg(F.array_sort(F.collect_list(record)).alias("records"))
    by_unit = by_unit.withColumn("records", F.transform("records", lambda r: r.dropFields("pos")))

    def mapped(key: str, value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct(key, value)))

    by_tag = by_unit.groupBy("cik", "tag").agg(F.struct(mapped("unit", "records").alias("units")).alias("body"))
    by_filer = by_tag.groupBy("cik").agg(mapped("tag", "body").alias("gaap"))
    body = F.when(F.col("cik") % 7 != 0, F.create_map(F.lit("us-gaap"), F.col("gaap")))
    text = F.to_json(F.struct(F.col("cik").cast("string").alias("cik"), F.concat(F.lit("Filer "), "cik").alias("entityName"), body.alias("facts")))
    return by_filer.select(F.concat(F.lit("T"), F.col("cik").cast("string")).alias("ticker"), text.alias("text"))


def odd_fact_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no fixed schema fits: values as numbers, texts and objects, in cents, and parts of the wrong kind."""
    cents = F.round(F.col("val") * 100).cast("long").cast("string")
    value = F.when(F.col("unit") == "USD", cents).when(
        F.col("unit") == "shares", F.concat(F.lit('"'), cents, F.lit('"'))
    ).otherwise(F.concat(F.lit('{"cents":'), cents, F.lit("}")))
    day = F.date_format("period_end", "yyyy-MM-dd")
    record = F.concat(F.lit('{"end":"'), day, F.lit('","val":'), value, F.lit(',"form":"'), F.col("form"), F.lit('"}'))
    lines = facts(spark, sf_dir).select("cik", "tag", "unit", "fp", F.struct("pos", record.alias("json")).alias("line"))
    lines = lines.repartition("cik")  # all groupings below are within a filer

    def joined(*entries: Column) -> Column:
        return F.concat(F.lit("{"), F.array_join(F.array_sort(F.flatten(F.array(*entries))), ","), F.lit("}"))

    def named(key: str, value: str) -> Column:
        return F.collect_list(F.concat(F.lit('"'), F.col(key), F.lit('":'), F.col(value)))

    lists = lines.groupBy("cik", "fp", "tag", "unit").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    lists = lists.withColumn("list", F.concat(F.lit("["), F.array_join(F.transform("lines", lambda x: x["json"]), ","), F.lit("]")))
    odd_unit = F.array(F.lit('"none":"not a list"'))
    tags = lists.groupBy("cik", "fp", "tag").agg(F.concat(F.lit('{"units":'), joined(named("unit", "list"), odd_unit), F.lit("}")).alias("body"))
    odd_tag = F.array(F.lit('"Wrong":7'), F.lit('"Empty":{}'))
    parts = tags.groupBy("cik", "fp").agg(joined(named("tag", "body"), odd_tag).alias("concepts"))
    odd_part = F.array(F.lit('"note":"no object"'))
    filers = parts.groupBy("cik").agg(joined(named("fp", "concepts"), odd_part).alias("taxonomies"))
    text = F.concat(F.lit('{"cik":'), F.col("cik").cast("string"), F.lit(',"facts":'), F.col("taxonomies"), F.lit("}"))
    return filers.select(F.concat(F.lit("T"), F.col("cik").cast("string")).alias("ticker"), text.alias("text"))


def fact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_texts(fact_texts(spark, sf_dir), schemas.FACTS_DOCUMENT).select("ticker", "doc")


def filers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industries by ten-digit id, for the filers that have a sector."""
    return sectors(spark, sf_dir).select(
        normal_cik(F.col("cik")).alias("cik"), F.lit("").alias("sic_code"), F.lit("n/a").alias("sic_description"), "target_sector"
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed submission documents, one per customer, built as JSON text from customers and their orders."""
    forms = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.array_sort(F.collect_set(renamed(F.col("o_orderpriority"), {**DOCUMENT_FORMS, "4-NOT SPECIFIED": "20-F"}))).alias("form")
    )
    key = F.col("c_custkey")
    lists = F.when(key % 4 != 0, F.array(F.concat(F.lit("T"), key.cast("string")), F.lit("ALT")))
    body = F.struct(
        F.when(key % 5 != 0, F.col("c_name")).alias("name"),
        F.when(key % 3 != 0, (1000 + (key * 37) % 8000).cast("string")).alias("sic"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("sicDescription"),
        lists.alias("tickers"),
        F.array(F.when(key % 2 == 0, "NYSE"), F.lit(""), F.lit("OTC")).alias("exchanges"),
        F.when(key % 6 != 0, "operating").alias("entityType"),
        F.struct(F.struct(F.col("c_mktsegment").alias("stateOrCountryDescription")).alias("business")).alias("addresses"),
        F.struct(F.struct("form").alias("recent")).alias("filings"),
    )
    joined = table(spark, sf_dir, "customer").join(forms, "c_custkey", "left")
    texts = joined.select(key.cast("string").alias("cik_key"), F.to_json(body).alias("text"))
    return parse_texts(texts, schemas.SUBMISSION_DOCUMENT).select("cik_key", "doc")
