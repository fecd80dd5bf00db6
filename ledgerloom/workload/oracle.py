"""SQL twins of the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

import re

from ledgerloom import rules
from ledgerloom.operators import scoring
from ledgerloom.workload import views as v

SQL: dict[str, str] = {}

# --- views -----------------------------------------------------------------------------------

POSITION = "pos"


def _facts(per: int) -> str:
    return f"""
select cast(floor(o_custkey / {per}) as bigint) as cik,
  concat(l_returnflag, cast(l_linenumber as varchar)) as tag,
  case when l_linestatus = 'F' then 'USD' when l_suppkey % 2 = 0 then 'USD/shares' else 'shares' end as unit,
  o_orderpriority as form, o_orderstatus as fp,
  last_day(cast(date_trunc('quarter', o_orderdate) + interval '2' month as date)) as period_end,
  cast(l_shipdate as date) as filed, l_extendedprice - 5000 as val,
  (l_orderkey * 8 + l_linenumber) * 16777216 + l_partkey as pos, l_extendedprice as price
from lineitem join orders on l_orderkey = o_orderkey"""


_PANEL_COLUMNS = ",\n  ".join(
    f"max(case when tag = '{tag}' then val end) as {name}" for tag, name in v.PANEL_TAGS.items()
)
_RENAMED = "* rename (revenue as total_revenue, cost_of_revenue as cost_of_goods_sold, receivables as total_receivables)"


def div(top: str, bottom: str) -> str:
    return f"(case when ({bottom}) <> 0 then ({top}) / ({bottom}) end)"


def even(expr: str, digits: int) -> str:
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


def bounded(expr: str, low: str, high: str) -> str:
    return f"(case when ({expr}) is not null then least(greatest(({expr}), {low}), {high}) end)"


def change(current: str, previous: str) -> str:
    return (
        f"(case when {previous} = 0 then case when {current} > 0 then 'inf'::double "
        f"when {current} < 0 then '-inf'::double end else {current} / {previous} - 1 end)"
    )


_SERIES = "partition by cik order by period_end"


def _known(column: str, back: int) -> str:
    return f"last_value({column} ignore nulls) over ({_SERIES} rows between unbounded preceding and {back} preceding)"


_EQUITY = "(total_assets - total_liabilities)"

VIEWS = {
    "facts_tx": _facts(10),
    "small_tx": _facts(1),
    "orders_tx": _facts(1).replace("cast(floor(o_custkey / 1) as bigint) as cik", "l_orderkey as cik"),
    "latest_tx": f"""
select cik, tag, period_end, filed, val from (
  select *, row_number() over (partition by cik, tag, period_end order by filed desc, {POSITION}) as rn
  from facts_tx where form <> '5-LOW') t where rn = 1""",
    "panel_tx": f"""
select cik, period_end, cast(year(period_end) as int) as fiscal_year,
  cast(quarter(period_end) as int) as fiscal_quarter, max(filed) as filing_date,
  {_PANEL_COLUMNS}
from latest_tx group by cik, period_end""",
    "sector_tx": """
select c_custkey // 10 as cik, arg_min(c_mktsegment, c_custkey) as target_sector, arg_min(c_name, c_custkey) as company
from customer group by 1""",
    "sector_panel_tx": """
select p.*, s.target_sector, s.company from panel_tx p left join sector_tx s on s.cik = p.cik""",
    "ratio_panel_tx": f"""
select *, {div('net_income', 'revenue')} as net_margin, {div('net_income', 'total_assets')} as roa
from sector_panel_tx""",
    "padded_tx": f"""
select {_RENAMED}, {_known('revenue', 0)} as r0, {_known('revenue', 1)} as r1, {_known('revenue', 3)} as r3
from panel_tx""",
    "featured_tx": f"""
select * exclude (r0, r1, r3, equity),
  {bounded(change('r0', 'r1'), '-0.9', '2.0')} as revenue_growth,
  {bounded(change('r0', 'r3') + ' / 3', '-0.9', '2.0')} as revenue_growth_3yr,
  {div('net_income', 'total_revenue')} as net_margin,
  {bounded(div('total_liabilities', _EQUITY), '0.0', '20.0')} as debt_to_equity,
  {div('current_assets', 'current_liabilities')} as current_ratio,
  {_EQUITY} as equity
from padded_tx""",
    "target_tx": """
select concat('T', cast(f.cik as varchar)) as ticker, s.company, s.target_sector, fiscal_year, total_assets,
  total_revenue, net_income, retained_earnings, market_value, net_margin, debt_to_equity, current_ratio,
  revenue_growth, revenue_growth_3yr
from (select *, row_number() over (partition by cik order by period_end desc) as rn from featured_tx) f
left join sector_tx s on s.cik = f.cik where rn = 1""",
}


def _pct(column: str) -> str:
    return (
        f"(rank() over (partition by target_sector order by {column}) "
        f"+ (count(*) over (partition by target_sector, {column}) - 1) / 2.0) "
        f"/ count({column}) over (partition by target_sector)"
    )


_FILLS = [f"coalesce({n}, median({n}) over (partition by target_sector)) as {n}_f" for n in scoring.MEDIAN_MEASURES]
_FILLS += [f"coalesce({n}, {fill}) as {n}_f" for n, fill in scoring.CONSTANT_FILLS.items()]
_MEASURES = [*scoring.MEDIAN_MEASURES, *scoring.CONSTANT_FILLS]
_RANKS = [
    f"case when target_sector is not null and {n}_f is not null then {_pct(n + '_f')} end as {n}_r" for n in _MEASURES
]

VIEWS["filled_tx"] = f"select *, {', '.join(_FILLS)} from target_tx"
VIEWS["sector_ranks_tx"] = f"select *, {', '.join(_RANKS)} from filled_tx"
VIEWS["scored_tx"] = """
select * ,
  least(greatest(coalesce(1.0 - total_assets_r, 0.5)
    + (case when coalesce(total_assets, 0) < 50000000 then 1.0 else 0.0 end)::double * 0.15::double, 0), 1) * 100 as size_score,
  (coalesce(net_margin_r, 0.5) * 0.60::double
    + (case when net_income > 0 then 1.0 else 0.0 end)::double * 0.40::double) * 100 as profit_score,
  (coalesce(revenue_growth_r, 0.5) * 0.60::double + coalesce(revenue_growth_3yr_r, 0.5) * 0.40::double) * 100 as growth_score,
  (coalesce(1.0 - debt_to_equity_r, 0.5) * 0.30::double + coalesce(current_ratio_r, 0.5) * 0.30::double
    + (case when net_income > 0 then 1.0 else 0.0 end)::double * 0.20::double
    + (case when retained_earnings > 0 then 1.0 else 0.0 end)::double * 0.20::double) * 100 as health_score,
  least(greatest(coalesce(1.0 - market_value_r, 0.5)
    + (case when coalesce(market_value, 0) < 500000000 then 1.0 else 0.0 end)::double * 0.10::double, 0), 1) * 100 as mv_score
from sector_ranks_tx"""


def _composite(preset: str) -> str:
    weights = rules.WEIGHTS[preset]
    return " + ".join(f"{column} * {weights[part]}::double" for part, column in scoring.SCORES.items())


VIEWS["composite_tx"] = f"select *, {_composite('balanced')} as acquirability_score from scored_tx"

_THESIS = """concat_ws(' / ',
  case when size_score >= 80 then 'Micro-cap' when size_score >= 60 then 'Small-cap'
    when size_score <= 30 then 'Large-cap' else 'Mid-cap' end,
  case when growth_score >= 75 then case when revenue_growth > 0.3 then 'high-growth' else 'steady-grower' end end,
  case when profit_score >= 75 then 'high-margin' when profit_score <= 35 then 'turnaround-candidate' end,
  case when health_score >= 75 then 'low-debt' when health_score <= 35 then 'distressed' end)
  || ' ' || coalesce(target_sector, 'nan') || ' target'"""

VIEWS["universe_tx"] = """
select c_custkey as row_id, cast(floor(c_custkey / 2) as bigint) as cik_num,
  concat(upper(substr(md5(c_name), 1, 2 + cast(c_custkey % 3 as int))),
    case cast(c_custkey % 8 as int) when 0 then 'W' when 1 then '-B' when 2 then 'YF' when 3 then 'WS'
      when 4 then '-PA' else '' end) as ticker,
  case when c_custkey % 13 = 0 then concat('  ', c_name, ' ') else c_name end as company,
  case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then 6770
    else 1000 + (c_custkey * 37) % 8000 end as sic_code,
  case when c_custkey % 5 = 0 then 'other' else 'Operating' end as entity_type,
  c_custkey % 7 <> 0 as files_10k, c_custkey % 11 = 0 as files_20f_or_40f
from customer"""
VIEWS["listed_tx"] = "select * from universe_tx where row_id in (select s_suppkey from supplier)"
VIEWS["ordering_tx"] = "select * from universe_tx where row_id in (select o_custkey from orders)"
VIEWS["raw_universe_tx"] = """
select *, case when row_id % 23 = 0 then 'n/a' when row_id % 3 = 0 then concat(cast(cik_num as varchar), '.0')
  else cast(cik_num as varchar) end as cik from universe_tx"""
VIEWS["clean_universe_tx"] = """
select ticker, cik, company, cast(sic_code as varchar) as sic_code from (
  select *, row_number() over (partition by cik order by row_id) as rc from (
    select *, row_number() over (partition by ticker order by row_id) as rt from (
      select row_id, upper(trim(ticker)) as ticker, trim(company) as company, sic_code,
        lpad(cast(coalesce(cast(try_cast(cik as double) as bigint), 0) as varchar), 10, '0') as cik
      from raw_universe_tx) a) b
  where rt = 1) c where rc = 1"""
VIEWS["typed_universe_tx"] = """
select *, case
    when (length(ticker) > 4 and right(ticker, 2) in ('YF', 'SF', 'XF', 'OF', 'FF'))
      or (length(ticker) > 5 and right(ticker, 1) = 'F') then 'FOREIGN_OTC'
    when right(ticker, 2) in ('WT', 'WS') then 'WARRANT'
    when contains(ticker, '-PA') or contains(ticker, '-PB') or contains(ticker, '-PC') then 'PREFERRED'
    when contains(ticker, '-') and length(ticker) <= 6
      and string_split(ticker, '-')[-1] in ('A', 'B', 'C', 'PA', 'PB', 'PC') then 'CLASS_SHARE'
    else 'PRIMARY' end as ticker_type
from universe_tx"""


def _values(rows: list[tuple], columns: str, name: str) -> str:
    body = ", ".join(str(row) for row in rows)
    return f"select * from (values {body}) as {name}({columns})"


def _rule_rows(groups: dict) -> list[tuple]:
    rows, order = [], 0
    for statement, fields in groups.items():
        for name, tags in fields.items():
            rows += [(tag, statement, name, order, rank) for rank, tag in enumerate(tags)]
            order += 1
    return rows


VIEWS["rules_tx"] = _values(_rule_rows(v.STATEMENT_TAGS), "tag, statement, field, field_order, priority", "r")
VIEWS["year_rules_tx"] = _values(_rule_rows({"annual": v.YEAR_TAGS}), "tag, statement, field, field_order, priority", "r")


def _resolved(source: str, condition: str) -> str:
    return f"""
select cik, statement, field, field_order, period_end, priority, filed, val from (
  select *, row_number() over (partition by cik, field, period_end order by priority, filed desc, {POSITION}) as rn
  from {source} f join rules_tx r on f.tag = r.tag where {condition}) t where rn = 1"""


def _statement(name: str, source: str = "resolved_tx") -> str:
    fields = ", ".join(
        f"max(case when field = '{field}' then val end) as {field}" for field in v.STATEMENT_FIELDS[name]
    )
    return f"""
select cik, period_end, arg_min(filed, field_order) as filing_date, {fields}
from {source} where statement = '{name}' group by cik, period_end"""


VIEWS["resolved_tx"] = _resolved("facts_tx", "form <> '5-LOW'")
VIEWS["small_resolved_tx"] = _resolved("orders_tx", "form <> '5-LOW'")
for _name in v.STATEMENT_TAGS:
    VIEWS[f"{_name}_tx"] = _statement(_name)
    VIEWS[f"small_{_name}_tx"] = _statement(_name, "small_resolved_tx")


def with_views(sql: str) -> str:
    """Put the views that a statement needs in front of it."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                need(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in ordered) + "\n" + sql


def add(name: str, sql: str, digits: int | None = None, doubles: list[str] | None = None) -> None:
    if digits is not None and doubles:
        shown = ", ".join(f"round({c}, {digits}) + 0.0::double as {c}" for c in doubles)
        sql = f"select * replace ({shown}) from ({sql}) as t"
    SQL[name] = with_views(sql)


# --- facts -----------------------------------------------------------------------------------

add("latest_filing", "select cik, tag, period_end, filed, val from latest_tx")

add("latest_filing_in_batches", "select cik, tag, period_end, filed, val from latest_tx")


def _preferred(rank: str) -> str:
    return f"""
select cik, tag, period_end, filed, val from (
  select *, row_number() over (partition by cik, tag, period_end order by filed desc, {POSITION}) as rn from (
    select *, min(unit_rank) over (partition by cik, tag) as best from (
      select *, {rank} as unit_rank from small_tx) a where unit_rank is not null) b
  where unit_rank = best and form <> '5-LOW') c where rn = 1"""


add("preferred_unit", _preferred("case unit when 'USD' then 0 when 'USD/shares' then 1 end"))
add("any_unit", _preferred("case unit when 'shares' then 0 when 'USD' then 1 else 2 end"))
add("latest_filing_by_year", f"""
select cik, tag, cast(year(period_end) as int) as fiscal_year, filed, val, period_end,
  case fp when 'F' then 4 when 'P' then 1 else cast(quarter(period_end) as int) end as reported_quarter from (
  select *, row_number() over (partition by cik, tag, year(period_end) order by filed desc, {POSITION}) as rn
  from facts_tx where form in ('1-URGENT', '2-HIGH') and val is not null and year(period_end) >= 1997) t
where rn = 1""")
add("fallback_period", "select * from resolved_tx")

VIEWS["year_resolved_tx"] = f"""
select cik, statement, field, field_order, priority, fiscal_year, filed, val, period_end from (
  select *, min(priority) over (partition by cik, field) as best from (
    select *, cast(year(period_end) as int) as fiscal_year,
      row_number() over (partition by cik, field, priority, year(period_end) order by filed desc, {POSITION}) as rn
    from small_tx f join year_rules_tx r on f.tag = r.tag where form <> '5-LOW') a
  where rn = 1) b where priority = best"""
VIEWS["year_resolved2_tx"] = VIEWS["year_resolved_tx"].replace("form <> '5-LOW'", "form in ('1-URGENT', '2-HIGH')")
add("fallback_entity", "select * from year_resolved_tx")

_CALENDAR = "cast(year(period_end) as int) as fiscal_year, cast(quarter(period_end) as int) as fiscal_quarter"
add("statement_pivot", f"select *, {_CALENDAR} from balance_tx")
_JOINED = """
select b.cik, b.period_end, b.filing_date, assets, cash_held, sales, profit, operating_flow,
  cast(year(b.period_end) as int) as fiscal_year, cast(quarter(b.period_end) as int) as fiscal_quarter
from balance_tx b
left join income_tx i on i.cik = b.cik and i.period_end = b.period_end {filing_i}
left join cash_tx c on c.cik = b.cik and c.period_end = b.period_end {filing_c}"""
_SAME_I = "and i.filing_date is not distinct from b.filing_date"
_SAME_C = "and c.filing_date is not distinct from b.filing_date"
add("three_statement_join", _JOINED.format(filing_i=_SAME_I, filing_c=_SAME_C))
add("statement_join_by_period", _JOINED.format(filing_i="", filing_c=""))
add("statement_base_fallback", f"""
select b.cik, b.period_end, b.filing_date, bs.assets, bs.cash_held, i.sales, i.profit, c.operating_flow,
  cast(year(b.period_end) as int) as fiscal_year, cast(quarter(b.period_end) as int) as fiscal_quarter
from (
  select cik, period_end, filing_date from small_balance_tx
  union all select cik, period_end, filing_date from small_income_tx where cik not in (select cik from small_balance_tx)
  union all select cik, period_end, filing_date from small_cash_tx
    where cik not in (select cik from small_balance_tx) and cik not in (select cik from small_income_tx)) b
left join small_balance_tx bs on bs.cik = b.cik and bs.period_end = b.period_end
  and bs.filing_date is not distinct from b.filing_date
left join small_income_tx i on i.cik = b.cik and i.period_end = b.period_end {_SAME_I}
left join small_cash_tx c on c.cik = b.cik and c.period_end = b.period_end {_SAME_C}""")
_YEAR_FIELDS = ", ".join(f"max(case when field = '{f}' then val end) as {f}" for f in v.YEAR_TAGS)
_FILLED = " + ".join(f"(case when {f} is not null then 1 else 0 end)" for f in v.YEAR_TAGS)
add("annual_panel", f"""
select * replace (coalesce(net_sales, total_revenue) as net_sales, coalesce(total_revenue, net_sales) as total_revenue)
from (select cik, fiscal_year, 4 as fiscal_quarter,
    coalesce(max(case when field = 'total_assets' then period_end end),
      max(case when field = 'total_revenue' then period_end end),
      max(case when field = 'net_income' then period_end end), arg_min(period_end, field_order)) as period_end,
    max(filed) as filing_date, {_YEAR_FIELDS}
  from year_resolved2_tx group by cik, fiscal_year) t
where {_FILLED} >= 3""")

# --- joins -----------------------------------------------------------------------------------


def sector_case(code: str) -> str:
    whens = " ".join(
        "when " + " or ".join(f"{code} between {low} and {high}" for low, high in ranges) + f" then '{name}'"
        for name, ranges in rules.SECTOR_RANGES
    )
    return f"case when {code} is null then 'Unknown' {whens} else '{rules.SECTOR_DEFAULT}' end"


add("metadata_join", f"""
select p.cik, period_end, total_assets, u.sic_code, case when u.cik is not null then 'n/a' end as sic_description,
  case when u.cik is not null then {sector_case('cast(u.sic_code as int)')} end as target_sector
from (select lpad(cast(cik as varchar), 10, '0') as cik, period_end, total_assets from panel_tx) p
left join clean_universe_tx u on u.cik = p.cik""")
add("lookup_default", f"""
select u.row_id, lpad(cast(u.cik_num as varchar), 10, '0') as cik, u.ticker,
  coalesce(k.sic_code, '') as sic_code, coalesce(k.sic_description, 'Unknown') as sic_description,
  coalesce(k.target_sector, 'Unknown') as target_sector
from universe_tx u left join (
  select * from (select cik_num, coalesce(cast(sic_code as varchar), '') as sic_code,
      'listed' as sic_description, {sector_case('sic_code')} as target_sector,
      row_number() over (partition by cik_num order by coalesce(cast(sic_code as varchar), ''), {sector_case('sic_code')}) as rn
    from listed_tx where cik_num <> 0) a where rn = 1) k
on k.cik_num = u.cik_num""")
add("profile_join", """
select u.row_id, lpad(cast(u.cik_num as varchar), 10, '0') as cik, u.ticker, p.entity_type, p.files_10k
from universe_tx u left join (select * from (select *, row_number() over (partition by cik_num order by row_id) as rn
  from ordering_tx where cik_num <> 0) a where rn = 1) p on p.cik_num = u.cik_num""")
add("external_join", """
select p.cik, p.period_end, p.fiscal_year, p.revenue, m.mean_order
from panel_tx p left join (
  select cast(year(o_orderdate) as int) as fiscal_year, round(avg(o_totalprice), 4) as mean_order
  from orders group by 1) m on m.fiscal_year = p.fiscal_year""")
add("market_values", f"""
select cik, period_end, {even('market_value * stock_price', 4)} as market_cap,
  {even('market_value * stock_price + long_term_debt - cash', 4)} as enterprise_value
from panel_tx p left join (
  select cik, cast(year(period_end) as int) as fiscal_year, round(avg(price) / 1000, 4) as stock_price
  from facts_tx group by 1, 2) s using (cik, fiscal_year)""", 4, ["market_cap", "enterprise_value"])
add("membership_semi", """
select row_id, lpad(cast(cik_num as varchar), 10, '0') as cik from universe_tx
where cik_num <> 0 and cik_num in (select cik_num from universe_tx where files_10k)""")
add("fetch_worklist", """
select ticker, row_id from universe_tx
where ticker not in (select ticker from ordering_tx)""")
add("orphans", """
select row_id, lower(ticker) as ticker from universe_tx
where upper(ticker) not in (select upper(ticker) from listed_tx)""")
add("concat_frames", f"""
select cik, period_end, arg_min(filed, field_order) as filing_date,
  max(case when field = 'assets' then val end) as assets, {_CALENDAR}, cast(null as double) as sales
from resolved_tx where field = 'assets' group by cik, period_end
union all
select cik, period_end, arg_min(filed, field_order), null, {_CALENDAR}, max(case when field = 'sales' then val end)
from resolved_tx where field = 'sales' group by cik, period_end""")

# --- documents -------------------------------------------------------------------------------


def _named(column: str, names: dict[str, str]) -> str:
    return f"case {column} " + " ".join(f"when '{old}' then '{new}'" for old, new in names.items()) + " end"


VIEWS["document_facts_tx"] = f"""
select concat('T', cast(cik as varchar)) as ticker, lpad(cast(cik as varchar), 10, '0') as cik,
  concat('Filer ', cast(cik as varchar)) as company, 'us-gaap' as taxonomy, tag, unit,
  cast(row_number() over (partition by cik, tag, unit order by pos) - 1 as int) as pos, period_end, val, form, fp, filed
from (select * replace ({_named('tag', v.DOCUMENT_TAGS)} as tag, {_named('form', v.DOCUMENT_FORMS)} as form) from facts_tx) f
where tag is not null and cik % 7 <> 0"""
VIEWS["unit_facts_tx"] = """
select * from (select *, min(case unit when 'USD' then 0 when 'USD/shares' then 1 end) over (partition by cik, tag) as best
  from document_facts_tx) d where best = case unit when 'USD' then 0 when 'USD/shares' then 1 end"""
_LONG = "ticker, cik, company, taxonomy, tag, unit, pos, period_end, val, form, fp, filed"
add("flatten_facts", f"select {_LONG} from document_facts_tx")
add("flatten_listed", f"select {_LONG} from document_facts_tx where cast(substr(ticker, 2) as bigint) in (select s_suppkey from supplier)")
add("flatten_variants", f"select {_LONG} from document_facts_tx")
VIEWS["odd_tx"] = """
select concat('T', cast(cik as varchar)) as ticker, lpad(cast(cik as varchar), 10, '0') as cik, fp as taxonomy, tag, unit,
  dense_rank() over (partition by cik, fp, tag order by unit) as place, cast(row_number() over (partition by cik, fp, tag, unit order by pos) - 1 as int) as pos,
  period_end, cast(round(val * 100) as bigint) as cents, form from facts_tx"""
# the list of the unit "none" is none, and comes after the others in the order of names
add("odd_documents", """
select ticker, cik, taxonomy, tag, unit, cast(place - 1 + case when unit > 'none' then 1 else 0 end as int) as unit_pos, pos, period_end,
  case when unit <> 'USD/shares' then cast(cents as double) end as val, form,
  case when unit = 'USD/shares' then concat('{"cents":', cast(cents as varchar), '}') end as raw_val from odd_tx""")
add("odd_document_units", """
select ticker, taxonomy, tag, unit, pos, period_end, cast(cents as double) as val
from (select *, min(case unit when 'shares' then 1 when 'USD' then 2 end) over (partition by ticker, taxonomy, tag) as best from odd_tx) t
where best = case unit when 'shares' then 1 when 'USD' then 2 end""")
add("document_units", f"select {_LONG} from unit_facts_tx")
add("rejected_documents", f"""
select distinct concat('T', cast(cik as varchar)) as ticker from facts_tx
where cik % 7 = 0 and {_named('tag', v.DOCUMENT_TAGS)} is not null""")
# field, statement, its place among all fields of the panel, and its tags, best first
_DOCUMENT_FIELDS = [
    ("inventory", "balance", 3, ["InventoryNet", "InventoryGross"]),
    ("total_assets", "balance", 8, ["Assets"]),
    ("long_term_debt", "balance", 11, ["LongTermDebtNoncurrent", "LongTermDebt"]),
    ("total_liabilities", "balance", 12, ["Liabilities"]),
    ("equity", "balance", 13, ["StockholdersEquity"]),
    ("revenue", "income", 14, ["SalesRevenueNet", "Revenues"]),
    ("cost_of_revenue", "income", 15, ["CostOfGoodsSold", "CostOfRevenue"]),
    ("gross_profit", "income", 16, ["GrossProfit"]),
    ("net_income", "income", 20, ["NetIncomeLoss"]),
]
VIEWS["document_rules_tx"] = _values(
    [(tag, part, name, place, rank) for name, part, place, tags in _DOCUMENT_FIELDS for rank, tag in enumerate(tags)],
    "tag, statement, field, field_order, priority", "r",
)
VIEWS["document_resolved_tx"] = """
select * from (select f.*, statement, field, field_order,
    row_number() over (partition by ticker, field, period_end order by priority, filed desc, pos) as rn
  from unit_facts_tx f join document_rules_tx r on f.tag = r.tag where form in ('10-K', '10-Q')) t where rn = 1"""
for _part in ("balance", "income"):
    _spread_fields = ", ".join(
        f"max(case when field = '{name}' then val end) as {name}" for name, part, _, _ in _DOCUMENT_FIELDS if part == _part
    )
    VIEWS[f"document_{_part}_tx"] = f"""
select ticker, cik, company, period_end, arg_min(filed, field_order) as filing_date, {_spread_fields}
from document_resolved_tx where statement = '{_part}' group by all"""
_BALANCE_FIELDS = ", ".join(f"bs.{name}" for name, part, _, _ in _DOCUMENT_FIELDS if part == "balance")
_INCOME_FIELDS = ", ".join(f"i.{name}" for name, part, _, _ in _DOCUMENT_FIELDS if part == "income")
_DOCUMENT_PANEL = f"""
select b.ticker, b.cik, b.company, s.target_sector, b.period_end, b.filing_date,
  cast(year(b.period_end) as int) as fiscal_year, cast(quarter(b.period_end) as int) as fiscal_quarter,
  {_BALANCE_FIELDS}, {_INCOME_FIELDS},
  coalesce(abs(total_assets - (total_liabilities + equity)) <= greatest(coalesce(abs(total_assets), 0) * 0.01::double, 1000000), false)
    as balance_sheet_valid
from (select ticker, cik, company, period_end, filing_date from document_balance_tx
  union all select ticker, cik, company, period_end, filing_date from document_income_tx
    where ticker not in (select ticker from document_balance_tx)) b
left join document_balance_tx bs on bs.ticker = b.ticker and bs.period_end = b.period_end and bs.filing_date = b.filing_date
left join document_income_tx i on i.ticker = b.ticker and i.period_end = b.period_end and i.filing_date = b.filing_date
left join sector_tx s on lpad(cast(s.cik as varchar), 10, '0') = b.cik"""
# field, its place among all fields of the annual panel, and its tags with their priorities
_ANNUAL_DOCUMENT_FIELDS = [
    ("cost_of_goods_sold", 1, {"CostOfGoodsSold": 1, "CostOfRevenue": 2}),
    ("inventory", 3, {"InventoryNet": 0, "InventoryGross": 3}),
    ("net_income", 4, {"NetIncomeLoss": 0}),
    ("net_sales", 6, {"SalesRevenueNet": 0}),
    ("total_assets", 7, {"Assets": 0}),
    ("long_term_debt", 8, {"LongTermDebtNoncurrent": 0, "LongTermDebt": 1}),
    ("gross_profit", 9, {"GrossProfit": 0}),
    ("total_revenue", 12, {"SalesRevenueNet": 1, "Revenues": 2}),
    ("total_liabilities", 13, {"Liabilities": 0}),
]
VIEWS["annual_document_rules_tx"] = _values(
    [(tag, name, place, rank) for name, place, tags in _ANNUAL_DOCUMENT_FIELDS for tag, rank in tags.items()],
    "tag, field, field_order, priority", "r",
)
_ANNUAL_UNIT = "case unit when 'USD' then 0 when 'USD/shares' then 1 else 2 end"
VIEWS["annual_unit_facts_tx"] = f"""
select * from (select *, min({_ANNUAL_UNIT}) over (partition by cik, tag) as best from document_facts_tx) d where best = {_ANNUAL_UNIT}"""
VIEWS["annual_document_tx"] = """
select * from (select *, min(priority) over (partition by ticker, field) as first_tag from (
    select f.*, year(period_end) as fiscal_year, field, field_order, priority,
      row_number() over (partition by ticker, field, priority, year(period_end) order by filed desc, pos) as rn
    from annual_unit_facts_tx f join annual_document_rules_tx r on f.tag = r.tag where form = '10-K' and val is not null) a
  where rn = 1) b where priority = first_tag"""
_ANNUAL_NAMES = [name for name, _, _ in _ANNUAL_DOCUMENT_FIELDS]
_ANNUAL_VALUES = ", ".join(f"max(case when field = '{name}' then val end) as {name}" for name in _ANNUAL_NAMES)
add("annual_from_documents", f"""
select y.* replace (coalesce(net_sales, total_revenue) as net_sales, coalesce(total_revenue, net_sales) as total_revenue), s.target_sector
from (select ticker, cik, company, cast(fiscal_year as int) as fiscal_year, 4 as fiscal_quarter,
    coalesce(max(case when field = 'total_assets' then period_end end), max(case when field = 'total_revenue' then period_end end),
      max(case when field = 'net_income' then period_end end), arg_min(period_end, field_order)) as period_end,
    max(filed) as filing_date, {_ANNUAL_VALUES}
  from annual_document_tx group by ticker, cik, company, fiscal_year) y
left join sector_tx s on lpad(cast(s.cik as varchar), 10, '0') = y.cik
where {' + '.join(f'(case when {n} is not null then 1 else 0 end)' for n in _ANNUAL_NAMES)} >= 3""")
add("quarterly_from_documents", _DOCUMENT_PANEL)
add("quarterly_from_stored_facts", _DOCUMENT_PANEL)
_SUBMITTED = """
(select c.*, f.forms from customer c left join (select o_custkey, list(distinct case o_orderpriority
  when '1-URGENT' then '10-K' when '2-HIGH' then '10-Q' when '3-MEDIUM' then '10-K' when '4-NOT SPECIFIED' then '20-F'
  when '5-LOW' then '8-K' end) as forms from orders group by 1) f on f.o_custkey = c.c_custkey) s"""
add("filer_profiles", f"""
select cast(c_custkey as varchar) as cik_key, case when c_custkey % 6 <> 0 then 'operating' else '' end as entity_type,
  '' as state_of_incorporation, c_mktsegment as country, case when c_custkey % 2 = 0 then 'NYSE,OTC' else 'OTC' end as exchanges,
  coalesce(list_contains(forms, '10-K'), false) as files_10k, coalesce(list_contains(forms, '20-F'), false) as files_20f_or_40f,
  '' as fiscal_year_end from {_SUBMITTED}""")
add("filer_categories", f"""
select case when c_custkey % 4 <> 0 then concat('T', cast(c_custkey as varchar)) else '' end as ticker,
  lpad(cast(c_custkey as varchar), 10, '0') as cik, case when c_custkey % 5 <> 0 then c_name else '' end as company,
  case when c_custkey % 3 <> 0 then cast(1000 + (c_custkey * 37) % 8000 as varchar) else '' end as sic_code,
  case when c_custkey % 3 <> 0 then c_mktsegment else 'Unknown' end as sic_description,
  case when c_custkey % 3 = 0 then 'Unknown' else {sector_case('(1000 + (c_custkey * 37) % 8000)')} end as target_sector
from {_SUBMITTED}""")

# --- scalar functions ------------------------------------------------------------------------

add("ticker_index", """
select upper(substr(c_mktsegment, 1, 4)) as ticker, lpad(cast(c_custkey as varchar), 10, '0') as cik,
  c_name as company from customer""")
add("props_json", """
select cast(json_extract(props, '$.k') as int) as k, coalesce(json_extract_string(props, '$.note.text'), '') as note,
  count(*) as events from events group by 1, 2""")
add("cik_normalize", """
select row_id, cik, regexp_replace(cik, '^0+', '') as bare, sheet_id from (
  select row_id, lpad(cast(coalesce(cast(try_cast(cik as double) as bigint), 0) as varchar), 10, '0') as cik,
    concat('="', lpad(cik, 10, '0'), '"') as sheet_id from raw_universe_tx) t""")
add("text_clean", """
select row_id, upper(ticker) as ticker,
  array_to_string(list_transform(string_split(lower(trim(replace(company, '#', ' '))), ' '),
    lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), ' ') as company
from universe_tx""")
add("title_case", """
select p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '),
  lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), ' ') as title from part""")
add("sector_map", f"select row_id, sic_code, {sector_case('sic_code')} as target_sector from universe_tx")
add("ticker_classes", "select row_id, ticker, ticker_type from typed_universe_tx")
add("ticker_quality", """
select row_id, ticker, cast(contains(ticker, '-') as int) as hyphen,
  cast(length(ticker) > 3 and right(ticker, 1) in ('W', 'U', 'R') and right(ticker, 2) <> 'OR' as int) as odd_line,
  cast(length(ticker) as int) as size from universe_tx""")
add("array_flags", """
select o_custkey, coalesce(forms[1], '') as first_form, list_contains(forms, '1-URGENT') as files_urgent,
  array_to_string(forms, ',') as all_forms
from (select o_custkey, list_sort(list(distinct o_orderpriority)) as forms from orders group by o_custkey) t""")
add("date_parts", """
select o_orderkey, period_end, cast(year(period_end) as int) as fiscal_year, cast(quarter(period_end) as int) as fiscal_quarter
from (select o_orderkey, case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) end as period_end from orders) t""")
add("cross_fill", """
select cik, period_end, coalesce(revenue, gross_profit) as total_revenue, coalesce(gross_profit, revenue) as net_sales
from panel_tx""")
add("money_format", """
select ticker, case when x is null or x = 0 then 'N/A'
    when abs(x) >= 1e9 then printf('$%.1fB', round_even(x / 1e9 * 10, 0) / 10)
    when abs(x) >= 1e6 then printf('$%.0fM', round_even(x / 1e6, 0))
    else '$' || format('{:,}', cast(round_even(x, 0) as bigint)) end as revenue,
  case when revenue_growth is null then 'N/A' else printf('%.0f%%', round_even(revenue_growth * 100, 0)) end as growth
from (select *, total_revenue * case when total_assets is null then 1 else 100000 end as x from target_tx) t""")

# --- universe --------------------------------------------------------------------------------

add("universe_clean", "select ticker, cik, company, sic_code, '' as sic_description, '' as target_sector from clean_universe_tx")
_DOMESTIC = "files_10k and not files_20f_or_40f and lower(entity_type) = 'operating' and sic_code is not null"
add("universe_filter", f"select * from universe_tx where {_DOMESTIC}")
add("universe_sector_pick", f"""
select row_id, cik_num as cik, company, {sector_case('sic_code')} as target_sector from universe_tx
where {sector_case('sic_code')} = 'Retail' order by company, cik_num limit 25""")
_NO_SHELL = "(sic_code is null or sic_code not in (6770, 6726, 6221, 6189, 9995))"
add("universe_no_shells", f"select row_id, sic_code from universe_tx where {_NO_SHELL}")
add("universe_one_per_cik", f"""
select lpad(cast(cik as varchar), 10, '0') as cik, '10-K' as filing_tag, ticker, cast(sic_code as double) as sic_code
from (select *, row_number() over (partition by cik order by contains(ticker, '-'),
    length(ticker) > 3 and right(ticker, 1) in ('W', 'U', 'R') and right(ticker, 2) <> 'OR', length(ticker), ticker) as rn
  from (select distinct cik_num as cik, ticker, sic_code from universe_tx) d) t
where rn = 1 and {_NO_SHELL}""")
add("universe_shortest", """
select ticker, lpad(cast(cik_num as varchar), 10, '0') as cik, company, cast(sic_code as varchar) as sic_code,
  '' as sic_description, '' as target_sector from (
  select *, row_number() over (partition by ticker order by length(ticker), lpad(cast(cik_num as varchar), 10, '0'), company) as r2 from (
    select *, row_number() over (partition by cik_num order by length(ticker), ticker, company) as r1
    from typed_universe_tx where ticker_type = 'PRIMARY') a where r1 = 1) b where r2 = 1""")
add("universe_by_company", """
select row_id, cik_num, ticker, trim(company) as company, row_number() over (order by trim(company), cik_num, row_id) as position
from universe_tx""")
add("universe_by_ticker", "select row_id, ticker, row_number() over (order by ticker, row_id) as position from universe_tx")
add("universe_distinct", """
select distinct lpad(cast(cik_num as varchar), 10, '0') as cik, ticker, cast(sic_code as double) as sic_code from universe_tx""")
add("universe_dropped_tickers", "select row_id, ticker, ticker_type from typed_universe_tx where ticker_type <> 'PRIMARY'")
add("universe_repeated_ciks", """
select cik_num, count(*) as rows from typed_universe_tx where ticker_type = 'PRIMARY' group by 1 having count(*) > 1""")
add("universe_match_summary", f"""
select 0 as step, 'started' as stage, count(*) as rows from universe_tx
union all select 1, 'matched', count(*) from ordering_tx where row_id <> 0
union all select 2, 'kept', count(*) from ordering_tx where row_id <> 0 and {_DOMESTIC} and {_NO_SHELL}""")

# --- ratios and features ---------------------------------------------------------------------


def _ratio(name: str, ratios: dict, digits: int = 4) -> str:
    top, bottom = ratios[name]
    return even(top if bottom is None else div(top, bottom), digits) + f" as {name}"


def _ratios(ratios: dict) -> str:
    return ", ".join(_ratio(name, ratios) for name in ratios)


add("ratios_quarterly", f"select cik, period_end, {_ratios(rules.QUARTERLY_RATIOS)} from panel_tx", 6, list(rules.QUARTERLY_RATIOS))
add("ratios_annual", f"select cik, period_end, {_ratios(rules.ANNUAL_RATIOS)} from (select {_RENAMED} from panel_tx) p",
    6, list(rules.ANNUAL_RATIOS))
_LAGS = ", ".join(f"lag({n}, 1) over ({_SERIES}) as {n}_lag1" for n in rules.LAGGED)
add("lag1", f"select cik, period_end, {_LAGS} from panel_tx")


def _growth(names: tuple[str, ...]) -> str:
    return ", ".join(even(div(f"{n} - {n}_lag1", f"abs({n}_lag1)"), 4) + f" as {n}_growth_qoq" for n in names)


_GROWN = [f"{n}_growth_qoq" for n in rules.GROWN]
add("growth_qoq", f"select cik, period_end, {_growth(rules.GROWN)} from (select *, {_LAGS} from panel_tx) p", 6, _GROWN)
add("pct_change", f"""
select cik, period_end, {bounded(change('r0', 'r1'), '-0.9', '2.0')} as change1,
  {bounded(change('total_revenue', 'raw1'), '-0.9', '2.0')} as change1_no_pad,
  {bounded(change('r0', 'r3') + ' / 3', '-0.9', '2.0')} as change3
from (select *, lag(total_revenue) over ({_SERIES}) as raw1 from padded_tx) p""", 6, ["change1", "change1_no_pad", "change3"])
_DERIVED = ["net_margin", "debt_to_equity", "current_ratio", "revenue_growth", "revenue_growth_3yr", "equity"]
add("derived_fields", f"select cik, period_end, {', '.join(_DERIVED)} from featured_tx", 6, _DERIVED)
add("derived_report", "\nunion all ".join(
    f"select '{n}' as \"column\", avg(case when {n} is not null then 1 else 0 end) * 100 as coverage_pct, "
    f"median({n}) as median, quantile_cont({n}, 0.99) as p99 from featured_tx" for n in _DERIVED),
    6, ["coverage_pct", "median", "p99"])

# --- cleaning --------------------------------------------------------------------------------

_GAP = "abs(total_assets - (total_liabilities + equity))"


def _identity(pct: str, floor: str) -> str:
    return (
        f"{_GAP} as balance_sheet_difference, "
        f"coalesce({_GAP} <= greatest(coalesce(abs(total_assets), 0) * {pct}::double, {floor}), false) as balance_sheet_valid"
    )


add("identity_check_1pct", f"select cik, period_end, {_identity('0.01', '1000000')} from panel_tx", 2, ["balance_sheet_difference"])
add("identity_check_2pct", f"select cik, period_end, {_identity('0.02', '1000')} from panel_tx", 2, ["balance_sheet_difference"])
add("identity_valid_counts", f"""
select cast(count_if(balance_sheet_valid) as bigint) as valid, cast(count_if(not balance_sheet_valid) as bigint) as invalid
from (select {_identity('0.02', '1000')} from panel_tx) t""")
_POSSIBLE = ", ".join(f"case when {n} >= 0 then {n} end as {n}" for n in rules.NOT_NEGATIVE)
add("impossible_values", f"select cik, period_end, {_POSSIBLE} from panel_tx")
add("impossible_value_counts", "\nunion all ".join(
    f"select '{n}' as \"column\", cast(count_if({n} < 0) as bigint) as fixed from panel_tx" for n in rules.NOT_NEGATIVE))
_NARROW = "cik, fiscal_year, fiscal_quarter, period_end, total_assets"
add("dedupe_first", f"""
select {_NARROW} from (select *, row_number() over (partition by cik, fiscal_year order by fiscal_quarter, period_end) as rn
  from panel_tx) t where rn = 1""")
add("dedupe_last", f"""
select {_NARROW} from (select *, row_number() over (partition by cik, fiscal_year order by fiscal_quarter desc, period_end desc) as rn
  from panel_tx) t where rn = 1""")
_ALL_PANEL = ["cik", "period_end", "fiscal_year", "fiscal_quarter", "filing_date", *v.PANEL_FIELDS]
_MISSING = " + ".join(f"(case when {n} is null then 1 else 0 end)" for n in _ALL_PANEL)
add("dedupe_complete", f"""
select {', '.join(_ALL_PANEL)} from (select *, row_number() over (partition by cik, fiscal_year
  order by {_MISSING}, filing_date desc, period_end desc) as rn from panel_tx) t where rn = 1""")
add("distinct_rows", "select distinct cik, tag, unit, form from facts_tx")
_CARRIED = [n for n in rules.CARRY_FORWARD if n in v.PANEL_FIELDS]
add("ffill", f"select cik, period_end, {', '.join(_known(n, 0) + ' as ' + n for n in _CARRIED)} from panel_tx")
add("ffill_from_buckets", f"select cik, period_end, {', '.join(_known(n, 0) + ' as ' + n for n in _CARRIED)} from panel_tx")
_BY_SECTOR = "partition by target_sector order by period_end, cik"
add("ffill_long", f"""
select target_sector, cik, period_end, {', '.join(f'last_value({n} ignore nulls) over ({_BY_SECTOR}) as {n}' for n in v.PANEL_FIELDS)}
from sector_panel_tx""")
add("lag_long", f"""
select target_sector, cik, period_end, revenue, cash, lag(revenue) over ({_BY_SECTOR}) as revenue_1,
  lag(revenue, 3) over ({_BY_SECTOR}) as revenue_3, lag(cash, 2) over ({_BY_SECTOR}) as cash_2 from sector_panel_tx""")
_IMPUTED = [n for n in rules.MEDIAN_FILLED if n in v.PANEL_FIELDS]


def _impute(names: list[str]) -> str:
    return ", ".join(f"coalesce({n}, median({n}) over (partition by fiscal_year)) as {n}" for n in names)


add("median_impute", f"select cik, period_end, {_impute(_IMPUTED)} from panel_tx", 4, _IMPUTED)


def _winsor(names: list[str], source: str) -> str:
    """Clip columns by their own 1st and 99th percentile; under 100 values nothing happens."""
    bounds = ", ".join(
        f"case when count({n}) >= 100 then quantile_cont({n}, 0.01) end as {n}_lo, "
        f"case when count({n}) >= 100 then quantile_cont({n}, 0.99) end as {n}_hi" for n in names
    )
    clipped = ", ".join(
        f"case when {n} is null or {n}_lo is null then {n} else least(greatest({n}, {n}_lo), {n}_hi) end as {n}" for n in names
    )
    drop = ", ".join(f"{n}_lo, {n}_hi" for n in names)
    return f"select * exclude ({drop}) replace ({clipped}) from {source} cross join (select {bounds} from {source}) b"


add("winsorize", f"select cik, period_end, {', '.join(v.PANEL_FIELDS)} from ({_winsor(list(v.PANEL_FIELDS), 'panel_tx')}) w",
    4, list(v.PANEL_FIELDS))
add("winsorize_counts", "\nunion all ".join(
    f"select '{n}' as \"column\", cast(count_if({n} < lo or {n} > hi) as bigint) as clipped from panel_tx cross join "
    f"(select quantile_cont({n}, 0.01) as lo, quantile_cont({n}, 0.99) as hi from panel_tx) b group by lo, hi"
    for n in v.PANEL_FIELDS))

# The full chain: every step in the order of the job.
VIEWS["clean1_tx"] = f"select * replace ({_POSSIBLE}) from panel_tx"
VIEWS["clean2_tx"] = f"select * replace ({', '.join(_known(n, 0) + ' as ' + n for n in _CARRIED)}) from clean1_tx"
VIEWS["clean3_tx"] = f"select * replace ({_impute(_IMPUTED)}) from clean2_tx"
VIEWS["clean4_tx"] = _winsor(list(v.PANEL_FIELDS), "clean3_tx")
VIEWS["clean5_tx"] = f"select *, {_identity('0.02', '1000000')}, {_LAGS} from clean4_tx"
VIEWS["clean6_tx"] = f"select *, {_growth(rules.GROWN)} from clean5_tx"
_LAG_NAMES = [f"{n}_lag1" for n in rules.LAGGED]
VIEWS["clean7_tx"] = _winsor([*_LAG_NAMES, *_GROWN], "clean6_tx")
add("clean_panel_full", f"""
select cik, period_end, {', '.join(v.PANEL_FIELDS)}, balance_sheet_difference, balance_sheet_valid,
  {', '.join(_LAG_NAMES)}, {', '.join(_GROWN)} from clean7_tx""",
    6, [*v.PANEL_FIELDS, "balance_sheet_difference", *_LAG_NAMES, *_GROWN])


def _nulls(names: list[str], source: str) -> str:
    return "(select " + " + ".join(f"count_if({n} is null)" for n in names) + f" from {source})"


def _clips(names: list[str], source: str) -> str:
    parts = " + ".join(
        f"(select coalesce(sum(case when {n} < lo or {n} > hi then 1 else 0 end), 0) from {source} cross join "
        f"(select quantile_cont({n}, 0.01) as lo, quantile_cont({n}, 0.99) as hi, count({n}) as k from {source}) b where k >= 100)"
        for n in names
    )
    return f"({parts})"


_NOT_NEGATIVE = list(rules.NOT_NEGATIVE)
add("clean_panel_counts", f"""
select 'impossible_values_fixed' as step, cast(
  (select {' + '.join(f'coalesce(sum(case when {n} < 0 then c end), 0)' for n in _NOT_NEGATIVE)}
   from (select *, case when cik % 4 = 0 then 2 else 1 end as c from panel_tx) d) as bigint) as affected
union all select 'duplicate_rows_removed', (select count(*) from panel_tx where cik % 4 = 0)
union all select 'values_forward_filled', cast({_nulls(_CARRIED, 'clean1_tx')} - {_nulls(_CARRIED, 'clean2_tx')} as bigint)
union all select 'values_median_filled', cast({_nulls(_IMPUTED, 'clean2_tx')} - {_nulls(_IMPUTED, 'clean3_tx')} as bigint)
union all select 'values_winsorized',
  cast({_clips(list(v.PANEL_FIELDS), 'clean3_tx')} + {_clips([*_LAG_NAMES, *_GROWN], 'clean6_tx')} as bigint)
union all select 'columns_dropped', (select case when count(case when fiscal_year = 1995 then cash end) * 1.0 / count(*) < 0.05
  then 1 else 0 end from panel_tx)""")

# --- quality ---------------------------------------------------------------------------------


def _covered(name: str) -> str:
    return even(f"avg(case when {name} is not null then 1 else 0 end) * 100", 1)


add("coverage", "\nunion all ".join(
    f"select '{n}' as \"column\", {_covered(n)} as coverage_pct from panel_tx" for n in v.PANEL_FIELDS),
    6, ["coverage_pct"])
add("stored_profile", "\nunion all ".join(
    f"select '{n}' as \"column\", count(*) as rows, count({n}) as present, cast(min({n}) as double) as least, cast(max({n}) as double) as greatest "
    f"from panel_tx" for n in ["cik", "fiscal_quarter", *v.PANEL_FIELDS]))
add("missing_counts", "\nunion all ".join(
    f"select '{n}' as \"column\", cast(count_if({n} is null) as bigint) as missing from panel_tx" for n in _ALL_PANEL))
add("distinct_counts", "\nunion all ".join(
    f"select '{n}' as \"column\", count(distinct {n}) as distinct_values from sector_panel_tx"
    for n in ("cik", "target_sector", "fiscal_year")))
add("value_counts", "select fiscal_year, count(*) as rows from panel_tx group by 1")
add("ticker_type_counts", "select ticker_type, count(*) as rows from typed_universe_tx group by 1")


def _schema(source: str, missing: list[str], numbers: list[str]) -> str:
    rows = [f"select 'missing_column' as metric, '{n}' as \"column\", 1.0::double as value" for n in missing]
    rows += [
        f"select 'duplicate_keys' as metric, '' as \"column\", "
        f"cast((select count(*) from {source}) - (select count(*) from (select distinct cik, period_end from {source}) d) as double) as value",
        f"select 'fiscal_year_min', 'fiscal_year', cast(min(fiscal_year) as double) from {source}",
        f"select 'fiscal_year_max', 'fiscal_year', cast(max(fiscal_year) as double) from {source}",
        f"select 'unreasonable_fiscal_years', 'fiscal_year', cast(count_if(fiscal_year < 1990 or fiscal_year > 2030) as double) from {source}",
        f"select 'valid_quarters', 'fiscal_quarter', cast(bool_and(coalesce(fiscal_quarter in (1, 2, 3, 4), false)) as double) from {source}",
    ]
    rows += [f"select 'coverage_pct', '{n}', {_covered(n)} from {source}" for n in numbers]
    return "\nunion all ".join(rows)


_NUMBERS = ["cik", "fiscal_year", "fiscal_quarter", *v.PANEL_FIELDS]
add("schema_report", _schema("panel_tx", ["company"], _NUMBERS), 1, ["value"])
add("describe_numbers", "\nunion all ".join(
    f"select '{n}' as \"column\", count({n}) as count, avg({n}) as mean, stddev_samp({n}) as std, min({n}) as min, "
    f"max({n}) as max, quantile_cont({n}, 0.25) as q25, median({n}) as q50, quantile_cont({n}, 0.75) as q75 from panel_tx"
    for n in v.PANEL_FIELDS), 4, ["mean", "std", "min", "max", "q25", "q50", "q75"])
add("describe_texts", "\nunion all ".join(
    f"select '{n}' as \"column\", cast(sum(c) as bigint) as count, count(*) as \"unique\", "
    f"arg_min(x, (-c, x)) as top, max(c) as freq from (select {n} as x, count(*) as c from facts_tx where {n} is not null group by 1) t_{n}"
    for n in ("tag", "unit", "form", "fp")))
_ENGINEERED = ["balance_sheet_difference", *_LAG_NAMES, *_GROWN]
_REPORTED = len(_ALL_PANEL) + len(_ENGINEERED) + 1
add("cleaning_report", f"""
select 'before' as section, 'rows' as metric, '' as "column", cast(sum(case when cik % 4 = 0 then 2 else 1 end) as double) as value from panel_tx
union all select 'before', 'columns', '', {len(_ALL_PANEL)}.0::double
union all select 'after', 'rows', '', cast(count(*) as double) from clean7_tx
union all select 'after', 'columns', '', {_REPORTED}.0::double
union all select 'removed', 'rows', '', cast((select count(*) from panel_tx where cik % 4 = 0) as double)
union all select 'schema', metric, "column", value from ({_schema('clean7_tx', ['company', 'ticker'], [*_NUMBERS, *_ENGINEERED])}) s""",
    1, ["value"])

# --- snapshot, ranks and scores ---------------------------------------------------------------

_REST = ["fiscal_year", "fiscal_quarter", "filing_date", *v.PANEL_FIELDS]
add("snapshot_latest_row", f"""
select cik, period_end, {', '.join(_REST)} from (
  select *, row_number() over (partition by cik order by period_end desc) as rn from panel_tx) t where rn = 1""")
add("snapshot_last_non_null", f"""
select * from (select cik, max(period_end) as period_end,
  {', '.join(f'arg_max({n}, period_end) filter (where {n} is not null) as {n}' for n in _REST)}
from panel_tx group by cik) t where total_assets is not null or revenue is not null""")


def _rank_within(name: str, group: str, source: str) -> str:
    return f"""
select key, '{name}' as name, (rank() over (partition by {group} order by {name})
  + (count(*) over (partition by {group}, {name}) - 1) / 2.0) / count(*) over (partition by {group}) as r
from {source} where {name} is not null and {group} is not null"""


_RANKED = ["total_assets", "net_margin", "current_ratio"]
add("sector_percent_rank", f"""
select key as ticker, {', '.join(f"max(case when name = '{n}' then r end) as {n}" for n in _RANKED)} from (
  {' union all '.join(_rank_within(n, 'target_sector', '(select *, ticker as key from target_tx) t') for n in _RANKED)}
  union all select ticker, null, null from target_tx) u
group by key""", 6, _RANKED)
_KEYED = "(select *, concat_ws('|', cast(cik as varchar), cast(period_end as varchar)) as key from panel_tx) t"
add("panel_percent_rank", f"""
select key, {', '.join(f"max(case when name = '{n}' then r end) as {n}" for n in ('total_assets', 'revenue'))} from (
  {' union all '.join(_rank_within(n, 'fiscal_year', _KEYED) for n in ('total_assets', 'revenue'))}
  union all select key, null, null from {_KEYED}) u
group by key""", 6, ["total_assets", "revenue"])
add("year_quantiles", "\nunion all ".join(
    f"select fiscal_year, '{n}' as \"column\", count({n}) as n, quantile_cont({n}, 0.01) as p01, median({n}) as p50, "
    f"quantile_cont({n}, 0.99) as p99 from panel_tx group by fiscal_year having count({n}) > 0" for n in v.PANEL_FIELDS),
    4, ["p01", "p50", "p99"])
for _part, _column in scoring.SCORES.items():
    add(f"score_{'float' if _part == 'mv' else _part}", f"select ticker, {_column} from scored_tx", 6, [_column])
for _preset in rules.WEIGHTS:
    add(f"composite_{_preset}", f"select ticker, {_composite(_preset)} as acquirability_score from scored_tx",
        6, ["acquirability_score"])
add("thesis", f"select ticker, {_THESIS} as thesis from scored_tx")
_EXPORT_DOUBLES = [
    "total_revenue", "net_income", *scoring.ALL_SCORES, "revenue_growth", "net_margin",
]
add("ranked_targets", f"""
select cast(row_number() over (order by acquirability_score desc, ticker) as int) as rank, ticker, company, target_sector,
  fiscal_year, total_revenue, net_income, acquirability_score, size_score, profit_score, growth_score, health_score,
  mv_score, revenue_growth, net_margin, {_THESIS} as thesis from composite_tx""", 6, _EXPORT_DOUBLES)
add("top50", """
select ticker, target_sector, acquirability_score from composite_tx
order by acquirability_score desc, ticker limit 50""", 6, ["acquirability_score"])
VIEWS["top3_tx"] = "select * from composite_tx order by acquirability_score desc, ticker limit 3"
add("top3_profile", "\nunion all ".join(
    f"select ticker, '{c}' as dimension, {c} as score from top3_tx" for c in scoring.SCORES.values()), 6, ["score"])
_MEANS = {"avg_score": "acquirability_score", "size": "size_score", "profit": "profit_score", "growth": "growth_score",
          "health": "health_score", "float": "mv_score"}
VIEWS["summary_tx"] = f"""
select target_sector, {', '.join(even(f'avg({c})', 1) + f' as "{n}"' for n, c in _MEANS.items())},
  arg_min(ticker, (-acquirability_score, ticker)) as top_target, count(ticker) as companies
from composite_tx where target_sector is not null group by target_sector"""
add("sector_summary", "select * from summary_tx", 6, ["avg_score", "size", "profit", "growth", "health", '"float"'])
add("sector_matrix", "\nunion all ".join(
    f"select target_sector, '{n}' as dimension, \"{n}\" as score from summary_tx"
    for n in ("size", "profit", "growth", "health", "float")), 6, ["score"])
add("score_stats", "\nunion all ".join(
    f"select '{c}' as \"column\", avg({c}) as mean, stddev_samp({c}) as std, min({c}) as min, max({c}) as max, "
    f"median({c}) as median from composite_tx" for c in scoring.ALL_SCORES), 6, ["mean", "std", "min", "max", "median"])
add("score_histogram", "\nunion all ".join(
    f"""select '{c}' as "column", cast(least(floor(({c} - lo) * 30 / (hi - lo)), 29) as int) as bin, lo, hi, mean, median, count(*) as companies
from composite_tx cross join (select case when min({c}) = max({c}) then min({c}) - 0.5 else min({c}) end as lo,
  case when min({c}) = max({c}) then max({c}) + 0.5 else max({c}) end as hi, avg({c}) as mean, median({c}) as median from composite_tx) b
group by 2, lo, hi, mean, median""" for c in scoring.ALL_SCORES), 6, ["lo", "hi", "mean", "median"])
add("sector_companies", "select target_sector, count(distinct cik) as companies from sector_panel_tx group by 1")

# --- analyses --------------------------------------------------------------------------------

_KNOWN_GROUP = "target_sector is not null and fiscal_year is not null"
add("sector_trend", f"""
select target_sector, fiscal_year, avg(net_margin) as net_margin_mean from ratio_panel_tx
where {_KNOWN_GROUP} group by 1, 2""", 6, ["net_margin_mean"])
add("volatility", f"""
select target_sector, fiscal_year, stddev_samp(net_margin) as net_margin_std from ratio_panel_tx
where {_KNOWN_GROUP} group by 1, 2""", 6, ["net_margin_std"])
add("best_in_sector", f"""
select target_sector, fiscal_year, cik, period_end, roa from (select *, row_number() over
  (partition by target_sector, fiscal_year order by roa desc, cik, period_end) as rn
  from ratio_panel_tx where roa is not null and {_KNOWN_GROUP}) t where rn = 1""", 6, ["roa"])
add("screens", f"""
select cik, period_end, coalesce({div('current_assets', 'current_liabilities')} < 1.0, false) as liquidity_risk,
  coalesce({div('total_liabilities', 'total_assets')} > 0.8, false) as over_leveraged,
  coalesce({change('r0', 'r1')} > 0.2 and net_income > 0, false) as growth
from padded_tx""")
add("profit_stall", """
select cik, min(step) as first, max(step) as last, count(*) as length from (
  select *, step - cast(row_number() over (partition by cik order by step) as int) as run from (
    select *, fiscal_year * 4 + fiscal_quarter as step from panel_tx where net_income < 0) a) b
group by cik, run having count(*) >= 2""")
add("cash_burn", f"""
select cik, cast(count_if(loss and before and capital < last_capital) as bigint) as burning_periods from (
  select *, net_income < 0 as loss, lag(net_income < 0) over ({_SERIES}) as before,
    lag(capital) over ({_SERIES}) as last_capital from (
    select cik, period_end, {_known('net_income', 0)} as net_income,
      {_known('current_assets', 0)} - {_known('current_liabilities', 0)} as capital from panel_tx) a) b
group by cik having count_if(loss and before and capital < last_capital) >= 1""")
add("event_study", """
select *, after - before as change from (
  select target_sector, cast(sum(cast(case when fiscal_year between 1995 and 1997 then revenue end as decimal(38, 4))) as double)
      / count(case when fiscal_year between 1995 and 1997 then revenue end) as before,
    cast(sum(cast(case when fiscal_year between 1999 and 2001 then revenue end as decimal(38, 4))) as double)
      / count(case when fiscal_year between 1999 and 2001 then revenue end) as after
  from ratio_panel_tx where target_sector is not null group by 1) t""", 4, ["before", "after", "change"])
add("quintiles", """
select cik, period_end, cast(ntile(5) over (partition by fiscal_year order by market_value, cik, period_end) as int) as quintile
from panel_tx where market_value is not null""")
_BENCH = ["current_ratio", "debt_to_assets", "net_margin", "roa"]
VIEWS["rated_tx"] = (
    f"select cik, period_end, target_sector, {', '.join(_ratio(n, rules.QUARTERLY_RATIOS) for n in _BENCH)} from sector_panel_tx"
)
add("benchmarks", "\nunion all ".join(
    f"select target_sector, '{n}' as \"column\", avg({n}) as mean, count({n}) as companies, median({n}) as median "
    f"from rated_tx where target_sector is not null group by 1" for n in _BENCH), 6, ["mean", "median"])
add("outliers", "\nunion all ".join(
    f"""select * from (select cik, period_end, target_sector, '{n}' as "column", {n} as value,
  ({n} - avg({n}) over (partition by target_sector)) / nullif(stddev_samp({n}) over (partition by target_sector), 0) as z
from rated_tx where target_sector is not null) o_{n} where abs(z) > 3""" for n in _BENCH), 6, ["value", "z"])
VIEWS["peer_tx"] = """
select ticker, target_sector, total_assets, (m - avg(m) over w) / nullif(stddev_samp(m) over w, 0) as m,
  (d - avg(d) over w) / nullif(stddev_samp(d) over w, 0) as d
from (select ticker, target_sector, total_assets, net_margin as m, debt_to_equity as d
  from target_tx where target_sector is not null) t window w as (partition by target_sector)"""
add("peers", """
select target_sector, picked, peer, distance, cast(place as int) as place from (
  select *, row_number() over (partition by picked order by distance, peer) as place from (
    select p.target_sector, a.ticker as picked, p.ticker as peer,
      sqrt((p.m - a.m) * (p.m - a.m) + (p.d - a.d) * (p.d - a.d)) as distance
    from peer_tx p join (select *, row_number() over (partition by target_sector order by total_assets desc, ticker) as rn
      from peer_tx where total_assets is not null) a
    on a.rn = 1 and p.target_sector = a.target_sector and p.ticker <> a.ticker
    where p.m is not null and p.d is not null and a.m is not null and a.d is not null) x) y where place <= 5""",
    6, ["distance"])
add("healthy_summary", f"""
select target_sector, {even('avg(nm)', 4)} as net_margin, {even('avg(cr)', 4)} as current_ratio,
  {even('avg(de)', 4)} as debt_to_equity,
  {even('avg(case when cr > 1.5 and de < 1.0 and nm > 0.05 then 1.0 else 0.0 end)', 4)} as healthy
from (select target_sector, case when revenue > 0 then net_income / revenue end as nm,
    case when current_liabilities > 0 then current_assets / current_liabilities end as cr,
    case when total_assets - total_liabilities > 0 then total_liabilities / (total_assets - total_liabilities) end as de
  from sector_panel_tx where fiscal_year = 1998 and target_sector is not null) t
group by target_sector""", 6, ["net_margin", "current_ratio", "debt_to_equity", "healthy"])

# Measures below 15 % coverage are dropped; their names are missing from the result.
_SPARSE = {f"q{n}_{name}": f"case when fiscal_quarter = {n} and fiscal_year % 2 = 0 then {name} end"
           for n in (1, 2) for name in ("cash", "revenue", "inventory")}
_SPARSE["always"] = "cik * 1.0"
add("drop_sparse", "\nunion all ".join(
    [f"select '{n}' as \"column\", count({n}) as present from panel_tx" for n in ("cik", "period_end", "fiscal_year", "fiscal_quarter", "filing_date")]
    + [f"select '{n}', count({e}) from panel_tx having count({e}) * 1.0 / count(*) >= 0.15"
       for n, e in [*((f, f) for f in v.PANEL_FIELDS), *_SPARSE.items()]]))
