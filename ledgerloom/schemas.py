"""Schemas of everything read from files."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerloom import rules

_TEXT, _DOUBLE, _INT, _DATE = T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_RECORD = _struct(end=_TEXT, val=_DOUBLE, fp=_TEXT, form=_TEXT, filed=_TEXT)
_TAG = _struct(units=T.MapType(_TEXT, T.ArrayType(_RECORD)))

FACTS_DOCUMENT = _struct(
    entityName=_TEXT,
    cik=_TEXT,
    facts=T.MapType(_TEXT, T.MapType(_TEXT, _TAG)),
)

SUBMISSION_DOCUMENT = _struct(
    name=_TEXT,
    sic=_TEXT,
    sicDescription=_TEXT,
    tickers=T.ArrayType(_TEXT),
    exchanges=T.ArrayType(_TEXT),
    entityType=_TEXT,
    stateOfIncorporation=_TEXT,
    fiscalYearEnd=_TEXT,
    addresses=_struct(business=_struct(stateOrCountryDescription=_TEXT)),
    filings=_struct(recent=_struct(form=T.ArrayType(_TEXT))),
)

TICKER_INDEX = T.MapType(_TEXT, _struct(cik_str=T.LongType(), ticker=_TEXT, title=_TEXT))

UNIVERSE = _struct(
    ticker=_TEXT, cik=_TEXT, company=_TEXT, sic_code=_TEXT, sic_description=_TEXT, target_sector=_TEXT
)


def _panel(fields: tuple[str, ...], extra: dict[str, T.DataType]) -> T.StructType:
    kinds: dict[str, T.DataType] = {name: _TEXT for name in rules.METADATA}
    kinds |= {"filing_date": _DATE, "period_end": _DATE, "fiscal_year": _INT, "fiscal_quarter": _INT}
    kinds |= {name: _DOUBLE for name in fields}
    return _struct(**kinds, **extra)


_IDENTITY = {"balance_sheet_difference": _DOUBLE, "balance_sheet_valid": T.BooleanType()}

QUARTERLY_PANEL = _panel(rules.QUARTERLY_FIELDS, _IDENTITY)
QUARTERLY_PANEL_WITH_RATIOS = _panel(
    rules.QUARTERLY_FIELDS, {**_IDENTITY, **{name: _DOUBLE for name in rules.QUARTERLY_RATIOS}}
)
ANNUAL_PANEL = _panel(rules.ANNUAL_FIELDS, {})
