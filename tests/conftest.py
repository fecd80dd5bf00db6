import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerloom-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ledgerloom-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def record(end, val, form="10-K", filed="2020-02-01", fp="FY"):
    return {"end": end, "val": val, "form": form, "filed": filed, "fp": fp}


def document(cik, name, gaap, dei=None):
    """Facts document; every tag maps to {unit: [records]}."""
    def section(tags):
        return {tag: {"label": tag, "units": units} for tag, units in tags.items()}

    return {"cik": cik, "entityName": name, "facts": {"us-gaap": section(gaap), "dei": section(dei or {})}}


def write_json(folder, name, body):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(body if isinstance(body, str) else json.dumps(body, indent=4))
    return path


def rows(df, *order):
    """Rows as tuples in a fixed order."""
    ordered = df.orderBy(*order) if order else df
    return [tuple(row) for row in ordered.collect()]
