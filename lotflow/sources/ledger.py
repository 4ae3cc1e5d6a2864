"""The ledger of paid stays as JSON objects {"PLATE_SLOT": {...}}, any number of entries each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.schemas import LEDGER_ENTRY, LEDGER_JSON


def ledger_rows(documents: DataFrame) -> DataFrame:
    """One row per entry; a document that does not parse holds none."""
    entries = documents.select(F.explode(F.from_json("value", LEDGER_JSON)).alias("ledger_key", "entry"))
    return entries.select("ledger_key", "entry.*")


def ledger_documents(ledger: DataFrame) -> DataFrame:
    """Ledger rows as JSON text, one object per row, so that no document grows with the table."""
    key = F.concat_ws("_", "license_plate", "location")
    return ledger.select(F.to_json(F.create_map(key, F.struct(*LEDGER_ENTRY.fieldNames()))).alias("value"))
