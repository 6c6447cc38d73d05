"""Property sales: CSV to bronze, cleaned silver, gold joined with tax returns by zip code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.cleaning import (
    cast_whole_number,
    keep_positive,
    normalise_names,
    replace_codes,
)
from tierline.operators.joins import inner_join, keep_known_keys
from tierline.sources.catalog import Workspace
from tierline.sources.files import read_csv

# Table names, codes and output columns of the flow.
BRONZE, SILVER, TAX, GOLD = "ny_bronze", "ny_silver", "irs", "ny_gold"
BOROUGHS = {1: "Manhattan", 2: "Bronx", 3: "Brooklyn", 4: "Queens", 5: "Staten Island"}
INCOME_BRACKETS = {
    1: "1 to 25,000",
    2: "25,000 to 50,000",
    3: "50,000 to 75,000",
    4: "75,000 to 100,000",
    5: "100,000 to 200,000",
    6: "200,000+",
}
GOLD_COLUMNS = ["ZIP_CODE", "ADDRESS", "SALE_PRICE", "NUM_RETURNS", "ADJ_GROSS_INCOME"]


def bronze_rows(raw: DataFrame) -> DataFrame:
    """Without the row number, names normalised, price as int (unreadable text gives null)."""
    named = normalise_names(raw.drop("_c0"), {"EASE-MENT": "EASEMENT"})
    return cast_whole_number(named, "SALE_PRICE")


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Without the empty column, borough as name, only sales with a price."""
    return keep_positive(
        replace_codes(bronze.drop("EASEMENT"), "BOROUGH", BOROUGHS), "SALE_PRICE"
    )


def tax_rows(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Tax rows of zip codes with a sale, income bracket as text."""
    real = raw.filter(F.col("zipcode") != 0)
    known = keep_known_keys(real, "zipcode", silver, "ZIP_CODE")
    named = known.withColumnsRenamed({"agi_stub": "ADJ_GROSS_INCOME", "N1": "NUM_RETURNS"})
    return replace_codes(named, "ADJ_GROSS_INCOME", INCOME_BRACKETS)


def gold_rows(silver: DataFrame, tax: DataFrame) -> DataFrame:
    """Each sale with each income bracket of its zip code."""
    return inner_join(silver, tax, "ZIP_CODE", "zipcode").select(*GOLD_COLUMNS)


def bronze(ws: Workspace, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    ws.use()
    return ws.save(BRONZE, bronze_rows(read_csv(ws.spark, path, schema)))


def silver(ws: Workspace) -> DataFrame:
    ws.use()
    return ws.save(SILVER, silver_rows(ws.table(BRONZE).read()))


def gold(ws: Workspace, tax_path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Save the tax rows, delete sales without a real zip code, join and save."""
    ws.use()
    raw = read_csv(ws.spark, tax_path, schema)
    tax = ws.save(TAX, tax_rows(raw, ws.table(SILVER).read()))
    tax.createOrReplaceTempView("irs_data")
    ws.table(SILVER).delete("ZIP_CODE = 0")
    return ws.save(GOLD, gold_rows(ws.register(SILVER), tax))


def cleanup(ws: Workspace) -> None:
    """Drop the four tables with their data."""
    ws.drop([BRONZE, SILVER, GOLD, TAX])
