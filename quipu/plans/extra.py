"""Reports the user guide lists by name only; what they compute is defined here."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.functions.text import col
from quipu.operators.ean import ean_pairs, owner
from quipu.operators.joins import COUNTRY, attach, documents, on_keys
from quipu.operators.order import arrange
from quipu.plans.reports import SALES_KEYS, customers, stock_by_lot
from quipu.sources.erp import Erp, in_period

# Fixed value: the document type of a return.
RETURN_TYPE = 4


def _lines(erp: Erp, start: date, end: date) -> DataFrame:
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    return documents(headers, erp["SOP30300"], SALES_KEYS)


def _by_company(df: DataFrame, *columns: str) -> list[str]:
    return [c for c in (COUNTRY, *columns) if c in df.columns]


def sales_per_customer(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Documents and amount per customer, largest amount first.

    The header already holds both, so lines are not read.
    """
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    group = [c for c in (COUNTRY, "CUSTNMBR") if c in headers.columns]
    totals = headers.groupBy(*group).agg(
        F.count(F.lit(1)).alias("Documentos"), F.sum("DOCAMNT").alias("Total")
    )
    named = attach(totals, erp["RM00101"], ["CUSTNMBR"], ["CUSTNAME"])
    columns = [
        *[F.col(c) for c in group],
        F.rtrim("CUSTNAME").alias("Nombre Cliente"),
        F.col("Documentos"),
        F.col("Total"),
    ]
    return arrange(named, [F.desc("Total")], columns, ordered)


def top_products(erp: Erp, start: date, end: date, top: int = 10) -> DataFrame:
    """The products with the highest sales, each company's code by itself; ties go by country and code."""
    lines = _lines(erp, start, end)
    group = _by_company(lines, "ITEMNMBR")
    totals = lines.groupBy(*group).agg(
        F.sum("QUANTITY").alias("Cantidad"), F.sum("XTNDPRCE").alias("Total")
    )
    return totals.orderBy(F.desc("Total"), *group).limit(top)


def inventory(erp: Erp, ordered: bool = True) -> DataFrame:
    """Stock on hand per product, over all warehouses and lots."""
    lots = stock_by_lot(erp, ordered=False)
    group = [c for c in (COUNTRY, "Código Producto", "Descripción") if c in lots.columns]
    totals = lots.groupBy(*group).agg(
        F.sum("Cantidad").alias("Cantidad"), F.count(F.lit(1)).alias("Lotes")
    )
    return arrange(totals, ["Descripción"], [col(c) for c in totals.columns], ordered)


def invoices_per_month(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    month = F.trunc("DOCDATE", "month").alias("Mes")
    country = [COUNTRY] if COUNTRY in headers.columns else []
    totals = headers.groupBy(*country, month).agg(
        F.count(F.lit(1)).alias("Documentos"), F.sum("DOCAMNT").alias("Total")
    )
    return arrange(totals, [*country, "Mes"], [F.col(c) for c in totals.columns], ordered)


def active_customers(erp: Erp, ordered: bool = True) -> DataFrame:
    return customers(erp, ordered).filter(F.col("Inactivo") == "NO")


def customer_master(erp: Erp, ordered: bool = True) -> DataFrame:
    return customers(erp, ordered).drop("Inactivo", "Suspendido")


def sales_by_brand(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Sales per brand; lines are summed per product before the brand is joined."""
    lines = _lines(erp, start, end)
    per_item = lines.groupBy(*_by_company(lines, "ITEMNMBR")).agg(
        F.sum("QUANTITY").alias("q"), F.sum("XTNDPRCE").alias("t")
    )
    branded = attach(per_item, erp["IV00101"], ["ITEMNMBR"], ["ITMCLSCD"])
    country = _by_company(branded)
    totals = branded.groupBy(*country, F.rtrim("ITMCLSCD").alias("Marca")).agg(
        F.sum("q").cast("decimal(29,5)").alias("Cantidad"),
        F.sum("t").cast("decimal(29,5)").alias("Total"),
    )
    return arrange(totals, [*country, "Marca"], [F.col(c) for c in totals.columns], ordered)


def returns(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Returned lines with their document."""
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    rows = documents(headers.filter(F.col("SOPTYPE") == RETURN_TYPE), erp["SOP30300"], SALES_KEYS)
    columns = [
        *[F.col(c) for c in (COUNTRY,) if c in rows.columns],
        *[F.col(c) for c in ("SOPNUMBE", "DOCDATE", "CUSTNMBR", "ITEMNMBR", "QUANTITY", "XTNDPRCE")],
    ]
    return arrange(rows, ["DOCDATE", "SOPNUMBE", "LNITMSEQ"], columns, ordered)


def products_with_ean(erp: Erp, ordered: bool = True) -> DataFrame:
    """Products that have a barcode in their company's table, whatever country it is for."""
    pairs = ean_pairs(erp["maeGC_ProductoEquiv"])
    coded = pairs.select(*owner(pairs), F.col("_product").alias("ITEMNMBR"))
    items = erp["IV00101"]
    items = items.join(coded, on_keys(items, coded, "ITEMNMBR"), "left_semi")
    columns = [
        *[F.col(c) for c in _by_company(items)],
        F.col("ITEMNMBR").alias("Código"),
        F.rtrim("ITEMDESC").alias("Descripción"),
        F.rtrim("ITMCLSCD").alias("Clase"),
    ]
    return arrange(items, ["ITEMDESC"], columns, ordered)
