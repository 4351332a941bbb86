"""The commercial reports, each one plan over all countries at once.

A report takes the ERP tables, the period where it has one, and ``ordered``. Its columns carry the
names a report reader knows; ``PAIS`` comes first when the tables hold several countries, and rows
are then ordered country by country.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.text import yes_no
from quipu.operators.ean import with_ean
from quipu.operators.joins import COUNTRY, attach, documents
from quipu.operators.order import arrange
from quipu.sources.erp import Erp, in_period

SALES_KEYS = ["SOPNUMBE", "SOPTYPE"]
MOV_KEYS = ["cSerie", "nCorrelativo"]


def _as(column: str, name: str) -> Column:
    return F.col(column).alias(name)


def _trim(column: str, name: str) -> Column:
    return F.rtrim(F.col(column)).alias(name)


def _by_country(df: DataFrame, items: list) -> list:
    """``items`` led by the country, where there is one."""
    return [COUNTRY, *items] if COUNTRY in df.columns else items


def _finish(df: DataFrame, keys: list, columns: list, ordered: bool) -> DataFrame:
    shown = [F.col(c) if isinstance(c, str) else c for c in _by_country(df, columns)]
    return arrange(df, _by_country(df, keys), shown, ordered)


def _percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` for a positive ``whole``, else 0."""
    ratio = part.cast("double") / whole.cast("double") * F.lit(100.0)
    return F.when(whole > 0, F.round(ratio, 6)).otherwise(F.lit(0.0))


def _with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Make sure optional columns exist, as nulls."""
    absent = [n for n in names if n not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(n) for n in absent])


# --- sales ---------------------------------------------------------------------------------------


#: Columns of the local sales documents and their lines that the sales report shows.
_SALES = {
    "fEmision": "FechaDocumento",
    "cCliente": "CodigoCliente",
    "dCliente": "NombreCliente",
    "cProductoVta": "CodigoProducto",
    "dProductoVta": "DescripcionProducto",
    "EAN": "EAN",
    "nCantidad": "Cantidad",
    "nPrecioOrig": "PrecioUnitario",
    "nTotalOrig": "PrecioExtendido",
    "nSubTotal": "Subtotal",
    "nImpuesto": "Impuesto",
    "nTotal": "TotalDocumento",
}


def _local_lines(erp: Erp, start: date, end: date) -> DataFrame:
    """The local sales documents of a period with their lines."""
    headers = in_period(erp["movGC_VtDocumentoVtaCab"], "fEmision", start, end)
    rows = documents(headers, erp["movGC_VtDocumentoVtaDet"], MOV_KEYS)
    return rows.select(*_by_country(rows, [*MOV_KEYS, *[c for c in _SALES if c != "EAN"]]))


def _sales_of(lines: DataFrame, erp: Erp, fanout: bool) -> DataFrame:
    rows = with_ean(
        lines,
        erp["maeGC_ProductoEquiv"],
        "cProductoVta",
        fanout=fanout,
        distinct=False,
        strip=F.rtrim,
    )
    number = F.concat("cSerie", F.lit("-"), F.col("nCorrelativo").cast("string"))
    columns = [number.alias("NumeroDocumento"), *[_as(c, name) for c, name in _SALES.items()]]
    return rows.select(*_by_country(rows, columns))


def sales(
    erp: Erp, start: date, end: date, ordered: bool = True, fanout: bool = False
) -> DataFrame:
    """Sales lines with barcode, from the local sales documents.

    No order is promised, so ``ordered`` is accepted and ignored.
    """
    return _sales_of(_local_lines(erp, start, end), erp, fanout)


def sales_posted(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Sales lines from the posted sales documents, without barcode."""
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    rows = documents(headers, erp["SOP30300"], SALES_KEYS)
    rows = attach(rows, erp["RM00101"], ["CUSTNMBR"], ["CUSTNAME"])
    columns = [
        _as("SOPNUMBE", "NumeroDocumento"),
        _as("DOCDATE", "FechaDocumento"),
        _as("CUSTNMBR", "CodigoCliente"),
        _as("CUSTNAME", "NombreCliente"),
        _as("ITEMNMBR", "CodigoProducto"),
        _as("ITEMDESC", "DescripcionProducto"),
        F.lit("").alias("EAN"),
        _as("QUANTITY", "Cantidad"),
        _as("UNITPRCE", "PrecioUnitario"),
        _as("XTNDPRCE", "PrecioExtendido"),
        _as("SUBTOTAL", "Subtotal"),
        _as("TAXAMNT", "Impuesto"),
        _as("DOCAMNT", "TotalDocumento"),
    ]
    return _finish(rows, ["DOCDATE", "SOPNUMBE"], columns, ordered)


def sales_report(
    erp: Erp, start: date, end: date, ordered: bool = True, fanout: bool = False
) -> DataFrame:
    """Sales from the local documents, or from the posted ones where those are absent or empty.

    With several countries the choice falls country by country. One plan holds both: which countries have local
    sales is a scalar subquery of it, and a filter on the posted tables that prunes their folders when the plan
    runs. The subquery asks for the same columns as the report, so both read one shuffle of headers and lines.
    """
    if "movGC_VtDocumentoVtaCab" not in erp or "movGC_VtDocumentoVtaDet" not in erp:
        return sales_posted(erp, start, end, ordered)
    lines = _local_lines(erp, start, end)
    local = _sales_of(lines, erp, fanout)
    if "SOP30200" not in erp or "SOP30300" not in erp:
        return local
    by_country = COUNTRY in local.columns and COUNTRY in erp["SOP30200"].columns
    held = F.col(COUNTRY) if by_country else F.lit("")
    whole = F.xxhash64(*lines.columns) != F.lit(0)  # of no use but that all columns are asked for
    covered = lines.agg(F.collect_set(F.when(whole, held)).alias("covered")).scalar()
    others = Erp({n: _without(df, covered, by_country) for n, df in erp.items()})
    return local.unionByName(sales_posted(others, start, end, ordered))


def _without(df: DataFrame, covered: Column, by_country: bool) -> DataFrame:
    """The rows of countries that are not covered; of a single company all or none."""
    if by_country and COUNTRY not in df.columns:
        return df
    return df.filter(~F.array_contains(covered, F.col(COUNTRY) if by_country else F.lit("")))


def sales_detail(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Sales documents with all their lines."""
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    rows = documents(headers, erp["SOP30300"], SALES_KEYS)
    rows = attach(rows, erp["RM00101"], ["CUSTNMBR"], ["CUSTNAME"])
    columns = [
        _trim("SOPNUMBE", "Número Documento"),
        _as("SOPTYPE", "Tipo"),
        _as("DOCDATE", "Fecha"),
        _trim("CUSTNMBR", "Código Cliente"),
        _trim("CUSTNAME", "Nombre Cliente"),
        _trim("ITEMNMBR", "Código Producto"),
        _trim("ITEMDESC", "Descripción Producto"),
        _as("QUANTITY", "Cantidad"),
        _as("UNITPRCE", "Precio Unitario"),
        _as("XTNDPRCE", "Precio Extendido"),
        _trim("UOFM", "Unidad Medida"),
        _trim("BACHNUMB", "Número Lote"),
        _as("SUBTOTAL", "Subtotal"),
        _as("TAXAMNT", "Impuesto"),
        _as("DOCAMNT", "Total"),
    ]
    return _finish(rows, ["DOCDATE", "SOPNUMBE", "LNITMSEQ"], columns, ordered)


def price_differences(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Lines sold more than a cent off the list price; a missing list price counts as 0."""
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    rows = documents(headers, erp["SOP30300"], SALES_KEYS)
    rows = attach(rows, erp["IV00101"], ["ITEMNMBR"], ["LISTPRCE"])
    sold, listed = F.col("UNITPRCE"), F.col("LISTPRCE")
    rows = rows.filter(F.abs(sold - F.coalesce(listed, F.lit(0))) > F.lit("0.01").cast("decimal(3,2)"))
    columns = [
        _trim("ITEMNMBR", "Código Producto"),
        _trim("ITEMDESC", "Descripción"),
        _trim("SOPNUMBE", "Número Documento"),
        _as("DOCDATE", "Fecha"),
        _trim("CUSTNMBR", "Código Cliente"),
        _as("UNITPRCE", "Precio Venta"),
        _as("LISTPRCE", "Precio Lista"),
        (sold - listed).alias("Diferencia"),
        _percent(sold - listed, listed).alias("% Diferencia"),
    ]
    return _finish(rows, ["DOCDATE", "ITEMNMBR"], columns, ordered)


def fill_rate(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Ordered, invoiced and pending quantity per customer and product, and the share invoiced.

    Quantities are summed per customer number and product before the customer name is joined, so
    that join moves totals and not lines. Names are grouped first, with the number of master rows
    that bear them: each row counts once, as if the lines had been joined, and the join is not
    followed by a second grouping that would keep AQE from dividing a large customer.
    """
    headers = in_period(erp["SOP30200"], "DOCDATE", start, end)
    rows = documents(headers, erp["SOP30300"], SALES_KEYS)
    group = _by_country(rows, ["CUSTNMBR", "ITEMNMBR", "ITEMDESC"])
    totals = (
        rows.withColumn("ITEMDESC", F.rtrim("ITEMDESC"))
        .groupBy(*group)
        .agg(
            F.sum("QUANTITY").alias("ordered"),
            F.sum("QTYTOINV").alias("invoiced"),
            F.sum(F.col("QUANTITY") - F.col("QTYTOINV")).alias("pending"),
        )
    )
    master = erp["RM00101"]
    names = master.groupBy(
        *_by_country(master, ["CUSTNMBR"]), F.rtrim("CUSTNAME").alias("CUSTNAME")
    ).agg(F.count(F.lit(1)).alias("times"))
    named = attach(totals, names, ["CUSTNMBR"], ["CUSTNAME", "times"])
    times = F.coalesce("times", F.lit(1))
    sums = named.withColumns(
        {c: (F.col(c) * times).cast("decimal(29,5)") for c in ("ordered", "invoiced", "pending")}
    )
    columns = [
        _as("CUSTNMBR", "Código Cliente"),
        _as("CUSTNAME", "Nombre Cliente"),
        _as("ITEMNMBR", "Código Producto"),
        _as("ITEMDESC", "Descripción Producto"),
        _as("ordered", "Cantidad Pedida"),
        _as("invoiced", "Cantidad Entregada"),
        _as("pending", "Cantidad Pendiente"),
        _percent(F.col("invoiced"), F.col("ordered")).alias("Fill Rate %"),
    ]
    return _finish(sums, ["CUSTNMBR", "ITEMNMBR"], columns, ordered)


# --- master data ---------------------------------------------------------------------------------


def customers(erp: Erp, ordered: bool = True) -> DataFrame:
    """The customer list; e-mail is null where a customer has none, '' where no column holds it.

    Next to the company's ``PAIS``, the country of the address is called ``Pais_1``: Spark does not
    tell the two names apart by case.
    """
    rows = erp["RM00101"]
    address_country = "Pais_1" if COUNTRY in rows.columns else "Pais"
    email = F.rtrim("INET1") if "INET1" in rows.columns else F.lit("")
    columns = [
        _trim("CUSTNMBR", "Cod. Cliente"),
        _trim("CUSTNAME", "Razón"),
        _trim("ADDRESS1", "Dirección"),
        _trim("COUNTRY", address_country),
        _trim("CITY", "Ciudad"),
        _trim("STATE", "Estado"),
        _trim("CUSTCLAS", "Crédito"),
        _trim("CURNCYID", "Moneda"),
        _as("CRLMTAMT", "Cupo"),
        yes_no(F.col("INACTIVE")).alias("Inactivo"),
        yes_no(F.col("HOLD")).alias("Suspendido"),
        _as("CREATDDT", "Fec. Creación"),
        email.alias("Correo"),
    ]
    return _finish(rows, ["CUSTNAME"], columns, ordered)


def products(erp: Erp, ordered: bool = True) -> DataFrame:
    """The product list, with list price and quantities where the country records them."""
    rows = erp["IV00101"]
    columns = [
        _trim("ITEMNMBR", "Código"),
        _trim("ITEMDESC", "Descripción"),
        _trim("ITMSHNAM", "Desc. Corta"),
        _trim("ITMCLSCD", "Clase"),
        _trim("ITEMTYPE", "Tipo"),
        _as("CURRCOST", "Costo Actual"),
        _as("STNDCOST", "Costo Estándar"),
        yes_no(F.col("INACTIVE")).alias("Inactivo"),
    ]
    extra = {
        "LISTPRCE": "Precio Lista",
        "QTYONHND": "Cant. Disponible",
        "QTYSOLD": "Cant. Vendida",
        "QTYONORD": "Cant. Ordenada",
    }
    if all(c in rows.columns for c in extra):
        columns += [_as(c, name) for c, name in extra.items()]
    return _finish(rows, ["ITEMDESC"], columns, ordered)


def price_list(erp: Erp, ordered: bool = True) -> DataFrame:
    columns = [
        _trim("PRCLEVEL", "Nivel Precio"),
        _trim("ITEMNMBR", "Código Producto"),
        _trim("UOFM", "Unidad Medida"),
        _as("CURNCYID", "Moneda"),
        _as("LISTPRCE", "Precio Lista"),
        _as("STNDCOST", "Costo Estándar"),
    ]
    return _finish(erp["IV00108"], ["ITEMNMBR", "PRCLEVEL"], columns, ordered)


def stock_by_lot(erp: Erp, ordered: bool = True) -> DataFrame:
    """Stock on hand per product, warehouse and lot; lots without stock are left out."""
    rows = erp["IV00102"].filter(F.col("QTYONHND") > 0)
    rows = attach(rows, erp["IV00101"], ["ITEMNMBR"], ["ITEMDESC"], "inner")
    columns = [
        _trim("ITEMNMBR", "Código Producto"),
        _trim("ITEMDESC", "Descripción"),
        _trim("LOCNCODE", "Almacén"),
        _trim("LOTNUMBR", "Lote"),
        _as("QTYONHND", "Cantidad"),
        _as("DATERECD", "Fecha Recepción"),
        _as("EXPNDATE", "Fecha Vencimiento"),
    ]
    return _finish(rows, ["ITEMDESC", "LOCNCODE", "LOTNUMBR"], columns, ordered)


# --- receivables and ledger ----------------------------------------------------------------------


def receivables(
    erp: Erp, start: date, end: date, ordered: bool = True, as_of: date | None = None
) -> DataFrame:
    """Open receivables with the days since they fell due at ``as_of`` (today by default)."""
    today = F.lit(str(as_of)).cast("date") if as_of else F.current_date()
    rows = in_period(erp["RM20101"], "DOCDATE", start, end).filter(F.col("CURTRXAM") > 0)
    rows = attach(rows, erp["RM00101"], ["CUSTNMBR"], ["CUSTNAME"], "inner")
    rows = attach(rows, erp["RM40401"], ["RMDTYPAL"], ["DOCDESCR"])
    columns = [
        _trim("CUSTNMBR", "NumeroCliente"),
        _trim("CUSTNAME", "NombreCliente"),
        _trim("DOCNUMBR", "NumeroDocumento"),
        _trim("DOCDESCR", "TipoDocumento"),
        _as("DOCDATE", "FechaDocumento"),
        _as("DUEDATE", "FechaVencimiento"),
        _trim("CURNCYID", "Moneda"),
        _as("ORTRXAMT", "MontoOriginal"),
        _as("CURTRXAM", "MontoActual"),
        (F.col("ORTRXAMT") - F.col("CURTRXAM")).alias("MontoPagado"),
        F.datediff(today, F.col("DUEDATE")).alias("DiasVencido"),
    ]
    return _finish(rows, ["CUSTNMBR", "DOCDATE"], columns, ordered)


def journal(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Journal lines by date, entry and sequence."""
    rows = in_period(erp["GL20000"], "TRXDATE", start, end)
    rows = _with_columns(rows, ["ORGNTSRC", "ORMSTRID", "ORMSTRNM"])
    columns = [
        F.col("JRNENTRY").cast("string").alias("Número Asiento"),
        _as("TRXDATE", "Fecha Transacción"),
        _trim("REFRENCE", "Referencia"),
        _trim("ACTNUMST", "Cuenta Contable"),
        _trim("DSCRIPTN", "Descripción"),
        _as("DEBITAMT", "Débito"),
        _as("CRDTAMNT", "Crédito"),
        _trim("ORGNTSRC", "Origen"),
        _trim("ORMSTRID", "ID Maestro"),
        _trim("ORMSTRNM", "Nombre Maestro"),
    ]
    return _finish(rows, ["TRXDATE", "JRNENTRY", "SEQNUMBR"], columns, ordered)


def ledger(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Ledger movements by account; the balance is the movement's own, not a running one."""
    rows = _with_columns(in_period(erp["GL20000"], "TRXDATE", start, end), ["ACTDESCR"])
    columns = [
        _trim("ACTNUMST", "Cuenta Contable"),
        _trim("ACTDESCR", "Descripción Cuenta"),
        _as("TRXDATE", "Fecha"),
        F.col("JRNENTRY").cast("string").alias("Asiento"),
        _trim("REFRENCE", "Referencia"),
        _as("DEBITAMT", "Débito"),
        _as("CRDTAMNT", "Crédito"),
        (F.col("DEBITAMT") - F.col("CRDTAMNT")).alias("Saldo Movimiento"),
    ]
    return _finish(rows, ["ACTNUMST", "TRXDATE", "JRNENTRY"], columns, ordered)


def control_accounts(erp: Erp, start: date, end: date, ordered: bool = True) -> DataFrame:
    """Movements of the asset accounts (those starting with 1) with the account's description."""
    rows = in_period(erp["GL20000"], "TRXDATE", start, end)
    rows = rows.filter(F.col("ACTNUMST").startswith("1"))
    rows = _with_columns(rows, ["ORGNTSRC", "ORMSTRID"]).drop("ACTDESCR")
    rows = attach(rows, erp["GL00100"], ["ACTINDX"], ["ACTDESCR"])
    columns = [
        _trim("ACTNUMST", "Cuenta"),
        _trim("ACTDESCR", "Descripción"),
        _as("TRXDATE", "Fecha"),
        _trim("REFRENCE", "Referencia"),
        _as("DEBITAMT", "Débito"),
        _as("CRDTAMNT", "Crédito"),
        _trim("ORGNTSRC", "Origen"),
        _trim("ORMSTRID", "Documento Origen"),
    ]
    return _finish(rows, ["ACTNUMST", "TRXDATE"], columns, ordered)
