from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quipu.demo.fixtures import erp
from quipu.demo.queries import AS_OF, END, MOV, SOP, START
from quipu.plans import extra, registry, reports
from quipu.sources.erp import Erp

D = Decimal


def shop(spark, **more):
    """Two countries that use the same document, customer and item codes."""
    header = "PAIS string, SOPNUMBE string, SOPTYPE int, DOCDATE date, CUSTNMBR string, "
    header += "BACHNUMB string, SUBTOTAL decimal(19,5), TAXAMNT decimal(19,5), DOCAMNT decimal(19,5)"
    line = "PAIS string, SOPNUMBE string, SOPTYPE int, LNITMSEQ int, ITEMNMBR string, ITEMDESC string, "
    line += "UOFM string, QUANTITY decimal(19,5), QTYTOINV decimal(19,5), UNITPRCE decimal(19,5), "
    line += "XTNDPRCE decimal(19,5)"
    day = date(2024, 3, 1)
    headers = [
        ("CHILE", "F1 ", 3, day, "C1", "B", D(8), D(2), D(10)),
        ("PERU", "F1", 3, date(2024, 3, 31), "C1  ", "B", D(80), D(20), D(100)),
        ("CHILE", "F2", 3, date(2024, 4, 1), "C2", "B", D(1), D(0), D(1)),
        ("CHILE", "F3", 4, day, "C9", "B", D(1), D(0), D(1)),
    ]
    lines = [
        ("CHILE", "F1", 3, 2, "P1 ", "uno ", "UN", D(4), D(1), D(11), D(44)),
        ("CHILE", "F1", 3, 1, "P1", "uno", "UN", D(6), D(2), D(10), D(60)),
        ("CHILE", "F1", 4, 1, "P1", "uno", "UN", D(99), D(99), D(1), D(1)),
        ("PERU", "F1", 3, 1, "P1", "uno", "UN", D(1), D(1), D("10.005"), D(10)),
        ("CHILE", "F3", 4, 1, "P2", "dos", "UN", D(0), D(0), D(5), D(0)),
    ]
    frames = {
        "SOP30200": spark.createDataFrame(headers, header),
        "SOP30300": spark.createDataFrame(lines, line),
        "RM00101": spark.createDataFrame(
            [("CHILE", "C1 ", "Ana "), ("PERU", "C1", "Beto")],
            "PAIS string, CUSTNMBR string, CUSTNAME string",
        ),
        "IV00101": spark.createDataFrame(
            [("P1", D(10)), ("P2", None)], "ITEMNMBR string, LISTPRCE decimal(19,5)"
        ),
        **more,
    }
    return Erp(frames)


MARCH = (date(2024, 3, 1), date(2024, 3, 31))


def test_countries_do_not_mix(spark):
    rows = reports.sales_detail(shop(spark), *MARCH).collect()
    got = [(r["PAIS"], r["Número Documento"], r["Nombre Cliente"], r["Cantidad"]) for r in rows]
    assert got == [
        ("CHILE", "F1", "Ana", D(6)),
        ("CHILE", "F1", "Ana", D(4)),
        ("CHILE", "F3", None, D(0)),
        ("PERU", "F1", "Beto", D(1)),
    ]


def test_one_country_without_a_country_column(spark):
    tables = {n: df.filter("PAIS = 'CHILE'").drop("PAIS") for n, df in shop(spark).items() if "PAIS" in df.columns}
    rows = reports.sales_detail(Erp(tables), *MARCH).collect()
    assert [r["Número Documento"] for r in rows] == ["F1", "F1", "F3"]
    assert "PAIS" not in rows[0].asDict()


def test_period_holds_both_ends(spark):
    dates = {r["Fecha"] for r in reports.sales_detail(shop(spark), *MARCH).collect()}
    assert dates == {date(2024, 3, 1), date(2024, 3, 31)}


def test_end_of_a_timestamp_period_is_midnight(spark):
    from quipu.sources.erp import in_period

    df = spark.sql("SELECT timestamp_ntz '2024-03-31 00:00:00' t UNION ALL SELECT timestamp_ntz '2024-03-31 08:00:00'")
    assert in_period(df, "t", *MARCH).count() == 1


def test_fill_rate_sums_blank_padded_items_together(spark):
    rows = {(r["PAIS"], r["Código Producto"]): r for r in reports.fill_rate(shop(spark), *MARCH).collect()}
    chile = rows["CHILE", "P1"]
    assert (chile["Cantidad Pedida"], chile["Cantidad Entregada"], chile["Cantidad Pendiente"]) == (D(10), D(3), D(7))
    assert chile["Fill Rate %"] == 30.0 and chile["Nombre Cliente"] == "Ana"
    assert rows["CHILE", "P2"]["Fill Rate %"] == 0.0  # nothing ordered, nothing divided


def test_fill_rate_with_repeated_master_rows_counts_as_the_join_does(spark):
    twice = spark.createDataFrame(
        [("CHILE", "C1", "Ana"), ("CHILE", "C1", "Ana "), ("CHILE", "C1", "Eva")],
        "PAIS string, CUSTNMBR string, CUSTNAME string",
    )
    rows = reports.fill_rate(shop(spark, RM00101=twice), *MARCH).filter("PAIS = 'CHILE'").collect()
    sums = {r["Nombre Cliente"]: r["Cantidad Pedida"] for r in rows if r["Código Producto"] == "P1"}
    assert sums == {"Ana": D(20), "Eva": D(10)}


def test_price_differences(spark):
    rows = reports.price_differences(shop(spark), *MARCH).collect()
    got = [(r["PAIS"], r["Código Producto"], r["Diferencia"], r["% Diferencia"]) for r in rows]
    # within a cent of the list price is no difference; without a list price all of it is
    assert got == [("CHILE", "P1", D(1), 10.0), ("CHILE", "P2", None, 0.0)]


def test_sales_falls_back_country_by_country(spark):
    cab = "PAIS string, cSerie string, nCorrelativo long, fEmision date, cCliente string, dCliente string, "
    cab += "nSubTotal decimal(19,5), nImpuesto decimal(19,5), nTotal decimal(19,5)"
    det = "PAIS string, cSerie string, nCorrelativo long, cProductoVta string, dProductoVta string, "
    det += "nCantidad decimal(19,5), nPrecioOrig decimal(19,5), nTotalOrig decimal(19,5)"
    equiv = "cProducto string, cProductoEquiv string, cEquivalencia string, cPais string"
    local = {
        "movGC_VtDocumentoVtaCab": spark.createDataFrame(
            [("CHILE", "S1 ", 7, date(2024, 3, 5), "C1", "Ana", D(1), D(0), D(1))], cab
        ),
        "movGC_VtDocumentoVtaDet": spark.createDataFrame(
            [("CHILE", "S1", 7, "P1 ", "uno", D(1), D(1), D(1))], det
        ),
        "maeGC_ProductoEquiv": spark.createDataFrame([("P1", "780", "EAN12", "CL")], equiv),
    }
    tables = shop(spark, **local)
    rows = reports.sales_report(tables, *MARCH).collect()
    assert sorted((r.PAIS, r.NumeroDocumento, r.EAN) for r in rows) == [("CHILE", "S1-7", "780"), ("PERU", "F1", "")]
    # nothing local in the period at all
    april = reports.sales_report(tables, date(2024, 4, 1), date(2024, 4, 30)).collect()
    assert april == []
    # no local tables at all
    assert reports.sales_report(shop(spark), *MARCH).count() == 4
    # one country, empty local sales
    single = {n: df.drop("PAIS") for n, df in tables.items()}
    single["MOVGC_VTDOCUMENTOVTACAB"] = single["MOVGC_VTDOCUMENTOVTACAB"].limit(0)
    assert reports.sales_report(Erp(single), *MARCH).filter("EAN <> ''").isEmpty()
    assert reports.sales_report(Erp(single), *MARCH).count() > 0


ORDERS = {
    "sales_posted": (reports.sales_posted, SOP, ["PAIS", "FechaDocumento", "NumeroDocumento"]),
    "sales_detail": (reports.sales_detail, SOP, ["PAIS", "Fecha", "Número Documento"]),
    "price_differences": (
        reports.price_differences,
        ("SOP30200", "SOP30300", "IV00101"),
        ["PAIS", "Fecha", "Código Producto"],
    ),
    "fill_rate": (reports.fill_rate, SOP, ["PAIS", "Código Cliente", "Código Producto"]),
    "receivables": (reports.receivables, ("RM20101", "RM00101", "RM40401"), ["PAIS", "NumeroCliente", "FechaDocumento"]),
    "ledger": (reports.ledger, ("GL20000",), ["PAIS", "Cuenta Contable", "Fecha"]),
    "journal": (reports.journal, ("GL20000",), ["PAIS", "Fecha Transacción"]),
    "control_accounts": (reports.control_accounts, ("GL20000", "GL00100"), ["PAIS", "Cuenta", "Fecha"]),
}


@pytest.mark.parametrize("name", ORDERS)
def test_reports_are_ordered(spark, sf, name):
    build, tables, keys = ORDERS[name]
    rows = build(erp(spark, sf, *tables), START, END).select(*[F.col(f"`{k}`") for k in keys]).collect()
    assert len(rows) > 100
    assert rows == sorted(rows)


def test_master_reports_are_ordered(spark, sf):
    names = [(r.PAIS, r["Razón"]) for r in reports.customers(erp(spark, sf, "RM00101")).collect()]
    assert names == sorted(names)
    items = [(r.PAIS, r["Descripción"]) for r in reports.products(erp(spark, sf, "IV00101")).collect()]
    assert items == sorted(items)
    lots = [(r[0], *tuple(r)[2:5]) for r in reports.stock_by_lot(erp(spark, sf, "IV00102", "IV00101")).collect()]
    assert lots == sorted(lots)
    prices = [(r[0], r[2], r[1]) for r in reports.price_list(erp(spark, sf, "IV00108")).collect()]
    assert prices == sorted(prices)


def test_order_is_repeatable(spark, sf):
    build = lambda: reports.receivables(erp(spark, sf, "RM20101", "RM00101", "RM40401"), START, END, as_of=AS_OF)
    shuffled = erp(spark, sf, "RM20101", "RM00101", "RM40401")
    frames = {n: df.repartition(3) for n, df in shuffled.items()}
    again = reports.receivables(Erp(frames), START, END, as_of=AS_OF)
    assert build().collect() == again.collect()


def test_days_overdue_may_be_negative(spark, sf):
    tables = erp(spark, sf, "RM20101", "RM00101", "RM40401")
    early = reports.receivables(tables, START, END, as_of=date(1998, 1, 15))
    assert early.filter("DiasVencido < 0").count() > 0


def test_customers_without_email_column(spark, sf):
    base = erp(spark, sf, "RM00101")["RM00101"]
    assert {r.Correo for r in reports.customers(Erp({"RM00101": base.drop("INET1")})).collect()} == {""}
    with_country = reports.customers(Erp({"RM00101": base.withColumn("PAIS", F.lit("PERU"))}))
    assert with_country.columns[0] == "PAIS" and "Pais_1" in with_country.columns


def test_products_without_optional_columns(spark, sf):
    base = erp(spark, sf, "IV00101")["IV00101"]
    assert "Precio Lista" not in reports.products(Erp({"IV00101": base.drop("QTYSOLD")})).columns


def test_journal_entries_balance(spark, sf):
    rows = reports.ledger(erp(spark, sf, "GL20000"), START, END, ordered=False)
    saldo = rows.groupBy("PAIS", "Asiento").agg(F.sum("Saldo Movimiento").alias("s"))
    assert saldo.filter("s <> 0").isEmpty()


def test_every_registered_report_runs(spark, sf):
    tables = erp(spark, sf)
    assert len(registry.REPORTS) == 14
    for name in registry.REPORTS:
        assert registry.run(name, tables, START, END).take(1), name


def test_ready_made_rows_win_even_when_empty(spark, sf):
    tables = erp(spark, sf, *SOP)
    name = "Lista Documento Vta Detallada"
    ready = reports.sales_detail(tables, START, END).limit(0)
    assert registry.run(name, tables, START, END, ready={name: ready}).isEmpty()
    assert not registry.run(name, tables, START, END, ready={name: None}).isEmpty()


def test_ready_made_sales_get_their_barcode(spark):
    equiv = spark.createDataFrame(
        [("P1", "780", "EAN12", "CL"), ("P1", "775", "EAN12", "PE")],
        "cProducto string, cProductoEquiv string, cEquivalencia string, cPais string",
    )
    ready = spark.createDataFrame([("PERU", "P1"), ("CHILE", "P1"), ("CHILE", "P2")], "PAIS string, CodigoProducto string")
    name = "Reporte Único de Ventas Sellin"
    rows = registry.run(name, Erp({"maeGC_ProductoEquiv": equiv}), ready={name: ready}).collect()
    assert sorted(tuple(r) for r in rows) == [("CHILE", "P1", "780"), ("CHILE", "P2", ""), ("PERU", "P1", "775")]


def test_reports_are_found_by_plain_name():
    assert registry.find("📊 Reporte Único de Ventas") is registry.REPORTS["Reporte Único de Ventas"]
    assert registry.find("lista stock por almacen y lote").build is reports.stock_by_lot
    with pytest.raises(KeyError):
        registry.find("Otro")


def test_dated_report_needs_dates(spark):
    with pytest.raises(ValueError):
        registry.run("Reporte Libro Mayor", Erp({}))


def test_sum_over_countries_is_the_whole(spark, sf):
    tables = erp(spark, sf, *MOV)
    whole = reports.sales(tables, START, END)
    parts = [
        reports.sales(Erp({n: df.filter(F.col("PAIS") == c) if "PAIS" in df.columns else df for n, df in tables.items()}), START, END).count()
        for c in ("CHILE", "COLOMBIA", "ECUADOR", "PERU")
    ]
    assert sum(parts) == whole.count()


def test_top_products_breaks_ties_by_code(spark):
    rows = extra.top_products(shop(spark), *MARCH, top=2).collect()
    assert rows == sorted(rows, key=lambda r: (-r.Total, r.PAIS, r.ITEMNMBR)) and len(rows) == 2
