"""Reports by name, the period they need, and where their rows come from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from quipu.functions.names import table_name
from quipu.operators.ean import with_ean
from quipu.plans import reports
from quipu.sources.erp import Erp


@dataclass(frozen=True)
class Report:
    name: str
    description: str
    build: Callable[..., DataFrame]
    dated: bool
    #: Whether rows delivered ready-made (see ``run``) still get their barcode here.
    enrich_ean: bool = False


# The names under which users know the reports.
REPORTS: dict[str, Report] = {
    r.name: r
    for r in (
        Report(
            "Reporte Único de Ventas",
            "Líneas de venta con código de barras, por país; donde no hay documentos locales, los contabilizados",
            reports.sales_report,
            True,
            True,
        ),
        Report(
            "Reporte Único de Ventas Sellin",
            "Las mismas líneas, bajo el nombre que usa el equipo de sell-in",
            reports.sales_report,
            True,
            True,
        ),
        Report(
            "Reporte Único de Ventas Mercado",
            "Las mismas líneas, bajo el nombre que usan los mercados",
            reports.sales_report,
            True,
            True,
        ),
        Report("Listar Clientes", "Maestro de clientes con cupo, moneda, estado y correo", reports.customers, False),
        Report(
            "Listar Productos Detallado",
            "Maestro de productos con costos, precio y existencias",
            reports.products,
            False,
        ),
        Report(
            "Lista Stock por Almacén y Lote",
            "Existencias positivas de cada lote y su vencimiento",
            reports.stock_by_lot,
            False,
        ),
        Report(
            "Obtener Precio Lista",
            "Precios por nivel, producto, unidad y moneda",
            reports.price_list,
            False,
        ),
        Report("Reporte Cartera", "Documentos con saldo y sus días de atraso", reports.receivables, True),
        Report(
            "Lista Documento Vta Detallada",
            "Documentos contabilizados con todas sus líneas",
            reports.sales_detail,
            True,
            True,
        ),
        Report(
            "Lista Diferencia Precios",
            "Líneas vendidas a más de un centavo del precio de lista",
            reports.price_differences,
            True,
        ),
        Report(
            "Fill Rate por Cliente Producto",
            "Cantidad pedida, entregada y pendiente, y la parte entregada",
            reports.fill_rate,
            True,
        ),
        Report("Reporte Libro Diario", "Asientos del período en orden de registro", reports.journal, True),
        Report("Reporte Libro Mayor", "Movimientos por cuenta con su saldo", reports.ledger, True),
        Report(
            "Cuenta Contraloría",
            "Movimientos de las cuentas que empiezan con 1, con su descripción",
            reports.control_accounts,
            True,
        ),
    )
}


_BY_PLAIN_NAME = {table_name(name): report for name, report in REPORTS.items()}


def register(report: Report) -> None:
    """Add a report, or give a known name another way to be computed."""
    REPORTS[report.name] = _BY_PLAIN_NAME[table_name(report.name)] = report


def forget(name: str) -> None:
    """Take a report out again."""
    del REPORTS[find(name).name], _BY_PLAIN_NAME[table_name(name)]


def find(name: str) -> Report:
    """A report by its name; case, accents and leading symbols do not matter."""
    return _BY_PLAIN_NAME[table_name(name)]


def run(
    name: str,
    erp: Erp,
    start: date | None = None,
    end: date | None = None,
    ready: Mapping[str, DataFrame | None] | None = None,
    **options,
) -> DataFrame:
    """Run a report for all countries.

    ``ready`` holds rows a source system delivers ready-made, by report name. They win even when
    they are empty; only a missing or ``None`` entry makes the report be computed from the ERP
    tables.
    """
    report = find(name)
    delivered = {find(n).name: df for n, df in (ready or {}).items()}.get(report.name)
    if delivered is not None:
        if report.enrich_ean and "maeGC_ProductoEquiv" in erp:
            return with_ean(delivered, erp["maeGC_ProductoEquiv"])
        return delivered
    if not report.dated:
        return report.build(erp, **options)
    if start is None or end is None:
        raise ValueError(f"{name} needs a start and an end date")
    return report.build(erp, start, end, **options)
