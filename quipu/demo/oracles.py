"""DuckDB SQL over the same test tables, one text per checked query."""

from __future__ import annotations

from quipu.demo.fixtures import ctes
from quipu.functions.country import COUNTRY_CODES
from quipu.functions.text import CONTROL_CHARS

PERIOD = "BETWEEN DATE '1995-02-01' AND DATE '2001-06-30'"
AS_OF = "DATE '2001-08-01'"

CODE = (
    "CASE PAIS WHEN 'CHILE' THEN 'CL' WHEN 'COLOMBIA' THEN 'CO' WHEN 'ECUADOR' THEN 'EC' "
    "WHEN 'PERU' THEN 'PE' ELSE 'CL' END"
)

# One barcode per product, and all of them.
LOOKUP = (
    ", lookup AS (SELECT PAIS AS owner, rtrim(cPais) AS code, rtrim(cProducto) AS prod, "
    "min(rtrim(cProductoEquiv)) AS EAN FROM maeGC_ProductoEquiv "
    "WHERE rtrim(cEquivalencia) = 'EAN12' GROUP BY 1, 2, 3)"
)
FAN_LOOKUP = (
    ", lookup AS (SELECT PAIS AS owner, rtrim(cPais) AS code, rtrim(cProducto) AS prod, "
    "rtrim(cProductoEquiv) AS EAN FROM maeGC_ProductoEquiv WHERE rtrim(cEquivalencia) = 'EAN12')"
)

MOV = ("movGC_VtDocumentoVtaCab", "movGC_VtDocumentoVtaDet", "maeGC_ProductoEquiv")
SOP = ("SOP30200", "SOP30300", "RM00101")

SALES_SELECT = f"""
SELECT cab.PAIS AS PAIS, cab.cSerie || '-' || cast(cab.nCorrelativo AS varchar) AS NUMERODOCUMENTO,
  cab.fEmision AS FECHADOCUMENTO, rtrim(cab.cCliente) AS CODIGOCLIENTE,
  cab.dCliente AS NOMBRECLIENTE, rtrim(det.cProductoVta) AS CODIGOPRODUCTO,
  det.dProductoVta AS DESCRIPCIONPRODUCTO, coalesce(lookup.EAN, '') AS EAN,
  det.nCantidad AS CANTIDAD, det.nPrecioOrig AS PRECIOUNITARIO,
  det.nTotalOrig AS PRECIOEXTENDIDO, cab.nSubTotal AS SUBTOTAL, cab.nImpuesto AS IMPUESTO,
  cab.nTotal AS TOTALDOCUMENTO
FROM movGC_VtDocumentoVtaCab cab
JOIN movGC_VtDocumentoVtaDet det
  ON cab.PAIS = det.PAIS AND cab.cSerie = det.cSerie AND cab.nCorrelativo = det.nCorrelativo
LEFT JOIN lookup
  ON lookup.owner = det.PAIS AND lookup.prod = rtrim(det.cProductoVta) AND lookup.code = {CODE.replace("PAIS", "cab.PAIS")}
WHERE cab.fEmision {PERIOD}"""

POSTED_SELECT = f"""
SELECT h.PAIS AS PAIS, h.SOPNUMBE AS NUMERODOCUMENTO, h.DOCDATE AS FECHADOCUMENTO,
  rtrim(h.CUSTNMBR) AS CODIGOCLIENTE, c.CUSTNAME AS NOMBRECLIENTE,
  rtrim(d.ITEMNMBR) AS CODIGOPRODUCTO, d.ITEMDESC AS DESCRIPCIONPRODUCTO, '' AS EAN,
  d.QUANTITY AS CANTIDAD, d.UNITPRCE AS PRECIOUNITARIO, d.XTNDPRCE AS PRECIOEXTENDIDO,
  h.SUBTOTAL AS SUBTOTAL, h.TAXAMNT AS IMPUESTO, h.DOCAMNT AS TOTALDOCUMENTO
FROM SOP30200 h
JOIN SOP30300 d ON h.PAIS = d.PAIS AND h.SOPNUMBE = d.SOPNUMBE AND h.SOPTYPE = d.SOPTYPE
LEFT JOIN RM00101 c ON h.PAIS = c.PAIS AND rtrim(h.CUSTNMBR) = rtrim(c.CUSTNMBR)
WHERE h.DOCDATE {PERIOD}"""

LINES = """FROM SOP30200 h
JOIN SOP30300 d ON h.PAIS = d.PAIS AND h.SOPNUMBE = d.SOPNUMBE AND h.SOPTYPE = d.SOPTYPE"""

CUSTOMER_COLUMNS = {
    "COD_CLIENTE": "rtrim(CUSTNMBR)",
    "RAZON": "rtrim(CUSTNAME)",
    "DIRECCION": "rtrim(ADDRESS1)",
    "PAIS": "PAIS",
    "PAIS_1": "rtrim(COUNTRY)",
    "CIUDAD": "rtrim(CITY)",
    "ESTADO": "rtrim(STATE)",
    "CREDITO": "rtrim(CUSTCLAS)",
    "MONEDA": "rtrim(CURNCYID)",
    "CUPO": "CRLMTAMT",
    "INACTIVO": "CASE WHEN INACTIVE = 1 THEN 'SI' ELSE 'NO' END",
    "SUSPENDIDO": "CASE WHEN HOLD = 1 THEN 'SI' ELSE 'NO' END",
    "FEC_CREACION": "CREATDDT",
    "CORREO": "rtrim(INET1)",
}


def _select(columns: dict[str, str], *without: str) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items() if n not in without)


COUNTRY_HEADERS = """, frames AS (
  SELECT PAIS, SOPNUMBE, SOPTYPE, DOCDATE, rtrim(CUSTNMBR) AS CUSTNMBR,
    CASE WHEN PAIS = 'COLOMBIA' THEN NULL ELSE BACHNUMB END AS BACHNUMB, SUBTOTAL,
    CASE WHEN PAIS = 'ECUADOR' THEN NULL ELSE TAXAMNT END AS TAXAMNT, DOCAMNT,
    CASE WHEN PAIS = 'PERU' THEN rtrim(CUSTNMBR) END AS RUC
  FROM SOP30200)"""

DIFFERENCES = """, differences AS (
  SELECT 'COLOMBIA' AS pais, 'BACHNUMB' AS columna, 'COLUMN_MISSING' AS kind, 7 AS columnas
  UNION ALL SELECT 'ECUADOR', 'TAXAMNT', 'COLUMN_MISSING', 7
  UNION ALL SELECT 'PERU', 'RUC', 'COLUMN_EXTRA', 9),
sizes AS (SELECT PAIS AS pais, count(*) AS registros FROM SOP30200 GROUP BY 1)"""

HEADERS = """WITH headers AS (
  SELECT p_partkey, CASE p_size WHEN 1 THEN 'Razon' WHEN 2 THEN 'TC' WHEN 3 THEN ' TC '
    WHEN 4 THEN 'TOTAL'
    ELSE '  Cód. ' || p_type || '-' || p_name || ' % ' || cast(p_partkey AS varchar) END AS original
  FROM part),
plain AS (
  SELECT p_partkey, original, CASE original WHEN 'Razon' THEN 'RAZON_SOCIAL'
    WHEN 'TC' THEN 'TIPO_CAMBIO' ELSE trim(BOTH '_' FROM regexp_replace(
      upper(translate(strip_accents(trim(original)), ' .-', '___')), '_{2,}', '_', 'g'))
    END AS normalizado FROM headers)"""

STAMP = (
    "replace(cast(DOCDATE AS varchar), '-', '') || '_' || substr(SOPNUMBE, length(SOPNUMBE) - 5, 6)"
)
FILES = (
    ctes("SOP30200")
    + f""", files AS (
  SELECT PAIS, '📊_Único de_' || rtrim(CUSTNMBR) || '_' || PAIS || '_' || {STAMP}
    || '_normalizado.csv' AS archivo,
    '📊_Único de_' || rtrim(CUSTNMBR) || '_' || PAIS || '_normalizado.csv' AS nombre,
    'UNICO_DE_' || rtrim(CUSTNMBR) || '_' || PAIS AS tabla,
    {STAMP} AS sello FROM SOP30200)"""
)

SYMBOLS = "' -./\\:*?\"<>|()[]{},;=+&%$#@!'"


def _ascii(text: str) -> str:
    plain = f"translate(translate({text}, 'áéíóúÁÉÍÓÚñÑüÜçÇ', 'aeiouAEIOUnNuUcC'), {SYMBOLS}, repeat('_', 28))"
    plain = f"regexp_replace({plain}, '[^a-zA-Z0-9_]', '', 'g')"
    plain = f"upper(trim(BOTH '_' FROM regexp_replace({plain}, '_+', '_', 'g')))"
    return f"rtrim(substr({plain}, 1, 128), '_')"


RECORDS = """WITH records AS (
  SELECT 'f' || cast(o_orderkey AS varchar) || '.csv' AS archivo, o_orderpriority AS pais,
    CASE o_orderstatus WHEN 'F' THEN o_custkey ELSE 0 END AS filas_cargadas,
    o_orderstatus = 'F' AS exito,
    CASE o_orderstatus WHEN 'P' THEN 'sin columnas' END AS error FROM orders)"""

HISTORY = """WITH history AS (
  SELECT substr(o_orderpriority, 3) AS pais, 'T' || cast(o_custkey AS varchar) AS tabla,
    cast(substr(o_orderpriority, 1, 1) AS int) AS version,
    CASE o_orderstatus WHEN 'O' THEN 'inicial' WHEN 'F' THEN 'actualizado_incremental'
      ELSE 'modificacion_detectada' END AS estado,
    o_orderkey AS total_registros, cast(o_orderdate AS timestamp) AS "timestamp",
    sha256(cast(o_orderkey AS varchar)) AS hash_sha256 FROM orders)"""

_LINE = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def _changes(keys: str) -> str:
    on = " AND ".join(f"o.{c.strip()} IS NOT DISTINCT FROM n.{c.strip()}" for c in _LINE.split(","))
    picked = ", ".join(f"coalesce(o.{k.strip()}, n.{k.strip()}) AS {k.strip()}" for k in keys.split(","))
    return f"""WITH old AS (
  SELECT {_LINE}, count(*) AS n FROM lineitem
  WHERE cast(l_shipdate AS date) <= DATE '2001-06-30' GROUP BY ALL),
raised AS (
  SELECT * REPLACE (CASE WHEN l_discount = 0.1::DOUBLE THEN l_tax + 1 ELSE l_tax END AS l_tax)
  FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_quantity > 45)),
new AS (SELECT {_LINE}, count(*) AS n FROM raised GROUP BY ALL),
both_sides AS (
  SELECT {picked}, coalesce(o.n, 0) AS was, coalesce(n.n, 0) AS is_now
  FROM old o FULL OUTER JOIN new n ON {on}),
sums AS (
  SELECT {keys}, sum(least(was, is_now)) AS kept, sum(greatest(was - is_now, 0)) AS gone,
    sum(greatest(is_now - was, 0)) AS come
  FROM both_sides GROUP BY {keys}),
changes AS (
  SELECT {keys}, cast(kept AS bigint) AS iguales, cast(least(gone, come) AS bigint) AS modificadas,
    cast(come - least(gone, come) AS bigint) AS agregadas,
    cast(gone - least(gone, come) AS bigint) AS eliminadas
  FROM sums)"""


_ALL_TABLES = {
    "region": 2,
    "nation": 3,
    "customer": 5,
    "supplier": 4,
    "part": 6,
    "orders": 6,
    "lineitem": 11,
    "events": 6,
    "documents": None,
    "embeddings": None,
    "pages": None,
    "benchmark": None,
    "labels": None,
    "conversations": None,
}


def _table_counts() -> str:
    parts = [
        f"SELECT '{t}' AS tabla, (SELECT count(*) FROM {t}) AS filas, cast((SELECT count(*) FROM "
        f"(DESCRIBE SELECT * FROM {t})) AS int) AS columnas"
        for t in _ALL_TABLES
    ]
    return " UNION ALL ".join(parts)


def _describe() -> str:
    columns = (
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax"
    )
    parts = []
    for c in columns.split(", "):
        d = f"cast({c} AS double)"
        quartiles = ", ".join(
            f"round(quantile_cont({d}, {p / 100}), 4) AS p{p}" for p in (25, 50, 75)
        )
        parts.append(
            f"SELECT '{c}' AS columna, count({c}) AS filas, round(avg({d}), 4) AS mean, "
            f"round(stddev_samp({d}), 4) AS std, round(min({d}), 4) AS min, {quartiles}, "
            f"round(max({d}), 4) AS max FROM lineitem"
        )
    return " UNION ALL ".join(parts)


def _cell(value: str) -> str:
    """A cell led by its length, or the mark for null."""
    return f"coalesce(length(cast({value} AS varchar)) || ':' || cast({value} AS varchar), '-')"


def _fingerprint() -> str:
    doubles = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    cells = [
        _cell(f"round({c}, 6)" if c in doubles else c)
        for c in sorted(c.strip() for c in _LINE.split(","))
    ]
    return f"""WITH digests AS (
  SELECT sha256(concat_ws(chr(31), {", ".join(cells)})) AS h FROM lineitem),
parts AS (
  SELECT cast('0x' || substr(h, 1, 15) AS bigint) AS a, cast('0x' || substr(h, 16, 15) AS bigint) AS b
  FROM digests)
SELECT count(*) AS total_registros, sha256(concat_ws(chr(31), cast(count(*) AS varchar),
  cast(sum(a) AS varchar), cast(sum(b) AS varchar), cast(bit_xor(a) AS varchar))) AS hash_sha256
FROM parts"""


def _extracted(headers: str = "") -> str:
    window = f">= {AS_OF} - 1080"
    parts = [
        f"SELECT PAIS, 'movGC_VtDocumentoVtaCab' AS tabla FROM movGC_VtDocumentoVtaCab WHERE fEmision {window}{headers}",
        "SELECT PAIS, 'movGC_VtDocumentoVtaDet' FROM movGC_VtDocumentoVtaDet",
        "SELECT PAIS, 'maeGC_ProductoEquiv' FROM maeGC_ProductoEquiv",
        f"SELECT PAIS, 'RM00101' FROM RM00101 WHERE CREATDDT {window}",
    ]
    shapes = [("movGC_VtDocumentoVtaCab", c, 9) for c in COUNTRY_CODES]
    shapes += [("movGC_VtDocumentoVtaDet", c, 9) for c in COUNTRY_CODES]
    for table, columns in (("maeGC_ProductoEquiv", 5), ("RM00101", 14)):
        shapes += [(table, c, columns) for c in COUNTRY_CODES]
    tried = ", ".join(f"('{c}', '{t}', {n})" for t, c, n in shapes)
    return f"""{ctes(*MOV, "RM00101")}, found AS ({" UNION ALL ".join(parts)}),
tried(pais, tabla, n) AS (VALUES {tried}),
records AS (
  SELECT tried.pais, tried.tabla, count(found.tabla) AS registros, coalesce(n, 0) AS columnas,
    CASE WHEN n IS NULL THEN 'ERROR' WHEN count(found.tabla) > 0 THEN 'OK' ELSE 'SIN DATOS' END AS estado
  FROM tried LEFT JOIN found ON found.PAIS = tried.pais AND found.tabla = tried.tabla
  GROUP BY tried.pais, tried.tabla, n)"""


# Orders as text: the columns of text_orders, in order.
_TEXT_ORDERS = {
    "entero": "cast(o_orderkey AS varchar)",
    "monto": "cast(cast(o_totalprice AS decimal(12,2)) AS varchar)",
    "real": "CASE WHEN o_orderkey % 10 = 0 THEN '1.5e3' ELSE cast(cast(o_totalprice AS decimal(12,2)) AS varchar) END",
    "fecha": "CASE WHEN o_orderkey % 3 > 0 THEN cast(cast(o_orderdate AS date) AS varchar) END",
    "hora": "cast(cast(o_orderdate AS date) AS varchar) || CASE WHEN o_orderkey % 5 = 0 THEN ' 10:30:00' ELSE '' END",
    "logico": "CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'FALSE' END",
    "mezcla": "CASE WHEN o_orderkey % 100 = 0 THEN 'n/d' ELSE cast(cast(o_totalprice AS decimal(12,2)) AS varchar) END",
    "ceros": "lpad(cast(o_custkey AS varchar), 12, '0')",
    "COD_CLIENTE": "cast(o_custkey AS varchar)",
    "vacia": "cast(NULL AS varchar)",
    "texto": "o_orderpriority",
}


def _inferred() -> str:
    """The narrowest type of each column by tests of whole columns, one after the other."""
    tests = {
        "boolean": "lower({c}) IN ('true', 'false')",
        "bigint": "regexp_full_match({c}, '[+-]?(0|[1-9][0-9]{{0,17}})')",
        "decimal": "regexp_full_match({c}, '[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?')",
        "double": "try_cast({c} AS double) IS NOT NULL AND regexp_full_match({c}, '[+-]?(0([.eE].*)?|[1-9].*)')",
        "date": "length({c}) = 10 AND try_cast({c} AS date) IS NOT NULL",
        "timestamp_ntz": "length({c}) >= 10 AND try_cast({c} AS timestamp) IS NOT NULL",
    }
    width = (
        "'decimal(' || cast(max(length(split_part(ltrim({c}, '+-'), '.', 1))) + max(length(split_part({c}, '.', 2))) AS varchar) "
        "|| ',' || cast(max(length(split_part({c}, '.', 2))) AS varchar) || ')'"
    )
    rows = []
    for i, c in enumerate(_TEXT_ORDERS):
        cases = "".join(
            f" WHEN bool_and(CASE WHEN {c} IS NOT NULL THEN {t.format(c=c)} END) THEN " + (width.format(c=c) if kind == "decimal" else f"'{kind}'")
            for kind, t in tests.items()
        )
        kind = "'string'" if c.startswith("COD") else f"CASE WHEN count({c}) = 0 THEN 'string'{cases} ELSE 'string' END"
        place = 0 if c == "logico" else i - (i > list(_TEXT_ORDERS).index("logico"))
        rows.append(
            f"SELECT {place} AS posicion, '{c}' AS columna, {kind} AS tipo, count({c}) AS celdas, "
            f"cast(coalesce(max(length({c})), 0) AS int) AS longitud FROM t"
        )
    return f"WITH t AS (SELECT {_select(_TEXT_ORDERS)} FROM orders) " + " UNION ALL ".join(rows)


# Customers of the faulty file by what becomes of their line.
_FAULTY = """WITH lines AS (
  SELECT c_mktsegment = 'FURNITURE' AS over_long, c_mktsegment = 'BUILDING' AS short,
    c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 0 AS faulty FROM customer),
sums AS (
  SELECT count(*) AS n, count(*) FILTER (over_long) AS over_long, count(*) FILTER (short) AS short,
    count(*) FILTER (faulty) AS faulty FROM lines)"""

# Two extractions of the posted documents, and their digests by country and month.
_CONTROL = ctes("SOP30200") + f""", new AS (
  SELECT PAIS, SOPNUMBE, SOPTYPE, DOCDATE, rtrim(CUSTNMBR) AS CUSTNMBR, BACHNUMB, SUBTOTAL, DOCAMNT,
    cast(CASE WHEN PAIS = 'COLOMBIA' AND strftime(DOCDATE, '%Y-%m') = '1996-03' THEN TAXAMNT + 1 ELSE TAXAMNT END
      AS decimal(19,5)) AS TAXAMNT
  FROM SOP30200 WHERE DOCDATE <= DATE '2001-06-30'
    AND NOT (PAIS = 'PERU' AND strftime(DOCDATE, '%Y-%m') = '1997-05' AND SOPTYPE = 4)),
old AS (SELECT * FROM SOP30200 WHERE DOCDATE <= DATE '2001-05-31'),
$DIGESTS,
moved AS (
  SELECT PAIS, count(*) FILTER (PAIS = 'COLOMBIA' AND strftime(DOCDATE, '%Y-%m') = '1996-03') AS changed,
    count(*) FILTER (PAIS = 'PERU' AND strftime(DOCDATE, '%Y-%m') = '1997-05' AND SOPTYPE = 4) AS gone, count(*) AS n
  FROM old GROUP BY PAIS),
came AS (SELECT PAIS, count(*) AS n FROM new WHERE DOCDATE > DATE '2001-05-31' GROUP BY PAIS)"""


def _digests(rows: str) -> str:
    cells = ", ".join(_cell(c) for c in sorted(("BACHNUMB", "CUSTNMBR", "DOCAMNT", "DOCDATE", "PAIS", "SOPNUMBE", "SOPTYPE", "SUBTOTAL", "TAXAMNT")))
    return f"""digests AS (
  SELECT PAIS, strftime(DOCDATE, '%Y-%m') AS mes, sha256(concat_ws(chr(31), {cells})) AS h FROM {rows}),
halves AS (
  SELECT PAIS, mes, cast('0x' || substr(h, 1, 15) AS bigint) AS a, cast('0x' || substr(h, 16, 15) AS bigint) AS b FROM digests),
leaves AS (
  SELECT PAIS, mes, count(*) AS registros, sha256(concat_ws(chr(31), cast(count(*) AS varchar), cast(sum(a) AS varchar),
    cast(sum(b) AS varchar), cast(bit_xor(a) AS varchar))) AS h FROM halves GROUP BY PAIS, mes),
nodes AS (
  SELECT PAIS, sum(registros) AS registros, count(*) AS meses,
    sha256(string_agg(mes || ':' || h, chr(31) ORDER BY mes || ':' || h)) AS h FROM leaves GROUP BY PAIS)"""


_FACETS = ("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey", "l_orderkey")


def _facets() -> str:
    parts = []
    for c in _FACETS:
        value = f"cast({'cast(l_quantity AS int)' if c == 'l_quantity' else c} AS varchar)"
        parts.append(
            f"(SELECT '{c}' AS columna, {value} AS valor, count(*) AS frecuencia, "
            f"cast(row_number() OVER (ORDER BY count(*) DESC, {value}) AS int) AS orden FROM lineitem "
            f"WHERE {c} IS NOT NULL GROUP BY {value} QUALIFY orden <= 10)"
        )
    return " UNION ALL ".join(parts)


_SLICED = """WITH source AS (
  SELECT CASE WHEN l_linenumber % 3 = 0 THEN DATE '1998-09-02' ELSE cast(l_shipdate AS date) END AS dia,
    l_orderkey AS a, l_linenumber AS b, l_partkey AS c FROM lineitem),
ranked AS (
  SELECT dia, a, b, c, row_number() OVER (ORDER BY dia, a, b, c) - 1 AS r, count(*) OVER () AS n FROM source),
starts AS (SELECT DISTINCT dia, a, b, c FROM ranked WHERE r % ((n + 11) // 12) = 0),
placed AS (
  SELECT (SELECT count(*) FROM starts s WHERE (s.dia, s.a, s.b, s.c) <= (t.dia, t.a, t.b, t.c)) - 1 AS rebanada
  FROM source t)
SELECT cast(rebanada AS int) AS rebanada, count(*) AS filas FROM placed GROUP BY 1"""


ORACLES: dict[str, str] = {
    "sales_ean": ctes(*MOV) + LOOKUP + SALES_SELECT,
    "sales_ean_fanout": ctes(*MOV) + FAN_LOOKUP + SALES_SELECT,
    "sales_fallback": ctes(*SOP) + POSTED_SELECT,
    "sales_report": ctes(*MOV, *SOP)
    + LOOKUP
    + f"{SALES_SELECT} AND cab.PAIS <> 'PERU' UNION ALL {POSTED_SELECT} AND h.PAIS = 'PERU'",
    "sales_by_country": ctes(*MOV)
    + LOOKUP
    + f""" SELECT PAIS, count(*) AS registros, cast(sum(PRECIOEXTENDIDO) AS decimal(29,5)) AS total,
  count_if(EAN <> '')::bigint AS con_ean FROM ({SALES_SELECT}) GROUP BY PAIS""",
    "sales_detail": ctes(*SOP)
    + f"""
SELECT h.PAIS AS PAIS, rtrim(h.SOPNUMBE) AS NUMERO_DOCUMENTO, h.SOPTYPE AS TIPO,
  h.DOCDATE AS FECHA, rtrim(h.CUSTNMBR) AS CODIGO_CLIENTE, rtrim(c.CUSTNAME) AS NOMBRE_CLIENTE,
  rtrim(d.ITEMNMBR) AS CODIGO_PRODUCTO, rtrim(d.ITEMDESC) AS DESCRIPCION_PRODUCTO,
  d.QUANTITY AS CANTIDAD, d.UNITPRCE AS PRECIO_UNITARIO, d.XTNDPRCE AS PRECIO_EXTENDIDO,
  rtrim(d.UOFM) AS UNIDAD_MEDIDA, rtrim(h.BACHNUMB) AS NUMERO_LOTE, h.SUBTOTAL AS SUBTOTAL,
  h.TAXAMNT AS IMPUESTO, h.DOCAMNT AS TOTAL
{LINES} LEFT JOIN RM00101 c ON h.PAIS = c.PAIS AND h.CUSTNMBR = c.CUSTNMBR WHERE h.DOCDATE {PERIOD}""",
    "price_diff": ctes("SOP30200", "SOP30300", "IV00101")
    + f"""
SELECT h.PAIS AS PAIS, rtrim(d.ITEMNMBR) AS CODIGO_PRODUCTO, rtrim(d.ITEMDESC) AS DESCRIPCION,
  rtrim(h.SOPNUMBE) AS NUMERO_DOCUMENTO, h.DOCDATE AS FECHA, rtrim(h.CUSTNMBR) AS CODIGO_CLIENTE,
  d.UNITPRCE AS PRECIO_VENTA, i.LISTPRCE AS PRECIO_LISTA,
  cast(d.UNITPRCE - i.LISTPRCE AS decimal(20,5)) AS DIFERENCIA,
  CASE WHEN i.LISTPRCE > 0 THEN round(cast(d.UNITPRCE - i.LISTPRCE AS double)
    / cast(i.LISTPRCE AS double) * 100.0::double, 6) ELSE 0.0::double END AS PCT_DIFERENCIA
{LINES} LEFT JOIN IV00101 i ON d.PAIS = i.PAIS AND d.ITEMNMBR = i.ITEMNMBR
WHERE h.DOCDATE {PERIOD} AND abs(d.UNITPRCE - coalesce(i.LISTPRCE, 0)) > 0.01""",
    "fill_rate": ctes(*SOP)
    + f"""
SELECT h.PAIS AS PAIS, rtrim(h.CUSTNMBR) AS CODIGO_CLIENTE, rtrim(c.CUSTNAME) AS NOMBRE_CLIENTE,
  rtrim(d.ITEMNMBR) AS CODIGO_PRODUCTO, rtrim(d.ITEMDESC) AS DESCRIPCION_PRODUCTO,
  cast(sum(d.QUANTITY) AS decimal(29,5)) AS CANTIDAD_PEDIDA,
  cast(sum(d.QTYTOINV) AS decimal(29,5)) AS CANTIDAD_ENTREGADA,
  cast(sum(d.QUANTITY - d.QTYTOINV) AS decimal(29,5)) AS CANTIDAD_PENDIENTE,
  CASE WHEN sum(d.QUANTITY) > 0 THEN round(cast(sum(d.QTYTOINV) AS double)
    / cast(sum(d.QUANTITY) AS double) * 100.0::double, 6) ELSE 0.0::double END AS FILL_RATE_PCT
{LINES} LEFT JOIN RM00101 c ON h.PAIS = c.PAIS AND h.CUSTNMBR = c.CUSTNMBR
WHERE h.DOCDATE {PERIOD} GROUP BY 1, 2, 3, 4, 5""",
    "customers": ctes("RM00101") + f" SELECT {_select(CUSTOMER_COLUMNS)} FROM RM00101",
    "products": ctes("IV00101")
    + """
SELECT PAIS, rtrim(ITEMNMBR) AS CODIGO, rtrim(ITEMDESC) AS DESCRIPCION, rtrim(ITMSHNAM) AS DESC_CORTA,
  rtrim(ITMCLSCD) AS CLASE, rtrim(ITEMTYPE) AS TIPO, CURRCOST AS COSTO_ACTUAL,
  STNDCOST AS COSTO_ESTANDAR, CASE WHEN INACTIVE = 1 THEN 'SI' ELSE 'NO' END AS INACTIVO,
  LISTPRCE AS PRECIO_LISTA, QTYONHND AS CANT_DISPONIBLE, QTYSOLD AS CANT_VENDIDA,
  QTYONORD AS CANT_ORDENADA FROM IV00101""",
    "price_list": ctes("IV00108")
    + """
SELECT PAIS, rtrim(PRCLEVEL) AS NIVEL_PRECIO, rtrim(ITEMNMBR) AS CODIGO_PRODUCTO,
  rtrim(UOFM) AS UNIDAD_MEDIDA, CURNCYID AS MONEDA, LISTPRCE AS PRECIO_LISTA,
  STNDCOST AS COSTO_ESTANDAR FROM IV00108""",
    "stock_lot": ctes("IV00102", "IV00101")
    + """
SELECT s.PAIS AS PAIS, rtrim(s.ITEMNMBR) AS CODIGO_PRODUCTO, rtrim(i.ITEMDESC) AS DESCRIPCION,
  rtrim(s.LOCNCODE) AS ALMACEN, rtrim(s.LOTNUMBR) AS LOTE, s.QTYONHND AS CANTIDAD,
  s.DATERECD AS FECHA_RECEPCION, s.EXPNDATE AS FECHA_VENCIMIENTO
FROM IV00102 s JOIN IV00101 i ON s.PAIS = i.PAIS AND s.ITEMNMBR = i.ITEMNMBR WHERE s.QTYONHND > 0""",
    "receivables": ctes("RM20101", "RM00101", "RM40401")
    + f"""
SELECT r.PAIS AS PAIS, rtrim(r.CUSTNMBR) AS NUMEROCLIENTE, rtrim(c.CUSTNAME) AS NOMBRECLIENTE,
  rtrim(r.DOCNUMBR) AS NUMERODOCUMENTO, rtrim(t.DOCDESCR) AS TIPODOCUMENTO,
  r.DOCDATE AS FECHADOCUMENTO, r.DUEDATE AS FECHAVENCIMIENTO, rtrim(r.CURNCYID) AS MONEDA,
  r.ORTRXAMT AS MONTOORIGINAL, r.CURTRXAM AS MONTOACTUAL,
  cast(r.ORTRXAMT - r.CURTRXAM AS decimal(20,5)) AS MONTOPAGADO,
  cast(datediff('day', r.DUEDATE, {AS_OF}) AS int) AS DIASVENCIDO
FROM RM20101 r JOIN RM00101 c ON r.PAIS = c.PAIS AND r.CUSTNMBR = c.CUSTNMBR
LEFT JOIN RM40401 t ON r.RMDTYPAL = t.RMDTYPAL
WHERE r.DOCDATE {PERIOD} AND r.CURTRXAM > 0""",
    "journal": ctes("GL20000")
    + f"""
SELECT PAIS, cast(JRNENTRY AS varchar) AS NUMERO_ASIENTO, TRXDATE AS FECHA_TRANSACCION,
  rtrim(REFRENCE) AS REFERENCIA, rtrim(ACTNUMST) AS CUENTA_CONTABLE, rtrim(DSCRIPTN) AS DESCRIPCION,
  DEBITAMT AS DEBITO, CRDTAMNT AS CREDITO, rtrim(ORGNTSRC) AS ORIGEN, rtrim(ORMSTRID) AS ID_MAESTRO,
  rtrim(ORMSTRNM) AS NOMBRE_MAESTRO FROM GL20000 WHERE TRXDATE {PERIOD}""",
    "ledger": ctes("GL20000")
    + f"""
SELECT PAIS, rtrim(ACTNUMST) AS CUENTA_CONTABLE, rtrim(ACTDESCR) AS DESCRIPCION_CUENTA,
  TRXDATE AS FECHA, cast(JRNENTRY AS varchar) AS ASIENTO, rtrim(REFRENCE) AS REFERENCIA,
  DEBITAMT AS DEBITO, CRDTAMNT AS CREDITO,
  cast(DEBITAMT - CRDTAMNT AS decimal(20,5)) AS SALDO_MOVIMIENTO
FROM GL20000 WHERE TRXDATE {PERIOD}""",
    "control_accounts": ctes("GL20000", "GL00100")
    + f"""
SELECT g.PAIS AS PAIS, rtrim(g.ACTNUMST) AS CUENTA, rtrim(a.ACTDESCR) AS DESCRIPCION,
  g.TRXDATE AS FECHA, rtrim(g.REFRENCE) AS REFERENCIA, g.DEBITAMT AS DEBITO, g.CRDTAMNT AS CREDITO,
  rtrim(g.ORGNTSRC) AS ORIGEN, rtrim(g.ORMSTRID) AS DOCUMENTO_ORIGEN
FROM GL20000 g LEFT JOIN GL00100 a ON g.ACTINDX = a.ACTINDX
WHERE g.TRXDATE {PERIOD} AND g.ACTNUMST LIKE '1%'""",
    "scan_full": ctes("RM00101") + " SELECT * REPLACE (rtrim(CUSTNMBR) AS CUSTNMBR) FROM RM00101",
    "scan_rolling": ctes("SOP30200")
    + f""" SELECT * REPLACE (rtrim(CUSTNMBR) AS CUSTNMBR) FROM SOP30200
WHERE DOCDATE >= {AS_OF} - 1080""",
    "scan_detail_ean": ctes(*MOV)
    + LOOKUP
    + f"""
SELECT d.PAIS, d.cSerie, d.nCorrelativo, rtrim(d.cProductoVta) AS cProductoVta, d.dProductoVta,
  d.nCantidad, d.nPrecioOrig, d.nTotalOrig, coalesce(lookup.EAN, '') AS EAN
FROM movGC_VtDocumentoVtaDet d
LEFT JOIN lookup ON lookup.owner = d.PAIS AND lookup.prod = rtrim(d.cProductoVta) AND lookup.code = {CODE.replace("PAIS", "d.PAIS")}""",
    "ean_lookup": ctes("maeGC_ProductoEquiv")
    + """
SELECT DISTINCT PAIS, rtrim(cPais) AS cPais, rtrim(cProducto) AS cProducto, rtrim(cProductoEquiv) AS EAN
FROM maeGC_ProductoEquiv WHERE cEquivalencia = 'EAN12'""",
    "ean_enrich": ctes("SOP30300", "maeGC_ProductoEquiv")
    + LOOKUP
    + f"""
SELECT d.* REPLACE (rtrim(d.ITEMNMBR) AS ITEMNMBR), coalesce(lookup.EAN, '') AS EAN
FROM SOP30300 d LEFT JOIN lookup
  ON lookup.owner = d.PAIS AND lookup.prod = rtrim(d.ITEMNMBR) AND lookup.code = {CODE.replace("PAIS", "d.PAIS")}""",
    "ean_coverage": ctes("SOP30300", "maeGC_ProductoEquiv")
    + LOOKUP
    + f""", rows AS (SELECT d.PAIS, lookup.EAN FROM SOP30300 d LEFT JOIN lookup
  ON lookup.owner = d.PAIS AND lookup.prod = rtrim(d.ITEMNMBR) AND lookup.code = {CODE.replace("PAIS", "d.PAIS")})
SELECT PAIS, count(*) AS filas, count(EAN) AS con_ean,
  round(count(EAN) * 100.0::double / count(*), 6) AS porcentaje FROM rows GROUP BY PAIS""",
    "consolidated": ctes("SOP30200") + COUNTRY_HEADERS + " SELECT * FROM frames",
    "country_stats": ctes("SOP30200")
    + """ SELECT PAIS, count(*) AS registros, (SELECT count(*) FROM (DESCRIBE SOP30200))::int - 1
  + CASE PAIS WHEN 'PERU' THEN 1 WHEN 'CHILE' THEN 0 ELSE -1 END AS columnas FROM SOP30200 GROUP BY PAIS""",
    "extract_records": _extracted()
    + " SELECT pais, tabla, registros, columnas, estado FROM records",
    "extract_summary": _extracted()
    + """ SELECT count(DISTINCT pais) AS paises, count(DISTINCT tabla) AS tablas,
  count(*) FILTER (estado = 'OK') AS exitosos, count(*) AS operaciones,
  cast(sum(registros) AS bigint) AS total_registros FROM records""",
    "preview": f"""SELECT * FROM lineitem
ORDER BY {", ".join(c.strip() + " NULLS FIRST" for c in _LINE.split(","))} LIMIT 100""",
    "adhoc_sql": """SELECT o_orderstatus, count(*) AS n,
  cast(sum(cast(o_totalprice AS decimal(19,5))) AS decimal(29,5)) AS total
FROM orders WHERE o_orderdate >= DATE '1995-02-01' GROUP BY o_orderstatus""",
    "filter_isin": "SELECT * FROM part WHERE p_type IN ('PROMO', 'SMALL')",
    "table_counts": _table_counts(),
    "describe_numeric": _describe(),
    "value_counts": """SELECT l_partkey AS valor, count(*) AS frecuencia FROM lineitem
WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "distinct_values": """SELECT DISTINCT p_name AS valor FROM part
ORDER BY 1 NULLS FIRST LIMIT 100""",
    "tables_by_country": FILES
    + """
SELECT DISTINCT PAIS AS grupo, tabla FROM files
UNION ALL SELECT DISTINCT 'OTROS', p_type || '_' || p_brand FROM part""",
    "normalize_headers": HEADERS + " SELECT p_partkey, original, normalizado FROM plain",
    "header_changes": HEADERS
    + " SELECT p_partkey, original, normalizado FROM plain WHERE original <> normalizado",
    "snapshot_name": FILES + " SELECT PAIS, archivo, nombre, tabla, sello FROM files",
    "latest_snapshot": FILES
    + """
SELECT PAIS, archivo, nombre, tabla, sello FROM files
QUALIFY row_number() OVER (PARTITION BY PAIS, nombre ORDER BY sello DESC, archivo DESC) = 1""",
    "ascii_names": FILES
    + f""", both_names AS (
  SELECT archivo, archivo || '/Año[Región]' || archivo || archivo AS largo FROM files)
SELECT archivo, {_ascii("archivo")} AS corto_ascii, {_ascii("largo")} AS largo_ascii
FROM both_names""",
    "scrub_control_chars": f"""SELECT doc_id, regexp_replace(text, '{CONTROL_CHARS}', '', 'g') AS text
FROM documents""",
    "load_summary": RECORDS
    + """
SELECT coalesce(pais, 'TOTAL') AS pais, count(*) AS tablas,
  cast(sum(filas_cargadas) AS bigint) AS filas FROM records WHERE exito GROUP BY ROLLUP (pais)""",
    "load_states": RECORDS
    + """
SELECT CASE WHEN exito THEN 'exitoso' WHEN error IS NOT NULL THEN 'error' ELSE 'omitido' END AS estado,
  count(*) AS archivos FROM records GROUP BY 1""",
    "load_errors": RECORDS + " SELECT pais, archivo, error FROM records WHERE error IS NOT NULL",
    "history_filter": HISTORY
    + """ SELECT pais, tabla, version, estado, total_registros, "timestamp", hash_sha256
FROM history WHERE pais = 'HIGH' AND estado = 'inicial'""",
    "history_metrics": HISTORY
    + """
SELECT count(*) AS total_registros,
  count(*) FILTER (estado = 'modificacion_detectada') AS modificaciones,
  cast(sum(version) AS bigint) AS total_versiones, count(DISTINCT tabla) AS tablas_unicas
FROM history""",
    "history_stats": HISTORY
    + """
SELECT count(*) AS total_registros, count(DISTINCT tabla) AS tablas_unicas,
  count(DISTINCT pais) AS paises_unicos,
  count(*) FILTER (estado = 'modificacion_detectada') AS modificaciones_detectadas,
  max("timestamp") AS ultima_actualizacion FROM history""",
    "row_hash": ctes("SOP30200")
    + f"""
SELECT SOPNUMBE, sha256(concat_ws(chr(31), {", ".join(_cell(c) for c in (
        "BACHNUMB", "rtrim(CUSTNMBR)", "DOCAMNT", "DOCDATE", "PAIS", "SOPNUMBE", "SOPTYPE", "SUBTOTAL", "TAXAMNT"
    ))})) AS hash_sha256 FROM SOP30200""",
    "fingerprint": _fingerprint(),
    "snapshot_changes": _changes("l_shipdate") + " SELECT * FROM changes",
    "snapshot_diff": _changes("l_orderkey, l_linenumber")
    + """
SELECT cast(sum(iguales) AS bigint) AS iguales, cast(sum(modificadas) AS bigint) AS modificadas,
  cast(sum(agregadas) AS bigint) AS agregadas, cast(sum(eliminadas) AS bigint) AS eliminadas,
  CASE WHEN sum(modificadas) = 0 AND sum(eliminadas) = 0 THEN 'OK' ELSE 'MODIFICADO' END AS resultado
FROM changes""",
    "schema_drift": ctes("SOP30200")
    + DIFFERENCES
    + " SELECT pais, 'SOP30200' AS tabla, columna, kind, columnas, registros "
    "FROM differences JOIN sizes USING (pais)",
    "content_drift": ctes("SOP30200")
    + DIFFERENCES
    + " SELECT pais, columna, kind, registros FROM differences JOIN sizes USING (pais)",
    "drift_totals": ctes("SOP30200")
    + DIFFERENCES
    + """
SELECT pais, count(*) AS total, count(*) FILTER (kind = 'COLUMN_MISSING') AS faltantes,
  count(*) FILTER (kind = 'COLUMN_EXTRA') AS extras
FROM differences JOIN sizes USING (pais) GROUP BY pais""",
    "csv_ingest": """
SELECT cast(c_custkey AS varchar) AS COD_CLIENTE,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name || '; "SA"' END AS RAZON_SOCIAL,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
    ELSE cast(cast(c_acctbal AS decimal(19,2)) AS varchar) END AS CUPO,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE c_mktsegment END AS CREDITO
FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
    "csv_roundtrip": ctes("SOP30200")
    + """
SELECT SOPNUMBE, cast(SOPTYPE AS varchar) AS SOPTYPE, cast(DOCDATE AS varchar) AS DOCDATE,
  rtrim(CUSTNMBR) AS CUSTNMBR, BACHNUMB, cast(SUBTOTAL AS varchar) AS SUBTOTAL,
  cast(TAXAMNT AS varchar) AS TAXAMNT, cast(DOCAMNT AS varchar) AS DOCAMNT, PAIS
FROM SOP30200""",
    "report_to_table": ctes("SOP30200", "RM00101")
    + """ SELECT PAIS AS pais, concat(kind, PAIS) AS tabla, count(*) AS filas_cargadas,
  cast(sum(amount) AS decimal(38,5)) AS total
FROM (SELECT PAIS, 'DOCUMENTOS_' AS kind, DOCAMNT AS amount FROM SOP30200
  UNION ALL SELECT PAIS, 'CLIENTES_', CRLMTAMT FROM RM00101) GROUP BY PAIS, kind""",
    "replace_with_backup": """
SELECT 'ORDERS_CHILE' AS tabla, count(*) AS filas, 6 AS columnas FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'ORDERS_CHILE_OLD', count(*), 6 FROM orders WHERE o_orderstatus = 'F'""",
    "catalog_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, count(*) AS filas, true AS con_bytes FROM {t}" for t in _ALL_TABLES
    ),
    "stream_ingest": ctes("RM00101")
    + """ SELECT 'CHILE' AS PAIS, rtrim(CUSTNMBR) AS CUSTNMBR, CUSTCLAS,
  cast(CRLMTAMT AS varchar) AS CRLMTAMT FROM RM00101""",
    "x_sales_customer": ctes("SOP30200", "RM00101")
    + f"""
SELECT h.PAIS AS PAIS, rtrim(h.CUSTNMBR) AS CUSTNMBR, rtrim(c.CUSTNAME) AS NOMBRE_CLIENTE,
  count(*) AS DOCUMENTOS, cast(sum(h.DOCAMNT) AS decimal(29,5)) AS TOTAL
FROM SOP30200 h LEFT JOIN RM00101 c ON h.PAIS = c.PAIS AND h.CUSTNMBR = c.CUSTNMBR
WHERE h.DOCDATE {PERIOD} GROUP BY 1, 2, 3""",
    "x_top_products": ctes("SOP30200", "SOP30300")
    + f"""
SELECT d.PAIS AS PAIS, rtrim(d.ITEMNMBR) AS ITEMNMBR, cast(sum(d.QUANTITY) AS decimal(29,5)) AS CANTIDAD,
  cast(sum(d.XTNDPRCE) AS decimal(29,5)) AS TOTAL
{LINES} WHERE h.DOCDATE {PERIOD} GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10""",
    "x_inventory": ctes("IV00102", "IV00101")
    + """
SELECT s.PAIS AS PAIS, rtrim(s.ITEMNMBR) AS CODIGO_PRODUCTO, rtrim(i.ITEMDESC) AS DESCRIPCION,
  cast(sum(s.QTYONHND) AS decimal(29,5)) AS CANTIDAD, count(*) AS LOTES
FROM IV00102 s JOIN IV00101 i ON s.PAIS = i.PAIS AND s.ITEMNMBR = i.ITEMNMBR WHERE s.QTYONHND > 0 GROUP BY 1, 2, 3""",
    "x_invoices_period": ctes("SOP30200")
    + f"""
SELECT PAIS, cast(date_trunc('month', DOCDATE) AS date) AS MES, count(*) AS DOCUMENTOS,
  cast(sum(DOCAMNT) AS decimal(29,5)) AS TOTAL FROM SOP30200 WHERE DOCDATE {PERIOD} GROUP BY 1, 2""",
    "x_active_customers": ctes("RM00101")
    + f" SELECT {_select(CUSTOMER_COLUMNS)} FROM RM00101 WHERE INACTIVE <> 1",
    "x_customer_master": ctes("RM00101")
    + f" SELECT {_select(CUSTOMER_COLUMNS, 'INACTIVO', 'SUSPENDIDO')} FROM RM00101",
    "x_sales_brand": ctes("SOP30200", "SOP30300", "IV00101")
    + f"""
SELECT d.PAIS AS PAIS, rtrim(i.ITMCLSCD) AS MARCA, cast(sum(d.QUANTITY) AS decimal(29,5)) AS CANTIDAD,
  cast(sum(d.XTNDPRCE) AS decimal(29,5)) AS TOTAL
{LINES} LEFT JOIN IV00101 i ON d.PAIS = i.PAIS AND d.ITEMNMBR = i.ITEMNMBR WHERE h.DOCDATE {PERIOD} GROUP BY 1, 2""",
    "x_returns": ctes("SOP30200", "SOP30300")
    + f"""
SELECT h.PAIS AS PAIS, h.SOPNUMBE AS SOPNUMBE, h.DOCDATE AS DOCDATE, rtrim(h.CUSTNMBR) AS CUSTNMBR,
  rtrim(d.ITEMNMBR) AS ITEMNMBR, d.QUANTITY AS QUANTITY, d.XTNDPRCE AS XTNDPRCE
{LINES} WHERE h.DOCDATE {PERIOD} AND h.SOPTYPE = 4""",
    "x_products_ean": ctes("IV00101", "maeGC_ProductoEquiv")
    + """
SELECT PAIS, rtrim(ITEMNMBR) AS CODIGO, rtrim(ITEMDESC) AS DESCRIPCION, rtrim(ITMCLSCD) AS CLASE
FROM IV00101 WHERE (PAIS, ITEMNMBR) IN
  (SELECT (PAIS, cProducto) FROM maeGC_ProductoEquiv WHERE cEquivalencia = 'EAN12')""",
    "infer_types": _inferred(),
    "load_typed": """
SELECT o_orderkey AS ENTERO, cast(cast(o_totalprice AS decimal(12,2)) AS decimal(19,2)) AS MONTO,
  CASE WHEN o_orderkey % 3 > 0 THEN cast(o_orderdate AS date) END AS FECHA,
  cast(o_orderdate AS date) + CASE WHEN o_orderkey % 5 = 0 THEN INTERVAL '10:30:00' ELSE INTERVAL '0' SECOND END AS HORA,
  o_orderstatus = 'F' AS LOGICO, lpad(cast(o_custkey AS varchar), 12, '0') AS CEROS,
  cast(o_custkey AS varchar) AS COD_CLIENTE, cast(NULL AS varchar) AS VACIA, o_orderpriority AS TEXTO
FROM orders""",
    "load_account": _FAULTY
    + """
SELECT cast(k AS int) AS intento, n AS filas_leidas, CASE WHEN k = 2 THEN n - over_long ELSE 0 END AS filas_cargadas,
  over_long AS filas_largas, short AS filas_cortas, faulty AS celdas_invalidas, k = 2 AS exito, k <> 2 AS con_error,
  CASE WHEN k = 1 THEN 0 ELSE n - over_long END AS en_tabla
FROM sums, (VALUES (1), (2), (3)) AS tries(k)""",
    "landing_inventory": ctes("RM00101")
    + """
SELECT PAIS, 'Clientes_20240105_000000.csv' AS archivo, false AS vacio, count(*) AS filas_cargadas, false AS con_error
FROM RM00101 GROUP BY PAIS
UNION ALL SELECT DISTINCT PAIS, 'Nada_20240105_000000.csv', true, 0, true FROM RM00101""",
    "sweep": """
SELECT 'T' AS tabla, count(*) AS filas, 5::BIGINT AS antes, 3::BIGINT AS borradas, 2::BIGINT AS quedan FROM orders
UNION ALL SELECT 'T_OLD', count(*), 5, 3, 2 FROM orders WHERE o_orderkey % 5 <= 3""",
    "control_run": _CONTROL.replace("$DIGESTS", _digests("new"))
    + """
SELECT nodes.PAIS AS pais, 'SOP30200' AS tabla, 2 AS version,
  CASE WHEN changed + gone > 0 THEN 'modificacion_detectada' ELSE 'actualizado_incremental' END AS estado,
  cast(registros AS bigint) AS total_registros, h AS hash_sha256, cast(meses AS int) AS meses,
  cast(changed + gone > 0 AS int) AS meses_comparados, moved.n - changed - gone AS iguales, changed AS modificadas,
  coalesce(came.n, 0) AS agregadas, gone AS eliminadas
FROM nodes JOIN moved USING (PAIS) LEFT JOIN came USING (PAIS)""",
    "control_tree": ctes("SOP30200")
    + ", plain AS (SELECT * REPLACE (rtrim(CUSTNMBR) AS CUSTNMBR) FROM SOP30200), "
    + _digests("plain")
    + """
SELECT cast(sum(registros) AS bigint) AS registros,
  sha256(string_agg(PAIS || ':' || h, chr(31) ORDER BY PAIS || ':' || h)) AS hash_sha256 FROM nodes""",
    "rolling_refresh": ctes("SOP30200")
    + f" SELECT * REPLACE (rtrim(CUSTNMBR) AS CUSTNMBR) FROM SOP30200 WHERE DOCDATE >= {AS_OF} - 120 AND DOCDATE <= {AS_OF}",
    "slice_bounds": _SLICED,
    "stream_current": ctes("RM00101")
    + """ SELECT PAIS, rtrim(CUSTNMBR) AS CUSTNMBR, CUSTCLAS, cast(CRLMTAMT AS varchar) AS CRLMTAMT
FROM RM00101 WHERE CUSTCLAS = 'BUILDING'""",
    "facets": _facets(),
    "cached_sql": """
SELECT o_orderstatus, count(*) AS n, cast(sum(cast(o_totalprice AS decimal(19,5))) AS decimal(29,5)) AS total, true AS de_cache
FROM orders WHERE o_orderdate >= DATE '1995-02-01' GROUP BY 1""",
    "catalog_totals": "SELECT "
    + f"{len(_ALL_TABLES)}::BIGINT AS tablas, cast("
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in _ALL_TABLES)
    + " AS bigint) AS filas, true AS con_bytes",
    "sales_sellin": ctes(*MOV) + LOOKUP + SALES_SELECT,
    "sales_market": ctes(*MOV) + LOOKUP + SALES_SELECT,
    "ready_rows": ctes("IV00101")
    + """ SELECT 'Obtener Precio Lista' AS reporte, 0::BIGINT AS filas
UNION ALL SELECT 'Listar Productos Detallado', count(*) FROM IV00101""",
    "repeated_headers": """
SELECT c_custkey AS COD_CLIENTE, c_name AS COD_CLIENTE_1, c_nationkey AS COD_CLIENTE_2, c_mktsegment AS RAZON_SOCIAL,
  c_acctbal AS SALDO FROM customer""",
    "session_info": "SELECT count(*) AS filas, 'spark_catalog' AS catalogo, true AS con_usuario FROM region",
    "extract_controlled": _extracted(" AND NOT (PAIS = 'CHILE' AND nTotal > 400000)")
    + """
SELECT pais, tabla, registros, estado, CASE WHEN registros > 0 THEN 2 END AS version,
  CASE WHEN pais = 'CHILE' AND tabla = 'movGC_VtDocumentoVtaCab' THEN 'modificacion_detectada'
    WHEN registros > 0 THEN 'actualizado_incremental' END AS control,
  CASE WHEN registros > 0 THEN 64 END AS cifras, registros > 0 AS con_archivo
FROM records""",
    "load_losses": """WITH r AS (
  SELECT o_orderpriority AS pais, CASE o_orderstatus WHEN 'O' THEN 0 ELSE o_custkey END AS leidas,
    CASE o_orderstatus WHEN 'F' THEN o_custkey ELSE 0 END AS cargadas, o_orderstatus = 'F' AS exito FROM orders)
SELECT coalesce(pais, 'TOTAL') AS pais, cast(sum(leidas) AS bigint) AS filas_leidas,
  cast(sum(cargadas) AS bigint) AS filas_cargadas, cast(sum(leidas % 5) AS bigint) AS filas_largas,
  cast(sum(leidas % 7) AS bigint) AS filas_cortas,
  cast(coalesce(sum(CASE WHEN exito THEN leidas % 3 END), 0) AS bigint) AS celdas_invalidas,
  cast(sum(leidas) - sum(cargadas) AS bigint) AS filas_no_cargadas
FROM r GROUP BY ROLLUP (pais)""",
    "own_report": ctes("RM00101")
    + """ SELECT PAIS, rtrim(CUSTCLAS) AS CLASE, count(*) AS CLIENTES, cast(sum(CRLMTAMT) AS decimal(29,5)) AS CUPO
FROM RM00101 GROUP BY 1, 2""",
}
