"""Run records of extractions and loads, and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.operators.joins import COUNTRY

LOAD_RECORD = T.StructType(
    [
        T.StructField("archivo", T.StringType()),
        T.StructField("pais", T.StringType()),
        T.StructField("tabla", T.StringType()),
        T.StructField("filas_leidas", T.LongType()),
        T.StructField("filas_cargadas", T.LongType()),
        T.StructField("exito", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("filas_largas", T.LongType()),
        T.StructField("filas_cortas", T.LongType()),
        T.StructField("celdas_invalidas", T.LongType()),
    ]
)


ATTEMPT = "pais string, tabla string, columnas int"


def extract_records(
    tables: Mapping[str, DataFrame | None],
    attempts: Sequence[tuple[str, str, int | None]] | None = None,
) -> DataFrame:
    """One record per table and country: rows, columns and outcome, counted in one job.

    ``attempts`` lists what was tried as (country, table, columns), with ``None`` columns for a
    failure; countries without rows then get a record, too. Without it the countries are those
    found in the tables, and a table that is ``None`` counts as failed.
    """
    some = [_counted(name, df) for name, df in tables.items() if df is not None]
    counted = reduce(DataFrame.unionAll, some)
    rows = F.coalesce("registros", F.lit(0)).alias("registros")
    if attempts is not None:
        tried = counted.sparkSession.createDataFrame(list(attempts), ATTEMPT)
        joined = tried.join(counted.drop("columnas"), ["pais", "tabla"], "left")
    else:
        none = [(None, name, None) for name, df in tables.items() if df is None]
        lost = counted.sparkSession.createDataFrame(none, ATTEMPT)
        joined = counted.unionByName(lost, allowMissingColumns=True)
    state = F.when(F.col("columnas").isNull(), F.lit("ERROR")).when(F.col("registros") > 0, F.lit("OK"))
    return joined.select(
        "pais",
        "tabla",
        rows,
        F.coalesce("columnas", F.lit(0)).alias("columnas"),
        state.otherwise(F.lit("SIN DATOS")).alias("estado"),
    )


def _counted(name: str, df: DataFrame) -> DataFrame:
    counted = df.groupBy(*([COUNTRY] if COUNTRY in df.columns else []))
    counted = counted.agg(F.count(F.lit(1)).alias("registros"))
    country = F.col(COUNTRY) if COUNTRY in df.columns else F.lit(None).cast("string")
    return counted.select(
        country.alias("pais"),
        F.lit(name).alias("tabla"),
        "registros",
        F.lit(len(df.columns)).alias("columnas"),
    )


def extract_summary(records: DataFrame) -> DataFrame:
    return records.agg(
        F.countDistinct("pais").alias("paises"),
        F.countDistinct("tabla").alias("tablas"),
        F.count_if(F.col("estado") == "OK").alias("exitosos"),
        F.count(F.lit(1)).alias("operaciones"),
        F.coalesce(F.sum("registros"), F.lit(0)).alias("total_registros"),
    )


def load_summary(records: DataFrame) -> DataFrame:
    """Tables and rows loaded per country, and in all (``TOTAL``)."""
    loaded = records.filter("exito").rollup("pais")
    return loaded.agg(
        F.count(F.lit(1)).alias("tablas"),
        F.sum("filas_cargadas").alias("filas"),
        F.grouping("pais").alias("total"),
    ).select(
        F.when(F.col("total") == 1, F.lit("TOTAL")).otherwise(F.col("pais")).alias("pais"),
        "tablas",
        "filas",
    )


def load_losses(records: DataFrame) -> DataFrame:
    """What loads did not take over, per country and in all (``TOTAL``): rows skipped, filled up, and cells lost.

    A refused or failed load takes over nothing; its rows count as read.
    """
    sums = ("filas_leidas", "filas_cargadas", "filas_largas", "filas_cortas", "celdas_invalidas")
    found = records.rollup("pais").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.grouping("pais").alias("total")
    )
    country = F.when(F.col("total") == 1, F.lit("TOTAL")).otherwise(F.col("pais"))
    rest = F.col("filas_leidas") - F.col("filas_cargadas")
    return found.select(country.alias("pais"), *sums, rest.alias("filas_no_cargadas"))


def load_errors(records: DataFrame) -> DataFrame:
    return records.filter(F.col("error").isNotNull()).select("pais", "archivo", "error")


def load_states(records: DataFrame) -> DataFrame:
    """Records by outcome; an empty file is neither a success nor an error but ``omitido``."""
    state = (
        F.when(F.col("exito"), F.lit("exitoso"))
        .when(F.col("error").isNotNull(), F.lit("error"))
        .otherwise(F.lit("omitido"))
    )
    return records.groupBy(state.alias("estado")).agg(F.count(F.lit(1)).alias("archivos"))
