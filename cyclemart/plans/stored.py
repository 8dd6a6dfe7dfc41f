"""The warehouse that report queries read: written once per application and data folder, below the
cluster's shared folder, and only the tables asked for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cyclemart.plans.loads import full_load
from cyclemart.session import working_path
from cyclemart.sources.retail import RetailSource
from cyclemart.sources.warehouse import Warehouse

_NEEDS = {
    "dim_tempo_ref": (),
    "fato_vendasdiarias": (),
    "fato_rankings": (),
    "listas_empresa": (),
    "cubo_kpi": ("dim_tempo_ref", "fato_vendasdiarias"),
    "fato_cliente_perfil": ("fato_rankings",),
    "fato_marca_perfil": ("fato_rankings",),
}
_roots: dict[tuple[str, str], tuple[str, set[str]]] = {}


def stored(spark: SparkSession, path: str, *tables: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, path)
    if key not in _roots:
        _roots[key] = (working_path(spark, "warehouse"), set())
    root, done = _roots[key]
    warehouse = Warehouse(spark, root)
    source = RetailSource(spark, path)
    for table in tables:
        for name in (*_NEEDS[table], table):
            if name not in done:
                full_load(warehouse, source, [name])
                done.add(name)
    return warehouse
