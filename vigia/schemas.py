"""Table contracts. Column names are the data contract shared with the readers of the results."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


MONEY = T.DecimalType(18, 2)

CLIENTES = _schema(
    id_cliente=T.StringType(), nombre=T.StringType(), sector=T.StringType(),
    clase_riesgo=T.IntegerType(), coordinador=T.StringType(), estado=T.StringType(),
)
CASOS = _schema(
    id_caso=T.LongType(), id_cliente=T.StringType(), periodo=T.DateType(), tipo=T.StringType(),
    dias_ausencia=T.IntegerType(), costo=MONEY, fecha_ocurrencia=T.DateType(), estado=T.StringType(),
)
FACTURACION = _schema(
    id_cliente=T.StringType(), periodo=T.DateType(),
    trabajadores_activos=T.IntegerType(), valor_contrato=MONEY,
)
PREVENCION = _schema(
    id_actividad=T.LongType(), id_cliente=T.StringType(), periodo=T.DateType(), fecha=T.DateType(),
    tipo=T.StringType(), participantes=T.IntegerType(),
)
BILLING_COLUMNS = ("id_cliente", "periodo", "trabajadores_activos", "valor_contrato")
