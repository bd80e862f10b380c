"""The nine tables derived from a customer / orders / nation star schema, for tests and benchmarks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# One text per table, valid in Spark SQL and in DuckDB but for ``sha2``. Later texts read earlier tables.
DERIVATION: dict[str, str] = {
    "cliente": """
SELECT c.c_custkey + 1 AS id_cliente,
       concat('nombre', CAST(c.c_custkey % 97 AS STRING)) AS nombre,
       concat('apellido', CAST(c.c_custkey % 89 AS STRING)) AS apellido,
       concat('CURP', lpad(CAST(c.c_custkey AS STRING), 14, '0')) AS curp,
       concat(lower(replace(c.c_name, '#', '.')), '@correo.example') AS correo,
       'Ciudad de México' AS ciudad,
       n.n_name AS delegacion,
       CASE c.c_custkey % 3 WHEN 0 THEN 'casado/a' WHEN 1 THEN 'soltero/a' ELSE 'viudo/a' END AS estado_civil
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "cliente_tel": """
SELECT concat('55', lpad(CAST(c_custkey AS STRING), 8, '0')) AS tel, c_custkey + 1 AS id_cliente
FROM customer WHERE c_custkey % 7 <> 0
UNION ALL
SELECT concat('56', lpad(CAST(c_custkey AS STRING), 8, '0')), c_custkey + 1
FROM customer WHERE c_custkey % 3 = 0""",
    "cliente_biometria": """
SELECT c_custkey + 1 AS id_biometria, c_custkey + 1 AS id_cliente,
       CASE c_custkey % 3 WHEN 0 THEN 'Huella' WHEN 1 THEN 'Iris' ELSE 'Facial' END AS tipo_biometria,
       sha2(c_name, 256) AS hash_referencia
FROM customer""",
    "cuenta": """
SELECT lpad(CAST(c_custkey AS STRING), 12, '0') AS no_cuenta,
       CASE c_custkey % 5 WHEN 0 THEN 'Debito' WHEN 1 THEN 'Ahorro' WHEN 2 THEN 'Nomina'
                          WHEN 3 THEN 'Chequera' ELSE 'Corriente' END AS tipo_cuenta,
       CAST(c_acctbal AS DECIMAL(12,2)) AS saldo, c_custkey + 1 AS id_cliente
FROM customer WHERE c_custkey % 50 <> 49""",
    "tarjeta": """
SELECT concat('4152', no_cuenta) AS no_tarjeta,
       lpad(CAST(id_cliente % 1000 AS STRING), 3, '0') AS cvv,
       CASE id_cliente % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'American Express' END AS emisor,
       CASE id_cliente % 4 WHEN 0 THEN 'Bloqueada' WHEN 1 THEN 'Vencida' ELSE 'Activa' END AS estado,
       no_cuenta
FROM cuenta WHERE id_cliente % 10 <> 0
UNION ALL
SELECT concat('4153', no_cuenta), lpad(CAST(id_cliente % 1000 AS STRING), 3, '0'), 'Visa', 'Activa', no_cuenta
FROM cuenta WHERE id_cliente % 10 = 1""",
    "transaccion": """
SELECT o_orderkey AS id_transaccion,
       concat('4152', lpad(CAST(o_custkey AS STRING), 12, '0')) AS no_tarjeta,
       lpad(CAST(o_custkey + 1 AS STRING), 12, '0') AS cuenta_destino,
       lpad(CAST(o_custkey AS STRING), 12, '0') AS cuenta_origen,
       CAST(o_totalprice AS DECIMAL(16,2)) AS monto,
       CASE o_orderkey % 4 WHEN 0 THEN 'Deposito' WHEN 1 THEN 'Retiro'
                           WHEN 2 THEN 'Transferencia' ELSE 'Pago de Servicio' END AS tipo_movimiento,
       o_orderdate AS fecha_transaccion
FROM orders""",
    "prestamo": """
SELECT c_custkey AS id_prestamo,
       CASE c_custkey % 6 WHEN 0 THEN 'Activo' WHEN 1 THEN 'Pagado' WHEN 2 THEN 'Vencido'
                          WHEN 3 THEN 'En Mora' ELSE 'Pendiente' END AS estado,
       CAST(5000 + c_custkey % 10000 AS DECIMAL(12,2)) AS monto, c_custkey + 1 AS id_cliente
FROM customer WHERE c_custkey % 5 = 0
UNION ALL
SELECT c_custkey + 1000000000, 'Pagado', CAST(7500 AS DECIMAL(12,2)), c_custkey + 1
FROM customer WHERE c_custkey % 20 = 0
UNION ALL
SELECT c_custkey + 2000000000, 'Pendiente', CAST(9000 AS DECIMAL(12,2)), c_custkey + 1
FROM customer WHERE c_custkey % 100 = 99""",
    "beneficiario": """
SELECT id_cliente * 3 + k AS id_beneficiario,
       CASE k WHEN 0 THEN 'Hijo/a' WHEN 1 THEN 'Esposo/a' ELSE 'Madre' END AS parentesco,
       concat('benef', CAST(k AS STRING)) AS nombre,
       concat('apellido', CAST(id_cliente % 89 AS STRING)) AS apellido,
       CAST(CASE id_cliente % 3 WHEN 0 THEN 100.00 WHEN 1 THEN 50.00 ELSE 33.33 END AS DECIMAL(5,2)) AS porcentaje_saldo,
       no_cuenta
FROM (SELECT id_cliente, no_cuenta, 0 AS k FROM cuenta
      UNION ALL SELECT id_cliente, no_cuenta, 1 FROM cuenta WHERE id_cliente % 3 >= 1
      UNION ALL SELECT id_cliente, no_cuenta, 2 FROM cuenta WHERE id_cliente % 3 >= 2) b
WHERE id_cliente % 11 <> 0""",
    "beneficiario_tel": """
SELECT concat('55', lpad(CAST(id_beneficiario AS STRING), 8, '0')) AS tel, id_beneficiario
FROM beneficiario WHERE id_beneficiario % 4 <> 0""",
}

_READS = re.compile(r"\b(FROM|JOIN) (\w+)\b")

# Order prices dwarf balances, so the ledger queries scale amounts to 1 … 1000.
SCALED_AMOUNT = "CAST(CAST(floor(monto) AS BIGINT) % 1000 + 1 AS DECIMAL(16,2))"


class SampleTables(dict):
    """``{table: DataFrame}``, each derived on first use from the Parquet files in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        if name in DERIVATION:
            text = _READS.sub(r"\1 {\2}", DERIVATION[name])
            frame = self.spark.sql(text, **{used: self[used] for _, used in _READS.findall(DERIVATION[name])})
        elif name == "transaccion_escalada":
            frame = self["transaccion"].selectExpr(
                *(f"{SCALED_AMOUNT} AS monto" if c == "monto" else c for c in self["transaccion"].columns)
            )
        else:
            frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = frame
        return frame

    def all_tables(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in DERIVATION}


def duckdb_ctes(*extra: str) -> str:
    """The same derivation as the head of a DuckDB ``WITH`` query."""
    parts = [f"{name} AS ({text.replace('sha2(c_name, 256)', 'sha256(c_name)')})" for name, text in DERIVATION.items()]
    parts.append(
        "transaccion_escalada AS (SELECT id_transaccion, no_tarjeta, cuenta_destino, cuenta_origen,"
        f" {SCALED_AMOUNT} AS monto, tipo_movimiento, fecha_transaccion FROM transaccion)"
    )
    return "WITH RECURSIVE " + ",\n".join([*parts, *extra])
