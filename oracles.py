"""For each query, SQL that computes the same rows from the same Parquet tables."""

from __future__ import annotations

from caudal.sources.sample import duckdb_ctes

MASK = "regexp_replace({}, '[0-9]', 'X', 'g')"
MAIL = "regexp_replace(correo, '^[^@]+', 'xxxxxx')"

FACT = """hecho AS (SELECT t.id_transaccion, t.no_tarjeta, t.cuenta_origen, t.cuenta_destino, t.monto,
    t.tipo_movimiento, t.fecha_transaccion, c.id_cliente, c.tipo_cuenta, c.saldo
  FROM transaccion t LEFT JOIN cuenta c ON t.cuenta_origen = c.no_cuenta)"""


def _wide(card: str) -> str:
    return f"""SELECT h.id_cliente, h.id_transaccion, h.cuenta_origen, h.tipo_cuenta, h.tipo_movimiento,
    h.fecha_transaccion, h.saldo, h.monto, k.estado, k.emisor
  FROM hecho h LEFT JOIN tarjeta k ON {card}
  LEFT JOIN cliente cl ON cl.id_cliente = h.id_cliente"""


def _full(card: str) -> str:
    return f"""SELECT h.id_cliente, h.id_transaccion, h.cuenta_origen, h.tipo_cuenta, h.tipo_movimiento,
    h.fecha_transaccion, h.saldo, h.monto AS monto_transaccion, k.estado AS estado_tarjeta, k.emisor,
    p.estado AS estado_prestamo
  FROM hecho h LEFT JOIN tarjeta k ON {card}
  LEFT JOIN cuenta cu ON cu.no_cuenta = h.cuenta_origen
  LEFT JOIN beneficiario b ON b.no_cuenta = cu.no_cuenta
  LEFT JOIN cliente cl ON cl.id_cliente = h.id_cliente
  LEFT JOIN prestamo p ON p.id_cliente = cl.id_cliente"""


BY_ACCOUNT = "k.no_cuenta = h.cuenta_origen"
BY_CARD = "k.no_tarjeta = h.no_tarjeta"

TILES = """SELECT *, CAST(ntile(4) OVER (ORDER BY id_cliente NULLS FIRST, id_transaccion NULLS FIRST,
    estado_tarjeta NULLS FIRST, emisor NULLS FIRST, estado_prestamo NULLS FIRST) AS INTEGER) AS bloque FROM ("""

FEATURES = """rasgos AS (SELECT coalesce(id_cliente, 0) AS id_cliente,
    coalesce(CAST(sum(CASE WHEN reciente THEN saldo END) AS DOUBLE)
             / nullif(count(CASE WHEN reciente THEN saldo END), 0), 0) AS saldo_promedio_ultimos_90_dias,
    coalesce(sum(CASE WHEN tipo_movimiento = 'Deposito' THEN monto ELSE 0 END), 0) AS total_ingresos,
    coalesce(sum(CASE WHEN tipo_movimiento <> 'Deposito' THEN monto ELSE 0 END), 0) AS total_egresos,
    count(id_transaccion) AS frecuencia_uso,
    coalesce(sum(CASE WHEN tipo_movimiento = 'Deposito' THEN monto ELSE 0 END)
             - sum(CASE WHEN tipo_movimiento <> 'Deposito' THEN monto ELSE 0 END), 0)
      AS volumen_total_ingresos_vs_egresos
  FROM (SELECT *, fecha_transaccion >= (SELECT max(fecha_transaccion) FROM transaccion) - INTERVAL 90 DAY AS reciente
        FROM hecho) h
  GROUP BY id_cliente)"""
LATER = """cuentas_despues AS (
  SELECT no_cuenta, tipo_cuenta, CAST(CASE WHEN id_cliente % 5 = 0 THEN saldo + 1 ELSE saldo END AS DECIMAL(12,2)) AS saldo, id_cliente
  FROM cuenta WHERE id_cliente % 17 <> 0
  UNION ALL SELECT '9' || substring(no_cuenta, 2, 11), tipo_cuenta, saldo, id_cliente FROM cuenta WHERE id_cliente % 13 = 0)"""

LABELS = """etiquetas AS (SELECT *, CASE WHEN volumen_total_ingresos_vs_egresos > 0 THEN 1 ELSE 0 END AS label
  FROM rasgos)"""
LINES = """lineas AS (SELECT id_cliente AS cliente_id, label AS credit_aprobado,
    saldo_promedio_ultimos_90_dias * CASE WHEN label = 1 THEN CAST(1.2 AS DOUBLE) ELSE CAST(1.01 AS DOUBLE) END
      AS "línea_credito_potencial"
  FROM etiquetas)"""

# Debits of one account in id order, each seeing those accepted before it.
RUNNING = (
    """cola AS MATERIALIZED (SELECT t.*, c.saldo,
      row_number() OVER (PARTITION BY cuenta_origen ORDER BY id_transaccion) AS n
    FROM transaccion_escalada t JOIN cuenta c ON c.no_cuenta = t.cuenta_origen)""",
    """paso AS (
    SELECT cuenta_origen, n, id_transaccion, saldo >= monto AS ok,
           CAST(CASE WHEN saldo >= monto THEN saldo - monto ELSE saldo END AS DECIMAL(18,2)) AS resto
    FROM cola WHERE n = 1
    UNION ALL
    SELECT q.cuenta_origen, q.n, q.id_transaccion, p.resto >= q.monto,
           CAST(CASE WHEN p.resto >= q.monto THEN p.resto - q.monto ELSE p.resto END AS DECIMAL(18,2))
    FROM paso p JOIN cola q ON q.cuenta_origen = p.cuenta_origen AND q.n = p.n + 1)""",
)

# One by one in id order. A transaction is due once it is first in the queue of both its accounts; all due
# transactions are taken at once, as none of them touches another's accounts.
SERIAL = (
    """mov AS MATERIALIZED (SELECT t.id_transaccion AS id, t.cuenta_origen AS o, t.monto,
      t.cuenta_destino = t.cuenta_origen AS propia,
      CASE WHEN t.cuenta_destino <> t.cuenta_origen THEN d.no_cuenta END AS d
    FROM transaccion_escalada t JOIN cuenta c ON c.no_cuenta = t.cuenta_origen
    LEFT JOIN cuenta d ON d.no_cuenta = t.cuenta_destino)""",
    """fila AS (SELECT k, id, row_number() OVER (PARTITION BY k ORDER BY id) AS pos
    FROM (SELECT o AS k, id FROM mov UNION ALL SELECT d, id FROM mov WHERE d IS NOT NULL) x)""",
    """tx AS MATERIALIZED (SELECT m.*, a.pos AS po, b.pos AS pd FROM mov m
    JOIN fila a ON a.k = m.o AND a.id = m.id LEFT JOIN fila b ON b.k = m.d AND b.id = m.id)""",
    """mayor(clave, saldo, pos, ok) USING KEY (clave) AS (
    SELECT no_cuenta, CAST(saldo AS DECIMAL(18,2)), CAST(0 AS BIGINT), CAST(NULL AS BOOLEAN) FROM cuenta
    UNION
    SELECT u.clave, u.saldo, u.pos, u.ok FROM (
      SELECT t.*, o.saldo >= t.monto AS ok, o.saldo AS so, d.saldo AS sd
      FROM tx t JOIN recurring.mayor o ON o.clave = t.o AND o.pos + 1 = t.po
      LEFT JOIN recurring.mayor d ON d.clave = t.d
      WHERE t.pd IS NULL OR d.pos + 1 = t.pd) s,
      LATERAL (SELECT 'tx' || s.id AS clave, CAST(NULL AS DECIMAL(18,2)) AS saldo, s.id AS pos, s.ok AS ok
        UNION ALL SELECT s.o, CASE WHEN s.ok AND NOT s.propia THEN s.so - s.monto ELSE s.so END, s.po, NULL
        UNION ALL SELECT s.d, CASE WHEN s.ok THEN s.sd + s.monto ELSE s.sd END, s.pd, NULL WHERE s.d IS NOT NULL) u)""",
)


def _decisions(source: str) -> str:
    return f"""SELECT t.id_transaccion, t.cuenta_origen, t.cuenta_destino, t.monto, coalesce(s.ok, false) AS aceptada,
    CASE WHEN c.saldo IS NULL THEN 'cuenta de origen desconocida' WHEN NOT s.ok THEN 'saldo insuficiente' END AS motivo
  FROM transaccion_escalada t LEFT JOIN cuenta c ON c.no_cuenta = t.cuenta_origen
  LEFT JOIN ({source}) s ON s.id_transaccion = t.id_transaccion"""


def _counts(rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS regla, count(CASE WHEN {bad} THEN 1 END) AS fallas FROM {table}" for table, name, bad in rules
    )


NEGATIVE = [("cuenta", "cuenta.saldo negativo", "saldo < 0")]
NONPOSITIVE = [("transaccion", "transaccion.monto no positivo", "monto <= 0")]
DOMAINS = [
    ("cuenta", "cuenta.tipo_cuenta fuera de dominio", "tipo_cuenta NOT IN ('Ahorro', 'Corriente', 'Nomina')"),
    (
        "cliente_biometria",
        "cliente_biometria.tipo_biometria fuera de dominio",
        "tipo_biometria NOT IN ('Huella Dactilar', 'Rostro', 'Iris')",
    ),
    (
        "beneficiario",
        "beneficiario.porcentaje_saldo fuera de rango",
        "porcentaje_saldo <= 0 OR porcentaje_saldo > 100",
    ),
]
# Fixed values of the nine tables: columns that may not be null, longest texts, unique columns, references.
BRONZE = "cliente cliente_tel cliente_biometria cuenta tarjeta transaccion prestamo beneficiario beneficiario_tel"
REQUIRED = """
    cliente id_cliente nombre apellido curp correo ciudad delegacion estado_civil
    cliente_tel tel id_cliente
    cliente_biometria id_biometria id_cliente tipo_biometria hash_referencia
    cuenta no_cuenta tipo_cuenta saldo id_cliente
    tarjeta no_tarjeta cvv emisor estado no_cuenta
    transaccion id_transaccion no_tarjeta cuenta_destino cuenta_origen monto tipo_movimiento fecha_transaccion
    prestamo id_prestamo estado monto id_cliente
    beneficiario id_beneficiario parentesco nombre apellido porcentaje_saldo no_cuenta
    beneficiario_tel tel id_beneficiario
"""
LONGEST = """
    cliente nombre:50 apellido:50 curp:18 correo:100 ciudad:30 delegacion:50 estado_civil:20
    cliente_tel tel:15
    cliente_biometria tipo_biometria:20 hash_referencia:64
    cuenta no_cuenta:20 tipo_cuenta:20
    tarjeta no_tarjeta:16 cvv:3 emisor:20 estado:20 no_cuenta:20
    transaccion no_tarjeta:16 cuenta_destino:20 cuenta_origen:20 tipo_movimiento:30
    prestamo estado:20
    beneficiario parentesco:30 nombre:50 apellido:50 no_cuenta:20
    beneficiario_tel tel:15
"""
ONCE = """
    cliente id_cliente curp correo
    cliente_tel tel
    cliente_biometria id_biometria
    cuenta no_cuenta
    tarjeta no_tarjeta
    transaccion id_transaccion
    prestamo id_prestamo
    beneficiario id_beneficiario
    beneficiario_tel tel
"""
REFERRED = """
    cliente_tel id_cliente cliente id_cliente
    cliente_biometria id_cliente cliente id_cliente
    cuenta id_cliente cliente id_cliente
    prestamo id_cliente cliente id_cliente
    beneficiario no_cuenta cuenta no_cuenta
    beneficiario_tel id_beneficiario beneficiario id_beneficiario
    tarjeta no_cuenta cuenta no_cuenta
    transaccion no_tarjeta tarjeta no_tarjeta
    transaccion cuenta_origen cuenta no_cuenta
    transaccion cuenta_destino cuenta no_cuenta
"""


def _listed(text: str) -> list[tuple[str, str]]:
    """``(table, column)`` of a list with a line for each table."""
    return [(name, c) for name, *columns in map(str.split, text.strip().splitlines()) for c in columns]


NOT_NULL = [(t, f"{t}.{c} nulo", f"{c} IS NULL") for t, c in _listed(REQUIRED)]
LENGTHS = [
    (t, f"{t}.{c} largo", f"length({c}) > {n}") for t, c, n in ((t, *x.split(":")) for t, x in _listed(LONGEST))
]
ORPHANS = """SELECT 'cliente sin cuenta' AS regla, count(*) AS fallas
  FROM cliente c LEFT JOIN cuenta q ON c.id_cliente = q.id_cliente WHERE q.no_cuenta IS NULL"""
PERCENT = """SELECT 'cuenta con porcentajes distintos de 100' AS regla, count(*) AS fallas
  FROM cuenta c LEFT JOIN (SELECT no_cuenta, sum(porcentaje_saldo) AS total FROM beneficiario GROUP BY no_cuenta) b
    ON c.no_cuenta = b.no_cuenta
  WHERE coalesce(b.total, 0) <> 100.00"""
UNIQUE = "\nUNION ALL ".join(
    f"""SELECT '{t}.{c} repetido' AS regla, count(*) AS fallas
  FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d"""
    for t, c in _listed(ONCE)
)
FOREIGN = "\nUNION ALL ".join(
    f"""SELECT '{child}.{column} sin {parent}' AS regla, count(*) AS fallas
  FROM {child} h WHERE h.{column} IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = h.{column})"""
    for child, column, parent, key in map(str.split, REFERRED.strip().splitlines())
)
EVERY_RULE = "\nUNION ALL ".join(
    [_counts(NEGATIVE + NONPOSITIVE + DOMAINS + NOT_NULL + LENGTHS), ORPHANS, PERCENT, UNIQUE, FOREIGN]
)

LOANS = """solicitud AS (SELECT p.id_prestamo, p.monto, q.no_cuenta,
    CASE WHEN p.estado IS DISTINCT FROM 'Pendiente' THEN 'préstamo inexistente o no pendiente'
         WHEN q.no_cuenta IS NULL THEN 'cliente sin cuenta' END AS motivo
  FROM prestamo p LEFT JOIN (SELECT id_cliente, min(no_cuenta) AS no_cuenta FROM cuenta GROUP BY id_cliente) q
    ON q.id_cliente = p.id_cliente)"""

ENROLMENTS = """altas AS (SELECT c_custkey * 2 AS orden, 'Nombre' || c_custkey AS nombre, 'Paterno' AS apellido_p,
    'Materno' AS apellido_m,
    CASE WHEN c_custkey % 10 = 0 THEN concat('CURP', lpad(CAST(c_custkey AS STRING), 14, '0'))
         ELSE concat(chr(CAST(65 + c_custkey % 26 AS INTEGER)), 'LTA', lpad(CAST(c_custkey AS STRING), 14, '0')) END AS curp,
    concat('alta', CAST(c_custkey - c_custkey % 7 % 2 AS STRING), '@correo.example') AS correo,
    'Ahorro' AS tipo_cuenta, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo_inicial
  FROM customer)"""
ENROLLED = (
    ENROLMENTS,
    # Row by row in order of arrival: what is taken so far is in the lists.
    """filas AS (SELECT *, row_number() OVER (ORDER BY orden) AS n, curp IN (SELECT curp FROM cliente) AS curp_hay,
      correo IN (SELECT correo FROM cliente) AS correo_hay,
      substr(curp, 1, 4) || CAST(CAST('0x' || substr(md5(curp), 1, 8) AS BIGINT) % 900000 + 100000 AS VARCHAR) AS no_cuenta FROM altas)""",
    """paso AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS curps, CAST([] AS VARCHAR[]) AS correos
    UNION ALL SELECT f.n,
      CASE WHEN f.curp_hay OR list_contains(p.curps, f.curp) OR f.correo_hay OR list_contains(p.correos, f.correo) THEN p.curps
           ELSE list_append(p.curps, f.curp) END,
      CASE WHEN f.curp_hay OR list_contains(p.curps, f.curp) OR f.correo_hay OR list_contains(p.correos, f.correo) THEN p.correos
           ELSE list_append(p.correos, f.correo) END
    FROM paso p JOIN filas f ON f.n = p.n + 1)""",
    """revisadas AS (SELECT f.*,
      CASE WHEN f.curp_hay OR list_contains(p.curps, f.curp) THEN 'CURP repetida'
           WHEN f.correo_hay OR list_contains(p.correos, f.correo) THEN 'correo repetido' END AS motivo
    FROM filas f JOIN paso p ON p.n = f.n - 1)""",
    """aceptadas AS (SELECT *, (SELECT max(id_cliente) FROM cliente) + row_number() OVER (ORDER BY orden) AS id_cliente
    FROM revisadas WHERE motivo IS NULL)""",
)

GONE = """bajas AS (SELECT id_cliente FROM cliente
  WHERE id_cliente NOT IN (SELECT id_cliente FROM cuenta) AND id_cliente NOT IN (SELECT id_cliente FROM prestamo))"""


def _phones(table: str, key: str, separator: str) -> str:
    mask = MASK.format("tel")
    return f"""(SELECT {key}, string_agg({mask}, '{separator}' ORDER BY {mask}) AS lista
    FROM {table} WHERE tel IS NOT NULL GROUP BY {key})"""


# Tables of Silver and Gold that are read back under a name of their own; the facts and movements are layer queries themselves.
LAYER_TABLES = ("dim_clientes", "dim_beneficiarios", "dim_cuentas", "dim_tarjetas", "kpi_capital", "kpi_prestamos")


def oracle_sql() -> dict[str, str]:
    head = duckdb_ctes
    sql = {
        "bronze_roundtrip": head() + "SELECT * FROM transaccion",
        "bronze_counts": head()
        + "\nUNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {t}" for t in BRONZE.split()),
        "csv_roundtrip": head(FACT) + _wide(BY_ACCOUNT),
        "silver_layer": head(FACT)
        + """SELECT id_transaccion, no_tarjeta, cuenta_origen, cuenta_destino, monto, tipo_movimiento, fecha_transaccion,
            id_cliente, strftime(fecha_transaccion, '%Y-%m') AS periodo FROM hecho""",
        "gold_layer": head()
        + """SELECT strftime(fecha_transaccion, '%Y-%m') AS periodo, tipo_movimiento,
            count(id_transaccion) AS movimientos, sum(monto) AS monto_total FROM transaccion GROUP BY 1, 2""",
        "facts_roundtrip": head(FACT)
        + """SELECT id_transaccion, no_tarjeta, cuenta_origen, cuenta_destino, monto, tipo_movimiento,
            fecha_transaccion, id_cliente FROM hecho""",
        "snapshot_roundtrip": head()
        + "\nUNION ALL ".join(
            f"""SELECT '{t}' AS tabla, count(*) AS filas,
              CAST(sum({dict(cuenta='saldo', transaccion='monto', prestamo='monto').get(t, '0')}) AS DECIMAL(28,2)) AS importe
            FROM {t}"""
            for t in BRONZE.split()
        ),
        "etl_wide_files": head(FACT) + f"SELECT *, CAST(4 AS BIGINT) AS archivos FROM ({_wide(BY_ACCOUNT)}) w",
        "tiles_csv_roundtrip": head(FACT) + TILES + _full(BY_ACCOUNT) + ") w",
        "kpi_sql": head()
        + """SELECT 'delegacion' AS reporte, delegacion AS grupo, count(*) AS total FROM cliente GROUP BY 2
          UNION ALL SELECT 'movimiento', tipo_movimiento, count(*) FROM transaccion GROUP BY 2""",
        "kpi_sql_money": head()
        + """SELECT 'capital' AS reporte, CAST(sum(saldo * 100) AS BIGINT) AS centavos FROM cuenta
          UNION ALL SELECT 'promedio', CAST((2 * s + n) // (2 * nullif(n, 0)) AS BIGINT)
          FROM (SELECT CAST(sum(monto * 100) AS BIGINT) AS s, count(monto) AS n FROM transaccion)""",
        "dim_tarjetas_masked": head()
        + f"""SELECT repeat('X', greatest(length(no_tarjeta) - 4, 0)) || right(no_tarjeta, 4) AS no_tarjeta,
            {MASK.format('cvv')} AS cvv, emisor, estado, no_cuenta FROM tarjeta""",
        "dim_clientes": head()
        + f"""SELECT c.id_cliente, upper(nombre) AS nombre, upper(apellido) AS apellido, {MAIL} AS correo, delegacion,
            estado_civil, coalesce(t.lista, '') AS telefonos
          FROM cliente c LEFT JOIN {_phones('cliente_tel', 'id_cliente', ',')} t ON t.id_cliente = c.id_cliente""",
        "dim_beneficiarios": head()
        + f"""SELECT b.id_beneficiario, parentesco, upper(nombre) AS nombre, upper(apellido) AS apellido,
            porcentaje_saldo, no_cuenta, coalesce(t.lista, '') AS telefonos_beneficiario
          FROM beneficiario b LEFT JOIN {_phones('beneficiario_tel', 'id_beneficiario', ', ')} t
            ON t.id_beneficiario = b.id_beneficiario""",
        "dim_cuentas": head() + "SELECT no_cuenta, tipo_cuenta, saldo, id_cliente FROM cuenta",
        "dim_tarjetas": head() + "SELECT no_tarjeta, cvv, emisor, estado, no_cuenta FROM tarjeta",
        "fact_transacciones": head(FACT)
        + """SELECT id_transaccion, no_tarjeta, cuenta_origen, cuenta_destino, monto, tipo_movimiento,
            fecha_transaccion, id_cliente FROM hecho""",
        "fact_prestamos": head() + "SELECT id_prestamo, estado, monto, id_cliente FROM prestamo",
        "pivot_model_credit": head(FACT)
        + """SELECT id_cliente, id_transaccion, cuenta_origen, tipo_cuenta, tipo_movimiento, fecha_transaccion,
            saldo, monto FROM hecho""",
        "kpi_capital": head()
        + """SELECT sum(saldo) AS total_capital, CAST(sum(saldo) AS DOUBLE) / count(saldo) AS saldo_promedio,
            sum(saldo) AS descripcion FROM cuenta""",
        "kpi_movimientos": head()
        + """SELECT strftime(fecha_transaccion, '%Y-%m') AS periodo, tipo_movimiento,
            count(id_transaccion) AS movimientos, sum(monto) AS monto_total
          FROM transaccion GROUP BY 1, 2 ORDER BY 1, 2""",
        "kpi_prestamos": head()
        + """SELECT estado, count(id_prestamo) AS total_creditos, sum(monto) AS monto_total_colocado,
            CAST(sum(monto) AS DOUBLE) / count(monto) AS ticket_promedio_prestamo FROM prestamo GROUP BY estado""",
        "rep_total_capital": head()
        + """SELECT sum(saldo) AS total_capital, '$' || lpad(format('{:,.2f}', sum(saldo)), 15, ' ') AS texto
          FROM cuenta""",
        "rep_avg_tx": head()
        + """SELECT CAST(sum(monto) AS DOUBLE) / count(monto) AS monto_promedio,
            '$' || lpad(format('{:,.2f}', CAST(sum(monto) AS DOUBLE) / count(monto)), 12, ' ') AS texto
          FROM transaccion""",
        "rep_top_delegaciones": head()
        + """SELECT delegacion, count(*) AS total FROM cliente GROUP BY delegacion
          ORDER BY total DESC, delegacion LIMIT 3""",
        "rep_movement_mix": head()
        + """SELECT tipo_movimiento, count(*) AS total FROM transaccion GROUP BY tipo_movimiento
          ORDER BY total DESC, tipo_movimiento""",
        "etl_wide": head(FACT) + _wide(BY_ACCOUNT),
        "etl_wide_by_card": head(FACT) + _wide(BY_CARD),
        "elt_wide": head(FACT) + _full(BY_ACCOUNT),
        "elt_wide_by_card": head(FACT) + _full(BY_CARD),
        "elt_tiles": head(FACT) + TILES + _full(BY_ACCOUNT) + ") w",
        "elt_tiles_by_card": head(FACT) + TILES + _full(BY_CARD) + ") w",
        "elt_tiles_select": head(FACT) + TILES + _full(BY_ACCOUNT) + ") w",
        "elt_tiles_ranges": head(FACT) + TILES + _full(BY_ACCOUNT) + ") w",
        "dq_negative_balance": head() + _counts(NEGATIVE),
        "dq_nonpositive_amount": head() + _counts(NONPOSITIVE),
        "dq_orphan_clients": head() + ORPHANS,
        "dq_beneficiary_pct": head() + PERCENT,
        "dq_checks": head() + _counts(DOMAINS),
        "dq_not_null": head() + _counts(NOT_NULL),
        "dq_lengths": head() + _counts(LENGTHS),
        "dq_unique": head() + UNIQUE,
        "dq_foreign_keys": head() + FOREIGN,
        "dq_report": head() + f"SELECT regla, fallas, fallas = 0 AS aprobada FROM ({EVERY_RULE}) r",
        "dq_incremental": head() + f"SELECT regla, fallas, fallas = 0 AS aprobada FROM ({EVERY_RULE}) r",
        "dq_core": head()
        + "SELECT regla, fallas, fallas = 0 AS aprobada FROM ("
        + "\nUNION ALL ".join([_counts(NEGATIVE + NONPOSITIVE), ORPHANS, PERCENT])
        + ") r",
        "dq_summary": head()
        + f"""SELECT count(*) AS reglas, count(CASE WHEN fallas > 0 THEN 1 END) AS reglas_fallidas,
            CAST(sum(fallas) AS BIGINT) AS fallas FROM ({EVERY_RULE}) r""",
        "dq_offending": head() + "SELECT * FROM cuenta WHERE saldo < 0",
        "my_accounts": head()
        + """SELECT q.no_cuenta, q.tipo_cuenta, q.saldo, c.curp FROM cuenta q JOIN cliente c USING (id_cliente)
          WHERE c.curp = (SELECT max(curp) FROM cliente JOIN cuenta USING (id_cliente))""",
        "tx_authorize_opening": head()
        + _decisions(
            """SELECT x.id_transaccion, q.saldo >= x.monto AS ok FROM transaccion_escalada x
            JOIN cuenta q ON q.no_cuenta = x.cuenta_origen"""
        ),
        "tx_authorize_running": head(*RUNNING) + _decisions("SELECT id_transaccion, ok FROM paso"),
        "tx_authorize_serial": head(*SERIAL)
        + _decisions("SELECT pos AS id_transaccion, ok FROM mayor WHERE ok IS NOT NULL"),
        "tx_post_balances": head()
        + """SELECT c.no_cuenta, c.tipo_cuenta, c.saldo + coalesce(m.cambio, 0) AS saldo, c.id_cliente
          FROM cuenta c LEFT JOIN (
            SELECT k, sum(v) AS cambio FROM (SELECT cuenta_origen AS k, -monto AS v FROM transaccion_escalada
              UNION ALL SELECT cuenta_destino, monto FROM transaccion_escalada) x GROUP BY k) m ON m.k = c.no_cuenta""",
        "tx_post_stream": head(*SERIAL)
        + """SELECT c.no_cuenta, c.tipo_cuenta, m.saldo, c.id_cliente
          FROM cuenta c JOIN mayor m ON m.clave = c.no_cuenta""",
        "loan_authorize": head(LOANS)
        + """SELECT p.id_prestamo, CASE WHEN s.motivo IS NULL THEN 'Aprobado' ELSE p.estado END AS estado, p.monto,
            p.id_cliente FROM prestamo p JOIN solicitud s ON s.id_prestamo = p.id_prestamo""",
        "loan_balances": head(LOANS)
        + """SELECT c.no_cuenta, c.tipo_cuenta, c.saldo + coalesce(a.abono, 0) AS saldo, c.id_cliente
          FROM cuenta c LEFT JOIN (SELECT no_cuenta, sum(monto) AS abono FROM solicitud WHERE motivo IS NULL
            GROUP BY no_cuenta) a ON a.no_cuenta = c.no_cuenta""",
        "loan_rejects": head(LOANS) + "SELECT id_prestamo, motivo FROM solicitud WHERE motivo IS NOT NULL",
        "month_end_fee": head()
        + """SELECT no_cuenta, tipo_cuenta, CASE WHEN tipo_cuenta = 'Corriente' AND saldo < 1000.00 AND saldo >= 50.00
            THEN saldo - 50.00 ELSE saldo END AS saldo, id_cliente FROM cuenta""",
        "register_clients": head(*ENROLLED)
        + """SELECT id_cliente, nombre, apellido_p || ' ' || apellido_m AS apellido, curp, correo,
            'Ciudad de México' AS ciudad, CAST(NULL AS VARCHAR) AS delegacion, CAST(NULL AS VARCHAR) AS estado_civil
          FROM aceptadas""",
        "register_accounts": head(*ENROLLED)
        + "SELECT no_cuenta, tipo_cuenta, saldo_inicial AS saldo, id_cliente FROM aceptadas",
        "register_rejects": head(*ENROLLED) + "SELECT orden, curp, motivo FROM revisadas WHERE motivo IS NOT NULL",
        "delete_blockers": head()
        + """SELECT id_cliente AS clave, 'cuenta' AS tabla, 'id_cliente' AS columna, count(*) AS filas
            FROM cuenta JOIN cliente USING (id_cliente) GROUP BY id_cliente
          UNION ALL SELECT id_cliente, 'prestamo', 'id_cliente', count(*)
            FROM prestamo JOIN cliente USING (id_cliente) GROUP BY id_cliente""",
        "delete_cascade": head(GONE)
        + "\nUNION ALL ".join(
            f"SELECT '{t}' AS tabla, {key}::VARCHAR AS clave FROM {t} WHERE id_cliente NOT IN (SELECT id_cliente FROM bajas)"
            for t, key in (("cliente", "id_cliente"), ("cliente_tel", "tel"), ("cliente_biometria", "id_biometria"))
        ),
        "delete_set_null": head()
        + """SELECT t.id_transaccion, CASE WHEN k.estado = 'Vencida' THEN NULL ELSE t.no_tarjeta END AS no_tarjeta
          FROM transaccion t LEFT JOIN tarjeta k ON k.no_tarjeta = t.no_tarjeta""",
        "max_tx_date": head() + "SELECT max(fecha_transaccion) AS fecha_max FROM transaccion",
        "ml_features": head(FACT, FEATURES) + "SELECT * FROM rasgos",
        "bronze_changes": head(LATER) + """SELECT coalesce(n.no_cuenta, o.no_cuenta) AS no_cuenta,
          CASE WHEN o.no_cuenta IS NULL THEN 'alta' WHEN n.no_cuenta IS NULL THEN 'baja' ELSE 'cambio' END AS operacion
          FROM cuenta o FULL JOIN cuentas_despues n ON o.no_cuenta = n.no_cuenta
          WHERE o.no_cuenta IS NULL OR n.no_cuenta IS NULL OR o.saldo <> n.saldo""",
        "bronze_apply": head(LATER) + "SELECT * FROM cuentas_despues",
        "ml_auc_exact": head(FACT, FEATURES, LABELS)
        + """, p AS (SELECT saldo_promedio_ultimos_90_dias AS s FROM etiquetas WHERE label = 1 AND saldo_promedio_ultimos_90_dias IS NOT NULL),
          n AS (SELECT saldo_promedio_ultimos_90_dias AS s FROM etiquetas WHERE label = 0 AND saldo_promedio_ultimos_90_dias IS NOT NULL),
          r AS (SELECT s, c, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS mid
                FROM (SELECT s, 1 AS c FROM p UNION ALL SELECT s, 0 FROM n) u)
          SELECT CAST(count(*) FILTER (c = 1) AS BIGINT) AS positivos, CAST(count(*) FILTER (c = 0) AS BIGINT) AS negativos,
                 (CAST(sum(CAST(2 * mid AS BIGINT)) FILTER (c = 1) AS BIGINT) - count(*) FILTER (c = 1) * (count(*) FILTER (c = 1) + 1))
                 / (2.0::DOUBLE * count(*) FILTER (c = 1) * count(*) FILTER (c = 0)) AS auc FROM r""",
        "ml_label": head(FACT, FEATURES, LABELS) + "SELECT id_cliente, label FROM etiquetas",
        "credit_line_rule": head(FACT, FEATURES, LABELS, LINES) + "SELECT * FROM lineas",
        "credit_score_check": head(FACT, FEATURES)
        + """SELECT count(*) AS clientes, count(DISTINCT id_cliente) AS distintos, count(*) AS lineas_correctas,
            CAST(0 AS BIGINT) AS fuera_de_rango, true AS auc_alta FROM rasgos""",
        "score_preview": head(FACT, FEATURES, LABELS, LINES)
        + "SELECT *, (SELECT count(*) FROM lineas) AS total FROM lineas ORDER BY cliente_id LIMIT 20",
    }
    # A layer read back holds what its tables are made of.
    return {**sql, **{f"layer_{name}": sql[name] for name in LAYER_TABLES}}
