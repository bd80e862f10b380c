"""The nine source tables: column types, keys, references and value rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
TX_MONEY = T.DecimalType(16, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


@dataclass(frozen=True)
class Reference:
    """``child.column`` points at ``parent.key``; ``on_delete`` is CASCADE, SET NULL or RESTRICT."""

    child: str
    column: str
    parent: str
    on_delete: str


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: str
    unique: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c for c in self.schema.fieldNames() if c not in self.optional)

    @property
    def unique_columns(self) -> tuple[str, ...]:
        return (self.key, *self.unique)


TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "cliente",
            _struct(
                id_cliente=T.LongType(),
                nombre=T.StringType(),
                apellido=T.StringType(),
                curp=T.StringType(),
                correo=T.StringType(),
                ciudad=T.StringType(),
                delegacion=T.StringType(),
                estado_civil=T.StringType(),
            ),
            key="id_cliente",
            unique=("curp", "correo"),
            max_length={
                "nombre": 50,
                "apellido": 50,
                "curp": 18,
                "correo": 100,
                "ciudad": 30,
                "delegacion": 50,
                "estado_civil": 20,
            },
            defaults={"ciudad": "Ciudad de México"},
        ),
        Table(
            "cliente_tel",
            _struct(tel=T.StringType(), id_cliente=T.LongType()),
            key="tel",
            max_length={"tel": 15},
        ),
        Table(
            "cliente_biometria",
            _struct(
                id_biometria=T.LongType(),
                id_cliente=T.LongType(),
                tipo_biometria=T.StringType(),
                hash_referencia=T.StringType(),
            ),
            key="id_biometria",
            max_length={"tipo_biometria": 20, "hash_referencia": 64},
        ),
        Table(
            "cuenta",
            _struct(no_cuenta=T.StringType(), tipo_cuenta=T.StringType(), saldo=MONEY, id_cliente=T.LongType()),
            key="no_cuenta",
            max_length={"no_cuenta": 20, "tipo_cuenta": 20},
            defaults={"saldo": 0},
        ),
        Table(
            "tarjeta",
            _struct(
                no_tarjeta=T.StringType(),
                cvv=T.StringType(),
                emisor=T.StringType(),
                estado=T.StringType(),
                no_cuenta=T.StringType(),
            ),
            key="no_tarjeta",
            max_length={"no_tarjeta": 16, "cvv": 3, "emisor": 20, "estado": 20, "no_cuenta": 20},
        ),
        Table(
            "transaccion",
            _struct(
                id_transaccion=T.LongType(),
                no_tarjeta=T.StringType(),
                cuenta_destino=T.StringType(),
                cuenta_origen=T.StringType(),
                monto=TX_MONEY,
                tipo_movimiento=T.StringType(),
                fecha_transaccion=T.TimestampNTZType(),
            ),
            key="id_transaccion",
            max_length={"no_tarjeta": 16, "cuenta_destino": 20, "cuenta_origen": 20, "tipo_movimiento": 30},
            defaults={"fecha_transaccion": "now"},
        ),
        Table(
            "prestamo",
            _struct(id_prestamo=T.LongType(), estado=T.StringType(), monto=MONEY, id_cliente=T.LongType()),
            key="id_prestamo",
            max_length={"estado": 20},
            defaults={"estado": "Activo"},
        ),
        Table(
            "beneficiario",
            _struct(
                id_beneficiario=T.LongType(),
                parentesco=T.StringType(),
                nombre=T.StringType(),
                apellido=T.StringType(),
                porcentaje_saldo=T.DecimalType(5, 2),
                no_cuenta=T.StringType(),
            ),
            key="id_beneficiario",
            max_length={"parentesco": 30, "nombre": 50, "apellido": 50, "no_cuenta": 20},
        ),
        Table(
            "beneficiario_tel",
            _struct(tel=T.StringType(), id_beneficiario=T.LongType()),
            key="tel",
            max_length={"tel": 15},
        ),
    )
}

REFERENCES: tuple[Reference, ...] = (
    Reference("cliente_tel", "id_cliente", "cliente", "CASCADE"),
    Reference("cliente_biometria", "id_cliente", "cliente", "CASCADE"),
    Reference("cuenta", "id_cliente", "cliente", "RESTRICT"),
    Reference("prestamo", "id_cliente", "cliente", "RESTRICT"),
    Reference("beneficiario", "no_cuenta", "cuenta", "CASCADE"),
    Reference("beneficiario_tel", "id_beneficiario", "beneficiario", "CASCADE"),
    Reference("tarjeta", "no_cuenta", "cuenta", "RESTRICT"),
    Reference("transaccion", "no_tarjeta", "tarjeta", "SET NULL"),
    Reference("transaccion", "cuenta_origen", "cuenta", "RESTRICT"),
    Reference("transaccion", "cuenta_destino", "cuenta", "RESTRICT"),
)

# The domains the source system enforces.
ACCOUNT_TYPES = ("Ahorro", "Corriente", "Nomina")
BIOMETRIC_TYPES = ("Huella Dactilar", "Rostro", "Iris")
LOAN_PENDING = "Pendiente"
LOAN_APPROVED = "Aprobado"
DEPOSIT = "Deposito"
FEE_ACCOUNT_TYPE = "Corriente"
