"""Row filters, column removal and masking as table functions.

They produce the tables a role may read. Who has which role stays with the platform.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.text import mask_partial
from .joins import semi

# Roles, their region and their hidden columns.
REGIONAL_ROLES = {
    "Gerente_Argentina": "Argentina",
    "Gerente_Chile": "Chile",
    "Gerente_Colombia": "Colombia",
    "Gerente_Mexico": "México",
    "Gerente_Peru": "Perú",
}
DYNAMIC_ROLE = "Gerente_Region"
UNRESTRICTED_ROLE = "RRHH"
DEFAULT_ROLE = "Default"
HIDDEN_COLUMNS = {"DimEmpleado": ("salario",)}
SECURITY_MAP = "SeguridadRegion"
#: Facts filtered through the store dimension, with the column they share with it.
STORE_FACTS = {
    "FactVentas": "tienda_key",
    "FactInventario": "tienda_key",
    "ventas_diarias_por_tienda": "tienda_key",
    "real_vs_presupuesto": "tienda_id",
}

Tables = Mapping[str, DataFrame]


def _restrict(tables: Tables, stores: DataFrame) -> dict[str, DataFrame]:
    """Given stores and the facts of those stores; employees and customers are not related that way."""
    out = dict(tables) | {"DimTienda": stores}
    for name, key in STORE_FACTS.items():
        if name in tables:
            out[name] = semi(tables[name], stores, key)
    return out


def row_filter(tables: Tables, region: str) -> dict[str, DataFrame]:
    return _restrict(tables, tables["DimTienda"].filter(F.col("region") == region))


def row_filter_user(tables: Tables, user: str) -> dict[str, DataFrame]:
    """Regions come from the security map; a user sees only the own rows of the map."""
    own = tables[SECURITY_MAP].filter(F.col("usuario_email") == user)
    return _restrict(tables, semi(tables["DimTienda"], own, "region")) | {SECURITY_MAP: own}


def hide(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


def drop_columns(df: DataFrame, table: str, role: str) -> DataFrame:
    return df if role == UNRESTRICTED_ROLE else df.drop(*HIDDEN_COLUMNS.get(table, ()))


def mask_documents(employees: DataFrame, col: str = "documento_identidad") -> DataFrame:
    """Masked view of the identity document. Stored text is untouched, so a reload cannot undo it."""
    return employees.withColumn(col, mask_partial(col))


def tables_for(tables: Tables, role: str, user: str | None = None) -> dict[str, DataFrame]:
    """Every table as the role reads it: rows, hidden columns, hidden map and masked documents."""
    if role == UNRESTRICTED_ROLE:
        return dict(tables)
    if role in REGIONAL_ROLES:
        seen = row_filter(tables, REGIONAL_ROLES[role])
    elif role == DYNAMIC_ROLE:
        if user is None:
            raise ValueError("the dynamic role needs a user")
        seen = row_filter_user(tables, user)
    elif role == DEFAULT_ROLE:
        seen = dict(tables)
    else:
        raise ValueError(f"unknown role {role!r}")
    if role != DYNAMIC_ROLE and SECURITY_MAP in seen:
        seen[SECURITY_MAP] = hide(seen[SECURITY_MAP])
    for name in HIDDEN_COLUMNS:
        if name in seen:
            seen[name] = mask_documents(drop_columns(seen[name], name, role))
    return seen
