import pytest

from shelfstar.operators import security


@pytest.fixture
def tables(spark):
    return {
        "DimTienda": spark.createDataFrame([(1, 101, "México"), (2, 102, "Perú"), (3, 103, "Mexico")], "tienda_key int, tienda_id int, region string"),
        "FactVentas": spark.createDataFrame([(1, 10), (2, 20), (2, 21), (None, 30)], "tienda_key int, x int"),
        "real_vs_presupuesto": spark.createDataFrame([(101, 1), (102, 2)], "tienda_id int, y int"),
        "DimEmpleado": spark.createDataFrame([(1, 10, "12345678"), (2, 20, "A1")], "empleado_key int, salario int, documento_identidad string"),
        "SeguridadRegion": spark.createDataFrame([("a@x", "Perú"), ("b@x", "México"), ("b@x", "Perú")], "usuario_email string, region string"),
    }


def test_regional_role_matches_accents_exactly(tables, rows):
    seen = security.tables_for(tables, "Gerente_Mexico")
    assert rows(seen["DimTienda"], "tienda_key") == [(1,)]
    assert rows(seen["FactVentas"]) == [(1, 10)]
    assert rows(seen["real_vs_presupuesto"]) == [(101, 1)]
    assert seen["SeguridadRegion"].count() == 0


def test_employees_keep_their_rows_but_not_their_salary(tables, rows):
    seen = security.tables_for(tables, "Gerente_Peru")["DimEmpleado"]
    assert rows(seen) == [(1, "12XXXX78"), (2, "XXXX")]


def test_dynamic_role(tables, rows):
    seen = security.tables_for(tables, "Gerente_Region", "a@x")
    assert rows(seen["FactVentas"]) == [(2, 20), (2, 21)]
    assert rows(seen["SeguridadRegion"]) == [("a@x", "Perú")]
    both = security.tables_for(tables, "Gerente_Region", "b@x")
    assert rows(both["DimTienda"], "tienda_key") == [(1,), (2,)]
    assert security.tables_for(tables, "Gerente_Region", "nobody")["FactVentas"].count() == 0
    with pytest.raises(ValueError):
        security.tables_for(tables, "Gerente_Region")


def test_hr_sees_everything(tables):
    seen = security.tables_for(tables, "RRHH")
    assert "salario" in seen["DimEmpleado"].columns and seen["FactVentas"].count() == 4


def test_default_role_hides_the_map_only(tables):
    seen = security.tables_for(tables, "Default")
    assert seen["FactVentas"].count() == 4 and seen["SeguridadRegion"].count() == 0


@pytest.mark.parametrize("role", ["nobody", "Gerente_Perú", "", "default"])
def test_unknown_roles_read_nothing(tables, role):
    with pytest.raises(ValueError, match="unknown role"):
        security.tables_for(tables, role)
