"""Shared fixtures: one local Spark session and a small student-record frame."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="cohortlens-tests",
                    conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cl-tests-"))
    yield s


STUDENT_COLS = [
    "estu_consecutivo", "periodo", "estu_fechanacimiento", "estu_genero", "estu_mcpio_reside",
    "estu_depto_reside", "estu_mcpio_presentacion", "estu_depto_presentacion",
    "fami_estratovivienda", "fami_educacionmadre", "fami_educacionpadre", "fami_personashogar",
    "fami_cuartoshogar", "fami_tieneinternet", "fami_tienecomputador", "fami_tieneautomovil",
    "fami_tienelavadora", "cole_naturaleza", "cole_calendario", "cole_area_ubicacion",
    "cole_bilingue", "punt_global",
]


def _student_rows():
    """12 rows: 4 periods x 3, municipalities 4/2/6, OFICIAL 7 vs 5, calendar B x2."""
    periods = ["20191", "20192", "20201", "20202"]
    mcpios = (["MEDELLIN"] * 4) + (["ENVIGADO"] * 2) + (["BOGOTA D.C."] * 6)
    deptos = {"MEDELLIN": "ANTIOQUIA", "ENVIGADO": "ANTIOQUIA", "BOGOTA D.C.": "BOGOTA"}
    strata = ["Estrato 1", "Estrato 2", "Estrato 3", "Estrato 4", "Estrato 5", "Estrato 6"]
    edu = ["Primaria completa", "Postgrado", "Ninguno", "Educación profesional completa",
           "Secundaria (Bachillerato) completa", "No sabe"]
    persons = ["Tres", "Cuatro", "3 a 4", "Cinco", "1 a 2", "Dos"]
    rooms = ["Dos", "Tres", "Uno", "Cuatro", "Seis o mas", "Dos"]
    rows = []
    for i in range(12):
        m = mcpios[i]
        stratum = strata[i % 6]
        y = 200.0 + 15.0 * (i % 6 + 1) + (i % 3)
        rows.append((
            i + 1, periods[i % 4], f"{(i % 27) + 1:02d}/0{(i % 9) + 1}/{2001 + i % 4}",
            "F" if i % 2 else "M", m, deptos[m], m if i % 3 else "OTRO", deptos[m],
            stratum, edu[i % 6], edu[(i + 2) % 6], persons[i % 6], rooms[i % 6],
            "Si" if i % 3 else "No", "Si" if i % 4 else "No", "Si" if i % 5 == 0 else "No",
            "Si" if i % 2 == 0 else "No", "OFICIAL" if i < 7 else "NO OFICIAL",
            "B" if i in (3, 9) else "A", "URBANO" if i % 4 else "RURAL", "N", y))
    return rows


@pytest.fixture(scope="session")
def students(spark):
    schema = ", ".join(f"{c} {'bigint' if c == 'estu_consecutivo' else 'double' if c == 'punt_global' else 'string'}"
                       for c in STUDENT_COLS)
    return spark.createDataFrame(_student_rows(), schema)


@pytest.fixture(scope="session")
def student_schema():
    return ", ".join(f"{c} {'bigint' if c == 'estu_consecutivo' else 'double' if c == 'punt_global' else 'string'}"
                     for c in STUDENT_COLS)
