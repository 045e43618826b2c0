"""Column roles: which column plays which part, so that no operator is tied to one schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Target:
    """A column to impute: its features, how the model output is bounded, and its 0/1 flag."""

    column: str
    kind: str  # "number", "bounded" (clipped to the observed range) or "category"
    categories: tuple[str, ...]
    numbers: tuple[str, ...]
    flag: str


@dataclass(frozen=True)
class Roles:
    """Roles of a fact table. Columns that a table lacks are skipped by the operators."""

    key: str
    order: tuple[str, ...]
    texts: tuple[str, ...]
    numbers: tuple[str, ...]
    folded_texts: tuple[str, ...]
    positive: str
    bounded: str
    bounds: tuple[float, float]
    non_negative: str
    group: str
    indicator_source: str
    indicator_value: str
    indicator: str
    ratio: str
    targets: tuple[Target, ...] = field(default=())

    @property
    def flags(self) -> tuple[str, ...]:
        return tuple(t.flag for t in self.targets)


FLAG_SUFFIXES = ("_imputada", "_imputado")

# The property table the defaults describe.
PROPERTY_SCHEMA = T.StructType(
    [
        T.StructField("id_predio", T.StringType()),
        T.StructField("estrato", T.StringType()),
        T.StructField("barrio_nombre", T.StringType()),
        T.StructField("avaluo_total", T.DoubleType()),
        T.StructField("area_construida", T.DoubleType()),
        T.StructField("puntaje", T.DoubleType()),
        T.StructField("tipo_construccion", T.StringType()),
    ]
)

PROPERTY_ROLES = Roles(
    key="id_predio",
    order=("-avaluo_total", "area_construida", "puntaje", "tipo_construccion", "barrio_nombre", "estrato"),
    texts=("estrato", "barrio_nombre", "tipo_construccion"),
    numbers=("avaluo_total", "area_construida", "puntaje"),
    folded_texts=("barrio_nombre", "tipo_construccion"),
    positive="avaluo_total",
    bounded="puntaje",
    bounds=(0.0, 100.0),
    non_negative="area_construida",
    group="barrio_nombre",
    indicator_source="estrato",
    indicator_value="0",
    indicator="es_comercial",
    ratio="avaluo_por_m2",
    targets=(
        Target(
            "area_construida",
            "number",
            ("estrato", "barrio_nombre", "tipo_construccion"),
            ("avaluo_total", "puntaje"),
            "area_construida_imputada",
        ),
        Target(
            "puntaje",
            "bounded",
            ("estrato", "barrio_nombre", "tipo_construccion"),
            ("avaluo_total", "area_construida"),
            "puntaje_imputado",
        ),
        Target(
            "tipo_construccion",
            "category",
            ("estrato", "barrio_nombre"),
            ("avaluo_total", "area_construida", "puntaje"),
            "tipo_construccion_imputado",
        ),
    ),
)
