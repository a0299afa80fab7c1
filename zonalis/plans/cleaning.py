"""The cleaning job: every check in sequence, later checks see only survivors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis import config
from zonalis.functions.values import missing_to_null
from zonalis.operators import quality as q
from zonalis.sources.session import staged


@dataclass(frozen=True)
class CleaningRules:
    subtype_to_type: Mapping[str, str] = field(default_factory=lambda: config.SUBTYPE_TO_TYPE)
    default_type: str = config.DEFAULT_TYPE
    required: Mapping[str, Sequence[str]] = field(default_factory=lambda: config.REQUIRED_FIELDS)
    floors: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: config.PRICE_FLOORS)
    deals: tuple[str, ...] = tuple(d.label for d in config.DEALS)
    latest_by: tuple[str, ...] = ("sold_date", "precio_cierre")
    sigmas: float = config.OUTLIER_SIGMAS
    min_values: int = config.OUTLIER_MIN_VALUES

    @property
    def groups(self) -> int:
        """Upper bound of (type, transaction) groups: both come from fixed tables."""
        return len({*self.subtype_to_type.values(), self.default_type}) * len(self.deals)


@dataclass(frozen=True)
class Cleaned:
    """All input rows with the step that stopped them (``paso``) and the reasons (``motivos``)."""

    checked: DataFrame

    @property
    def kept(self) -> DataFrame:
        return self.checked.filter(F.col("paso") == "conservado").drop("paso", "motivos")

    @property
    def rejects(self) -> DataFrame:
        return q.reject_rows(self.checked, "motivos")

    @property
    def counters(self) -> DataFrame:
        """Rows per step; the sum is the number of input rows."""
        return self.checked.groupBy("paso").agg(F.count("*").alias("filas"))


def clean(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> Cleaned:
    """Run all checks.

    The row-wise checks are one pass. Their result is written once, because the
    two outlier steps need statistics over the survivors of the step before:
    each is one aggregation over three or four columns of the written frame, kept as limits by group. The result is
    one scan of that frame.
    """
    source = missing_to_null(raw)
    flagged = q.flag_last(source, "id_propiedad", rules.latest_by)
    typed = q.with_type_areas(q.map_category(
        flagged, "subtipo_original", "tipo_propiedad", rules.subtype_to_type, rules.default_type))

    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    stopped = (F.when(~F.col("es_ultimo"), F.lit("duplicado"))
               .when(~located, F.lit("sin_coordenadas"))
               .when(q.invalid_area(), F.lit("m2_invalido"))
               .when(F.size("_fields") > 0, F.lit("campos_requeridos"))
               .otherwise(F.lit("conservado")))
    reasons = (F.when(F.col("paso") == "duplicado", F.array(F.lit(config.REASON_DUPLICATE)))
               .when(F.col("paso") == "m2_invalido", F.array(F.lit(config.REASON_AREA)))
               .when(F.col("paso") == "campos_requeridos", F.col("_fields"))
               .otherwise(q.no_reasons()))
    first = staged(
        typed.withColumn("_fields", q.missing_field_reasons(rules.required))
             .withColumn("paso", stopped).withColumn("motivos", reasons)
             .drop("_fields", "es_ultimo"),
        "cleaning")

    keys = ["tipo_propiedad", "tipo_transaccion"]
    alive = (F.col("paso") == "conservado") & F.col("tipo_transaccion").isin(*rules.deals)

    def outlier_step(df: DataFrame, value: str, step: str, reason: str) -> DataFrame:
        marked = q.flag_outliers(df, value, keys, "_out", among=alive, at_most=rules.groups,
                                 sigmas=rules.sigmas, min_values=rules.min_values, written=True)
        hit = (F.col("paso") == "conservado") & F.col("_out")
        return marked.withColumns({
            "motivos": F.when(hit, F.array(F.lit(reason))).otherwise(F.col("motivos")),
            "paso": F.when(hit, F.lit(step)).otherwise(F.col("paso")),
        }).drop("_out")

    by_price = outlier_step(first, "precio_cierre", "atipico_precio", config.REASON_PRICE_OUTLIER)
    by_area = outlier_step(by_price, "m2_construidos", "atipico_m2", config.REASON_AREA_OUTLIER)

    below = q.flag_below_floor(by_area, rules.floors, flag="_below")
    survives = F.col("paso") == "conservado"
    low = survives & F.col("_below")
    other_deal = survives & ~F.coalesce(F.col("tipo_transaccion").isin(*rules.deals), F.lit(False))
    checked = below.withColumns({
        "motivos": F.when(low, F.array(q.floor_reason())).otherwise(F.col("motivos")),
        "paso": F.when(low, F.lit("precio_minimo"))
                 .when(other_deal, F.lit("otra_transaccion")).otherwise(F.col("paso")),
    }).drop("_below")
    # Kept rows, rejects, reports and counters read the written frame and repeat no outlier statistics.
    return Cleaned(checked)
