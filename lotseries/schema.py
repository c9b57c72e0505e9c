"""Column names and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

INDICES = ["ndvi", "ndwi11", "msi11"]
STATISTICS = ["mean", "max", "min", "std"]

# Output of the extraction jobs: identity columns, then four statistics per index.
INDEX_COLUMNS = ["lot_id", "obs_date", "image_id"] + [
    f"{index}_{stat}" for index in INDICES for stat in STATISTICS
]

# Observation table: corrected and reference value of every index.
OBSERVATION_COLUMNS = ["lot_id", "obs_date", "image_id"] + [
    f"{index}_{kind}" for index in INDICES for kind in ("corrected", "ref")
]

# Physically possible range per index, bounds included.
VALID_RANGE = {"ndvi": (-1.0, 1.0), "ndwi11": (-1.0, 1.0), "msi11": (0.0, 10.0)}

# Column names found in existing files, and the names used here.
SOURCE_NAMES = {
    "lote": "lot_id",
    "cod_cg": "lot_id",
    "fecha": "obs_date",
    "imagen_id": "image_id",
    "id_img": "image_id",
    "ndvi_promedio": "ndvi_mean",
    "ndwi11_promedio": "ndwi11_mean",
    "msi11_promedio": "msi11_mean",
    "zafra": "season",
    "cod_cg_zafra": "lot_season",
    "cierre": "harvest",
    "edad_de_cultivo": "crop_age_days",
    "cierre_ciclo": "cycle_end",
    "gap_in_data": "data_gap",
    "ciclo_valido": "valid_cycle",
}

# Yield report columns carried into the master table, in report order.
YIELD_COLUMNS = (
    "ingenio zafra zae grupo_de_suelo grupo_de_humedad codigo_zae lote semana finca "
    "familia_de_suelo variedad area tc tch rendimiento tah brix pureza jugo ph pol fibra "
    "humedad edad no_corte nitrogeno potasio fosforo cachaza vinaza sulfato "
    "urea_nitro_exted aplicaciones_foliares riego total_riego_aplicado_mm "
    "numero_de_riegos dias_ultimo_riego pre_incorporado pre_emergente post_emergente "
    "pre_post_emergente ultimo_control_de_malezas bejuco parchoneo arranque "
    "tipo_aplicacion_control_malezas precipitacion temp_minima radiacion_solar "
    "inhibidor_de_floracion premadurante madurante tipo_de_aplicacion_madurante "
    "dias_madurantes horas_quema tipo_quema para_cosecha_en_verde cierre mes_de_cosecha "
    "cosecha de_infestacion_barrenador tipo_de_control_para_barrenador "
    "de_infestacion_de_roedores tipo_de_control_para_roedores "
    "chinche_salivosa_ninfas_tallo chinche_salivosa_adultos_tallo "
    "tipo_de_control_de_chinche latitud longitud zona_longitudinal estrato ultima_imagen "
    "ndvi ndwi_11 ndwi_12 msi_11 msi_12"
).split()


def rename_source_columns(df: DataFrame) -> DataFrame:
    """Give the columns of an existing file the names used in this package."""
    names = {old: new for old, new in SOURCE_NAMES.items() if old in df.columns}
    return df.withColumnsRenamed(names)
