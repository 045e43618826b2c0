"""Thresholds, labels and lookup tables the results depend on."""

from __future__ import annotations

# Quality score: weights and state bands (lower bound, state), best first.
COMPLETENESS_WEIGHT = 0.6
CONSISTENCY_WEIGHT = 0.4
QUALITY_BANDS = [(90.0, "EXCELENTE"), (75.0, "BUENA"), (60.0, "ACEPTABLE")]
QUALITY_LOWEST = "CRÍTICA"

# Four-part score: weights.
FOUR_PART_WEIGHTS = {"completeness": 0.40, "consistency": 0.30, "validity": 0.20, "format": 0.10}

# Completeness colours: (upper bound, colour), worst first.
COMPLETENESS_COLOURS = [(80.0, "red"), (95.0, "orange")]
COMPLETENESS_BEST_COLOUR = "green"

# A column is critical above this null percentage (rounded to two digits).
CRITICAL_NULL_PERCENT = 20.0

# Outlier fences: multiples of the interquartile range.
IQR_FACTOR = 1.5

# Correlations above this absolute value are reported.
HIGH_CORRELATION = 0.5

# Alerts: lowest accepted quality score, retention percentage and model R2.
ALERT_MIN_SCORE = 60.0
ALERT_MIN_RETENTION_PERCENT = 90.0
ALERT_MIN_R2 = 0.60

# Schema and key states.
SCHEMA_MISSING = "FALTANTE"
SCHEMA_OK = "OK"
SCHEMA_WRONG_TYPE = "TIPO_INCORRECTO"
KEY_OK = "OK"
KEY_FIXED = "DUPLICADOS_CORREGIDOS"
KEY_NOT_FOUND = "COLUMNA_NO_ENCONTRADA"

# Prestige classes: label, score, stratum, least average value. Best first.
PRESTIGE = [
    ("PREMIUM", 5, 5, 300_000_000),
    ("ALTO", 4, 4, 250_000_000),
    ("MEDIO ALTO", 3, 3, 200_000_000),
    ("MEDIO", 2, 2, 150_000_000),
    ("BAJO", 1, None, None),
]

# Share of rows held out for testing, folds and seed of the imputation models.
TEST_SHARE = 0.2
FOLDS = 5
SEED = 42

# Categories kept per column when one-hot encoding (the last one stands for all infrequent values).
MAX_CATEGORIES = 50

# Bins of a number in the trees.
BINS = 32

# Lookup tier 1: name, stratum, base count, average value.
NEIGHBOURHOODS = [
    ("EL POBLADO", 6, 1500, 450_000_000),
    ("LAURELES", 5, 1200, 350_000_000),
    ("ALTOS DEL POBLADO", 6, 800, 480_000_000),
    ("GUAYABAL", 5, 1400, 320_000_000),
    ("LA CANDELARIA", 4, 1300, 280_000_000),
    ("BELEN", 3, 900, 220_000_000),
    ("BUENOS AIRES", 3, 1300, 200_000_000),
    ("VILLA HERMOSA", 3, 850, 210_000_000),
    ("ARANJUEZ", 2, 550, 160_000_000),
    ("CASTILLA", 2, 850, 160_000_000),
    ("DOCE DE OCTUBRE #1", 2, 400, 150_000_000),
    ("DOCE DE OCTUBRE #2", 2, 350, 150_000_000),
    ("ROBLEDO", 2, 1200, 140_000_000),
    ("MANRIQUE CENTRAL #1", 2, 600, 130_000_000),
    ("MANRIQUE CENTRAL #2", 2, 500, 130_000_000),
    ("MANRIQUE ORIENTAL", 2, 450, 130_000_000),
    ("POPULAR", 1, 1100, 100_000_000),
    ("SANTA CRUZ", 1, 1400, 110_000_000),
    ("SAN JAVIER #1", 2, 600, 170_000_000),
    ("SAN JAVIER #2", 2, 450, 170_000_000),
    ("MORAVIA", 1, 650, 90_000_000),
    ("VILLATINA", 1, 700, 95_000_000),
    ("SANTO DOMINGO SAVIO #1", 1, 500, 95_000_000),
    ("SANTO DOMINGO SAVIO #2", 1, 450, 95_000_000),
    ("LA AMÉRICA", 2, 600, 180_000_000),
    ("PABLO VI", 2, 400, 140_000_000),
]

# Lookup tier 2: district code, name, stratum, count factor, value factor.
DISTRICTS = [
    ("01", "Popular", 1, 0.8, 0.9),
    ("02", "Santa Cruz", 1, 0.9, 0.95),
    ("03", "Manrique", 2, 0.7, 1.0),
    ("04", "Aranjuez", 2, 0.6, 1.05),
    ("05", "Castilla", 2, 0.8, 1.0),
    ("06", "Doce de Octubre", 2, 0.5, 1.0),
    ("07", "Robledo", 2, 0.9, 0.9),
    ("08", "Villa Hermosa", 3, 0.7, 1.2),
    ("09", "Buenos Aires", 3, 0.9, 1.1),
    ("10", "La Candelaria", 4, 0.8, 1.5),
    ("11", "Laureles", 5, 0.8, 2.0),
    ("12", "La América", 2, 0.6, 1.2),
    ("13", "San Javier", 2, 0.6, 1.1),
    ("14", "El Poblado", 6, 0.8, 2.5),
    ("15", "Guayabal", 5, 0.8, 1.8),
    ("16", "Belén", 3, 0.7, 1.2),
]

# Tier 2 base values that the factors scale, and what a double miss gets.
DISTRICT_BASE_COUNT = 800
DISTRICT_BASE_VALUE = 150_000_000
DEFAULT_STRATUM = 2
DEFAULT_COUNT = 500
DEFAULT_VALUE = 150_000_000

# Area scaling of counts.
DEFAULT_AREA = 10_000.0
AREA_PER_BASE_COUNT = 100_000.0
MIN_COUNT = 50
SQUARE_METRES_PER_KM2 = 1_000_000.0

# Static neighbourhood table: name, latitude, longitude, stratum, average value, count, zone.
STATIC_NEIGHBOURHOODS = [
    ("El Poblado", 6.2094, -75.5671, 6, 450_000_000, 1498, "Centro Oriente"),
    ("Laureles", 6.2447, -75.5984, 5, 350_000_000, 1200, "Centro"),
    ("La Candelaria", 6.2442, -75.5812, 4, 280_000_000, 1276, "Centro"),
    ("Belen", 6.2294, -75.5671, 3, 220_000_000, 911, "Centro"),
    ("Envigado", 6.1895, -75.6100, 5, 380_000_000, 850, "Zona Sur"),
    ("Sabaneta", 6.1650, -75.6350, 4, 260_000_000, 720, "Zona Sur"),
    ("Itagui", 6.1450, -75.6550, 4, 240_000_000, 680, "Zona Sur"),
    ("La America", 6.2447, -75.5984, 2, 180_000_000, 600, "Centro Occidente"),
    ("Buenos Aires", 6.2514, -75.5494, 3, 200_000_000, 1314, "Centro Occidente"),
    ("Castilla", 6.2914, -75.5494, 2, 160_000_000, 876, "Centro Occidente"),
    ("Doce de Octubre", 6.2914, -75.5494, 2, 150_000_000, 376, "Centro Occidente"),
    ("Robledo", 6.2714, -75.5494, 2, 140_000_000, 1210, "Centro Occidente"),
    ("Villa Hermosa", 6.2714, -75.5494, 3, 210_000_000, 842, "Centro Occidente"),
    ("Manrique", 6.2714, -75.5494, 2, 130_000_000, 1084, "Nororiental"),
    ("Popular", 6.2914, -75.5494, 1, 100_000_000, 1100, "Nororiental"),
    ("Santa Cruz", 6.2914, -75.5494, 1, 110_000_000, 1391, "Nororiental"),
    ("San Javier", 6.2514, -75.5494, 2, 170_000_000, 608, "Noroccidental"),
    ("Aranjuez", 6.2814, -75.5494, 2, 160_000_000, 568, "Noroccidental"),
    ("Guayabal", 6.2094, -75.5671, 4, 320_000_000, 1461, "Suroccidental"),
    ("San Alejo", 6.2200, -75.5500, 3, 190_000_000, 450, "Centro"),
]

# Marker radius: base and span of each map style.
MARKER_LARGE = (300.0, 1200.0)
MARKER_SMALL = (200.0, 800.0)

# Heat layer: one point per this many counted rows, spread of the points, weight divisor.
HEAT_ROWS_PER_POINT = 100
HEAT_SPREAD = 0.02
HEAT_WEIGHT_DIVISOR = 5.0

# Jitter of markers placed around one centre: spread and centre (latitude, longitude).
CENTRE_SPREAD = 0.05
CENTRE = (6.2442, -75.5812)

# Sample data: stratum weights, value ranges, building types, share of types when weighted.
SAMPLE_STRATUM_WEIGHTS = {1: 0.15, 2: 0.20, 3: 0.25, 4: 0.20, 5: 0.15, 6: 0.05}
SAMPLE_VALUE_RANGE = (50_000_000.0, 500_000_000.0)
SAMPLE_AREA_RANGE = (50.0, 500.0)
SAMPLE_SCORE_RANGE = (1, 100)
SAMPLE_GROUP_ROWS = (150, 1500)
SAMPLE_TYPES = ["Residencial", "Comercial", "Mixto", "Industrial"]
