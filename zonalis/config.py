"""Fixed values of the property-market model.

Everything here is data, not logic. Every operator takes these tables as
arguments, so another market only needs other values.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class City:
    name: str
    tier: int
    n_clusters: int
    lat: tuple[float, float]
    lng: tuple[float, float]


# Cities, tier, suggested number of zones, bounding box.
CITIES = (
    City("Santa Cruz de la Sierra", 1, 10, (-18.5, -17.0), (-64.0, -62.5)),
    City("Cochabamba", 1, 6, (-17.8, -17.2), (-66.5, -65.8)),
    City("La Paz", 1, 5, (-16.8, -16.3), (-68.3, -67.8)),
    City("Porongo", 2, 1, (-17.9, -17.5), (-63.6, -63.2)),
    City("El Alto", 2, 1, (-16.6, -16.4), (-68.3, -68.0)),
    City("Oruro", 2, 1, (-18.1, -17.8), (-67.2, -67.0)),
    City("Tiquipaya", 2, 1, (-17.4, -17.2), (-66.3, -66.1)),
    City("Sacaba", 2, 1, (-17.5, -17.3), (-65.9, -65.7)),
    City("Sucre", 2, 1, (-19.2, -18.9), (-65.4, -65.1)),
    City("La Guardia", 2, 1, (-17.9, -17.7), (-63.4, -63.2)),
    City("Warnes", 2, 1, (-17.6, -17.4), (-63.3, -63.1)),
    City("Quillacollo", 2, 1, (-17.5, -17.3), (-66.3, -66.1)),
    City("Samaipata", 2, 1, (-18.3, -18.1), (-63.9, -63.7)),
    City("Cotoca", 2, 1, (-17.9, -17.7), (-63.1, -62.9)),
    City("Potosí", 2, 1, (-19.7, -19.4), (-65.9, -65.6)),
)

COUNTRY = "Bolivia"


@dataclass(frozen=True)
class Deal:
    """One kind of transaction and the status ids that mark it closed."""

    type_id: int
    closed_status_id: int
    label: str
    closed_status: str
    # Where the price of the zone mean comes from: the listing, or the transaction of a listing that is closed.
    listed_price: bool = False


# Transaction types with their closed status.
DEALS = (
    Deal(1, 8, "Venta", "Venta Aceptada/Vendida", listed_price=True),
    Deal(2, 7, "Alquiler", "Alquilado"),
)
ACTIVE_STATUS = "Activa"
CLOSED_TRANSACTION_STATUS_IDS = (2, 5)
SALE_YEARS = (2024, 2025, 2026)

# Property subtype -> property type.
SUBTYPE_TO_TYPE = {
    "Casa": "Casa",
    "Casa de Calidad": "Casa",
    "Casa de Campo": "Casa",
    "Casa con Espacio Comercial": "Casa",
    "Departamento": "Departamento",
    "Dúplex": "Departamento",
    "Penthouse": "Departamento",
    "Estudio/Monoambiente": "Departamento",
    "Condominio / Departamento": "Departamento",
    "Apartamento con servicio de hotel": "Departamento",
    "Local Comercial": "Local Comercial",
    "Comercial/Negocio": "Local Comercial",
    "Oficina": "Oficina",
    "Baulera": "Otro",
    "Clínica de salud": "Otro",
    "Edificio": "Otro",
    "Edificio de apartamentos entero": "Otro",
    "Edificio/Construcción": "Otro",
    "Galpon": "Otro",
    "Garaje/Baulera": "Otro",
    "Hotel/Edificio de apartamentos": "Otro",
    "Quinta": "Otro",
    "Otros": "Otro",
    "Propiedad Agrícola/Ganadera": "Propiedad Agrícola/Ganadera",
    "Terreno": "Terreno",
    "Terreno Comercial": "Terreno",
}
DEFAULT_TYPE = "Otro"
DEPARTMENT = "Departamento"
HOUSE = "Casa"
LAND = "Terreno"

# Required fields per property type and the reason text per field.
REQUIRED_FIELDS = {
    "Casa": ("construction_area_m", "land_m2", "dormitorios", "banos"),
    "Departamento": ("construction_area_m", "dormitorios", "banos"),
    "Terreno": ("total_area",),
}
FIELD_REASONS = {
    "construction_area_m": "m2_construidos nulo o 0",
    "land_m2": "m2_terreno nulo o 0",
    "total_area": "m2_total nulo o 0",
    "dormitorios": "dormitorios nulo o 0",
    "banos": "baños nulo o 0",
}

# Reject reasons.
REASON_DUPLICATE = "duplicado"
REASON_AREA = "m2_construidos <= 0 o nulo"
REASON_PRICE_OUTLIER = "outlier precio_cierre"
REASON_AREA_OUTLIER = "outlier m2_construidos"
REASON_FLOOR = {
    "Venta": "precio menor mínimo venta",
    "Alquiler": "precio menor mínimo alquiler",
}

# Lowest accepted listing price per (transaction, type).
PRICE_FLOORS = {
    "Venta": {
        "Casa": 50000,
        "Departamento": 30000,
        "Terreno": 10000,
        "Local Comercial": 20000,
        "Oficina": 20000,
        "Otro": 10000,
        "Propiedad Agrícola/Ganadera": 10000,
    },
    "Alquiler": {
        "Casa": 500,
        "Departamento": 800,
        "Local Comercial": 500,
        "Oficina": 500,
        "Otro": 500,
        "Propiedad Agrícola/Ganadera": 500,
    },
}

# Outlier rule, bbox margin, price window, minimum zone points.
OUTLIER_SIGMAS = 3.0
OUTLIER_MIN_VALUES = 4
BBOX_MARGIN = 0.2
PRICE_WINDOW_MONTHS = 6
MIN_ZONE_POINTS = 5

# Inclusive integer limits of the analytics table.
INTEGER_LIMITS = {
    "mes_publicacion": (1, 12),
    "anio_publicacion": (1900, 2100),
    "dormitorios": (0, 50),
    "banos": (0, 50),
    "estacionamientos": (0, 200),
    "antiguedad": (0, 200),
    "tiempo_en_mercado": (0, 2147483647),
    "numero_reducciones": (0, 2147483647),
    "cluster_zona": (0, 32767),
}

# The loaded columns of the analytics table, in order.
ANALYTICS_COLUMNS = (
    "id_propiedad", "mlsid", "tipo_propiedad", "subtipo_original",
    "categoria_propiedad", "estado_propiedad", "segmento", "tipo_transaccion",
    "latitude", "longitude", "cluster_zona", "ciudad",
    "m2_construidos", "m2_terreno",
    "dormitorios", "banos", "estacionamientos", "antiguedad",
    "precio_publicacion", "precio_venta", "precio_alquiler_mes", "precio_m2",
    "tiempo_en_mercado", "numero_reducciones",
    "diferencia_vs_promedio_zona", "ratio_activas_vendidas_zona",
    "mes_publicacion", "anio_publicacion", "fecha_venta",
    "status", "transaction_type",
)

# Columns an upsert overwrites on an existing property.
UPSERT_COLUMNS = (
    "precio_publicacion", "precio_venta", "precio_alquiler_mes", "precio_m2",
    "tiempo_en_mercado", "cluster_zona", "tipo_transaccion",
    "diferencia_vs_promedio_zona", "ratio_activas_vendidas_zona",
    "numero_reducciones", "status",
)

# Constraints of the analytics table.
ANALYTICS_NOT_NULL = ("id_propiedad", "tipo_propiedad", "tipo_transaccion", "ciudad")
ANALYTICS_KEY = "id_propiedad"

# Model types, features, targets, clamps and defaults.
_BASE_FEATURES = (
    "cluster_zona", "m2_construidos", "dormitorios", "banos", "antiguedad",
    "tiempo_en_mercado", "mes_publicacion",
    "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona",
)
MODEL_FEATURES = {
    "Casa": _BASE_FEATURES + ("estacionamientos", "m2_terreno"),
    "Departamento": _BASE_FEATURES + ("estacionamientos",),
    "Terreno_urbano": ("cluster_zona", "m2_terreno", "mes_publicacion",
                       "ratio_activas_vendidas_zona", "diferencia_vs_promedio_zona"),
    "Terreno_rural": ("cluster_zona", "m2_terreno", "mes_publicacion",
                      "ratio_activas_vendidas_zona"),
}
MODEL_TARGET = {
    "Casa": "precio_venta",
    "Departamento": "precio_venta",
    "Terreno_urbano": "precio_m2",
    "Terreno_rural": "precio_m2",
}
URBAN_LAND_LIMIT_M2 = 1000.0
FEATURE_CLAMPS = {
    "diferencia_vs_promedio_zona": (-2.0, 2.0),
    "ratio_activas_vendidas_zona": (0.0, 10.0),
}
REQUEST_DEFAULTS = {
    "m2_construidos": 0.0, "m2_terreno": 0.0, "dormitorios": 0.0, "banos": 0.0,
    "antiguedad": 0.0, "tiempo_en_mercado": 30.0, "mes_publicacion": 3.0,
    "estacionamientos": 0.0,
}
MIN_TRAINING_ROWS = 50
TARGET_MAPE = 12.0
PRICE_BAND = 0.12
CURRENCY = "BOB"
MODEL_VERSION = "1.0.0"
TREES = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05,
         "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}


@dataclass(frozen=True)
class RoadRule:
    """A road name to look for: the whole name, or a part of it."""

    name: str
    exact: bool = True
    lat: tuple[float, float] | None = None
    lng: tuple[float, float] | None = None


@dataclass(frozen=True)
class RoadCategory:
    key: str
    label: str
    color: str
    weight: int
    rules: tuple[RoadRule, ...] = field(default_factory=tuple)


def _whole(*names: str) -> tuple[RoadRule, ...]:
    return tuple(RoadRule(n) for n in names)


def _part(*names: str) -> tuple[RoadRule, ...]:
    return tuple(RoadRule(n, exact=False) for n in names)


# Road categories with their rules in order of preference.
ROAD_CATEGORIES = (
    RoadCategory("conexion_nacional", "Conexión Nacional/Regional", "#DC2626", 5, _whole(
        "Avenida Grigotá", "Doble Vía Santa Cruz - La Guardia", "Avenida Virgen de Cotoca",
        "Avenida Cristo Redentor", "Avenida G77",
    )),
    RoadCategory("anillos_principales", "Anillos Principales (1ro–4to)", "#EA580C", 4, (
        *_whole(
            "Avenida Uruguay", "Avenida Cañoto", "Avenida Irala", "Avenida Argomosa",
            "Avenida El Trompillo", "Avenida Viedma", "Avenida Santa Cruz",
            "Avenida Cristóbal de Mendoza", "Avenida 26 de febrero",
        ),
        *_part("Tercer Anillo"),
        *_whole("Avenida Roque Aguilera", "Avenida Noel Kempff"),
        RoadRule("Avenida Noel Kempff Mercado", True, (-17.81, -17.74), (-63.21, -63.15)),
        RoadRule("Avenida Juan Pablo II", True, (-17.81, -17.79), (-63.17, -63.15)),
        *_part("Cuarto Anillo"),
        *_whole("Avenida Antonio Vaca Diez", "Avenida Marcelo Terceros Bánzer"),
    )),
    RoadCategory("anillos_expansion", "Anillos Expansión (5to–8vo)", "#F59E0B", 3, _part(
        "Quinto Anillo", "Sexto Anillo", "Séptimo Anillo", "Octavo Anillo", "Noveno Anillo",
    )),
    RoadCategory("primarias", "Avenidas Primarias", "#2563EB", 4, _whole(
        "Avenida San Martín", "Avenida Busch", "Avenida Beni", "Avenida Alemania",
        "Avenida Mutualista", "Avenida Santos Dumont", "Avenida Roca y Coronado",
        "Avenida Piraí", "Avenida San Aurelio", "Avenida Irala", "Avenida Cañoto",
        "Avenida Paraguá", "Avenida Guapay", "Avenida Brasil", "Avenida Intermodal",
        "Avenida 3 Pasos al frente", "Avenida Centenario", "Avenida La Salle", "Radial 21",
        "Avenida El Palmar", "Avenida Ovidio Barbery Justiniano", "Radial 17 1/2",
        "Radial 27", "Avenida Hernando Sanabria", "Avenida Landivar",
        "Avenida Prefecto Rivas", "Avenida Escuadrón Velasco", "Avenida Monseñor Rivero",
        "Avenida Trinidad", "Avenida Suárez Arana", "Avenida Charcas",
        "Avenida Melchor Pinto", "Avenida Argentina", "Avenida Francisco Velarde",
        "Avenida Omar Chávez Ortiz", "Radial 13", "Avenida Coronel Maximiliano España",
        "Avenida El Trillo", "Avenida Moscú", "Avenida Radial 10", "Avenida Internacional",
        "Radial 16", "Radial 26", "Avenida José Benjamín Burela Justiniano",
        "Avenida Capitán Alfredo Higazy", "Avenida Marcelo Quiroga Santa Cruz",
        "Avenida Adolfo Román Hijo", "Avenida Mariscal Santa Cruz", "Avenida Totaí",
        "Avenida Miguel de Cervantes", "Avenida Pedro Casais", "Avenida Olímpica",
        "Avenida hilandería", "Calle Diamante",
    )),
    RoadCategory("plan_3000", "Plan 3.000 (D-8)", "#7C3AED", 3, _part(
        "Paurito", "Mechero", "La Campana", "Plan Tres Mil",
        "Monseñor Nicolás Castellanos Franco", "Palmar Viruez", "El Quior",
    )),
    RoadCategory("villa", "Villa 1ro de Mayo (D-7)", "#059669", 3, _part(
        "Cumavi", "Tres Pasos al Frente", "16 de Julio", "General Campero", "Arroyito",
    )),
    RoadCategory("pampa", "Pampa de la Isla (D-6)", "#0891B2", 3, _part(
        "Virgen de Luján", "Montecristo", "Las Orquídeas",
    )),
    RoadCategory("zona_sur", "Los Lotes / Zona Sur (D-9/D-12)", "#BE185D", 3, _whole(
        "Avenida Prolongacion Bolivia", "Avenida El Palmar del Oratorio",
        "Avenida Blooming", "Avenida El Fuerte", "Avenida 4 de Octubre",
    )),
)
