"""Fixed values every query relies on.

They are part of the domain (places, designators, colours, thresholds), so they
are stated as plain text, in their natural order.  Order matters where noted.
"""

from __future__ import annotations

# Monitored box, degrees, inclusive at every edge.
BOX = {"lat_min": 12.0, "lat_max": 37.5, "lon_min": 31.0, "lon_max": 63.3}

# Fixed values: (code, latitude, longitude). On equal distance the first listed wins.
AIRPORTS = [
    ("DXB", 25.2532, 55.3657),
    ("DOH", 25.2731, 51.6081),
    ("RUH", 24.9576, 46.6988),
    ("JED", 21.6796, 39.1565),
    ("AUH", 24.4330, 54.6511),
    ("KWI", 29.2266, 47.9689),
    ("BAH", 26.2708, 50.6336),
    ("MCT", 23.5933, 58.2844),
    ("CAI", 30.1219, 31.4056),
    ("AMM", 31.7226, 35.9932),
    ("BEY", 33.8209, 35.4884),
    ("TLV", 32.0055, 34.8854),
    ("BGW", 33.2625, 44.2346),
    ("DAM", 33.4114, 36.5156),
    ("IKA", 35.4161, 51.1522),
]
NO_REGION = "OTHER"
MAX_REGION_KM = 150.0
EARTH_RADIUS_KM = 6371.0

# Callsign prefix -> operator.
AIRLINE_BY_PREFIX = {
    "UAE": "Emirates",
    "ETD": "Etihad Airways",
    "QTR": "Qatar Airways",
    "SVA": "Saudia",
    "GFA": "Gulf Air",
    "KAC": "Kuwait Airways",
    "OMA": "Oman Air",
    "FDB": "flydubai",
    "ABY": "Air Arabia",
    "XY": "flynas",
    "MSC": "Air Cairo",
    "PIA": "Pakistan International",
    "AIC": "Air India",
    "IGO": "IndiGo",
    "SIA": "Singapore Airlines",
    "THY": "Turkish Airlines",
    "MSR": "EgyptAir",
    "RJA": "Royal Jordanian",
    "MEA": "Middle East Airlines",
    "UAL": "United Airlines",
    "AAL": "American Airlines",
    "DAL": "Delta Air Lines",
    "BAW": "British Airways",
    "DLH": "Lufthansa",
    "AFR": "Air France",
    "KLM": "KLM",
    "AFL": "Aeroflot",
    "ANA": "All Nippon Airways",
    "JAL": "Japan Airlines",
    "CCA": "Air China",
    "CPA": "Cathay Pacific",
    "UPS": "UPS Airlines",
    "FDX": "FedEx Express",
    "CKS": "Kalitta Air",
}
AIRLINE_UNKNOWN = "Unknown / private"
AIRLINE_OTHER = "Other"

# Operator colours, in categorical order; everything else is grey.
AIRLINE_COLOURS = {
    "Emirates": "#2a78d6",
    "Etihad Airways": "#eb6834",
    "Qatar Airways": "#1baf7a",
    "Saudia": "#eda100",
    "Air India": "#e87ba4",
    "Pakistan International": "#008300",
    "Turkish Airlines": "#4a3aa7",
    "Singapore Airlines": "#e34948",
}
OTHER_COLOUR = "#898781"
MAP_COLOURED_AIRLINES = 3  # a map shows colours for the first three only

# Fixed values: (name, lat_min, lat_max, lon_min, lon_max). The first match wins.
ZONES = [
    ("Iran", 25.0, 39.8, 44.0, 63.3),
    ("Iraq", 29.1, 37.4, 38.8, 48.6),
    ("Yemen", 12.1, 19.0, 42.5, 54.5),
]
ZONE_FILL = {
    "Iran": [208, 59, 59, 60],
    "Iraq": [208, 59, 59, 60],
    "Yemen": [236, 131, 90, 60],
}

# Operators whose routes avoid the zones.
AFFECTED_AIRLINES = [
    "Emirates",
    "Etihad Airways",
    "Qatar Airways",
    "Air India",
    "Pakistan International",
    "Saudia",
    "Gulf Air",
    "Kuwait Airways",
    "Turkish Airlines",
    "Singapore Airlines",
]
FUEL_USD_PER_HOUR = 5000
OPERATING_USD_PER_HOUR = 6000
DETOUR_MINUTES_LOW = 45
DETOUR_MINUTES_HIGH = 120

# Scoring.
BUCKET_MINUTES = 5
MIN_BASELINE_BUCKETS = 12
MAX_BASELINE_BUCKETS = 288
STD_FLOOR = 1.0
TIERS = [(1.5, "normal"), (2.5, "warning"), (3.5, "serious")]
TOP_TIER = "critical"
NO_BASELINE = "insufficient_baseline"
ALERT_STATUSES = ["warning", "serious", "critical"]
SEVERITY_ORDER = ["critical", "serious", "warning", "normal", "insufficient_baseline"]

# Status colours for charts, and red/green/blue/alpha for map halos.
STATUS_COLOURS = {
    "normal": "#0ca30c",
    "warning": "#fab219",
    "serious": "#ec835a",
    "critical": "#d03b3b",
}
HALO_RGBA = {
    "critical": [208, 59, 59, 140],
    "serious": [236, 131, 90, 140],
    "warning": [250, 178, 25, 140],
    "normal": [12, 163, 12, 60],
    "insufficient_baseline": [137, 135, 129, 50],
}
STATUS_ICONS = {"normal": "✓", "warning": "⚠", "serious": "⚠", "critical": "✖"}
UNKNOWN_ICON = "•"

# Conflict events.
MIN_QUAD_CLASS = 3
SEVERE_GOLDSTEIN = -7.0
MENTIONS_CAP = 50

# Unit factors and altitude bands (metres, right-closed).
FEET_PER_METRE = 3.28084
KNOTS_PER_METRE_SECOND = 1.94384
ALTITUDE_BANDS = [
    ("<10k ft", -1.0, 3000.0),
    ("10-30k ft", 3000.0, 9000.0),
    (">30k ft", 9000.0, 100000.0),
]

RETENTION_DAYS = 30
