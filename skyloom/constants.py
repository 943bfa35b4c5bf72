"""Fixed values shared by the operators.

Each block marked "fixed values" must be kept as it is for results to agree with
flight tables built earlier; everything else in the package is a parameter.
"""

from __future__ import annotations

from datetime import date

# Airports served, by kind of airport.
PARIS_AIRPORTS = ("CDG", "ORY")
REGIONAL_AIRPORTS = ("LYS", "NCE", "MRS", "TLS")
AIRPORTS = ("CDG", "LYS", "MRS", "NCE", "ORY", "TLS")

# City names used by weather files -> IATA code.
CITY_TO_IATA = {
    "MARSEILLE": "MRS",
    "ORLY": "ORY",
    "NICE": "NCE",
    "TOULOUSE": "TLS",
    "LYON": "LYS",
}

# Statuses for which a revised time counts as the actual time.
FINAL_STATUSES = ("arrived", "departed", "landed")

# Thresholds.
LATE_AFTER_MINUTES = 15
CONGESTION_OVER_PERCENT = 20.0
# The batch build of the history table flags congestion earlier.
CONGESTION_OVER_PERCENT_BATCH = 10.0
MATCH_TOLERANCE_MINUTES = 30
RISK_MEDIUM_FROM = 30
RISK_HIGH_FROM = 60

# WMO weather codes.
FOG_CODES = (45, 48)
FREEZING_RAIN_CODES = (56, 57, 66, 67)
THUNDERSTORM_CODES = (95, 96, 97, 98, 99)

# Words that stand for a missing value.
PLACEHOLDERS = ("none", "null", "unknown", "missing", "nan", "undefined")
MISSING_DELAY_WORDS = ("", "nan", "none", "missing value")

# Column names with a special role when a table is purged.
FLIGHT_KEYS = ("flight_number", "flight_date", "airport_origin", "airport_destination")
PROTECTED_WORDS = ("delay", "retard", "target")
TRANSFORM_KEEP = ("scheduled_departure", "scheduled_arrival", "movement_date", "status")
LEAKAGE_COLUMNS = ("departure_delay_min", "arrival_delay_min", "time_dep", "time_arr")
ESTIMATE_COLUMNS = (
    "actual_arrival", "actual_departure", "actual_source_arrival", "actual_source_departure",
    "departure_delay_min", "departure_advance_min", "estimated_departure", "estimated_arrival",
)
FEATURE_DATE_COLUMNS = ("flight_date", "scheduled_departure_dep", "scheduled_arrival_arr")

# Generation stamp written in the first data row of older CSV files.
GENERATION_STAMP = "DATE_GENERATION"

# Words that announce a strike.
STRIKE_KEYWORDS = (
    "grève", "greve", "strike", "walkout", "arrêt de travail", "arret de travail",
    "mouvement social", "social movement", "débrayage", "debrayage",
)

# Names under which the news write of each airport.
AIRPORT_ALIASES = {
    "LYON": (
        "lyon", "saint-exupéry", "saint exupery", "lys",
        "aéroport lyon", "aeroport lyon", "lyon airport",
    ),
    "TOULOUSE": (
        "toulouse", "blagnac", "tls",
        "aéroport toulouse", "aeroport toulouse", "toulouse airport",
    ),
    "NICE": (
        "nice", "côte d'azur", "cote d azur", "nce",
        "aéroport nice", "aeroport nice", "nice airport",
    ),
    "MARSEILLE": (
        "marseille", "provence", "mrs",
        "aéroport marseille", "aeroport marseille", "marseille airport",
    ),
    "CDG": (
        "charles-de-gaulle", "charles de gaulle", "roissy", "cdg",
        "paris-charles-de-gaulle", "paris charles de gaulle",
    ),
    "ORLY": ("orly", "ory", "paris-orly", "paris orly"),
}

# Letters folded when text is compared.
FOLD_FROM = "éèêëàâäîïôöùûüç"
FOLD_TO = "eeeeaaaiioouuuc"

# Cities of the calendar, in the order they are listed, and their column.
CALENDAR_CITIES = {
    "PARIS": "Vacances PRS",
    "NICE": "Vacances NCE",
    "TOULOUSE": "Vacances TLS",
    "MARSEILLE": "Vacances MRS",
    "LYON": "Vacances LYS",
}

# School zone of each city.
SCHOOL_ZONES = {"PARIS": "C", "TOULOUSE": "C", "NICE": "B", "MARSEILLE": "B", "LYON": "A"}

# School holidays by zone, first and last day included.
SCHOOL_PERIODS = {
    "C": (
        ("Vacances de Noël", date(2024, 12, 21), date(2025, 1, 5)),
        ("Vacances d'hiver (février)", date(2025, 2, 22), date(2025, 3, 9)),
        ("Vacances de printemps", date(2025, 4, 19), date(2025, 5, 4)),
        ("Pont de l'Ascension", date(2025, 5, 30), date(2025, 5, 31)),
        ("Vacances d'été", date(2025, 7, 6), date(2025, 8, 31)),
        ("Vacances de Noël", date(2025, 12, 20), date(2026, 1, 4)),
        ("Vacances d'hiver (février)", date(2026, 2, 21), date(2026, 3, 8)),
        ("Vacances de printemps", date(2026, 4, 18), date(2026, 5, 3)),
        ("Pont de l'Ascension", date(2026, 5, 15), date(2026, 5, 17)),
    ),
    "B": (
        ("Vacances de Noël", date(2024, 12, 21), date(2025, 1, 5)),
        ("Vacances d'hiver (février)", date(2025, 2, 15), date(2025, 3, 2)),
        ("Vacances de printemps", date(2025, 4, 12), date(2025, 4, 27)),
        ("Pont de l'Ascension", date(2025, 5, 30), date(2025, 5, 31)),
        ("Vacances d'été", date(2025, 7, 6), date(2025, 8, 31)),
        ("Vacances de Noël", date(2025, 12, 20), date(2026, 1, 4)),
        ("Vacances d'hiver (février)", date(2026, 2, 14), date(2026, 3, 1)),
        ("Vacances de printemps", date(2026, 4, 11), date(2026, 4, 26)),
        ("Pont de l'Ascension", date(2026, 5, 15), date(2026, 5, 17)),
    ),
    "A": (
        ("Vacances de Noël", date(2024, 12, 21), date(2025, 1, 5)),
        ("Vacances d'hiver (février)", date(2025, 2, 8), date(2025, 2, 23)),
        ("Vacances de printemps", date(2025, 4, 5), date(2025, 4, 21)),
        ("Pont de l'Ascension", date(2025, 5, 30), date(2025, 5, 31)),
        ("Vacances d'été", date(2025, 7, 6), date(2025, 8, 31)),
        ("Vacances de Noël", date(2025, 12, 20), date(2026, 1, 4)),
        ("Vacances d'hiver (février)", date(2026, 2, 7), date(2026, 2, 22)),
        ("Vacances de printemps", date(2026, 4, 4), date(2026, 4, 20)),
        ("Pont de l'Ascension", date(2026, 5, 15), date(2026, 5, 17)),
    ),
}
SUMMER_LABEL = "Vacances d'été"

# Public holidays on a fixed day (month, day) and counted from Easter (days).
FIXED_HOLIDAYS = (
    (1, 1, "Jour de l'an"),
    (5, 1, "Fête du Travail"),
    (5, 8, "Victoire 1945"),
    (7, 14, "Fête nationale"),
    (8, 15, "Assomption"),
    (11, 1, "Toussaint"),
    (11, 11, "Armistice 1918"),
    (12, 25, "Noël"),
)
EASTER_HOLIDAYS = ((1, "Lundi de Pâques"), (39, "Ascension"), (50, "Lundi de Pentecôte"))
