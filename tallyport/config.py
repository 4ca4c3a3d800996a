"""Rule lists, profiles and lookups that decide what a report contains."""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- Fixed values: they must read exactly like this for results to be right. ---

MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# request type code -> label; any other code has no label
REQUEST_LABELS = {1: "prévisualisation", 2: "téléchargement", 3: "téléchargement"}

# LIKE pattern -> class, first match wins; a name that matches none has no class
SOURCE_RULES = (
    ("%histo_actions%", "Stocks"),
    ("%actions_%", "Stocks"),
    ("%indices_telekurs%", "Global\\Market Indices"),
    ("%histo_indices_telekurs%", "Global\\Market Indices"),
    ("%indices_eurofidai%", "Eurofidai Indices"),
    ("%histo_indices_eurofidai%", "IEurofidai Indices"),
    ("%corres_code%", "Code Mapping Table"),
    ("%fonds_mutuel_%", "Mutual Funds"),
    ("%change%", "Spot Exchange Rate"),
    ("%histo_ost%", "Corporate Events"),
    ("ost%", "Corporate Events"),
    ("%esg%", "ESG"),
    ("%greenbonds%", "Green Bonds"),
)

SEARCH_PATTERN = "%histo%"
SEARCH_LABEL = "Search_Code"
EXTRACT_LABEL = "Extract_Data"

UNKNOWN_USER = "Unknown User"
UNKNOWN_INSTITUTION = "Unknown Institution"

# columns shown on report pages, by file; files not listed show all of theirs
REPORT_COLUMNS = {
    "stats_all_users_with_subscription_informations.csv": (
        "id_user", "user_name", "labo_name", "statut", "date_last_access", "date_created",
    ),
}

CONTINENTS = {
    "eu": (
        "Germany", "United Kingdom", "Austria", "Belgium", "Bosnia and Herzegovina", "Bulgaria",
        "Cyprus", "Croatia", "Denmark", "Spain", "Estonia", "Finland", "France", "Greece",
        "Hungary", "Ireland", "Iceland", "Italy", "Latvia", "Lithuania", "Luxembourg",
        "Macedonia", "Malta", "Norway", "Netherlands", "Poland", "Portugal", "Romania",
        "Russian Federation", "Serbia", "Slovakia", "Slovenia", "Sweden", "Switzerland",
        "Turkey", "Ukraine", "Czech Republic",
    ),
    "as": (
        "Australia", "Bahrain", "Bangladesh", "China", "Hong Kong", "India", "Indonesia",
        "Israel", "Japan", "Jordan", "Kazakhstan", "Kuwait", "Laos", "Lebanon", "Malaysia",
        "Nepal", "New Zealand", "Oman", "Pakistan", "Philippines", "Qatar", "Saudi Arabia",
        "Singapore", "South Korea", "Sri Lanka", "Taiwan Province of China", "Thailand",
        "United Arab Emirates", "Viet Nam",
    ),
    "am": (
        "Argentina", "Barbados", "Brazil", "Cayman Islands", "Chile", "Colombia", "Ecuador",
        "El Salvador", "Jamaica", "Mexico", "Panama", "Peru", "Trinidad and Tobago", "Uruguay",
        "Venezuela",
    ),
    "af": (
        "Botswana", "Ivory Coast", "Egypt", "Ghana", "Kenya", "Malawi", "Mauritius", "Morocco",
        "Namibia", "Nigeria", "South Africa", "Tanzania, United Republic of", "Tunisia",
        "Uganda", "Zambia", "Zimbabwe",
    ),
}

INSTRUMENT_CODES = {"actions": 2, "indices": 7, "fonds": 3}
PRICE_TABLES = {
    "actions": "src_cours_actions",
    "indices": "src_cours_indices",
    "fonds": "src_cours_fonds",
}

_STAFF_GROUPS = ("EUROFIDAI", "administrateur Drupal")
_STAFF_USERS = (1178, 1922, 367, 274)


# --- Profiles ---

@dataclass(frozen=True)
class Profile:
    """What a report leaves out and which years it covers.

    ``years`` wins over ``first_year``; with neither, every year is kept. By default nothing is left out: the
    portal's own groups and accounts belong to its profiles below, not to the class.
    """

    excluded_groups: tuple[str, ...] = ()
    excluded_users: tuple[int, ...] = ()
    excluded_subscriber_institutions: tuple[str, ...] = ()
    excluded_subscribers: tuple[int, ...] = ()
    require_institution: bool = True
    years: tuple[int, ...] | None = None
    first_year: int | None = None
    institution: str | None = None


#: per-institution statistics
PORTAL = Profile(
    excluded_groups=_STAFF_GROUPS,
    excluded_users=_STAFF_USERS + (594, 896, 904),
    excluded_subscriber_institutions=_STAFF_GROUPS + ("probesys2 probesys",),
    excluded_subscribers=_STAFF_USERS,
    first_year=2020,
)

#: the same without a year bound; years are chosen per institution afterwards
OPEN_YEARS = replace(PORTAL, first_year=None)

#: the earlier rules: fewer excluded users, unknown institutions stay in
LEGACY = replace(PORTAL, excluded_users=_STAFF_USERS, require_institution=False)

#: monthly workbook tables
WORKBOOK = Profile(
    excluded_groups=_STAFF_GROUPS,
    excluded_users=(1178, 1922, 367),
    excluded_subscriber_institutions=_STAFF_GROUPS,
    excluded_subscribers=(1178, 1922, 367),
    require_institution=False,
    years=(2021, 2022, 2023, 2024, 2025),
    first_year=None,
)
