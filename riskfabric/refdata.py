"""Reference values fixed by the source data model.

Everything below is a FIXED VALUE that must equal the upstream definitions for
results (codes, labels, weights, lookup keys) to match. Values are given as
plain text in their natural order. Larger mappings (ISO-3166 country lists,
full ISO3 -> region tables) are *data*: the caller supplies them as DataFrames
(see ``riskfabric.sources.dims``) instead of them being shipped here.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — dimension seeds
# ---------------------------------------------------------------------------

REGIONS = [
    ("EU_EUR", "Europe and Eurasia"),
    ("MENA", "Middle East and North Africa"),
    ("SSA", "Sub-Saharan Africa"),
    ("SCA", "South and Central Asia"),
    ("EAP", "East Asia and Pacific"),
    ("AME", "Americas"),
    ("GLO", "Global / Multilateral"),
]

# Display labels used by dashboards (code -> label, fallback to the code).
REGION_LABELS = [
    ("EU_EUR", "Europe & Eurasia"),
    ("MENA", "Middle East & N. Africa"),
    ("SSA", "Sub-Saharan Africa"),
    ("SCA", "South & Central Asia"),
    ("EAP", "East Asia & Pacific"),
    ("AME", "Americas"),
    ("GLO", "Global / Multilateral"),
]

# (code, display_name, url, access_method, coverage_start, coverage_end, notes)
SOURCE_SYSTEMS = [
    ("ACLED", "Armed Conflict Location and Event Data Project", "https://acleddata.com",
     "Download", "2017-01-20", None,
     "Loaded from local regional aggregate CSV snapshots in data/raw/acled"),
    ("ACLED_MANUAL", "ACLED manual KPI backfill", "https://acleddata.com/aggregated-data-files/",
     "Manual", "2026-02-16", "2026-02-16",
     "Manual weekly aggregates for Jan-Feb 2026 KPI backfill; event counts sourced from ACLED "
     "country-month summaries and fatalities estimated when monthly fatality totals were unavailable"),
    ("UCDP_GED", "UCDP Georeferenced Event Dataset v25.1", "https://ucdp.uu.se", "Download",
     "1989-01-01", "2024-12-31", "Annual release; 2025+ events require ACLED"),
    ("WORLD_BANK", "World Bank World Development Indicators", "https://api.worldbank.org", "API",
     "1960-01-01", None, "Free, no authentication required"),
    ("GDELT_DOC", "GDELT DOC 2.0 API", "https://api.gdeltproject.org", "API", "2017-01-01", None,
     "3-month API window; backfill batched by quarter"),
    ("OFAC_SDN", "OFAC Specially Designated Nationals List", "https://www.treasury.gov/ofac",
     "Download", None, None, "No original designation date in CSV; action_date is ingestion date"),
    ("SEED", "Curated event catalog from deep-research-report.md", None, "Manual", "2017-01-20", None,
     "Hand-maintained CSV; source of truth for major diplomatic milestones"),
]

# (event_type_code, label, source_system, parent_type)
EVENT_TYPES = [
    ("ACLED_BATTLES", "Battles", "ACLED", "Violent Events"),
    ("ACLED_EXPLOSIONS", "Explosions/Remote violence", "ACLED", "Violent Events"),
    ("ACLED_VIOLENCE_CIVILIANS", "Violence against civilians", "ACLED", "Violent Events"),
    ("ACLED_PROTESTS", "Protests", "ACLED", "Demonstrations"),
    ("ACLED_RIOTS", "Riots", "ACLED", "Demonstrations"),
    ("ACLED_STRATEGIC_DEV", "Strategic developments", "ACLED", "Non-violent"),
    ("UCDP_STATE_BASED", "State-based conflict", "UCDP_GED", None),
    ("UCDP_NON_STATE", "Non-state conflict", "UCDP_GED", None),
    ("UCDP_ONE_SIDED", "One-sided violence", "UCDP_GED", None),
]

# Quasi-country rows added after the ISO list: (iso3, iso2, name, region_code)
SPECIAL_COUNTRIES = [
    ("EUU", "EU", "European Union", "EU_EUR"),
    ("NAT", None, "NATO", "EU_EUR"),
    ("UNO", None, "United Nations", "GLO"),
    ("XKX", "XK", "Kosovo", "EU_EUR"),
    ("TWN", "TW", "Taiwan", "EAP"),
    ("PSE", "PS", "Palestinian Territories", "MENA"),
]

# Countries of each region when the country dimension is seeded.
SEEDED_REGION_COUNTRIES = [
    ("EU_EUR", "RUS UKR GBR DEU FRA POL FIN SWE NOR TUR AZE ARM GEO BLR MDA SRB KAZ UZB"),
    ("MENA", "ISR PSE IRN IRQ SYR SAU YEM LBN JOR EGY LBY TUN DZA MAR ARE OMN QAT KWT BHR"),
    ("SSA", "ETH SDN SSD SOM NGA MLI BFA NER TCD CAF COD MOZ ZAF KEN TZA UGA RWA ZWE COG CMR GNB GIN"),
    ("SCA", "AFG PAK IND BGD NPL LKA MMR"),
    ("EAP", "CHN TWN PRK KOR JPN PHL VNM MYS IDN THA AUS NZL SGP PNG"),
    ("AME", "USA MEX CAN VEN COL BRA ARG CHL PER BOL ECU CUB NIC HND GTM SLV HTI"),
]

# Countries of each region that the later back-fill assigns where none is stored.
BACKFILL_REGION_COUNTRIES = [
    ("EU_EUR", "ALB AND AUT BEL BGR BIH CHE CYP CZE DNK EST ESP FRO GGY GIB GRC GRL HRV HUN IMN IRL ISL ITA JEY "
               "KGZ LIE LTU LUX LVA MCO MKD MLT MNE NLD PRT ROU SJM SMR SVK SVN TJK TKM VAT ALA"),
    ("AME", "ABW AIA ATG BES BHS BLM BLZ BMU BRB CRI CUW CYM DMA DOM FLK GLP GRD GUF GUM GUY JAM KNA LCA MAF MNP "
            "MSR MTQ PAN PRI PRY SPM SUR SXM TCA TTO UMI URY VCT VGB VIR"),
    ("SSA", "AGO BDI BEN BWA CIV COM CPV ERI GAB GHA GMB GNQ LSO LBR MDG MRT MUS MWI MYT NAM REU SEN SHN SLE STP "
            "SWZ SYC TGO ZMB"),
    ("MENA", "DJI ESH"),
    ("SCA", "BTN MDV"),
    ("EAP", "ASM BRN CCK COK CXR FJI FSM HKG IOT KHM KIR LAO MAC MHL MNG NCL NFK NIU NRU PCN PLW PYF SLB TKL TLS "
            "TON TUV VUT WLF WSM"),
    ("GLO", "ATA ATF BVT HMD SGS"),
]

DATE_SPINE_START = "2010-01-01"
DATE_SPINE_END = "2030-12-31"

# ---------------------------------------------------------------------------
# FIXED VALUES — country-code resolution
# ---------------------------------------------------------------------------

# Lower-cased country-name overrides -> ISO3, checked before any ISO lookup.
NAME_OVERRIDES = [
    ("russia", "RUS"),
    ("iran", "IRN"),
    ("syria", "SYR"),
    ("venezuela", "VEN"),
    ("south korea", "KOR"),
    ("north korea", "PRK"),
    ("dprk", "PRK"),
    ("democratic republic of congo", "COD"),
    ("dr congo", "COD"),
    ("drc", "COD"),
    ("ivory coast", "CIV"),
    ("cote d'ivoire", "CIV"),
    ("taiwan", "TWN"),
    ("palestine", "PSE"),
    ("west bank and gaza", "PSE"),
    ("eu", "EUU"),
    ("european union", "EUU"),
    ("nato", "NAT"),
    ("un", "UNO"),
    ("united nations", "UNO"),
    ("bosnia-herzegovina", "BIH"),
    ("bosnia and herzegovina", "BIH"),
    ("south vietnam", "VNM"),
    ("north vietnam", "VNM"),
    ("democratic republic of vietnam", "VNM"),
    ("republic of vietnam", "VNM"),
    ("burma/myanmar", "MMR"),
    ("dr congo (zaire)", "COD"),
    ("republic of congo", "COG"),
    ("trinidad and tobago", "TTO"),
    ("united arab emirates", "ARE"),
    ("south sudan", "SSD"),
    ("central african republic", "CAF"),
    ("cape verde", "CPV"),
    ("guinea-bissau", "GNB"),
    ("sao tome and principe", "STP"),
    ("equatorial guinea", "GNQ"),
    ("western sahara", "ESH"),
    ("turkey", "TUR"),
    ("bailiwick of jersey", "JEY"),
    ("bailiwick of guernsey", "GGY"),
    ("caribbean netherlands", "BES"),
    ("akrotiri and dhekelia", "CYP"),
    ("czech republic", "CZE"),
    ("czechoslovakia", "CZE"),
    ("east timor", "TLS"),
    ("timor-leste", "TLS"),
    ("micronesia", "FSM"),
]

# News-source FIPS codes that differ from ISO alpha-2 (FIPS wins on clashes).
FIPS_EXTRA = [
    ("IZ", "IRQ"), ("IR", "IRN"), ("SY", "SYR"), ("RS", "RUS"),
    ("CH", "CHN"), ("KN", "PRK"), ("KS", "KOR"), ("UP", "UKR"),
    ("UK", "GBR"), ("FR", "FRA"), ("GM", "DEU"), ("IS", "ISR"),
    ("JA", "JPN"), ("PK", "PAK"), ("AF", "AFG"), ("IN", "IND"),
    ("LE", "LBN"), ("EG", "EGY"), ("SA", "SAU"), ("YM", "YEM"),
    ("SO", "SOM"), ("SU", "SDN"), ("LY", "LBY"), ("ET", "ETH"),
    ("ML", "MLI"), ("NI", "NER"), ("BK", "BFA"),
]

# Indicator-source non-standard alpha-2 codes.
WB_SPECIAL_CODES = [("KV", "XKX"), ("XK", "XKX")]

# Sanctions program code -> target ISO3, in lookup order. None = no single target
# (a match on such a key stops the prefix search with NULL).
SANCTION_PROGRAMS = [
    ("RUSSIA-EO14024", "RUS"),
    ("UKRAINE-EO13685", "RUS"),
    ("IRAN", "IRN"),
    ("IRAN2", "IRN"),
    ("NPWMD", None),
    ("SDGT", None),
    ("SYRIA", "SYR"),
    ("DPRK", "PRK"),
    ("DPRK2", "PRK"),
    ("DPRK3", "PRK"),
    ("DPRK4", "PRK"),
    ("VENEZUELA", "VEN"),
    ("VENEZUELA2", "VEN"),
    ("BURMA", "MMR"),
    ("BELARUS", "BLR"),
    ("SUDAN", "SDN"),
    ("IRAQ2", "IRQ"),
    ("LIBYA2", "LBY"),
    ("SOMALIA", "SOM"),
    ("YEMEN", "YEM"),
    ("GLOMAG", None),
    ("CYBER2", None),
]

# Conflict-event violence type code -> label.
VIOLENCE_TYPES = [
    (1, "state-based conflict"),
    (2, "non-state conflict"),
    (3, "one-sided violence"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — sources
# ---------------------------------------------------------------------------

# Indicator code -> indicator name, in load order.
INDICATORS = [
    ("SP.POP.TOTL", "population_total"),
    ("NY.GDP.PCAP.CD", "gdp_per_capita_usd"),
    ("MS.MIL.XPND.GD.ZS", "military_exp_pct_gdp"),
]
POPULATION_CODE = "SP.POP.TOTL"
MILITARY_CODE = "MS.MIL.XPND.GD.ZS"
INDICATOR_URL_PREFIX = "https://data.worldbank.org/indicator/"

ACLED_FILE_GLOB = "*_aggregated_data_up_to-*.csv"
ACLED_SUMMARY_PREFIX = "number_of_"
ACLED_REQUIRED = [
    "WEEK", "REGION", "COUNTRY", "ADMIN1", "EVENT_TYPE", "SUB_EVENT_TYPE", "EVENTS",
    "FATALITIES", "DISORDER_TYPE", "ID", "CENTROID_LATITUDE", "CENTROID_LONGITUDE",
]
ACLED_NOTE = "ACLED weekly aggregate (local CSV snapshot)"
ACLED_CIVILIAN_EVENT = "violence against civilians"

MANUAL_REQUIRED = ["country_iso3", "week_start", "event_type", "event_count", "fatalities_best"]
MANUAL_OPTIONAL = ["sub_event_type", "region_code", "source_url", "notes"]
MANUAL_WEEK_FIRST = "2026-01-01"
MANUAL_WEEK_LAST = "2026-02-28"

SDN_COLUMNS = [
    "ent_num", "sdn_name", "sdn_type", "program", "title", "call_sign", "vess_type",
    "tonnage", "grt", "vess_flag", "vess_owner", "remarks",
]
SDN_NULL_TOKEN = "-0-"
SDN_SOURCE_URL = "https://www.treasury.gov/ofac/downloads/sdn.csv"

NEWS_TIME_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
NEWS_TAGS_MAX = 500
INSTRUMENT_MAX = 255
NEWS_WINDOW_DAYS = 90

# ---------------------------------------------------------------------------
# FIXED VALUES — composite risk score
# ---------------------------------------------------------------------------

GRS_WEIGHTS = {
    "conflict": 0.45,       # split evenly between incident and fatality rates
    "sanctions": 0.20,
    "militarization": 0.15,
    "news_volume": 0.10,
    "news_tone": 0.10,
}
# Driver weights shown on per-driver contribution charts (sum 0.90; tone has none).
DRIVER_WEIGHTS = [
    ("conflict_incidents", 0.225),
    ("conflict_fatalities", 0.225),
    ("sanctions", 0.20),
    ("militarization", 0.15),
    ("news_tension", 0.10),
]
# Band thresholds: score < bound -> label; None -> "No data"; else "High".
GRS_BANDS = [(15, "Low"), (30, "Moderate"), (50, "Elevated")]
GRS_TOP_BAND = "High"
GRS_NO_DATA = "No data"
