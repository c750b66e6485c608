"""Fixed values that results depend on: lookup tables, word lists, bounds."""

# City -> ISO 3166 alpha-3 code, latitude, longitude.
CITIES = [
    ("Paris", "FRA", 48.85, 2.35),
    ("London", "GBR", 51.51, -0.13),
    ("Berlin", "DEU", 52.52, 13.41),
    ("Rome", "ITA", 41.89, 12.49),
    ("Madrid", "ESP", 40.42, -3.70),
    ("Vienna", "AUT", 48.21, 16.37),
    ("Amsterdam", "NLD", 52.37, 4.89),
    ("Brussels", "BEL", 50.85, 4.35),
    ("Lisbon", "PRT", 38.72, -9.14),
    ("Athens", "GRC", 37.98, 23.72),
    ("Oslo", "NOR", 59.91, 10.75),
    ("Stockholm", "SWE", 59.33, 18.06),
    ("Copenhagen", "DNK", 55.68, 12.57),
    ("Helsinki", "FIN", 60.17, 24.94),
    ("Dublin", "IRL", 53.35, -6.26),
    ("Warsaw", "POL", 52.23, 21.01),
    ("Prague", "CZE", 50.08, 14.43),
    ("Budapest", "HUN", 47.50, 19.04),
    ("Zurich", "CHE", 47.38, 8.54),
    ("Barcelona", "ESP", 41.38, 2.15),
    ("Milan", "ITA", 45.46, 9.19),
    ("Istanbul", "TUR", 41.01, 28.97),
    ("Moscow", "RUS", 55.75, 37.62),
    ("New York", "USA", 40.71, -74.01),
    ("Washington D.C.", "USA", 38.90, -77.04),
    ("Los Angeles", "USA", 34.05, -118.24),
    ("San Francisco", "USA", 37.77, -122.42),
    ("Chicago", "USA", 41.88, -87.63),
    ("Toronto", "CAN", 43.65, -79.38),
    ("Ottawa", "CAN", 45.42, -75.69),
    ("Mexico City", "MEX", 19.43, -99.13),
    ("Buenos Aires", "ARG", -34.61, -58.38),
    ("Brasília", "BRA", -15.78, -47.93),
    ("Rio de Janeiro", "BRA", -22.91, -43.17),
    ("Lima", "PER", -12.04, -77.03),
    ("Santiago", "CHL", -33.45, -70.66),
    ("Bogotá", "COL", 4.71, -74.07),
    ("Tokyo", "JPN", 35.69, 139.69),
    ("Beijing", "CHN", 39.91, 116.39),
    ("Shanghai", "CHN", 31.23, 121.47),
    ("Seoul", "KOR", 37.56, 126.97),
    ("Bangkok", "THA", 13.75, 100.50),
    ("Singapore", "SGP", 1.35, 103.82),
    ("Jakarta", "IDN", -6.21, 106.85),
    ("Delhi", "IND", 28.61, 77.21),
    ("Mumbai", "IND", 19.07, 72.88),
    ("Dubai", "ARE", 25.20, 55.27),
    ("Riyadh", "SAU", 24.71, 46.67),
    ("Tehran", "IRN", 35.69, 51.39),
    ("Cairo", "EGY", 30.04, 31.23),
    ("Cape Town", "ZAF", -33.92, 18.42),
    ("Johannesburg", "ZAF", -26.20, 28.04),
    ("Nairobi", "KEN", -1.29, 36.82),
    ("Sydney", "AUS", -33.87, 151.21),
    ("Melbourne", "AUS", -37.81, 144.96),
    ("Canberra", "AUS", -35.28, 149.13),
    ("Wellington", "NZL", -41.29, 174.78),
]

# Country spelling -> ISO 3166 alpha-3 code, matched exactly.
COUNTRY_CODES = [
    ("UK", "GBR"),
    ("USA", "USA"),
    ("France", "FRA"),
    ("Argentina", "ARG"),
    ("Germany", "DEU"),
    ("China", "CHN"),
    ("Australia", "AUS"),
    ("Indonesia", "IDN"),
    ("Brazil", "BRA"),
    ("India", "IND"),
    ("Russia", "RUS"),
    ("Canada", "CAN"),
    ("Mexico", "MEX"),
    ("Japan", "JPN"),
    ("'South Africa'", "ZAF"),
    ("South Africa", "ZAF"),
]

# Title-cased country name -> name in the ISO 3166 register, for
# the names where the two differ. None means "has no code".
COUNTRY_NAME_CORRECTIONS = [
    ("Bolivia", "Bolivia, Plurinational State of"),
    ("Brunei", "Brunei Darussalam"),
    ("Cape Verde", "Cabo Verde"),
    ("Congo (Brazzaville)", "Congo"),
    ("Congo (Kinshasa)", "Congo, The Democratic Republic Of The"),
    ("Czech Republic", "Czechia"),
    ("Hong Kong S.A.R. Of China", "Hong Kong"),
    ("Iran", "Iran, Islamic Republic of"),
    ("Ivory Coast", "Côte d'Ivoire"),
    ("Kosovo", None),
    ("Laos", "Lao People's Democratic Republic"),
    ("Macedonia", "North Macedonia"),
    ("Moldova", "Moldova, Republic of"),
    ("Palestinian Territory", "Palestine, State of"),
    ("Reunion", "Réunion"),
    ("Russia", "Russian Federation"),
    ("South Korea", "Korea, Republic of"),
    ("State Of Palestine", "Palestine, State of"),
    ("Taiwan", "Taiwan Province of China"),
    ("Taiwan Province Of China", "Taiwan, Province of China"),
    ("Tanzania", "Tanzania, United Republic of"),
    ("Turkey", "Türkiye"),
    ("Turkiye", "Türkiye"),
    ("Uk", "United Kingdom"),
    ("United Kingdom Of Great Britain And Northern Ireland", "United Kingdom"),
    ("United States Of America", "United States"),
    ("Usa", "United States"),
    ("Vatican", "Holy See (Vatican City State)"),
    ("Venezuela", "Venezuela, Bolivarian Republic of"),
    ("Vietnam", "Viet Nam"),
]

# ISO 3166 register names that differ from the display name the
# Java runtime gives for the same alpha-3 code.
ISO_REGISTER_NAMES = [
    ("ATG", "Antigua and Barbuda"),
    ("BES", "Bonaire, Sint Eustatius and Saba"),
    ("BIH", "Bosnia and Herzegovina"),
    ("BLM", "Saint Barthélemy"),
    ("BOL", "Bolivia, Plurinational State of"),
    ("BRN", "Brunei Darussalam"),
    ("CIV", "Côte d'Ivoire"),
    ("COD", "Congo, The Democratic Republic of the"),
    ("COG", "Congo"),
    ("CPV", "Cabo Verde"),
    ("CZE", "Czechia"),
    ("FLK", "Falkland Islands (Malvinas)"),
    ("FSM", "Micronesia, Federated States of"),
    ("HKG", "Hong Kong"),
    ("HMD", "Heard Island and McDonald Islands"),
    ("IRN", "Iran, Islamic Republic of"),
    ("KNA", "Saint Kitts and Nevis"),
    ("KOR", "Korea, Republic of"),
    ("LAO", "Lao People's Democratic Republic"),
    ("LCA", "Saint Lucia"),
    ("MAC", "Macao"),
    ("MAF", "Saint Martin (French part)"),
    ("MDA", "Moldova, Republic of"),
    ("MKD", "North Macedonia"),
    ("MMR", "Myanmar"),
    ("PCN", "Pitcairn"),
    ("PRK", "Korea, Democratic People's Republic of"),
    ("PSE", "Palestine, State of"),
    ("RUS", "Russian Federation"),
    ("SGS", "South Georgia and the South Sandwich Islands"),
    ("SHN", "Saint Helena, Ascension and Tristan da Cunha"),
    ("SJM", "Svalbard and Jan Mayen"),
    ("SPM", "Saint Pierre and Miquelon"),
    ("STP", "Sao Tome and Principe"),
    ("SWZ", "Eswatini"),
    ("SXM", "Sint Maarten (Dutch part)"),
    ("SYR", "Syrian Arab Republic"),
    ("TCA", "Turks and Caicos Islands"),
    ("TTO", "Trinidad and Tobago"),
    ("TUR", "Türkiye"),
    ("TWN", "Taiwan, Province of China"),
    ("TZA", "Tanzania, United Republic of"),
    ("UMI", "United States Minor Outlying Islands"),
    ("VAT", "Holy See (Vatican City State)"),
    ("VCT", "Saint Vincent and the Grenadines"),
    ("VEN", "Venezuela, Bolivarian Republic of"),
    ("VGB", "Virgin Islands, British"),
    ("VIR", "Virgin Islands, U.S."),
    ("VNM", "Viet Nam"),
    ("WLF", "Wallis and Futuna"),
]

# Words that make a post relevant, matched as substrings, any case.
TOPIC_KEYWORDS = [
    "temperature", "climate", "air quality", "Barcelona", "paris",
    "Madrid", "valencia", "seville", "malaga", "bilbao",
]

# Classifier label -> counter it adds to; other labels count as neutral.
LABEL_COUNTERS = {"good": "positive", "bad": "negative", "neutral": "neutral"}
COUNTERS = ["positive", "negative", "neutral"]

# Text spellings of "missing" in normalised text columns.
MISSING_WORDS = ["nan", "none", "", "null"]

# Columns of the happiness table that hold numbers.
HAPPINESS_NUMERIC = [
    "ladder_score", "standard_error_of_ladder_score", "standard_error",
    "upperwhisker", "lowerwhisker", "upper_whisker", "lower_whisker",
    "logged_gdp_per_capita", "gdp_per_capita", "social_support",
    "healthy_life_expectancy_at_birth", "healthy_life_expectancy",
    "freedom_to_make_life_choices", "freedom", "generosity",
    "perceptions_of_corruption", "trust_government_corruption",
    "dystopia_residual", "dystopia_plus_residual",
]

# Number columns of the country indicator table.
COUNTRY_INDICATORS = [
    "Intentional homicides (per 100,000 people) [VC.IHR.PSRC.P5]",
    "General government final consumption expenditure (% of GDP) [NE.CON.GOVT.ZS]",
    "Community health workers (per 1,000 people) [SH.MED.CMHW.P3]",
    "School enrollment, tertiary (% gross) [SE.TER.ENRR]",
    "School enrollment, secondary (% gross) [SE.SEC.ENRR]",
    "Unemployment, total (% of total labor force) (national estimate) [SL.UEM.TOTL.NE.ZS]",
    "Unemployment, youth total (% of total labor force ages 15-24) (national estimate) [SL.UEM.1524.NE.ZS]",
    "Gross capital formation (% of GDP) [NE.GDI.TOTL.ZS]",
    "Gross domestic savings (% of GDP) [NY.GDS.TOTL.ZS]",
    "Government expenditure per student, tertiary (% of GDP per capita) [SE.XPD.TERT.PC.ZS]",
    "Government expenditure per student, secondary (% of GDP per capita) [SE.XPD.SECO.PC.ZS]",
    "Government expenditure on education, total (% of GDP) [SE.XPD.TOTL.GD.ZS]",
    "Life expectancy at birth, total (years) [SP.DYN.LE00.IN]",
    "Age dependency ratio, young (% of working-age population) [SP.POP.DPND.YG]",
    "GDP per capita, PPP (constant 2021 international $) [NY.GDP.PCAP.PP.KD]",
    "GDP per capita (constant 2015 US$) [NY.GDP.PCAP.KD]",
    "Foreign direct investment, net inflows (% of GDP) [BX.KLT.DINV.WD.GD.ZS]",
    "GDP per capita growth (annual %) [NY.GDP.PCAP.KD.ZG]",
    "Market capitalization of listed domestic companies (% of GDP) [CM.MKT.LCAP.GD.ZS]",
    "Trade (% of GDP) [NE.TRD.GNFS.ZS]",
    "Inflation, consumer prices (annual %) [FP.CPI.TOTL.ZG]",
    "Net migration [SM.POP.NETM]",
    "Strength of legal rights index (0=weak to 12=strong) [IC.LGL.CRED.XQ]",
    "Mortality rate, under-5 (per 1,000 live births) [SH.DYN.MORT]",
    "Gini index [SI.POV.GINI]",
    "Net primary income (Net income from abroad) (constant LCU) [NY.GSR.NFCY.KN]",
    "Population growth (annual %) [SP.POP.GROW]",
    "Secondary education, teachers [SE.SEC.TCHR]",
    "Lending interest rate (%) [FR.INR.LEND]",
]

# Physical bounds used by the cleaning rules.
ABSOLUTE_ZERO_CELSIUS = -273.15
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
PERCENT_RANGE = (0.0, 100.0)
SURFACE_TEMPERATURE_RANGE = (-100.0, 60.0)
POPULATION_RANGE = (0, 10**12)
LADDER_RANGE = (0.0, 10.0)

# This repository's own default word lists for the offline label classifier.
GOOD_WORDS = [
    "amazing", "beautiful", "best", "clean", "fresh", "good", "great", "gusta",
    "happy", "healthy", "improve", "improved", "improving", "love", "lovely",
    "nice", "perfect", "pleasant", "safe", "wonderful",
]
BAD_WORDS = [
    "awful", "bad", "contaminated", "dangerous", "dirty", "hate", "horrible",
    "odio", "polluted", "pollution", "poor", "sad", "smog", "terrible", "toxic",
    "ugly", "unhealthy", "unsafe", "worse", "worst",
]
