"""Business constants and lookup tables that results must agree on.

These are data, not logic. Every operator takes them as arguments; the plans pass
them in as defaults.
"""

# Weather series -------------------------------------------------------------
HOURLY_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
    "surface_pressure",
]
VALID_RANGES = {
    "temperature_2m": (-50.0, 60.0),
    "relative_humidity_2m": (0.0, 100.0),
    "precipitation": (0.0, 1000.0),
    "wind_speed_10m": (0.0, 400.0),
    "surface_pressure": (850.0, 1085.0),
}
BATCH_ORIGINS = ["API", "FALLBACK"]
MOVING_AVERAGE_ROWS = 24
CITY_CATALOG = [
    ("Madrid", 40.4168, -3.7038),
    ("Barcelona", 41.3851, 2.1734),
    ("Valencia", 39.4699, -0.3763),
    ("Sevilla", 37.3891, -5.9845),
    ("Bilbao", 43.2630, -2.9350),
]
PENINSULA_LAT = (35.5, 44.0)
PENINSULA_LON = (-9.5, 3.5)

# Shop -------------------------------------------------------------------------
USD_PER_EUR = 1.15
FASHION_CATEGORIES = [
    "Camisetas y Polos",
    "Pantalones y Jeans",
    "Ropa Deportiva",
    "Calzado y Zapatillas",
    "Accesorios y Cinturones",
]
NATIONAL_ID_PATTERN = r"^\d{8}[A-Za-z]$"
CLIENT_PATTERN = r"^\s*([^,]+),\s*(.+?)\s*(?:-\s*(\S+))?\s*$"

# Matches ------------------------------------------------------------------------
EXCLUDED_COUNTRIES = ["italia", "nigeria"]

# Country indicators ---------------------------------------------------------------
SQ_MI_TO_KM2 = 2.58999
CURRENCY_PER_EUR = [
    ("EUR", 1.0),
    ("USD", 1.1614),
    ("GBP", 0.85740),
    ("CHF", 0.9425),
    ("SEK", 11.1520),
    ("NOK", 10.7450),
    ("DKK", 7.4748),
    ("CZK", 24.186),
    ("PLN", 4.3178),
    ("HUF", 363.95),
    ("BGN", 1.95583),
]
COUNTRY_SYNONYMS = [
    ("ESPANA", "SPAIN"),
    ("FRANCIA", "FRANCE"),
    ("ALEMANIA", "GERMANY"),
    ("REINO UNIDO", "UNITED KINGDOM"),
    ("PAISES BAJOS", "NETHERLANDS"),
    ("SUIZA", "SWITZERLAND"),
    ("SUECIA", "SWEDEN"),
    ("DINAMARCA", "DENMARK"),
    ("GRECIA", "GREECE"),
    ("POLONIA", "POLAND"),
    ("HUNGRIA", "HUNGARY"),
    ("REPUBLICA CHECA", "CZECHIA"),
    ("IRLANDA", "IRELAND"),
    ("ITALIA", "ITALY"),
    ("BELGICA", "BELGIUM"),
    ("NORUEGA", "NORWAY"),
    ("FINLANDIA", "FINLAND"),
    ("PORTUGAL", "PORTUGAL"),
    ("RUMANIA", "ROMANIA"),
    ("BULGARIA", "BULGARIA"),
    ("CROACIA", "CROATIA"),
]
COUNTRY_POPULATION = [
    ("ALBANIA", 2_771_508),
    ("ANDORRA", 82_904),
    ("AUSTRIA", 9_113_574),
    ("BELARUS", 8_997_603),
    ("BELGIUM", 11_758_603),
    ("BOSNIA AND HERZEGOVINA", 3_140_096),
    ("BULGARIA", 6_714_560),
    ("CROATIA", 3_848_160),
    ("CYPRUS", 1_370_754),
    ("CZECHIA", 10_609_240),
    ("DENMARK", 6_002_507),
    ("SPAIN", 47_889_958),
    ("ESTONIA", 1_344_232),
    ("FINLAND", 5_623_330),
    ("FRANCE", 66_650_804),
    ("GERMANY", 84_075_074),
    ("GREECE", 9_938_844),
    ("HUNGARY", 9_632_287),
    ("ICELAND", 398_266),
    ("IRELAND", 5_308_039),
    ("ITALY", 59_146_260),
    ("LATVIA", 1_853_559),
    ("LIECHTENSTEIN", 40_128),
    ("LITHUANIA", 2_830_144),
    ("LUXEMBOURG", 680_454),
    ("MALTA", 545_405),
    ("MOLDOVA", 2_996_106),
    ("MONACO", 38_341),
    ("MONTENEGRO", 632_729),
    ("NETHERLANDS", 18_346_819),
    ("NORTH MACEDONIA", 1_813_791),
    ("NORWAY", 5_618_354),
    ("POLAND", 37_332_000),
    ("PORTUGAL", 10_411_834),
    ("ROMANIA", 18_908_650),
    ("SAN MARINO", 33_572),
    ("SERBIA", 6_689_039),
    ("SLOVAKIA", 5_474_881),
    ("SLOVENIA", 2_117_072),
    ("SWEDEN", 10_656_633),
    ("SWITZERLAND", 8_967_408),
    ("UKRAINE", 38_980_377),
    ("UNITED KINGDOM", 69_551_332),
    ("VATICAN CITY", 764),
]

# District index ---------------------------------------------------------------------
DENSITY_FACTOR = 10_000
DEFAULT_POWER_KW = 3.7
UNNAMED_STATION = "Punto de recarga sin nombre"
OUTSIDE_REASON = "Punto fuera de los 11 distritos oficiales de Sevilla"
SEARCH_CENTRE = (37.3900, -5.9961)
SEARCH_RADIUS_KM = 20.0
RAMP_COLOURS = ["#ffffb2", "#fed976", "#fd8d3c", "#f03b20", "#bd0026"]
INCOME_SHEET_PATTERN = r"^41091(0[1-9]|1[01]) Sevilla distrito (\d{2})$"
# (district key, registered population, mean net income per person)
DISTRICTS = [
    ("CASCO ANTIGUO", 56_980, 20_777),
    ("MACARENA", 76_059, 12_576),
    ("NERVION", 51_276, 20_984),
    ("CERRO-AMATE", 90_913, 9_993),
    ("SUR", 69_359, 15_297),
    ("TRIANA", 47_114, 17_262),
    ("NORTE", 70_963, 12_100),
    ("SAN PABLO-SANTA JUSTA", 59_018, 15_838),
    ("ESTE-ALCOSA-TORREBLANCA", 107_133, 13_175),
    ("BELLAVISTA-LA PALMERA", 42_647, 16_488),
    ("LOS REMEDIOS", 25_771, 21_423),
]
DISTRICT_POPULATION_TOTAL = 697_233
# (name, latitude, longitude, power in kW)
FALLBACK_STATIONS = [
    ("Emasesa - Sede Central (C/ Escuelas Pias)", 37.4010, -5.9950, 22.0),
    ("Emasesa - EDAR San Jeronimo", 37.4350, -5.9700, 22.0),
    ("Lipasam - Parque Central (C/ Virgen de la Oliva)", 37.4180, -5.9850, 22.0),
    ("Lipasam - Centro Pino Montano", 37.4330, -5.9600, 22.0),
    ("Parque Movil del Ayuntamiento", 37.3650, -5.9850, 22.0),
    ("AP Arenal", 37.3850, -6.0010, 22.0),
    ("AP Jose Laguillo", 37.3870, -5.9800, 22.0),
    ("AP Mercado de Triana", 37.3870, -6.0030, 22.0),
    ("AP Avda. de Roma", 37.3800, -5.9950, 22.0),
    ("AP Plaza de Cuba", 37.3820, -6.0000, 22.0),
    ("AP Macarena", 37.4020, -5.9920, 22.0),
    ("AP Plaza de la Concordia", 37.3950, -5.9880, 22.0),
    ("AP Magdalena - San Pablo", 37.3880, -5.9970, 22.0),
    ("Avda. San Francisco Javier (zona azul)", 37.3800, -5.9700, 3.7),
    ("Avda. Reyes Catolicos (zona azul)", 37.3900, -6.0020, 3.7),
    ("Teatro Lope de Vega (Avda. Maria Luisa)", 37.3760, -5.9880, 22.0),
    ("Hotel Inglaterra (Plaza Nueva)", 37.3900, -5.9950, 22.0),
    ("Hotel Sevilla Center", 37.3830, -5.9750, 22.0),
    ("Hotel ABBA Triana", 37.3870, -6.0050, 22.0),
    ("Hotel Ribera de Triana", 37.3830, -6.0080, 22.0),
    ("C.C. Nervion Plaza", 37.3870, -5.9750, 50.0),
    ("C.C. Plaza de Armas", 37.3920, -6.0030, 50.0),
    ("C.C. El Mirador de Santa Justa", 37.3930, -5.9680, 50.0),
    ("C.C. Los Arcos", 37.3950, -5.9550, 50.0),
    ("Aparcamiento INSUR - Mirador Santa Justa", 37.3935, -5.9670, 22.0),
    ("Aparcamiento INSUR (C/ Diego Martinez Barrios)", 37.3925, -5.9695, 22.0),
    ("Parking Sagrado Corazon", 37.3870, -5.9820, 22.0),
    ("Parking Cristina (Puerta de Jerez)", 37.3820, -5.9930, 22.0),
    ("Carrefour San Pablo", 37.3980, -5.9550, 50.0),
    ("REE Cartuja (C/ Inca Garcilaso)", 37.4200, -6.0020, 22.0),
    ("El Corte Ingles San Juan de Aznalfarache", 37.3720, -6.0330, 22.0),
]
