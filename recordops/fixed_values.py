"""Lists, codes, patterns and labels that results must reproduce."""

# --- fixed values: person keys ------------------------------------------------
PERSON_KEY_PATTERN = "^[A-Z]{4}[0-9]{6}[HM][A-Z]{5}[A-Z0-9]{2}$"
PERSON_KEY_LENGTH = 18
KEY_BLANK = "CURP vacía"
KEY_BAD_LENGTH = "Longitud distinta de 18"
KEY_BAD_FORMAT = "Formato inválido"
KEY_CORRECTED = "CURP corregida por limpieza"
KEY_UNCHANGED = "CURP válida sin cambios"
NAME_FROM_PREVIOUS = "Nombre recuperado de base previa"
NAME_FROM_LOOKUP = "CURP encontrada en endpoint"
NAME_NOT_FOUND = "CURP válida en formato, no encontrada en endpoint"
NO_NAME_REASON = "CURP válida pero sin nombre/apellidos en endpoint"

# --- fixed values: facility codes ---------------------------------------------
FACILITY_PATTERN = "^[A-Z]{2}IMB[0-9]{6}"
FACILITY_REMAP = {
    "PLIMB003706": "PLIMB002516",
    "SLIMB001950": "SLIMB002930",
    "SLIMB000195": "SLIMB002930",
    "SLIMB001554": "SLIMB002930",
    "BSIMB000503": "BSIMB000754",
    "TSIMB003483": "TSIMB001260",
}
CLUSTER_REMAP = {"CSIMB005500_09": "CSIMB005500_8"}

# --- fixed values: roles and team positions -----------------------------------
POSITIONS = [
    "Anestesiologia",
    "Cirugia",
    "Medicina General",
    "Enfermeria quirurgica",
    "Chofer",
]
TEAM_OF_CANDIDATES = ["Anestesiologia", "Cirugia", "Medicina General", "Enfermeria quirurgica"]
POSITION_OF_ROLE = {
    "MG001": "Medicina General",
    "ME001": "Anestesiologia",
    "ME002": "Cirugia",
    "EN002": "Enfermeria quirurgica",
    "EN005": "Enfermeria quirurgica",
    "PA020": "Chofer",
    "PA022": "Chofer",
}
VALID_ROLES = ["PA020", "PA022", "ME001", "ME002", "MG001", "EN005", "EN002"]
REQUIRED_POSITIONS = [
    ("Cirugia", "ME002", "Cirujano"),
    ("Anestesiologia", "ME001", "Anestesiólogo"),
    ("Enfermeria quirurgica", "EN005", "Enfermera quirúrgica"),
    ("Chofer", "PA020", "Chofer"),
    ("Medicina General", "MG001", "Médico general"),
]
SECOND_CHOICE_ROLES = ["EN002", "PA022"]
ROLE_OF_CODE = {"OP057": "PA020", "OP065": "PA022"}
ROLE_OF_TEXT = {
    "OP057 CHOFER PROMOTOR POLIVALENTE": "PA020",
    "CHOFER PROMOTOR POLIVALENTE": "PA020",
    "OP065 AUXILIAR ADMINISTRATIVO (CHOFER)": "PA022",
    "CHOFER POLIVALENTE": "PA022",
    "AUXILIAR ADMINISTRATIVO (CHOFER)": "PA022",
    "ME002 CIRUGIA GENERAL": "ME002",
    "CIRUGIA GENERAL": "ME002",
    "ANESTESIOLOGIA": "ME001",
    "MG001 MEDICINA GENERAL": "MG001",
    "MEDICINA GENERAL": "MG001",
    "EN005 ENFERMERA ESPECIALISTA CIRUGIA": "EN005",
    "ENFERMERA ESPECIALISTA CIRUGIA": "EN005",
}
# One list of extracts reads this text differently.
ROLE_OF_TEXT_OTHER_EXTRACT = {
    "OP057 CHOFER PROMOTOR POLIVALENTE": "PA022",
    "ME002 CIRUGIA GENERAL": "ME002",
}

# The gap report's own reading of both fields.
GAP_POSITION_OF_CODE = {
    "MG001": "Medicina General",
    "ME001": "Anestesiologia",
    "ME002": "Cirugia",
    "EN005": "Enfermeria quirurgica",
    "PA020": "Chofer",
    "PA022": "Chofer",
}
GAP_POSITION_OF_TEXT = {
    "OP057 CHOFER PROMOTOR POLIVALENTE": "Chofer",
    "CHOFER PROMOTOR POLIVALENTE": "Chofer",
    "CHOFER POLIVALENTE": "Chofer",
    "AUXILIAR ADMINISTRATIVO (CHOFER)": "Chofer",
    "PA022": "Chofer",
    "ME002 CIRUGIA GENERAL": "Cirugia",
    "CIRUGIA GENERAL": "Cirugia",
    "ME002": "Cirugia",
    "ANESTESIOLOGIA": "Anestesiologia",
    "ME001": "Anestesiologia",
    "MEDICINA GENERAL": "Medicina General",
    "MG001": "Medicina General",
    "ENFERMERA ESPECIALISTA CIRUGIA": "Enfermeria quirurgica",
    "EN005": "Enfermeria quirurgica",
}

# --- fixed values: candidates and slots ---------------------------------------
CLUSTER_SUFFIX = r"_\d+$"
CLUSTER_NUMBER = r"\d+$"
TRAVELLING_SHIFT_PATTERN = "(?i)itinerante"
TRAVELLING_SHIFTS = ["Equipo itinerante", "EQUIPO ITINERANTE"]
APPROVED = "APROBADO"
NO_CLUSTER = "Sin match en cluster"
CANDIDATE_SOURCE = "Base validada UAS"
SLOT_FILLED = "Cubierto con candidato UAS"
SLOT_VACANT = "Vacante / sin candidato UAS"
PLACED = "Asignado en base"
NOT_PLACED = "No asignado en base"
PLACED_REASON = "Asignado correctamente"
NOT_PLACED_REASON = "Sin espacio disponible en cluster/puesto"
BROKEN_LINK_REASON = "Duplicado eliminado porque el link no abre"
NOT_ANCHOR_REASON = "CLUES no pertenece a base_alex / no es ancla"
LATER_FILTER_REASON = "Se eliminó en filtros posteriores"
FORMS_TEAM = "Sí arma team QX"
FORMS_NO_TEAM = "No arma team QX"
WORKING_STATUS = [200, 302]
STATE_NAMES = {
    "VERACRUZ DE IGNACIO DE LA LLAVE": "Veracruz",
    "MICHOACAN DE OCAMPO": "Michoacan",
    "MEXICO": "Estado de Mexico",
}

# --- fixed values: services and procedures ------------------------------------
GENERAL_SERVICES = ["MG01", "6301", "9999", "PREC", "5001", "6601"]
NO_SHOW = "No se Presentó"
SURGICAL = "Procedimientos quirurgicos"
NOT_SURGICAL = "Procedimientos no quirurgicos"
SOURCE_LABELS = [
    ("%salud_mental%", "salud mental"),
    ("%salud_bucal%", "salud bucal"),
    ("%planificacion_familiar%", "planificacion familiar"),
    ("%consulta_externa%", "consulta externa"),
]
NOT_COVERED_PATTERN = "^0.*ND$"
YES_VALUES = ["Si", "Sí"]
NO_VALUE = "No"

# --- fixed values: calendar ---------------------------------------------------
LOCAL_ZONE = "America/Mexico_City"
MONTHS = {
    "Enero": 1,
    "Febrero": 2,
    "Marzo": 3,
    "Abril": 4,
    "Mayo": 5,
    "Junio": 6,
    "Julio": 7,
    "Agosto": 8,
    "Septiembre": 9,
    "Octubre": 10,
    "Noviembre": 11,
    "Diciembre": 12,
}
UNKNOWN_MONTH = "Unknown"
DATE_FIXES = {"0203-03-08": "2026-03-08"}

# --- fixed values: national and state rows ------------------------------------
NATIONAL = "NACIONAL"
NATIONAL_NAME = "México"
IN_OPERATION = "EN OPERACION"
TOTAL = "TOTAL"

# --- fixed values: coordinates ------------------------------------------------
LATITUDE_RANGE = (14, 33)
LONGITUDE_RANGE = (-119, -86)
DMS_PATTERN = (
    r"(\d+(?:\.\d+)?)°\s*(\d+(?:\.\d+)?)?'?\s*(\d+(?:\.\d+)?)?\"?\s*([NSEW])?"
)
NUMBER_PAIR_PATTERN = r"^(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)$"
DMS_PAIR_PATTERN = r"(.+?[NS])\s+(.+?[EW])"
DMS_MARK_PATTERN = "°|'|\"|[NSEW]"
NUMERIC_ORIGIN = "numérico"
TEXT_ORIGIN = "texto"
CAUSE_BOTH_MISSING = "Latitud y longitud no convertidas"
CAUSE_LAT_MISSING = "Latitud no convertida"
CAUSE_LON_MISSING = "Longitud no convertida"
CAUSE_BOTH_RANGE = "Latitud y longitud fuera de rango México"
CAUSE_LAT_RANGE = "Latitud fuera de rango México"
CAUSE_LON_RANGE = "Longitud fuera de rango México"
CAUSE_NONE = "Sin causa identificada"
CAUSE_LOST = "Se perdió en alguna transformación intermedia"
# Latitude, range of the wrong longitude, right longitude.
NUMERIC_LONGITUDE_FIXES = [
    (24.15034, -10.565515, -10.565505, -110.56551),
    (15.60042, float("-inf"), -100000.0, -93.1443414),
]
LATITUDE_FIXES_BY_LATITUDE = {
    "164403": 16.4403,
    "165143": 16.5143,
    "14°47'": 14 + 47 / 60,
    "15.63065°": 15.63065,
    "16.359982299999999": 16.3599823,
}
LATITUDE_FIXES_BY_LONGITUDE = {"-92.4453267,13.92": 13.92}
LONGITUDE_FIXES_BY_LONGITUDE = {
    "110..26522": -110.26522,
    "930138 1": -93.01381,
    "925626 2": -92.56262,
    "-92.02061°": -92.02061,
    "-92.34611°": -92.34611,
    "-92.4453267,13.92": -92.4453267,
}
# Stages of the row-loss report, in order.
LOSS_STAGES = [
    "Base original",
    "Numéricos válidos",
    "Numéricos revisión",
    "Texto válido",
    "Texto revisión",
    "Final válido",
    "Final revisión",
    "Perdidos",
]
# Module, facilities, records, percentage.
PROFILE_SENTENCE = ("- ", ": ", " clues, ", " registros y ", "% de no derechohabiencia")
