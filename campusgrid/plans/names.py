"""Column names, codes and labels of the school source files.

Fixed values: they must equal those in the published files and are listed here once."""

SITE = "CODLOCAL"

REGISTER = ("COD_MOD", "CODLOCAL", "D_FORMA", "DAREACENSO", "TALUM", "TDOC", "D_DPTO")
REGISTER_OLD = ("COD_MOD", "CODLOCAL", "D_FORMA", "DAREACENSO", "TALUMNO", "TDOCENTE")

CLASSROOMS = ("CODLOCAL", "P61_2", "P61_3", "P61_4")
ROOM_TYPES = ("01", "02")

BUILDINGS = ("CODLOCAL", "P53_3", "P53_4", "P53_9", "P53_10", "P53_13_1", "P53_13_2", "P53_13_3")
BUILDINGS_OLD = (
    "CODLOCAL", "ID_TERR", "P53_3", "P53_4", "P53_9", "P53_10", "P53_14_3", "P53_18_1",
    "P53_13_1", "P53_13_2", "P53_13_3",
)
BUILDING_FLAGS = ("P53_3", "P53_4", "P53_9", "P53_13_1", "P53_13_2", "P53_13_3")

PROGRAMMES = ("PDL", "QM DIRECTO", "QM INDIRECTO", "QM", "PDLD", "MTESANA", "ACADEMIA")
PROGRAMMES_PANEL = ("PDL", "QM", "MTESANA", "ACADEMIA")
PROGRAMME_NAMES = {"MTESANA": "MTESANA_INDIRECTO", "ACADEMIA": "ACADEMIA_DIRECTO"}

HISTORY = ("Cod_Local", *PROGRAMMES, "Evaluación", "Nivel de logro")
HISTORY_WIDE = (
    "Cod_Modular", "Cod_Local", "AÑO", "Nombre_IE", *PROGRAMMES,
    "Nivel", "Área", "Evaluación", "Nivel de logro", "PERIODO",
)
LEVELS = {"en inicio": 1, "en proceso": 2, "satisfactorio": 3}
SUBJECTS = {"lectura": "Evaluación_lectura", "matematica": "Evaluación_matematica"}
SUBJECTS_PANEL = ("LECTURA", "MATEMATICA")

DISTANCE = "dist_km_utm_log+1"

EVALUATIONS = (
    "id_estudiante", "nom_ie", "grado", "Programa", "cuadernillo", "area_evaluacion",
    "suma_puntaje", "tot_preguntas", "porcentaje_promedio", "region", "ugel",
)

INFRA = ("P53_13_1", "P53_13_2", "P53_13_3", "P531011", "P531012", "P53_3", "P53_4", "P53_9")
INFRA_YES_NO = ("P53_3", "P53_4", "P53_9", "P53_10", "P53_14_3", "P53_18_1")
SEGMENT_FEATURES = ("ratio_alumno_docente", "TALUM", "infra_index", DISTANCE, "n_aulas", "max_piso")
SEGMENT_FEATURES_MASTER = ("ratio_alumno_docente", "TALUMNO", "infra_index", "P61_2", DISTANCE)
UNUSED = ("COD_MOD", "D_FORMA", "D_DPTO")
