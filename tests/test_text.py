import pytest
from pyspark.sql import functions as F

from sendero.functions import classify, text


@pytest.fixture(scope="module")
def of(spark):
    def run(build, *values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r.y for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


def test_normalizers(of):
    given = " juzgado  1º «Peña» (copia) | ño — Bogotá, D.C. "
    assert of(text.clean_text, given, "", None, "...", "“Alcaldía”་de Ibagué;") == ["JUZGADO 1º «PEÑA» NO - BOGOTA, D.C", "", "", "", "ALCALDIA DE IBAGUE"]
    assert of(text.norm_keep, "Peña-Nieto, D.C.", None) == ["PEÑA NIETO D C", ""]
    assert of(text.norm_fold, "Peña-Nieto, D.C.", " a\tb ") == ["PENA NIETO D C", "A B"]
    assert of(text.norm_registry, "Peña_Nieto #2 日本") == ["PENA_NIETO 2 日本"]
    assert of(text.norm_city, " Santa  Fé  de Ñ") == ["SANTA FE DE N"]
    assert of(text.norm_suggest, "Peña Ü") == ["PEÑA U"]
    for build in (text.clean_text, text.norm_keep, text.norm_fold, text.norm_city, text.norm_audit):
        once = of(build, given, "a - b", "x.;")
        assert of(build, *once) == once


def test_ordinals_and_numbers(of):
    assert of(text.replace_ordinals, "JUZGADO DECIMO PRIMERO", "VIGESIMA", "CUARENTA Y UN", "TREINTA", "OCHENTA Y SEIS", "1ERO DE") == ["JUZGADO 11", "VIGESIMA", "41", "30", "80 Y SEIS", "1 DE"]
    assert of(text.extract_number, "Juzgado Treinta y dos civil 7", "sin") == ["32", ""]
    assert of(text.court_ordinal, "JUZGADO DECIMO CUARTO CIVIL", "JUZGADO TERCER PENAL", "JUZGADO CIVIL MUNICIPAL DE X 045", "JUZGADO CIVIL") == [14, 3, 45, None]
    assert of(text.whole_number, " 007 ", "x", "", None) == ["7", "", "", ""]
    assert [str(x) if x is not None else None for x in of(text.amount, "28594000900609481.00", "", "abc")] == ["28594000900609481.00", None, None]


def test_fields(of):
    assert of(text.tax_id, "Acme NIT: 900.123-4", "nit 800", "none") == ["9001234", "800", ""]
    assert of(text.address, '{"direccionGenerada": "calle 1"}', '{"complemento": "Vacia"}', '{"direccionGenerada": "cra 2", x', "av 3", None) == ["CALLE 1", "", "CRA 2", "AV 3", ""]
    assert of(text.mixed_case, "Abc", "ABC", "abc", "123") == [True, False, False, True]
    assert of(lambda c: text.blank_if(c, text.NO_MAIL), " No Encontrada ", "a@b", None) == ["", "a@b", ""]
    assert of(lambda c: text.levenshtein_ratio(c, F.lit("ABCD")), "ABCD", "ABCE", "A", "", "ABCDEFGH") == [1.0, 0.75, 0.0, 0.0, 0.0]


def test_ladder(of):
    names = ["DATT", "JUZGADO DE LA RAMA JUDICIAL", "RAMA JUDICIAL", "SECRETARIA DE TRANSITO", "AGUAS ESP", "SENAMIHI SENA", "JUZGADO DE PEQUEÑAS CAUSAS MUNICIPAL", "MINISTERIO DE MINAS"]
    assert of(classify.entity_type, *names) == ["DATT", "JUZGADO", "RAMA_JUDICIAL", "SECRETARIA", "ESP", "OTRO", "JUZGADO", "MINISTERIO"]
    assert of(lambda c: classify.subtype(classify.entity_type(c), c), *names) == ["TRANSITO", "", "", "TRANSITO", "", "", "MUNICIPAL", "DE MINAS"]


#: Names and what they are, worked out by hand, one for each branch of the ladder.
BY_HAND = {
    "DEPARTAMENTO ADMINISTRATIVO DE TRANSITO": ("DATT", "TRANSITO"), "DIAN SECCIONAL": ("DIAN", ""), "SENA REGIONAL": ("SENA", ""), "COLPENSIONES BOGOTA": ("COLPENSIONES", ""), "EMCALI EICE": ("EMCALI", ""),
    "CORPORACION AUTONOMA REGIONAL DE RISARALDA CARDER": ("CAR", "CARDER"), "CVC CALI": ("CAR", "CVC"), "CORNARE": ("CAR", "CORNARE"), "CAS DE SANTANDER": ("CAR", "CAS"), "CORTOLIMA IBAGUE": ("CAR", "CORTOLIMA"),
    "CORPOGUAJIRA": ("CAR", "CORPOGUAJIRA"), "CORANTIOQUIA": ("CAR", "CORANTIOQUIA"), "CORPOCESAR": ("CAR", "CORPOCESAR"), "CORPOAMAZONIA": ("CAR", "CORPOAMAZONIA"), "CORPOBOYACA": ("CAR", "CORPOBOYACA"), "CORPOMAG": ("CAR", "CORPOMAG"),
    "CDMB": ("CAR", "CDMB"), "CORPORACION AUTONOMA REGIONAL CRA": ("CAR", "CRA"), "CORPORACION AUTONOMA REGIONAL CRQ": ("CAR", "CRQ"), "CORPORACION AUTONOMA REGIONAL": ("CAR", ""),
    "CONSEJO SECCIONAL DE LA JUDICATURA": ("RAMA_JUDICIAL", ""), "CONSEJO SUPERIOR Y JUZGADO": ("JUZGADO", ""), "JUZSADO 4": ("JUZGADO", ""), "JUEZ LABORAL DE PEQUENAS CAUSAS": ("JUZGADO", "PEQUENAS_CAUSAS_LABORAL"),
    "JUZGADO DE PEQUENAS CAUSAS LABORALES": ("JUZGADO", "PEQUENAS_CAUSAS_LABORAL"), "JUZGADO DE COMPETENCIA MULTIPLE": ("JUZGADO", "PEQUENAS_CAUSAS"), "JUZGADO PROMISCUO DE FAMILIA": ("JUZGADO", "PROMISCUO_FAMILIA"),
    "JUZGADO PROMISCUO": ("JUZGADO", "PROMISCUO_MUNICIPAL"), "JUZGADO DE EJECUCION CIVIL": ("JUZGADO", "EJECUCION_CIVIL"), "JUZGADO DE EJECUCION PENAL": ("JUZGADO", "EJECUCION_PENAL"), "JUZGADO DE EJECUCION": ("JUZGADO", "EJECUCION"),
    "JUZGADO DE FAMILIA DEL CIRCUITO": ("JUZGADO", "FAMILIA_CIRCUITO"), "JUZGADO DE FAMILIA": ("JUZGADO", "FAMILIA"), "JUZGADO LABORAL DEL CIRCUITO": ("JUZGADO", "LABORAL_CIRCUITO"), "JUZGADO LABORAL": ("JUZGADO", "LABORAL"),
    "JUZGADO PENAL DEL CIRCUITO": ("JUZGADO", "PENAL_CIRCUITO"), "JUZGADO PENAL MUNICIPAL": ("JUZGADO", "PENAL_MUNICIPAL"), "JUZGADO PENAL": ("JUZGADO", "PENAL"), "JUZGADO ADMINISTRATIVO": ("JUZGADO", "ADMINISTRATIVO"),
    "JUZGADO CIVIL DEL CIRCUITO": ("JUZGADO", "CIVIL_CIRCUITO"), "JUZGADO CIVIL MUNICIPAL": ("JUZGADO", "CIVIL_MUNICIPAL"), "JUZGADO CIVIL": ("JUZGADO", "CIVIL"), "JUZGADO MUNICIPAL": ("JUZGADO", "MUNICIPAL"),
    "OFICINA DE APOYO CIVIL MUNICIPAL": ("OFICINA_APOYO", "CIVIL_MUNICIPAL"), "OFICINA DE APOYO CIVIL": ("OFICINA_APOYO", "CIVIL"), "OFICINA DE APOYO LABORAL": ("OFICINA_APOYO", "LABORAL"), "OFICINA DE APOYO": ("OFICINA_APOYO", ""),
    "CENTRO DE SERVICIOS JUDICIALES": ("CENTRO_SERVICIOS", ""), "ALCALDIA DE CALI": ("ALCALDIA", ""), "GBERANCION DEL CESAR": ("GOBERNACION", ""), "SUPERINTENDENCIA DE SOCIEDADES": ("SUPERINTENDENCIA", "SOCIEDADES"),
    "SUPERINTENDENCIA DE INDUSTRIA": ("SUPERINTENDENCIA", "INDUSTRIA_COMERCIO"), "SUPERINTENDENCIA DE SALUD": ("SUPERINTENDENCIA", "SALUD"), "SUPERINTENDENCIA FINANCIERA": ("SUPERINTENDENCIA", "FINANCIERA"), "SUPERINTENDENCIA DE NOTARIADO": ("SUPERINTENDENCIA", "NOTARIADO"),
    "SUPERINTENDENCIA DE PUERTOS": ("SUPERINTENDENCIA", "PUERTOS_TRANSPORTE"), "SUPERINTENDENCIA DEL SUBSIDIO": ("SUPERINTENDENCIA", "SUBSIDIO_FAMILIAR"), "SUPERINTENDENCIA DE SERVICIOS PUBLICOS": ("SUPERINTENDENCIA", "SERVICIOS_PUBLICOS"),
    "SUPERINTENDENCIA DE VIGILANCIA": ("SUPERINTENDENCIA", "VIGILANCIA"), "SUPERINTENDENCIA X": ("SUPERINTENDENCIA", "OTRA"), "SECRETARIA DE MOVILIDAD": ("SECRETARIA", "TRANSITO"), "SECRETARIA DE HACIENDA": ("SECRETARIA", "HACIENDA"),
    "SECRETARIA DE GOBIERNO": ("SECRETARIA", "GOBIERNO"), "SECRETARIA DE EDUCACION": ("SECRETARIA", "EDUCACION"), "SECRETARIA DE SALUD": ("SECRETARIA", "SALUD"), "SECRETARIA GENERAL": ("SECRETARIA", "OTRA"),
    "MINISTERIO DEL TRABAJO": ("MINISTERIO", "TRABAJO"), "MINHACIENDA": ("MINISTERIO", "HACIENDA"), "MINISTERIO DE DEFENSA": ("MINISTERIO", "DEFENSA"), "MINISTERIO DE EDUCACION": ("MINISTERIO", "EDUCACION"), "MINISTERIO DE SALUD": ("MINISTERIO", "SALUD"),
    "MINISTERIO DE TECNOLOGIAS DE LA INFORMACION": ("MINISTERIO", "DE TECNOLOGIAS DE LA INFO"), "U.G.P.P.": ("UGPP", ""), "UGPP BOGOTA": ("UGPP", ""), "MUNICIPIO DE CHIA": ("MUNICIPIO", ""), "DIRECCION EJECUTIVA": ("DIRECCION_EJECUTIVA", ""),
    "INSTITUTO DE DESARROLLO URBANO": ("IDU", ""), "INSTITUTO DE MOVILIDAD": ("INSTITUTO_MOVILIDAD", ""), "DIRECCION DE TRANSITO": ("TRANSITO", ""), "TRIBUNAL ADMINISTRATIVO": ("TRIBUNAL", "ADMINISTRATIVO"), "TRIBUNAL SUPERIOR": ("TRIBUNAL", "SUPERIOR"),
    "FISCALIA 5": ("FISCALIA", ""), "EMPRESA PUBLICA": ("ESP", ""), "AGUAS E.S.P": ("ESP", ""), "POLICIA NACIONAL": ("POLICIA", ""), "CORTE SUPREMA": ("CORTE", "SUPREMA"), "CORTE CONSTITUCIONAL": ("CORTE", "CONSTITUCIONAL"),
    "CONTRALORIA GENERAL": ("CONTRALORIA", ""), "PERSONERIA DE CALI": ("PERSONERIA", ""), "BANCO X": ("OTRO", ""), "": ("OTRO", ""),
}


def test_ladder_by_hand(of):
    names = list(BY_HAND)
    got = zip(of(classify.entity_type, *names), of(lambda c: classify.subtype(classify.entity_type(c), c), *names), strict=True)
    assert dict(zip(names, got, strict=True)) == BY_HAND
    assert {kind for kind, _, _ in classify.TYPES} <= {kind for kind, _ in BY_HAND.values()}
    assert {s for of_kind in classify.SUBTYPES.values() for s, _ in of_kind} <= {s for _, s in BY_HAND.values()}


def test_spelled_numbers_by_hand(of):
    told = {"JUZGADO DECIMO PRIMERA": "11", "VIGESIMO SEPTIMO": "27", "TREINTA Y UN": "31", "TREINTA Y UNO": "31", "CUARENTA Y NUEVE": "49", "SETENTA Y UNO": "71", "OCHENTA Y CINCO": "85", "PRIMER": "1", "2DA": "2", "SEPTIMA": "7", "DUODECIMO": "12", "VEINTIUN": "21", "NOVENTA": "90", "NINGUNO": ""}
    assert of(text.extract_number, *told) == list(told.values())
