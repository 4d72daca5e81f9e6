"""Spelled-out numbers and the figures that each stands for."""

#: Phrases of two or three words, replaced before single words.
ORDINAL_PHRASES = {
    "DECIMO PRIMERO": 11, "DECIMO PRIMERA": 11, "DECIMO SEGUNDO": 12, "DECIMO SEGUNDA": 12, "DECIMO TERCERO": 13, "DECIMO TERCERA": 13,
    "DECIMO CUARTO": 14, "DECIMO CUARTA": 14, "DECIMO QUINTO": 15, "DECIMO QUINTA": 15, "DECIMO SEXTO": 16, "DECIMO SEXTA": 16, "DECIMO SEPTIMO": 17,
    "DECIMO SEPTIMA": 17, "DECIMO OCTAVO": 18, "DECIMO OCTAVA": 18, "DECIMO NOVENO": 19, "DECIMO NOVENA": 19, "VIGESIMO PRIMERO": 21,
    "VIGESIMO PRIMERA": 21, "VIGESIMO SEGUNDO": 22, "VIGESIMO SEGUNDA": 22, "VIGESIMO TERCERO": 23, "VIGESIMO TERCERA": 23, "VIGESIMO CUARTO": 24,
    "VIGESIMO CUARTA": 24, "VIGESIMO QUINTO": 25, "VIGESIMO QUINTA": 25, "VIGESIMO SEXTO": 26, "VIGESIMO SEXTA": 26, "VIGESIMO SEPTIMO": 27,
    "VIGESIMO SEPTIMA": 27, "VIGESIMO OCTAVO": 28, "VIGESIMO OCTAVA": 28, "VIGESIMO NOVENO": 29, "VIGESIMO NOVENA": 29, "TREINTA Y UN": 31,
    "TREINTA Y UNO": 31, "TREINTA Y DOS": 32, "TREINTA Y TRES": 33, "TREINTA Y CUATRO": 34, "TREINTA Y CINCO": 35, "TREINTA Y SEIS": 36,
    "TREINTA Y SIETE": 37, "TREINTA Y OCHO": 38, "TREINTA Y NUEVE": 39, "CUARENTA Y UN": 41, "CUARENTA Y UNO": 41, "CUARENTA Y DOS": 42,
    "CUARENTA Y TRES": 43, "CUARENTA Y CUATRO": 44, "CUARENTA Y CINCO": 45, "CUARENTA Y SEIS": 46, "CUARENTA Y SIETE": 47, "CUARENTA Y OCHO": 48,
    "CUARENTA Y NUEVE": 49, "CINCUENTA Y UN": 51, "CINCUENTA Y UNO": 51, "CINCUENTA Y DOS": 52, "CINCUENTA Y TRES": 53, "CINCUENTA Y CUATRO": 54,
    "CINCUENTA Y CINCO": 55, "CINCUENTA Y SEIS": 56, "CINCUENTA Y SIETE": 57, "CINCUENTA Y OCHO": 58, "CINCUENTA Y NUEVE": 59, "SESENTA Y UN": 61,
    "SESENTA Y UNO": 61, "SESENTA Y DOS": 62, "SESENTA Y TRES": 63, "SESENTA Y CUATRO": 64, "SESENTA Y CINCO": 65, "SESENTA Y SEIS": 66,
    "SESENTA Y SIETE": 67, "SESENTA Y OCHO": 68, "SESENTA Y NUEVE": 69, "SETENTA Y UN": 71, "SETENTA Y UNO": 71, "SETENTA Y DOS": 72,
    "SETENTA Y TRES": 73, "SETENTA Y CUATRO": 74, "SETENTA Y CINCO": 75, "SETENTA Y SEIS": 76, "SETENTA Y SIETE": 77, "SETENTA Y OCHO": 78,
    "SETENTA Y NUEVE": 79, "OCHENTA Y UN": 81, "OCHENTA Y UNO": 81, "OCHENTA Y DOS": 82, "OCHENTA Y TRES": 83, "OCHENTA Y CUATRO": 84,
    "OCHENTA Y CINCO": 85,
}
#: Single words.
ORDINAL_WORDS = {
    "PRIMERO": 1, "PRIMER": 1, "PRIMERA": 1, "1ERO": 1, "1ER": 1, "1RO": 1, "SEGUNDO": 2, "SEGUNDA": 2, "2DO": 2, "2DA": 2, "TERCERO": 3, "TERCERA": 3,
    "3ERO": 3, "3ER": 3, "3RO": 3, "CUARTO": 4, "CUARTA": 4, "4TO": 4, "QUINTO": 5, "QUINTA": 5, "5TO": 5, "SEXTO": 6, "SEXTA": 6, "6TO": 6,
    "SEPTIMO": 7, "SEPTIMA": 7, "7MO": 7, "OCTAVO": 8, "OCTAVA": 8, "8VO": 8, "NOVENO": 9, "NOVENA": 9, "9NO": 9, "DECIMO": 10, "DECIMA": 10,
    "UNDECIMO": 11, "UNDECIMA": 11, "ONCE": 11, "DUODECIMO": 12, "DUODECIMA": 12, "DOCE": 12, "TRECE": 13, "CATORCE": 14, "QUINCE": 15, "DIECISEIS": 16,
    "DIECISIETE": 17, "DIECIOCHO": 18, "DIECINUEVE": 19, "VEINTE": 20, "VEINTIUNO": 21, "VEINTIUN": 21, "VEINTIDOS": 22, "VEINTITRES": 23,
    "VEINTICUATRO": 24, "VEINTICINCO": 25, "VEINTISEIS": 26, "VEINTISIETE": 27, "VEINTIOCHO": 28, "VEINTINUEVE": 29, "TREINTA": 30, "CUARENTA": 40,
    "CINCUENTA": 50, "SESENTA": 60, "SETENTA": 70, "OCHENTA": 80, "NOVENTA": 90,
}
#: Phrases looked for anywhere in a court's name.
COURT_PHRASES = {
    "DECIMO CUARTO": 14, "DECIMO QUINTO": 15, "DECIMO SEXTO": 16, "DECIMO SEPTIMO": 17, "DECIMO OCTAVO": 18, "DECIMO NOVENO": 19, "VIGESIMO PRIMERO": 21,
    "VIGESIMO SEGUNDO": 22, "VIGESIMO TERCERO": 23, "VIGESIMO CUARTO": 24, "VIGESIMO QUINTO": 25, "VIGESIMO SEXTO": 26, "VIGESIMO SEPTIMO": 27,
    "VIGESIMO OCTAVO": 28, "VIGESIMO NOVENO": 29, "TREINTA Y UNO": 31, "TREINTA Y UN": 31, "TREINTA Y DOS": 32, "TREINTA Y TRES": 33,
    "TREINTA Y CUATRO": 34, "TREINTA Y CINCO": 35, "TREINTA Y SEIS": 36, "TREINTA Y SIETE": 37, "TREINTA Y OCHO": 38, "TREINTA Y NUEVE": 39,
    "CUARENTA Y UNO": 41, "CUARENTA Y UN": 41, "CUARENTA Y DOS": 42, "CUARENTA Y TRES": 43, "CUARENTA Y CUATRO": 44, "CUARENTA Y CINCO": 45,
    "CUARENTA Y SEIS": 46, "CUARENTA Y SIETE": 47, "CUARENTA Y OCHO": 48, "CUARENTA Y NUEVE": 49, "CINCUENTA Y UNO": 51, "CINCUENTA Y UN": 51,
    "CINCUENTA Y DOS": 52, "CINCUENTA Y TRES": 53, "CINCUENTA Y CUATRO": 54, "CINCUENTA Y CINCO": 55, "CINCUENTA Y SEIS": 56, "CINCUENTA Y SIETE": 57,
    "CINCUENTA Y OCHO": 58, "CINCUENTA Y NUEVE": 59, "SESENTA Y UNO": 61, "SESENTA Y UN": 61, "SESENTA Y DOS": 62, "SESENTA Y TRES": 63,
    "SESENTA Y CUATRO": 64, "SESENTA Y CINCO": 65, "SESENTA Y SEIS": 66, "SESENTA Y SIETE": 67, "SESENTA Y OCHO": 68, "SESENTA Y NUEVE": 69,
    "SETENTA Y UNO": 71, "SETENTA Y DOS": 72, "SETENTA Y TRES": 73, "SETENTA Y CUATRO": 74, "SETENTA Y CINCO": 75, "SETENTA Y SEIS": 76,
    "SETENTA Y SIETE": 77, "SETENTA Y OCHO": 78, "SETENTA Y NUEVE": 79, "OCHENTA Y UNO": 81, "OCHENTA Y DOS": 82, "OCHENTA Y TRES": 83,
}
#: Words among the first three of a court's name.
COURT_WORDS = {
    "PRIMERO": 1, "PRIMERA": 1, "PRIMER": 1, "1": 1, "01": 1, "001": 1, "SEGUNDO": 2, "SEGUNDA": 2, "2": 2, "02": 2, "002": 2, "TERCERO": 3,
    "TERCERA": 3, "TERCER": 3, "3": 3, "03": 3, "003": 3, "TRES": 3, "CUARTO": 4, "CUARTA": 4, "4": 4, "04": 4, "004": 4, "QUINTO": 5, "QUINTA": 5,
    "5": 5, "05": 5, "005": 5, "SEXTO": 6, "SEXTA": 6, "6": 6, "06": 6, "006": 6, "SEPTIMO": 7, "SEPTIMA": 7, "SETIMO": 7, "7": 7, "07": 7, "007": 7,
    "OCTAVO": 8, "OCTAVA": 8, "8": 8, "08": 8, "008": 8, "NOVENO": 9, "NOVENA": 9, "9": 9, "09": 9, "009": 9, "DECIMO": 10, "DECIMA": 10, "10": 10,
    "010": 10, "ONCE": 11, "11": 11, "UNDECIMO": 11, "DOCE": 12, "12": 12, "TRECE": 13, "13": 13, "CATORCE": 14, "14": 14, "QUINCE": 15, "15": 15,
    "DIECISEIS": 16, "16": 16, "DIECISIETE": 17, "17": 17, "DIECIOCHO": 18, "18": 18, "DIECINUEVE": 19, "19": 19, "VEINTE": 20, "20": 20,
    "VEINTIUNO": 21, "VEINTIUN": 21, "21": 21, "VEINTIDOS": 22, "22": 22, "VEINTITRES": 23, "23": 23, "VEINTICUATRO": 24, "24": 24, "VEINTICINCO": 25,
    "25": 25, "VEINTISEIS": 26, "26": 26, "VEINTISIETE": 27, "27": 27, "VEINTIOCHO": 28, "28": 28, "VEINTINUEVE": 29, "29": 29, "TREINTA": 30, "30": 30,
    "CUARENTA": 40, "40": 40, "CINCUENTA": 50, "50": 50, "SESENTA": 60, "60": 60, "SETENTA": 70, "70": 70, "OCHENTA": 80, "80": 80, "NOVENTA": 90,
    "90": 90,
}
