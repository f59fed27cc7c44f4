"""Positioned words of each layout to transactions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkledger.operators import layout, pages

WORDS = "doc_id string, file_name string, page int, word_seq long, text string, x0 double, x1 double, top double"


def page(doc, number, lines, file_name=""):
    """Words of (top, [(text, x0, x1), ...]) lines."""
    out, n = [], 0
    for top, words in lines:
        for text, x0, *x1 in words:
            n += 1
            out.append((doc, file_name, number, number * 1000 + n, text, float(x0), float(x1[0] if x1 else x0 + 20), float(top)))
    return out


HEAD = [("Date", 20), ("Code", 80), ("Description", 110), ("Frais", 250), ("Retrait", 300), ("Dépôt", 380), ("Solde", 460)]
RBC_HEAD = [("Date", 45, 60), ("Description", 90, 140), ("débits", 300, 330), ("($)", 332, 345), ("crédits", 400, 430), ("($)", 432, 445), ("Solde", 500, 530)]
BANK = page("bank", 0, [
    (10, [("CAISSE DESJARDINS", 20), ("Folio 12345", 200), ("2024", 300)]), (30, HEAD), (40, [("EOP", 20), ("OPERATIONS", 60)]),
    (50, [("05 JAN", 20), ("RA", 78), ("Loyer", 110), ("bureau", 150), ("1 475.60", 295, 335), ("900.00", 450, 490)]),
    (60, [("FORFAIT DE FRAIS DE FINANCEMENT", 110), ("3.00", 295, 335), ("4.50", 300, 336)]),
    (70, [("06 FÉV", 20), ("DI", 78), ("Dépôt", 110), ("12.00", 370, 410), ("475.60-", 450, 490)]),
    (72.9, [("late", 180)]), (90, [("Solde reporté", 110), ("1.00", 370, 410)]),
    (100, [("SOMMAIRE DES FRAIS", 20)]), (110, [("07 MAR", 20), ("Frais", 110), ("9.00", 295, 335)]),
]) + page("bank", 1, [
    (10, [("No date yet", 110), ("8.00", 295, 335)]), (20, [("EOP", 20), ("EPARGNE", 60)]), (30, [("Still none", 110), ("7.00", 295, 335)]), (40, [("08 DÉC", 20), ("VWW", 78), ("Achat", 110), ("2.00", 295, 335)]),
    (50, [("PRET HYPOTHECAIRE", 20)]), (60, [("09 DÉC", 20), ("x", 110), ("2.00", 295, 335)]),
])
RBC = page("rbc", 0, [
    (10, [("Banque Royale", 20), ("Numéro de compte: 01234 123-456-7", 200), ("Du 5 décembre 2023 au 4 janvier 2024", 300)]), (30, RBC_HEAD),
    (40, [("20 déc", 45), ("Fournisseur", 90), ("1", 318, 322), ("205,09", 325, 345), ("5 000,00", 500, 530)]),
    (50, [("Client", 90), ("(6 973,33)", 405, 440)]), (60, [("2 jan", 45), ("Frais", 90), ("3,00", 320, 340)]), (70, [("Solde de clôture", 90), ("1,00", 500, 530)]), (80, [("1 de 3", 300)]),
])
CC = page("cc", 0, [
    (10, [("Desjardins AFFAIRES MARGE", 20), ("Jour 03 Mois 01 Année 2025", 200), ("4530 92** **** 4002", 400)]),
    (40, [("28", 40), ("12", 60), ("30", 90), ("12", 110), ("Essence", 255), ("1 250,00 CR", 480)]), (50, [("02", 40), ("01", 60), ("Papier", 255), ("4,10", 480)]), (60, [("02", 40), ("Une date", 255), ("4,10", 480)]),
    (70, [("02", 40), ("01", 60), ("NOUVEAU SOLDE", 255), ("4,10", 480)]), (80, [("03", 40), ("01", 60), ("Jane Roe", 255), ("9,00", 480)]),
])
VISA = page("visa", 0, [
    (10, [("RBC Visa", 20), ("4516 07** **** 9146", 100), ("Échéance 21 JUL 2024", 200)]), (40, [("15 JUN", 30), ("17 JUN", 60), ("Hôtel", 130), ("1 234,50", 300), ("$", 340)]),
    (50, [("Suite du séjour", 130)]), (60, [("Remise", 130), ("(12,00)", 300), ("$", 340)]), (70, [("JOHN DOE", 30)]), (80, [("12345678901234567", 130)]), (90, [("20 DÉC", 30), ("Cadeau", 130), ("5,00", 300), ("9,99", 400)]),
], "releve 2024.07.pdf")
BDC = page("bdc", 0, [
    (10, [("Solutions Mastercard", 20), ("DATE DU RELEVÉ 24 01 09", 200), ("5191 234567 345678", 300)]), (40, [("12", 30), ("28", 50), ("REF", 100), ("Vol", 190), ("6,000.00-", 440)]), (50, [("01", 30), ("03", 50), ("Taxi", 190), ("30.10", 440)]),
    (60, [("****", 100), ("1.00", 440)]),
])
TD = page("td", 0, [
    (10, [("TD Aeroplan", 20)]), (20, [("May 23, 2024 to June 24, 2024", 200)]), (40, [("MAY 24", 30), ("Books", 140), ("$23.64", 300)]), (50, [("MAY 25", 30), ("Paid", 140), ("-$6,000.00", 300)]), (60, [("26 mai", 30), ("Café", 140), ("1 610,00 $", 300)]), (70, [("TOTAL", 140), ("9.00", 300)]),
    (80, [("Right side", 140), ("5.00", 355)]),
])
PERSO = page("perso", 0, [
    (10, [("BONIDOLLARS", 20), ("Jour 09 Mois 02 Année 2025", 200)]), (40, [("03", 40), ("02", 60), ("Resto", 220), ("45,00", 470)]), (50, [("30", 40), ("12", 60), ("Retour", 220), ("5,00CR", 470)]),
])
OTHER = page("other", 0, [(10, [("nothing known", 20)]), (20, [("01", 40), ("02", 60), ("x", 255), ("4,10", 480)])])


def test_transactions_of_every_layout(spark):
    rows = [r for doc in (BANK, RBC, CC, VISA, BDC, TD, PERSO, OTHER) for r in doc] + [("bank", "", 0, 999, None, 1.0, 2.0, 3.0)]
    got = pages.transactions(spark.createDataFrame(rows, WORDS).repartition(5), cardholders=["jane roe"]).collect()
    money = lambda v: None if v is None else float(v)
    found = sorted(((r.doc_id, r.page, r.date, r.description, money(r.debit), money(r.credit), money(r.balance)) for r in got), key=str)
    d, by_text = dt.date, lambda rows: sorted(rows, key=str)
    assert found == by_text([
        ("bank", 0, d(2024, 1, 5), "Loyer bureau", 1475.6, None, 900.0), ("bank", 0, d(2024, 1, 5), "FORFAIT DE FRAIS DE FINANCEMENT", 7.5, None, None),
        ("bank", 0, d(2024, 2, 6), "Dépôt late", None, 12.0, -475.6), ("bank", 1, d(2024, 12, 8), "Achat", 2.0, None, None),
        ("rbc", 0, d(2023, 12, 20), "Fournisseur", 1205.09, None, 5000.0), ("rbc", 0, d(2023, 12, 20), "Client", None, 6973.33, None), ("rbc", 0, d(2024, 1, 2), "Frais", 3.0, None, None),
        ("cc", 0, d(2024, 12, 28), "Essence", None, 1250.0, None), ("cc", 0, d(2025, 1, 2), "Papier", 4.1, None, None),
        ("visa", 0, d(2024, 6, 15), "Hôtel", 1234.5, None, None), ("visa", 0, d(2024, 6, 15), "Remise", None, 12.0, None), ("visa", 0, d(2023, 12, 20), "Cadeau", 5.0, None, None),
        ("bdc", 0, d(2023, 12, 28), "Vol", None, 6000.0, None), ("bdc", 0, d(2024, 1, 3), "Taxi", 30.1, None, None),
        ("td", 0, d(2024, 5, 24), "Books", 23.64, None, None), ("td", 0, d(2024, 5, 25), "Paid", None, 6000.0, None), ("td", 0, d(2024, 5, 26), "Café", 1610.0, None, None),
        ("perso", 0, d(2025, 2, 3), "Resto", 45.0, None, None), ("perso", 0, d(2024, 12, 30), "Retour", None, 5.0, None),
    ])
    assert {(r.doc_id, r.code) for r in got if r.code} == {("bank", "RA"), ("bank", "DI"), ("bank", "VWW")}
    assert {r.doc_id: r.card for r in got}["cc"] == "4530 92** **** 4002" and {r.doc_id: r.account for r in got}["bank"] == "0012345"
    assert pages.transactions(spark.createDataFrame([], WORDS)).count() == 0


@pytest.mark.parametrize("name", list(pages.LAYOUTS))
def test_token_roles(spark, name):
    bounds = {c: F.lit(v) for c, v in {"code_x": 80.0, "desc_x": 110.0, "frais_x": 250.0, "debit_x": 265.0}.items()}
    words = spark.createDataFrame([(20.0, "05"), (200.0 if name not in ("desjardins_cc_pdf", "desj_visa_perso_pdf") else 260.0, "Loyer"), (480.0, "12.00")], "x0 double, text string")
    roles = [r.role for r in words.select("x0", layout.token_role(name, F.col("x0"), F.col("text"), bounds).alias("role")).orderBy("x0").collect()]
    assert roles == ["date", "description", "amount"]
