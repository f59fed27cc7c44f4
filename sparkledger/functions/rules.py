"""Ordered pattern rules as data: the first rule that matches a description gives its category.

A rule is (pattern, category, label).  A rule list becomes one CASE expression, so Catalyst evaluates it
inside code generation and each pattern is compiled once per task.  Patterns ignore case for all letters
and their ``\\s`` covers the no-break space.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkledger.plans.shared import materialize

Rule = tuple[str, str, str]
FLAGS = "(?iU)"

#: Bank rules in their order.
BANK_RULES: list[Rule] = [
    (r"PAYFACTO CAD PAYFACTO", "revenue_pos", "Revenue POS (Payfacto)"),
    (r"Lightspeed Commerce.*LS", "revenue_pos", "Revenue POS (Lightspeed)"),
    (r"AMEX 2992156570", "revenue_amex", "Revenue AMEX"),
    (r"Uber Holdings C", "revenue_delivery", "Revenue Uber Eats"),
    (r"DoorDash", "revenue_delivery", "Revenue DoorDash"),
    (r"UEAT AR", "revenue_delivery", "Revenue UberEats AR"),
    (r"D[ée]p[oô]t GAB", "revenue_cash", "Revenue Cash (GAB)"),
    (r"D[ée]p[oô]t direct", "revenue_deposit", "Revenue Direct Deposit"),
    (r"NETHRIS", "labor", "Labor (Nethris)"),
    (r"CGI PAYROLL", "labor", "Labor (CGI Payroll)"),
    (r"LOYER|BAUX", "rent", "Rent"),
    (r"HYDRO-QUEBEC", "utilities", "Utilities (Hydro-Quebec)"),
    (r"ENERGIR", "utilities", "Utilities (Energir)"),
    (r"BELL CAN|BELL MOBIL", "utilities", "Utilities (Bell)"),
    (r"VIDEOTRON", "utilities", "Utilities (Videotron)"),
    (r"Intact Assur|Economical", "insurance", "Insurance"),
    (r"REV QC|REVENU QUEBEC", "tax_rq", "Tax (Revenue Quebec)"),
    (r"PME MTL|VILLE DE|MUNICIPAL", "tax_municipal", "Tax (Municipal)"),
    (r"Paiement /LSPD CAPITAL|LSPD CAPITAL", "loan_lightspeed", "Lightspeed Cash Advance Repayment"),
    (r"Remise gouvernementale.*TPS|Remise gouvernementale.*TVQ", "tax_gst_qst", "Tax Remittance (TPS-TVQ)"),
    (r"Paiement internet.*Landlord.*rent|Paiement internet.*Landlord.*loyer", "rent", "Rent (Landlord)"),
    (r"Paiement internet.*Landlord.*Tax", "tax_property", "Property Tax (Landlord)"),
    (r"Paiement internet.*Landlord", "rent_unconfirmed", "Landlord Payment (rent or tax — à confirmer)"),
    (r"Owner_B\s*Holding", "ali_advance", "Owner_B Holding (Shareholder Advance)"),
    (r"VERSEMENT PRET|Versement sur pr[êe]t", "loan", "Loan Payment"),
    (r"Int[ée]r[êe]ts sur pr[êe]t", "loan_interest", "Loan Interest"),
    (r"CREDIT PRET", "loan_credit", "Loan Credit"),
    (r"ECONOLEASE|VLFC", "lease", "Equipment Lease"),
    (r"BANQUE DEVELOPPEMENT|BDC", "loan_bdc", "BDC Payment"),
    (r"CWB National Leasing", "lease", "Equipment Lease (CWB)"),
    (r"D[ÉE]P[ÔO]T DE LA MARGE", "credit_line", "Credit Line Draw"),
    (r"Frais fixes financement", "loan_fees", "Financing Fees"),
    (r"Frais mensuels|Frais bancaires|Frais fixes d.utilisation", "bank_fees", "Bank Fees"),
    (r"MERCH PAD|FIRST DATA|CLOVER", "pos_fees", "POS/Card Processing Fees"),
    (r"Frais virement INTERAC", "bank_fees", "Interac Fee"),
    (r"Brasseurs|Molson|Labatt", "supplier_beverage", "Supplier (Beverage)"),
    (r"march[ée]", "supplier_food", "Supplier (Food)"),
    (r"ECOLAB|Cintas", "supplier_cleaning", "Supplier (Cleaning/Linen)"),
    (r"Sysco|GFS|Gordon Food", "supplier_food", "Supplier (Food Distributor)"),
    (r"SAQ\d", "supplier_alcohol", "Supplier (SAQ)"),
    (r"Virement.*Acc[èe]sD.*EOP", "transfer_internal", "Internal Transfer"),
    (r"Virement Interac", "transfer_interac", "Interac Transfer"),
    (r"Virement envoy[ée]", "transfer_out", "Transfer Out"),
    (r"Virement re[çc]u", "transfer_in", "Transfer In"),
    (r"VISA DESJARDINS|Paiement.*American Express", "cc_payment", "CC Payment"),
    (r"trustee|syndic", "trustee", "Trustee Payment"),
    (r"PAIEMENT RE[ÇC]U.*MERCI", "cc_payment_received", "Amex Payment Received"),
    (r"Virement-remboursement.*PR\s*\d", "credit_line_repayment", "Credit Line Repayment"),
    (r"JOURNEY CAPITAL|ONDECK", "loan_journey", "Loan (Journey Capital/OnDeck)"),
    (r"Assurance.*Compagnie|assurance", "insurance", "Insurance"),
    (r"AGENDRIX", "software_hr", "Software (Agendrix HR/Scheduling)"),
    (r"SAQ\s", "supplier_alcohol", "Supplier (SAQ Alcohol)"),
    (r"Milton rent|Milton Rent", "rent_milton", "Rent (Milton)"),
    (r"D[ée]p[oô]t au comptoir", "cash_deposit", "Cash Deposit (Counter)"),
    (r"Retrait au comptoir", "cash_withdrawal_counter", "Cash Withdrawal (Counter)"),
    (r"Paiement.*PAYFACTO", "pos_fees", "POS Fees (Payfacto)"),
    (r"Virement par Banque en direct", "transfer_bank_direct", "Direct Bank Transfer"),
    (r"PAYROLL", "software_payroll", "Payroll Software (generic)"),
    (r"Retrait GAB", "cash_withdrawal", "Cash Withdrawal (ATM)"),
    (r"Ch[èe]que", "cheque", "Cheque"),
    (r"Achat Interac|D[ée]bit", "purchase", "Purchase"),
    (r"Remboursement automatique", "auto_repayment", "Auto Repayment"),
    (r"AVANCE DE FONDS VISA", "cc_advance", "CC Cash Advance"),
    (r"FRAIS D'?UTILISATION", "bank_fees", "Bank Fees (Usage)"),
    (r"FRAIS DE CR[ÉE]DIT", "bank_fees", "Bank Fees (Credit)"),
    (r"INT[ÉE]R[ÊE]TS\s+SUR\s+ACHATS", "interest", "Interest on Purchases"),
    (r"FORFAIT DE FRAIS DE FINANCEMEN", "loan_fees", "Financing Fee Package"),
    (r"^INT[ÉE]R[ÊE]TS\s*$|^INT[ÉE]R[ÊE]TS\s+\d", "interest", "Interest"),
    (r"REMBOURSEMENT DES FRAIS", "bank_refund", "Bank Fee Refund"),
    (r"FRAIS POUR OP[ÉE]RATIONS", "bank_fees", "Bank Fees (Operations)"),
    (r"PAIEMENT AUTORIS[ÉE].*PR[ÉE]L[ÈE]VEMEN", "pre_auth_payment", "Pre-Authorized Payment"),
    (r"FACEBK\s|FACEBOOK", "marketing_ads", "Marketing (Facebook Ads)"),
    (r"PAIEMENT FACTURE.*ACC[ÈE]SD", "bill_payment", "Bill Payment (AccèsD)"),
    (r"EUREKA\s*&?\s*FI", "loan_eureka", "Loan (Eureka & Fi Finance)"),
    (r"PAIEMENT INTERNET.*COMPTABL", "professional_services", "Professional Services (Accountant)"),
    (r"PAIEMENT.*AMEX\s+BANK", "cc_payment", "AMEX Payment"),
    (r"SUPA\s*PHO", "supplier_food", "Supplier (Supa Pho)"),
    (r"D[ÉE]P[ÔO]T AU GA\b|D[ÉE]P[ÔO]T AU GAB", "revenue_cash", "Cash Deposit (ATM)"),
    (r"PEACOCK", "supplier_food", "Supplier (Peacock)"),
    (r"EPIDEMIC SOUND", "software", "Software (Epidemic Sound)"),
    (r"MONERIS", "pos_fees", "POS Fees (Moneris)"),
    (r"BNI-VILLEMARIE|BNI VILLEMARIE", "business_networking", "Business Networking (BNI)"),
    (r"DOLLARAMA", "supplier_misc", "Supplier (Dollarama)"),
    (r"^\s*$", "no_description", "No Description (Data Quality Flag)"),
]

#: Card rules by set, each in its order.
CARD_RULES: dict[str, list[Rule]] = {
    "FLAG": [],
    "CARD_FEE": [
        (r"ASSURANCE PAIEMENT", "card_fee", "Card Insurance"),
        (r"FRAIS DE DEPASSEMENT", "card_fee", "Overlimit Fee"),
        (r"INTERETS SUR ACHATS", "card_fee", "Interest Charges"),
        (r"FRAIS DE CR[ÉE]DIT", "card_fee", "Credit Fee"),
        (r"FRAIS SOLUTIONS LIBRE", "card_fee", "Card Service Fee"),
        (r"MENSUALIT[ÉE]\s*FINANCEMENT", "card_fee", "Card Financing Fee"),
        (r"FRAIS\s*INTERET|FRAIS\s*INTÉRÊT", "card_fee", "Interest Charges"),
        (r"PAIEMENT\s*-?\s*MERCI|PAIEMENT\s*RECU\s*MERCI", "card_fee", "CC Payment Received (not expense)"),
    ],
    "VERIFY": [
        (r"APPLE\.COM|APPLE\.COM/BILL", "VERIFY", "Apple — mixed business/personal"),
        (r"UBER\s*CANADA.*TRIP|UBERCANADA.*TRIP", "VERIFY", "Uber Trips — mixed, manual review"),
        (r"UBER.*EATS|UBEREATS", "VERIFY", "UberEats — mixed, manual review"),
        (r"WALMART", "VERIFY", "Walmart — could be restaurant or personal"),
        (r"ESSO|PETRO|SHELL|ULTRAMAR|COUCHE-TARD", "VERIFY", "Gas/Transport — mixed, apply business %"),
        (r"INTERET\s*DE\s*DETAIL|INTERETDEDETAIL", "card_fee", "Intérêt de détail"),
    ],
    "TEAM_BUILDING": [
        (r"VRBO|AIRBNB", "team_building", "Partner Trip Accommodation"),
        (r"BOOKING\.COM", "team_building", "Partner Trip Booking"),
    ],
    "PERSONAL": [
        (r"FITNESS|GYM", "fitness", "Fitness"),
        (r"NETFLIX|SPOTIFY|DISNEY|CRAVE", "entertainment", "Streaming"),
        (r"PHARMAPRIX|JEAN COUTU", "pharmacy", "Pharmacie"),
        (r"NESPRESSO", "personal_shopping", "Nespresso"),
        (r"ANNUAL\s*FEE", "card_fee", "Annual Fee"),
        (r"DOLLARAMA", "personal_shopping", "Dollarama (Perso)"),
    ],
    "BUSINESS": [
        (r"CINTAS", "supplier_cleaning", "Cintas"),
        (r"ECOLAB", "supplier_cleaning", "Ecolab"),
        (r"COSTCO\s*DELIVERY|COSTCO\s*ENTREPRISE|COSTCOENTREPRISE", "supplier_food", "Costco (Business)"),
        (r"CANADIAN TIRE", "supplier_misc", "Canadian Tire"),
        (r"RONA|HOME DEPOT|BMR", "construction", "Hardware Store"),
        (r"VIDEOTRON", "telecom", "Vidéotron"),
        (r"ROGERS", "telecom", "Rogers"),
        (r"ENERGIR", "utility", "Énergir"),
        (r"HYDRO.QUEBEC", "utility", "Hydro-Québec"),
        (r"LIGHTSPEED", "software_pos", "Lightspeed (POS)"),
        (r"OPENTABLE", "software_reservation", "OpenTable"),
        (r"AGENDRIX", "software_hr", "Agendrix"),
        (r"INDEED", "software_hr", "Indeed (Recrutement)"),
        (r"UEAT|UBER.*EAT", "delivery_platform", "UberEats"),
        (r"GOOGLE.*SUITE|GOOGLE.*WORKSPACE|GSUITE", "software", "Google Workspace"),
        (r"QUICKBOOKS", "software", "QuickBooks"),
        (r"DROPBOX", "software", "Dropbox"),
        (r"ZOOM", "software", "Zoom"),
        (r"ADOBE", "software", "Adobe"),
        (r"FACEBOOK|FACEBK", "marketing", "Facebook Ads"),
        (r"AGENCE DE MOBILIT|AGENCEDEMOBILIT", "transport", "Parking/Mobilité"),
        (r"UHC OF QUEBEC|UHAUL", "storage", "UHaul/Storage"),
        (r"EXTERMINATEUR|PEST", "supplier_service", "Pest Control"),
    ],
}
#: Fixed value: wine-shop purchases from this amount on are business.
SAQ_THRESHOLD = 300


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(FLAGS + pattern)


def literal(text: str) -> str:
    """A pattern that matches exactly ``text``."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def first_match(text: Column, rules: Sequence[Rule], default: tuple[str, str] | None = None) -> Column:
    """struct(category, label) of the first rule that matches; null text counts as empty."""
    text, found = F.coalesce(text, F.lit("")), None
    for pattern, category, label in rules:
        value = F.struct(F.lit(category).alias("category"), F.lit(label).alias("label"))
        found = F.when(matches(text, pattern), value) if found is None else found.when(matches(text, pattern), value)
    last = F.struct(F.lit(default[0]).alias("category"), F.lit(default[1]).alias("label")) if default else F.lit(None)
    return last if found is None else found.otherwise(last)


#: Distinct texts of so many bytes are sent to all tasks.  With more, a text of more than one row in ``HOT`` is sent alone, and
#: if a text has fewer than ``REPEATS`` rows on average each row is judged where it is.
TEXT_BYTES, HOT, REPEATS = 8 << 20, 1000, 2


def by_text(df: DataFrame, text: str, answer: Column) -> DataFrame:
    """Adds ``_hit``, an answer that depends on a text (``_text``) alone, computed once for each distinct one.

    The distinct texts are counted, written and measured.  A small table is broadcast, so rows stay where they are.  Of a
    large one the hot texts ("deposit", blanks), of which there are fewer than ``HOT``, are broadcast while they too are small,
    and only the rows of other texts are shuffled to meet their answers.  Texts that hardly repeat are not looked up at all.
    """
    key = F.coalesce(text, F.lit(""))
    rows = df.withColumn("_text", key)
    texts = materialize(rows.groupBy("_text").agg(F.count("*").alias("_n")), "texts")
    bytes_of = F.sum(F.octet_length("_text") + 64)
    known = texts.agg(bytes_of.alias("size"), F.sum("_n").alias("rows"), F.count("*").alias("texts")).first()
    answers = texts.drop("_n").withColumn("_hit", answer)
    if (known["size"] or 0) <= TEXT_BYTES:
        return rows.join(F.broadcast(answers), "_text").drop("_text")
    if known["rows"] < REPEATS * known["texts"]:
        return rows.withColumn("_hit", answer).drop("_text")
    hot = texts.where(F.col("_n") * HOT > known["rows"]).drop("_n")
    size = hot.agg(bytes_of.alias("size")).first()["size"]
    if size is None or size > max(TEXT_BYTES, 8 << 20):  # none, or long ones: AQE splits a skewed join
        return rows.join(answers.hint("merge"), "_text").drop("_text")
    often = rows.join(F.broadcast(hot.withColumn("_hit", answer)), "_text")
    rest = rows.join(F.broadcast(hot), "_text", "left_anti").join(answers.hint("merge"), "_text")
    return often.unionByName(rest).drop("_text")


def categorize(df: DataFrame, rules: Sequence[Rule] = BANK_RULES, text: str = "description") -> DataFrame:
    """Adds category and category_label; each distinct description is classified once."""
    joined = by_text(df, text, first_match(F.col("_text"), rules, ("uncategorized", "UNCATEGORIZED")))
    return joined.withColumns({"category": F.col("_hit.category"), "category_label": F.col("_hit.label")}).drop("_hit")


def classify_card(text: Column, amount: Column, rules: dict[str, list[Rule]] = CARD_RULES, threshold: float = SAQ_THRESHOLD) -> Column:
    """struct(class, category, label, business_amount, status) of a card row.

    The ladder is flags, fees, merchants to verify, team events, personal merchants, the wine-shop
    threshold, business merchants; what no rule knows is to be verified.  business_amount null is
    pending and 0 is not deductible.
    """
    none = F.lit(None).cast("decimal(18,2)")
    zero, whole = F.lit(0).cast("decimal(18,2)"), amount.cast("decimal(18,2)")

    def result(cls, category, label, business, status):
        named = {"class": F.lit(cls), "category": F.lit(category), "label": F.lit(label), "business_amount": business, "status": F.lit(status)}
        return F.struct(*[v.alias(k) for k, v in named.items()])

    text = F.coalesce(text, F.lit(""))
    steps = [(p, result("FLAG", c, l, none, "NEEDS_REVIEW")) for p, c, l in rules["FLAG"]]
    steps += [(p, result("CARD_FEE", c, l, zero, "CONFIRMED")) for p, c, l in rules["CARD_FEE"]]
    steps += [(p, result("CARD_FEE", "card_fee", l, zero, "CONFIRMED") if c == "card_fee" else result("VERIFY", "verify_specific", l, none, "NEEDS_REVIEW")) for p, c, l in rules["VERIFY"]]
    steps += [(p, result("TEAM_BUILDING", c, l, none, "NEEDS_REVIEW")) for p, c, l in rules["TEAM_BUILDING"]]
    steps += [(p, result("PERSONAL", c, l, zero, "CONFIRMED")) for p, c, l in rules["PERSONAL"]]
    found = None
    for pattern, value in steps:
        found = F.when(matches(text, pattern), value) if found is None else found.when(matches(text, pattern), value)
    wine = matches(text, "SAQ")
    found = found.when(wine & (amount >= threshold), result("BUSINESS", "supplier_alcohol", "SAQ (>=$300)", whole, "CONFIRMED"))
    found = found.when(wine, result("PERSONAL", "personal_alcohol", "SAQ (<$300)", zero, "CONFIRMED"))
    for pattern, category, label in rules["BUSINESS"]:
        found = found.when(matches(text, pattern), result("BUSINESS", category, label, whole, "CONFIRMED"))
    return found.otherwise(result("VERIFY", "unknown", "NEEDS_REVIEW — no rule match", none, "NEEDS_REVIEW"))


def classify_cards(cards: DataFrame, amount: Column, text: str = "description", rules: dict[str, list[Rule]] = CARD_RULES, threshold: float = SAQ_THRESHOLD) -> DataFrame:
    """Adds ``_r``, the ladder's struct, to card rows.

    Each distinct text is classified once, as for an amount below and one at the threshold, and joined back;
    a business part is then the row's own amount.
    """
    wine = F.col("_hit.category") == "personal_alcohol"  # the one rule that looks at the amount
    money = amount.cast("decimal(18,2)")
    fields = {"class": "class", "category": "category", "label": "label", "business_amount": None, "status": "status"}
    high = {"class": "BUSINESS", "category": "supplier_alcohol", "label": "SAQ (>=$300)", "status": "CONFIRMED"}
    over = wine & (amount >= threshold)
    whole = over | (F.col("_hit.class") == "BUSINESS")
    parts = [(F.when(whole, money).otherwise(F.col("_hit.business_amount")) if f is None else F.when(over, high[f]).otherwise(F.col(f"_hit.{f}"))).alias(name) for name, f in fields.items()]
    return by_text(cards, text, classify_card(F.col("_text"), F.lit(0.0), rules, threshold)).withColumn("_r", F.struct(*parts)).drop("_hit")


def fits_engine(pattern: str) -> bool:
    """Whether Spark can run a pattern: its own engine is asked, in a query of one row."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    try:
        spark.range(1).select(matches(F.concat(F.lit("a"), F.col("id").cast("string")), pattern).alias("m")).collect()
    except (PySparkException, Py4JJavaError):  # refused in planning, or by the task
        return False
    return True


def rules_from_json(text: str | None) -> list[Rule]:
    """Extra rules from JSON, a list of [pattern, category, label]; what is malformed gives none, and so does an entry of another shape or a pattern that Spark refuses."""
    try:
        found = json.loads(text or "[]")
    except ValueError:
        return []
    shaped = [tuple(e) for e in found if isinstance(e, list) and len(e) == 3 and all(isinstance(x, str) for x in e)] if isinstance(found, list) else []
    return [entry for entry in shaped if fits_engine(entry[0])]


def with_extra(rules: dict[str, list[Rule]], extra: dict[str, list[Rule]]) -> dict[str, list[Rule]]:
    """Rule sets with a caller's own rules behind the shipped ones."""
    return {name: [*rules.get(name, []), *extra.get(name, [])] for name in {**rules, **extra}}


def sql_case(text: str, rules: Sequence[Rule], default: str, field: int = 1) -> str:
    """The same ladder as DuckDB SQL, for checks: field 1 is the category, 2 the label."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    whens = " ".join(f"WHEN regexp_matches(coalesce({text}, ''), {quoted('(?i)' + r[0])}) THEN {quoted(r[field])}" for r in rules)
    return f"CASE {whens} ELSE {quoted(default)} END"
