"""Normalisation rules of the gold layer.

FIXED VALUES: the labels, ILIKE patterns and regexes below must equal the
reference warehouse's rules for results to match; they are listed in the
reference's order (first match wins).  Two rule copies exist on purpose
(dimension vs fact, SURVEY trap T3) and must stay different.
"""

from souk.functions.rules import ilike, pg_regex

# ---- R1 city (dimension; the fact uses the identical copy) ----------------
CITY_RULES = [
    ("Casablanca", ilike("%casablanca%")),
    ("Rabat", ilike("%rabat%")),
    ("Marrakech", ilike("%marrakech%")),
    ("Tanger", ilike("%tanger%")),
    ("Fès", ilike("%fès%", "%fes%", "%fez%")),
    ("Agadir", ilike("%agadir%")),
    ("Meknès", ilike("%meknès%", "%meknes%")),
    ("Oujda", ilike("%oujda%")),
    ("Kénitra", ilike("%kénitra%", "%kenitra%")),
    ("Tétouan", ilike("%tétouan%", "%tetouan%")),
    ("Salé", ilike("%salé%", "%sale%")),
    ("Mohammedia", ilike("%mohammedia%")),
    ("El Jadida", ilike("%el jadida%")),
    ("Nador", ilike("%nador%")),
    ("Settat", ilike("%settat%") & ~ilike("%casablanca%")),
    ("Berrechid", ilike("%berrechid%")),
    ("Khouribga", ilike("%khouribga%")),
    ("Beni Mellal", ilike("%beni mellal%")),
    ("Témara", ilike("%temara%", "%témara%")),
    ("Safi", ilike("%safi%")),
    ("Essaouira", ilike("%essaouira%")),
    ("Ifrane", ilike("%ifrane%")),
    ("Ouarzazate", ilike("%ouarzazate%")),
    ("Laâyoune", ilike("%laâyoune%", "%laayoune%")),
    ("Dakhla", ilike("%dakhla%")),
    ("Maroc (national)", ilike("%maroc%", "%morocco%")),
]

REGION_RULES = [
    ("Casablanca-Settat", ilike("%casablanca%", "%mohammedia%", "%berrechid%", "%settat%", "%el jadida%")),
    ("Rabat-Salé-Kénitra", ilike("%rabat%", "%salé%", "%sale%", "%temara%", "%témara%", "%kénitra%", "%kenitra%")),
    ("Marrakech-Safi", ilike("%marrakech%", "%safi%", "%essaouira%")),
    ("Tanger-Tétouan-Al Hoceïma", ilike("%tanger%", "%tétouan%", "%tetouan%")),
    ("Fès-Meknès", ilike("%fès%", "%fes%", "%meknès%", "%meknes%")),
    ("Oriental", ilike("%oujda%", "%nador%")),
    ("Souss-Massa", ilike("%agadir%")),
    ("Béni Mellal-Khénifra", ilike("%beni mellal%", "%khouribga%")),
    ("Fès-Meknès", ilike("%ifrane%")),
    ("Sud", ilike("%ouarzazate%", "%laâyoune%", "%laayoune%", "%dakhla%")),
]
REGION_DEFAULT = "Non spécifiée"

# ---- R2 contract (applied to the text before the first '-') ---------------
CONTRACT_RULES = [
    ("CDI", ilike("%CDI%")),
    ("CDD", ilike("%CDD%")),
    ("Stage", ilike("%stage%", "%intern%")),
    ("PFE", ilike("%PFE%")),
    ("Alternance", ilike("%alternance%", "%apprentice%")),
    ("Freelance", ilike("%freelance%", "%contract%")),
    ("Temps plein", ilike("%temps plein%", "%full%time%")),
    ("Temps partiel", ilike("%temps partiel%", "%part%time%")),
]
CONTRACT_DEFAULT = "Autre"

CONTRACT_CATEGORY_RULES = [
    ("Long terme", ilike("%CDI%", "%temps plein%", "%full%time%")),
    ("Moyen terme", ilike("%CDD%")),
    ("Formation", ilike("%stage%", "%intern%", "%PFE%", "%alternance%", "%apprentice%")),
    ("Flexible", ilike("%freelance%", "%contract%", "%temps partiel%", "%part%time%")),
]
CONTRACT_CATEGORY_DEFAULT = "Autre"

# ---- R3 education ----------------------------------------------------------
EDUCATION_DIM_RULES = [
    ("Doctorat", ilike("%doctorat%", "%phd%", "%doctorate%")),
    ("Bac+5 / Master / Ingénieur",
     ilike("%bac%+%5%", "%bac+5%", "%master%", "%ing[ée]nieur%", "%MSc%", "%engineering degree%")),
    ("Bac+4", ilike("%bac%+%4%", "%bac+4%")),
    ("Bac+3 / Licence", ilike("%bac%+%3%", "%bac+3%", "%licence%", "%bachelor%", "%BSc%")),
    ("Bac+2 / BTS / DUT", ilike("%bac%+%2%", "%bac+2%", "%BTS%", "%DUT%", "%associate%")),
]
# fact copy: without 'engineering degree', 'BSc', 'associate' (trap T3)
EDUCATION_FACT_RULES = [
    ("Doctorat", ilike("%doctorat%", "%phd%", "%doctorate%")),
    ("Bac+5 / Master / Ingénieur", ilike("%bac%+%5%", "%bac+5%", "%master%", "%ing[ée]nieur%", "%MSc%")),
    ("Bac+4", ilike("%bac%+%4%", "%bac+4%")),
    ("Bac+3 / Licence", ilike("%bac%+%3%", "%bac+3%", "%licence%", "%bachelor%")),
    ("Bac+2 / BTS / DUT", ilike("%bac%+%2%", "%bac+2%", "%BTS%", "%DUT%")),
]
EDUCATION_DEFAULT = "Autre / Non spécifié"

EDUCATION_LEVEL_RULES = [
    (6, ilike("%doctorat%", "%phd%")),
    (5, ilike("%bac%+%5%", "%bac+5%", "%master%", "%ing[ée]nieur%")),
    (4, ilike("%bac%+%4%")),
    (3, ilike("%bac%+%3%", "%licence%", "%bachelor%")),
    (2, ilike("%bac%+%2%", "%BTS%", "%DUT%")),
]
EDUCATION_LEVEL_DEFAULT = 0

EDUCATION_CATEGORY_BY_LEVEL = [  # thresholds on MIN(level), first wins
    (5, "Études supérieures longues"),
    (3, "Études supérieures courtes"),
    (2, "Bac+2"),
]
EDUCATION_CATEGORY_DEFAULT = "Non spécifié"

# ---- R4 experience ---------------------------------------------------------
_EXP_JUNIOR = ilike("%débutant%", "%junior%", "%entry%", "%stagiaire%", "%internship%")
_EXP_MID = ilike("%mid%", "%associate%", "%intermediate%")
_EXP_SENIOR = ilike("%senior%", "%confirm%")
_EXP_LEAD = ilike("%lead%", "%director%", "%executive%", "%expert%")

EXPERIENCE_DIM_RULES = [
    ("Junior / Débutant", _EXP_JUNIOR),
    ("Intermédiaire", _EXP_MID),
    ("Senior / Confirmé", _EXP_SENIOR),
    ("Lead / Expert", _EXP_LEAD),
    ("Junior / Débutant", pg_regex(r"^\s*0\s*[-à]\s*[12]")),
    ("Intermédiaire", pg_regex(r"^\s*[12]\s*[-à]\s*[34]")),
    ("Senior / Confirmé", pg_regex(r"^\s*[34]\s*[-à]\s*[5-9]")),
    ("Senior / Confirmé", pg_regex(r"\m([5-9]|1[0-9])\s*ans?")),
    ("Junior / Débutant", pg_regex(r"\m[1-2]\s*ans?")),
    ("Intermédiaire", pg_regex(r"\m[3-4]\s*ans?")),
]
# fact copy: no range arms, 3-4 years tested before 1-2 (trap T3)
EXPERIENCE_FACT_RULES = [
    ("Junior / Débutant", _EXP_JUNIOR),
    ("Intermédiaire", _EXP_MID),
    ("Senior / Confirmé", _EXP_SENIOR),
    ("Lead / Expert", _EXP_LEAD),
    ("Senior / Confirmé", pg_regex(r"\m([5-9]|1[0-9])\s*ans?")),
    ("Intermédiaire", pg_regex(r"\m[3-4]\s*ans?")),
    ("Junior / Débutant", pg_regex(r"\m[1-2]\s*ans?")),
]
EXPERIENCE_DEFAULT = "Non spécifié"

EXPERIENCE_LEVEL_RULES = [
    (5, _EXP_LEAD),
    (4, _EXP_SENIOR | pg_regex(r"\m([5-9]|1[0-9])\s*ans?")),
    (3, _EXP_MID | pg_regex(r"\m[3-4]\s*ans?")),
    (2, _EXP_JUNIOR | pg_regex(r"\m[1-2]\s*ans?")),
]
EXPERIENCE_LEVEL_DEFAULT = 0

EXPERIENCE_CATEGORY_BY_LEVEL = [
    (4, "Senior"),
    (2, "Junior / Mid"),
]
EXPERIENCE_CATEGORY_DEFAULT = "Non spécifié"

# ---- company activity buckets ---------------------------------------------
RECRUITER_CATEGORY_BY_OFFERS = [
    (10, "Grand recruteur (10+)"),
    (5, "Recruteur actif (5-9)"),
    (2, "Recruteur régulier (2-4)"),
]
RECRUITER_CATEGORY_DEFAULT = "Recruteur ponctuel (1)"
