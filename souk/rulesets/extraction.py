"""Text-extraction dictionaries of the four collectors.

FIXED VALUES: labels and Python-``re`` patterns below must equal the
reference collectors' dictionaries, in their order; all are matched
case-insensitively.  Dreamjob and Indeed/LinkedIn dictionaries look alike but
differ on purpose.
"""

# Moroccan city gazetteer, first whole-word hit wins (Dreamjob).
CITIES = [
    "Casablanca", "Rabat", "Marrakech", "Tanger", "Fès", "Fes", "Agadir",
    "Meknès", "Meknes", "Oujda", "Kénitra", "Kenitra", "Tétouan", "Tetouan",
    "Salé", "Sale", "El Jadida", "Mohammedia", "Khouribga", "Beni Mellal",
    "Nador", "Settat", "Berrechid", "Laâyoune", "Laayoune", "Dakhla",
    "Témara", "Temara", "Safi", "Essaouira", "Ifrane", "Ouarzazate",
    "Maroc", "Morocco",
]

# Contract labels, every hit in this order.
CONTRACTS_FR = [
    ("CDI", r"\bCDI\b"),
    ("CDD", r"\bCDD\b"),
    ("Stage", r"\bstage(?:s)?\b"),
    ("Freelance", r"\bfreelance\b"),
    ("Alternance", r"\balternance\b"),
    ("Intérim", r"\bint[ée]rim\b"),
    ("PFE", r"\bPFE\b"),
]
CONTRACTS_FR_EN = [
    ("CDI", r"\bCDI\b|\bpermanent\b|\bfull[- ]time\b"),
    ("CDD", r"\bCDD\b|\bfixed[- ]term\b"),
    ("Stage", r"\bstage(?:s)?\b|\binternship\b|\bintern\b"),
    ("Freelance", r"\bfreelance\b|\bcontractor\b"),
    ("Alternance", r"\balternance\b|\bapprenticeship\b"),
    ("Intérim", r"\bint[ée]rim\b|\btemporary\b"),
    ("PFE", r"\bPFE\b"),
]

# Education level, first hit wins.
EDUCATION_DREAMJOB = [
    ("Bac+5", r"\bBac\s*\+\s*5\b|\bMaster\b|\bing[ée]nieur\b"),
    ("Bac+3", r"\bBac\s*\+\s*3\b|\bLicence\b"),
    ("Bac+2", r"\bBac\s*\+\s*2\b|\bBTS\b|\bDUT\b"),
    ("Doctorat", r"\bDoctorat\b|\bPhD\b"),
    ("Bac+4", r"\bBac\s*\+\s*4\b"),
]
EDUCATION_INDEED = [  # also used by the LinkedIn collector
    ("Doctorat", r"\bDoctorat\b|\bPhD\b|\bDoctorate\b"),
    ("Bac+5", r"\bBac\s*\+\s*5\b|\bMaster['s]?\b|\bing[ée]nieur\b|\bengineering\s+degree\b|\bMSc\b"),
    ("Bac+4", r"\bBac\s*\+\s*4\b"),
    ("Bac+3", r"\bBac\s*\+\s*3\b|\bLicence\b|\bBachelor['s]?\b|\bBSc\b"),
    ("Bac+2", r"\bBac\s*\+\s*2\b|\bBTS\b|\bDUT\b|\bAssociate\s+degree\b"),
]

# Years of experience, ordered patterns; 2 groups -> "a-b ans", 1 -> "a ans".
EXPERIENCE_DREAMJOB = [
    r"(\d+)\s*(?:à|-|–)\s*(\d+)\s*ans?\s*d['e ]+exp[ée]rience",
    r"(?:minimum\s+)?(\d+)\s*ans?\s*(?:d['e ]+exp[ée]rience|minimum)",
    r"exp[ée]rience\s*(?:de|:)?\s*(\d+)\s*(?:à|-|–)?\s*(\d+)?\s*ans?",
]
EXPERIENCE_INDEED = [
    r"(\d+)\s*(?:to|à|-|–)\s*(\d+)\s*(?:years?|ans?)\s*(?:of\s+)?(?:experience|d['e ]+exp[ée]rience)",
    r"(?:minimum\s+|at\s+least\s+)?(\d+)\+?\s*(?:years?|ans?)\s*(?:of\s+)?(?:experience|d['e ]+exp[ée]rience)",
    r"(?:experience|exp[ée]rience)\s*(?:de|of|:)?\s*(\d+)\+?\s*(?:years?|ans?)",
]
EXPERIENCE_LINKEDIN = EXPERIENCE_INDEED[:2]

# word fallbacks after the numeric patterns (LinkedIn has none)
EXPERIENCE_WORDS_DREAMJOB = [
    ("Débutant / Junior", r"\bdébutant\b|\bjunior\b|\bsans\s+exp[ée]rience\b"),
    ("Senior / Confirmé", r"\bsenior\b|\bconfirm[ée]\b"),
]
EXPERIENCE_WORDS_INDEED = [
    ("Débutant / Junior", r"\bd[ée]butant\b|\bjunior\b|\bsans\s+exp[ée]rience\b|\bentry[- ]level\b"),
    ("Senior / Confirmé", r"\bsenior\b|\bconfirm[ée]\b|\blead\b|\bexperienced\b"),
]

# Job functions, first three hits in this order.
FUNCTIONS_DREAMJOB = [
    "Data Scientist", "Data Engineer", "Data Analyst", "Data Manager",
    "Machine Learning Engineer", "ML Engineer", "BI Developer",
    "Business Intelligence", "Big Data Engineer", "DevOps", "MLOps",
    "Architect", "Architecte Data", "Chef de projet Data",
    "Analyste", "Développeur", "Consultant",
]
FUNCTIONS_INDEED = [
    "Data Scientist", "Data Engineer", "Data Analyst", "Data Manager",
    "Machine Learning Engineer", "ML Engineer", "BI Developer",
    "Business Intelligence", "Big Data Engineer", "DevOps", "MLOps",
    "Data Architect", "Architecte Data", "Chef de projet Data",
    "Power BI Developer", "ETL Developer",
]

# Sectors, first two hits in this order.
SECTORS = [
    ("Banque/Finance", r"\bbanqu(?:e|aire)\b|\bbank(?:ing)?\b|\bfinanc(?:e|i[èe]re?|ial)\b|\binsurance\b|\bassurance\b"),
    ("Telecom", r"\bt[ée]l[ée]com(?:munications?)?\b|\btelecom\b"),
    ("Industrie/Manufacturing", r"\bindustri(?:e|el|al)\b|\bmanufactur(?:e|ing)\b|\baeronaut\w*\b|\bautomobile\b"),
    ("Conseil/Consulting", r"\bconsulting\b|\bconseil\b|\bcabinet\b"),
    ("Tech/IT", r"\bSaaS\b|\bcloud\b|\bsoftware\b|\bIT\s+services\b|\bdigital\b"),
    ("Santé", r"\bsant[ée]\b|\bhealthcare\b|\bm[ée]dical\b|\bpharmaceutical\b"),
    ("E-commerce/Retail", r"\be[- ]commerce\b|\bretail\b|\bgrande\s+distribution\b"),
    ("Énergie", r"\b[ée]nergie\b|\benergy\b|\boil\s+and\s+gas\b|\bp[ée]trole\b"),
    ("Public/Gouvernement", r"\bsecteur\s+public\b|\bgovernment\b|\bpublic\s+sector\b"),
    ("Éducation", r"\b[ée]ducation\b|\benseignement\b|\buniversit[ée]\b|\bschool\b"),
]

# X11: words removed from an image alt before it is taken as a company name.
ALT_NOISE = r"\b(Emploi|Recrutement|Maroc|Morocco)\b"

# Labels the collectors keep.
FUNCTION_LABELS = 3
SECTOR_LABELS = 2

# Company from a title, ordered, and the lengths the collectors accept.
COMPANY_SHORTEST = 3
COMPANY_LONGEST = 59
COMPANY_FROM_TITLE = [
    r"^(.+?)\s+(?:lance|recrute|recherche|ouvre|renforce)\b",
    r"\bchez\s+([A-ZÉÀÈ][\w\s&\-\.]+?)(?:\s+en|\s+pour|\s*$|,|\.|:)",
    r"^Recrutement\s+([A-ZÉÀÈ][\w\s&\-\.]+?)(?:\s*,|\s+postes|\s+pour|\s*:|\s*$)",
    r"^(?:Postes?\s+(?:ouverts?|à pourvoir)\s+(?:chez|à|au))\s+([A-ZÉÀÈ][\w\s&\-\.]+?)(?:\s+en|\s+pour|\s*$|,|\.|:)",
]

# LinkedIn native id at the end of an offer url.
LINKEDIN_ID = r"-(\d{8,})/?(?:\?|$)"

# Stored description length of the Dreamjob, Indeed and LinkedIn collectors.
DESCRIPTION_MAX_CHARS = 5000

# LinkedIn criteria headers -> field; ordered substring tests on the
# lower-cased header, first test that matches wins.
CRITERIA_FIELDS = [
    ("experience_level", ("niveau", "seniority")),
    ("contract_type", ("type", "employment")),
    ("function", ("fonction", "function")),
    ("sector", ("secteur", "industries", "industrie")),
]

# Rekrute telework suffixes, tested in this order.
TELEWORK_SUFFIXES = [("Hybride", "Hybride"), ("Oui", "Télétravail Oui"), ("Non", "Télétravail Non")]

# Rekrute labelled list items, tested in this order:
# (field, substring that selects the item, label removed from its text).
REKRUTE_FIELDS = [
    ("sector", "Secteur d'activité", "Secteur d'activité :"),
    ("function", "Fonction", "Fonction :"),
    ("experience", "Expérience requise", "Expérience requise :"),
    ("education", "Niveau d'étude", "Niveau d'étude demandé :"),
    ("contract", "Type de contrat", None),
]
REKRUTE_FUNCTION_EXCLUDED = "Fonctions"

# Hosts prefixed to relative links.
REKRUTE_HOST = "https://www.rekrute.com"
INDEED_VIEW_URL = "https://ma.indeed.com/viewjob?jk="
