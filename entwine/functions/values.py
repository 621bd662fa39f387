"""Word lists, patterns and names that results of the register work depend on."""

#: Letters written without accents, one for one, and those that become two.
PLAIN_FROM = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿąćęłńśźżčďěňřšťůžőűășțāēīū"
PLAIN_TO = "aaaaaaceeeeiiiinoooooouuuuyyacelnszzcdenrstuzouastaeiu"
PLAIN_PAIRS = (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("–", "-"), ("—", "-"), ("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"'), ("º", "o"), ("ª", "a"))

LEGAL_SUFFIXES = (
    "sarl", "sas", "sa", "sasu", "scop", "scic", "eurl", "gmbh", "ug", "ag", "kg", "eg", "srl", "spa", "soc coop", "cooperativa", "sl", "s l", "sll", "cee",
    "asbl", "vzw", "aps", "onlus", "ets", "ev", "e v", "foundation", "association", "associazione",
)
REGISTER_FORMS = (r"sociedad\s+cooperativa", "cooperativa", r"s\.?\s*c\.?\s*a\.?", r"s\.?\s*l\.?", "sll", r"s\.?\s*a\.?", r"sociedad\s+limitada", r"sociedad\s+anonima", r"sociedad\s+laboral", "sca", "sat")
REGISTER_STOPWORDS = ("grupo", "corporacion", "holding", "servicios", "integral", "general")
GENERIC_TOKENS = (
    "association", "associazione", "asociacion", "asociacao", "vereniging", "stichting", "foundation", "fondation", "fundacion", "fundacao",
    "federation", "federacion", "federacao", "institute", "institut", "instituto", "laboratoire", "laboratorio", "lab", "clinic", "hospital",
    "company", "group", "holding", "service", "services", "international", "global", "europe", "eu",
)
#: Words that are no help in finding candidates.
STOP_TOKENS = (
    "grupo", "group", "groupe", "company", "cooperative", "coop", "foundation", "association", "societe", "société", "services", "service", "hotel", "hotels", "the",
    "sociedad", "fundacion", "fundación", "associacion", "asociación",
)
COOP_WORDS = ("cooperativa", "cooperative", "coop", "coöperatie", "genossenschaft", "osuuskunta", "spoldzielnia", "druzstvo")
ASSOC_WORDS = ("association", "associazione", "asociacion", "associacao", "verein", "stichting", "vereniging", "fondation", "foundation", "fundacion", "fundacao")
SOCIAL_BRANDS = ("ilunion", "gureak", "amiab", "auticon", "afb", "groupe sos", "samhall")
#: Commercial legal forms; letters of an abbreviation may be parted by dots and blanks.
COMMERCIAL_FORMS = ("sarl", "sas", "sa", "sasu", "gmbh", "ug", "ag", "kg", "srl", "spa", "sl", "ltd", "inc")
WHOLE_FORMS = ("gmbh", "ug", "ag", "kg", "ltd", "inc")
#: Tokens looked for in upper-case names, in this order.
FORM_TOKENS = ("S.L.U.", "S.L.", "S.A.", "S.COOP", "SCOOP", "S. COOP", "COOP")

CANONICAL = (
    "country", "ccaa", "address", "postcode", "city", "province", "ei_register_name", "ei_registration_number", "entity_name", "entity_name_norm", "tax_id",
    "legal_form_local", "base_legal_form_code", "base_legal_form_family", "se_recognition_type", "se_recognition_name", "se_recognition_evidence", "source_url",
    "source_type", "retrieved_at", "tax_id_root",
)

#: Name rules by country and category; any pattern of a category suffices.
NAME_RULES = {
    "DE": {"coop": [r"\b(e\.?\s*g\.?)\b", r"\beingetragene\s+genossenschaft\b", r"\bgenossenschaft\b"], "ggmbh": [r"\bggmbh\b", r"\bgemeinn[üu]tzige\s+gmbh\b", r"\bgemeinnuetzige\s+gmbh\b"]},
    "NL": {
        "coop": [r"\bco[öo]peratie\b", r"\bco[öo]peratief\b", r"\b(?:u\.?\s*a\.?|b\.?\s*a\.?|w\.?\s*a\.?)\b(?=\s*$)"],
        "marker": [r"\bANBI\b"],
        "foundation_assoc": [r"\bstichting\b", r"\bvereniging\b"],
    },
    "BE": {
        "coop": [r"\bco[öo]perat(?:ieve|ief)\b", r"\b(?:soci[ée]t[ée]\s+coop[ée]rative|vennootschap\s+met\s+co[öo]peratief)\b", r"(?:^|[\s,;\(\[])\s*(?:CVBA|SCRL)\b(?=\s*$)", r"(?:^|[\s,;\(\[])\s*(?:CV|SC)\b(?=\s*$)"],
        "marker": [r"\b(?:VZW|ASBL)\b", r"\b(?:IVZW|AISBL)\b", r"\bVoG\b"],
        "foundation_assoc": [r"\b(?:stichting|fondation)\b", r"(?:^|[\s,;\(\[])\s*(?:FP|PS|FUP|SON)\b(?=\s*$)"],
    },
    "FR": {"coop": [r"\bSCOP\b", r"\bSCIC\b", r"\bsoci[ée]t[ée]\s+coop[ée]rative\b"], "esus": [r"\bESUS\b"], "marker": [r"\bassociation\b", r"\bloi\s+1901\b", r"\bfondation\b", r"\bmutuelle\b"]},
    "IT": {
        "coop": [r"\bcooperativa\b", r"\b(?:soc\.?\s*)?coop\.?\b"],
        "impresa_sociale": [r"\bimpresa\s+sociale\b"],
        "marker": [r"\bONLUS\b", r"(?:^|[\s,;\(\[])\s*(?:ODV|APS)\b(?=\s*$)"],
        "foundation_assoc": [r"\bfondazione\b", r"\bassociazione\b"],
    },
    "ES": {"coop": [r"\bsociedad\s+cooperativa\b", r"\bS\.\s*Coop\.?\b", r"\bS\.?\s*Coop\.\b", r"\bcooperativa\b"], "marker": [r"\basociaci[óo]n\b", r"\bfundaci[óo]n\b", r"\bONGD?\b"]},
    "PT": {"coop": [r"\bcooperativa\b", r"(?:^|[\s,;\(\[])\s*C\.?\s*R\.?\s*L\.?\b(?=\s*$)", r"\bCRL\b(?=\s*$)"], "marker": [r"\bIPSS\b", r"\bassocia[cç][ãa]o\b", r"\bfunda[cç][ãa]o\b", r"\bONGD?\b"]},
    "AT": {"coop": [r"\begen\b(?=\s*$)", r"\bgenossenschaft\b"], "marker": [r"\bverein\b", r"\bstiftung\b"]},
    "DK": {"coop": [r"\bA\.?\s*M\.?\s*B\.?\s*A\.?\b(?=\s*$)"], "marker": [r"\bF\.?\s*M\.?\s*B\.?\s*A\.?\b(?=\s*$)"]},
    "FI": {"coop": [r"\bosuuskunta\b", r"\bandelslag\b", r"\b(?:osk|anl)\b(?=\s*$)"], "marker": [r"\bs[äa][äa]ti[öo]\b", r"\bstiftelse\b", r"\bry\b(?=\s*$)"]},
    "CZ": {"coop": [r"\bdru[žz]stvo\b"], "marker": [r"\bo\.?\s*p\.?\s*s\.?\b(?=\s*$)", r"\bz\.?\s*s\.?\b(?=\s*$)", r"\bnadace\b"]},
    "IE": {"coop": [r"\bco-?operative\b"], "marker": [r"\bCLG\b(?=\s*$)"]},
    "PL": {"coop": [r"\bsp[oó]łdzielnia\b"], "marker": [r"\bfundacja\b", r"\bstowarzyszenie\b"]},
    "SE": {"coop": [r"\bekonomisk\s+f[öo]rening\b"], "marker": [r"\bideell\s+f[öo]rening\b", r"\bstiftelse\b"]},
    "GR": {"impresa_sociale": [r"Κοιν\.?\s*Σ\.?\s*Επ\.?"]},
    "CH": {
        "coop": [r"\bgenossenschaft\b", r"\bsoci[ée]t[ée]\s+coop[ée]rative\b", r"\bsociet[àa]\s+cooperativa\b"],
        "foundation_assoc": [r"\bverein\b", r"\bassociation\b", r"\bassociazione\b", r"\bstiftung\b", r"\bfondation\b", r"\bfondazione\b"],
    },
}
CATEGORIES = {"coop": "coop", "ggmbh": "social enterprise", "esus": "social enterprise", "impresa_sociale": "social enterprise", "marker": "not for profit", "foundation_assoc": "not for profit"}
