"""Word lists and tables of the text classifiers.

FIXED VALUES: results depend on these terms and on their order (first match and ties), so they are stated as they
have to be, in natural order.
"""

from __future__ import annotations

# --- legal documents: source type, jurisdiction, area, keywords, subjects -------------------------------------
SOURCE_TYPE_TITLE_RULES = (
    ("statute", ("act", "statute")),
    ("case", ("v.", "v ", "versus", "[20", "case")),
    ("regulation", ("regulation", "rules")),
)
SI_TERMS = ("s.i.", "statutory instrument")
SOURCE_TYPE_LATE_RULES = (
    ("hmrc_guidance", ("hmrc", "revenue", "tax")),
    ("court_rule", ("court rule", "cpr")),
    ("practice_direction", ("practice direction",)),
)
JURISDICTIONS = (
    ("scotland", ("scotland", "scottish", "csih", "csoh")),
    ("northern_ireland", ("northern ireland", "nica", "niqb")),
    ("england_wales", ("england", "wales", "ewca", "ewhc")),
    ("uk_wide", ("uk", "united kingdom", "uksc", "ukhl")),
)
LEGAL_AREAS = (
    ("criminal", ("criminal", "crime", "prosecution", "defendant", "guilty", "sentence")),
    ("civil", ("civil", "tort", "negligence", "contract", "damages")),
    ("tax", ("tax", "vat", "hmrc", "revenue", "duty", "allowance", "relief")),
    ("employment", ("employment", "worker", "dismissal", "redundancy", "discrimination")),
    ("housing", ("housing", "landlord", "tenant", "rent", "eviction", "lease")),
    ("family", ("family", "marriage", "divorce", "custody", "child", "matrimonial")),
    ("commercial", ("commercial", "business", "company", "corporate", "insolvency")),
    ("property", ("property", "land", "conveyancing", "real estate", "mortgage")),
    ("immigration", ("immigration", "visa", "asylum", "deportation", "nationality")),
    ("administrative", ("administrative", "judicial review", "public law", "tribunal")),
)
LEGAL_KEYWORDS = (
    "statute", "regulation", "case law", "precedent", "jurisdiction", "liability", "damages", "injunction", "appeal",
    "tribunal", "legislative", "judicial", "executive", "constitutional",
)
SUBJECTS = (
    ("contracts", ("contract", "agreement", "terms", "breach")),
    ("torts", ("negligence", "duty of care", "tort", "damages")),
    ("constitutional", ("constitutional", "human rights", "judicial review")),
    ("procedure", ("procedure", "process", "court rules", "evidence")),
    ("remedies", ("remedy", "injunction", "damages", "specific performance")),
)
QUALITY_TERMS = ("pursuant", "whereas", "hereby", "therein", "aforementioned")

# --- courts: abbreviation, name, level ------------------------------------------------------------------------
COURTS = (
    ("UKSC", "Supreme Court", 1),
    ("UKHL", "House of Lords", 1),
    ("UKPC", "Privy Council", 1),
    ("EWCA", "Court of Appeal", 2),
    ("EWHC", "High Court", 3),
    ("EWCOP", "Court of Protection", 3),
    ("CSIH", "Court of Session (Inner House)", 2),
    ("CSOH", "Court of Session (Outer House)", 3),
    ("NICA", "Northern Ireland Court of Appeal", 2),
    ("NIQB", "Northern Ireland High Court", 3),
)
MAX_LEVEL = 8

# --- patterns of references -----------------------------------------------------------------------------------
NEUTRAL_CITATION = r"(?i)\[(\d{4})\]\s+(UKSC|UKHL|UKPC|EWCA|EWHC|EWCOP|CSIH|CSOH|NICA|NIQB)\s+(\d+)"
LAW_REPORT = r"(?i)\[(\d{4})\]\s+(\d+)\s+(AC|WLR|All\s+ER|QB|Ch|Fam|P|Lloyd's\s+Rep)"
LAW_REPORT_PAGE = r"(?i)\[(\d{4})\]\s+(\d+)\s+(AC|WLR|All\s+ER|QB|Ch|Fam|P)\s+(\d+)"
#: Forms of answers' citations, in which case counts (fixed patterns).
NEUTRAL_CITATION_CASED = r"\[(\d{4})\]\s+(UKSC|UKHL|UKPC|EWCA|EWHC|EWCOP|CSIH|CSOH|NICA|NIQB)\s+(\d+)"
LAW_REPORT_CASED = r"\[(\d{4})\]\s+(\d+)\s+(AC|WLR|All\s+ER|QB|Ch|Fam)"
TAX_ACT_CASED = r"\b((?:TCGA|ITA|ITTOIA|CTA|IHTA|FA|VATA|TMA)\s+\d{4})\b"
SECTION_NUMBER = r"(?i)\b(?:section|s\.|§)\s*(\d+)"
SECTION_WITH_PARTS = r"(?i)\b(?:section|s\.|§)\s*(\d+(?:\([^)]+\))*)"
MANUAL_CODE_CASED = r"\b([A-Z]{2,4}\d{5}[A-Z]*)\b"
ANY_NEUTRAL_FORM = r"\[(\d{4})\]\s+[A-Z]+\s+\d+"
SECTION_REFERENCE = r"(?i)(?:section|s\.|§)\s*(\d+(?:\(\d+\))*(?:[A-Z]*)?)"
ACT_REFERENCE = r"(?i)([A-Z][A-Za-z\s]+Act\s+\d{4})"
SI_REFERENCE = r"(?i)S\.?I\.?\s+(\d{4}/\d+)"
GUIDANCE_REFERENCE = r"(?i)((?:HMRC|Revenue)\s+(?:Manual|Guidance|Brief)\s+[A-Z]+\d+)"
MANUAL_REFERENCE = r"(?i)\b([A-Z]{2,4})(\d{5}[A-Z]*)\b"
TAX_ACT = r"(?i)\b((?:TCGA|ITA|ITTOIA|CTA|IHTA|FA|VATA|TMA)\s+\d{4})\b"
TAX_SECTION = r"(?i)\b(?:section|s\.|sec\.|§)\s*(\d+(?:\([A-Za-z0-9]+\))*(?:[A-Z]*)?)"
CASE_NAME = r"(?i)\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s+v\.?\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s+\[(\d{4})\]"
CASE_AGAINST_AUTHORITY = r"(?i)\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\s+v\.?\s+(HMRC|Inspector of Taxes)\s+\[(\d{4})\]"
AMENDMENT = r"(?i)\[.*?amended\s+by.*?\]"
SECTION_START = r"(?:^|\n)\s*(?:Section|SECTION)\s+(\d+(?:\.\d+)*)"

# --- tax documents --------------------------------------------------------------------------------------------
MANUAL_NAMES = (
    ("CG", "Capital Gains Manual"),
    ("BIM", "Business Income Manual"),
    ("EIM", "Employment Income Manual"),
    ("SAIM", "Savings and Investment Manual"),
    ("PCTM", "Pension Contributions Tax Manual"),
    ("RPSM", "Registered Pension Schemes Manual"),
    ("IHTM", "Inheritance Tax Manual"),
    ("VATFIN", "VAT Finance Manual"),
    ("ARTG", "Anti-Avoidance Reporting of Tax Avoidance Schemes"),
    ("INTM", "International Manual"),
    ("CTM", "Corporation Tax Manual"),
    ("PIM", "Property Income Manual"),
    ("TSEM", "Tax Specialist Investigations Manual"),
    ("CH", "Compliance Handbook"),
)
ACT_NAMES = (
    ("TCGA 1992", "Taxation of Chargeable Gains Act 1992"),
    ("ITA 2007", "Income Tax Act 2007"),
    ("ITTOIA 2005", "Income Tax (Trading and Other Income) Act 2005"),
    ("CTA 2009", "Corporation Tax Act 2009"),
    ("CTA 2010", "Corporation Tax Act 2010"),
    ("IHTA 1984", "Inheritance Tax Act 1984"),
    ("VATA 1994", "Value Added Tax Act 1994"),
    ("TMA 1970", "Taxes Management Act 1970"),
)
TAX_DOMAINS = (
    ("income_tax", ("income tax", "ita 2007", "ittoia", "employment income", "trading income", "property income", "savings income", "dividend income")),
    ("corporation_tax", ("corporation tax", "cta 2009", "cta 2010", "corporate", "company tax", "business profits", "chargeable gains", "loan relationships")),
    ("capital_gains_tax", ("capital gains", "tcga 1992", "chargeable gains", "disposal", "acquisition", "base cost", "enhancement expenditure")),
    ("value_added_tax", ("vat", "value added tax", "vata 1994", "input tax", "output tax", "exempt", "zero-rated", "standard rate")),
    ("inheritance_tax", ("inheritance tax", "ihta 1984", "potentially exempt transfer", "chargeable lifetime transfer", "death estate")),
    ("national_insurance", ("national insurance", "ni contributions", "class 1", "class 2", "class 3", "class 4", "earnings threshold")),
    ("paye", ("paye", "pay as you earn", "payroll", "p45", "p46", "p60", "p11d", "benefits in kind", "real time information")),
    ("making_tax_digital", ("making tax digital", "mtd", "digital reporting", "digital tax", "quarterly reporting", "software", "api")),
    ("employee_benefits", ("benefits in kind", "company car", "fuel benefit", "advisory fuel rates", "taxable benefits", "p11d", "benefit charge", "employee benefit")),
    ("fuel_duties", ("fuel duty", "advisory fuel rates", "vehicle excise duty", "company car fuel", "fuel benefit")),
    ("alcohol_tobacco_duties", ("alcohol duty", "tobacco duty", "spirits duty", "beer duty", "wine duty", "cigarette duty", "alcoholic products")),
    ("customs_import_duties", ("customs duty", "import duty", "customs clearance", "cds", "customs declaration service", "tariff", "import")),
    ("money_laundering_supervision", ("money laundering", "aml supervision", "economic crime", "supervision handbook", "aml", "terrorist financing")),
    ("tax_avoidance_schemes", ("tax avoidance schemes", "dotas", "disclosure", "promoter", "notifiable arrangements", "named schemes")),
    ("research_development_reliefs", ("research and development", "r&d relief", "r&d tax credits", "corporate intangibles", "innovation", "sme r&d")),
    ("service_availability", ("service availability", "online service", "system issues", "service disruption", "planned maintenance")),
    ("digital_services", ("digital services tax", "online services", "digital platform", "digital economy", "digital transformation")),
    ("trade_procedures", ("trade procedures", "export", "import procedures", "customs procedures", "trade facilitation")),
    ("economic_crime", ("economic crime", "financial crime", "fraud", "sanctions", "terrorist financing", "proceeds of crime")),
    ("tax_credits", ("tax credits", "working tax credit", "child tax credit", "universal credit", "credits system")),
    ("business_rates", ("business rates", "non-domestic rates", "rateable value", "rating list", "rate relief")),
    ("environmental_taxes", ("climate change levy", "landfill tax", "aggregates levy", "carbon price", "environmental tax", "green tax")),
)
ENTITIES = (
    ("individuals", ("individual", "person", "taxpayer", "employee", "self-employed")),
    ("companies", ("company", "corporation", "limited", "plc", "ltd", "corporate")),
    ("trusts", ("trust", "trustee", "beneficiary", "settlement")),
    ("partnerships", ("partnership", "partner", "llp", "limited liability partnership")),
)
TAX_CONCEPTS = (
    ("allowances", ("allowance", "relief", "exemption", "deduction")),
    ("charges", ("charge", "liability", "assessment", "computation")),
    ("procedures", ("return", "filing", "deadline", "procedure", "process")),
    ("penalties", ("penalty", "interest", "surcharge", "default")),
    ("appeals", ("appeal", "tribunal", "review", "dispute")),
    ("anti_avoidance", ("avoidance", "artificial", "scheme", "arrangement")),
)
EXAMPLE_TERMS = ("example", "for instance", "case study", "illustration")
CALCULATION_TERMS = ("£", "%", "calculate", "computation", "=", "+", "-", "×", "÷")
TAX_TERMS = (
    "tax", "duty", "rate", "threshold", "band", "relief", "allowance", "liability", "assessment", "return", "filing",
    "deadline", "penalty", "interest", "appeal", "tribunal", "compliance", "avoidance", "planning",
)

# --- relevance of search results ------------------------------------------------------------------------------
RELEVANCE_TERMS = (
    "tax", "taxes", "taxation", "vat", "income tax", "corporation tax", "capital gains", "inheritance tax", "stamp duty",
    "national insurance", "paye", "self assessment", "hmrc", "revenue", "customs", "duty", "allowance", "relief",
    "exemption", "deduction", "credit",
    "capital gains tax", "value added tax", "stamp duty land tax", "annual tax on enveloped dwellings",
    "apprenticeship levy", "bank levy", "diverted profits tax", "petroleum revenue tax", "landfill tax",
    "climate change levy", "aggregates levy", "air passenger duty", "vehicle excise duty", "fuel duty", "alcohol duty",
    "tobacco duty", "betting and gaming duties",
    "corporation tax return", "vat return", "payroll", "benefits in kind", "expenses", "business rates",
    "annual investment allowance", "research and development", "enterprise investment scheme",
    "seed enterprise investment scheme", "venture capital trust", "employee share schemes",
    "personal allowance", "marriage allowance", "blind person allowance", "tax credits", "child benefit",
    "working tax credit", "child tax credit", "pension contributions", "isa", "premium bonds", "savings", "dividends",
    "interest", "rental income", "foreign income",
    "penalty", "appeal", "enquiry", "investigation", "disclosure", "avoidance", "evasion", "compliance",
    "record keeping", "registration", "deregistration", "making tax digital",
)
PRIORITY_FORMATS = ("guide", "detailed_guide", "manual", "answer", "form", "publication", "consultation_outcome")
EXCLUDED_FORMATS = ("press_release", "news_story", "speech")
ACTIONABLE_TERMS = (
    "how to", "calculate", "claim", "apply", "rate", "allowance", "deadline", "form", "return", "guidance", "rules",
    "requirements",
)
SPECIFIC_AREAS = (
    "self assessment", "corporation tax", "vat", "paye", "capital gains", "inheritance tax", "stamp duty",
    "making tax digital", "tax credits",
)

# --- housing --------------------------------------------------------------------------------------------------
HOUSING_CATEGORIES = (
    ("tenancy_types", ("assured shorthold tenancy", "assured tenancy", "secure tenancy", "protected tenancy", "statutory tenancy", "periodic tenancy")),
    ("eviction_possession", ("section 8", "section 21", "possession", "eviction", "notice to quit", "mandatory ground", "discretionary ground")),
    ("tenant_rights", ("quiet enjoyment", "repair obligations", "deposit protection", "harassment", "illegal eviction", "retaliatory eviction")),
    ("landlord_obligations", ("gas safety", "electrical safety", "fire safety", "energy efficiency", "licensing", "deposit protection")),
    ("leasehold", ("service charge", "ground rent", "major works", "lease extension", "enfranchisement", "right to manage")),
)
HOUSING_FALLBACKS = (
    ("eviction_possession", ("eviction", "possession", "section 8", "section 21")),
    ("tenancy_types", ("tenancy", "tenant", "assured", "shorthold")),
    ("leasehold", ("leasehold", "service charge", "ground rent")),
    ("landlord_obligations", ("landlord", "repair", "safety")),
)
HOUSING_URL_CATEGORIES = (
    ("Housing Acts", "housing-act"),
    ("Landlord & Tenant Acts", "landlord-and-tenant"),
    ("Rent Acts", "rent-act"),
    ("Leasehold Acts", "leasehold"),
    ("Tenancy Acts", "tenancy"),
)
HOUSING_PRIMARY = (
    "housing", "tenant", "tenancy", "landlord", "rent", "rental", "leasehold", "freehold", "eviction", "deposit",
    "tenants", "landlords", "renting", "lettings", "dwellings", "residential",
)
HOUSING_TENANCY = (
    "assured shorthold tenancy", "assured tenancy", "secure tenancy", "protected tenancy", "statutory tenancy",
    "periodic tenancy", "fixed term tenancy", "joint tenancy", "sole tenancy", "subletting", "assignment", "succession",
    "tenancy agreement", "lease agreement", "rental agreement", "letting agreement",
)
HOUSING_EVICTION = (
    "eviction", "possession", "notice to quit", "section 8", "section 21", "mandatory ground", "discretionary ground",
    "possession order", "possession proceedings", "accelerated possession", "warrant of possession", "bailiff",
    "enforcement", "notice seeking possession", "ground for possession", "suitable alternative accommodation",
    "rent arrears",
)
HOUSING_RIGHTS = (
    "right to buy", "right to acquire", "preserved right to buy", "tenant rights", "landlord obligations",
    "quiet enjoyment", "repair obligations", "housing standards", "fitness for habitation", "overcrowding",
    "harassment", "illegal eviction", "retaliatory eviction", "discriminatory eviction",
)
HOUSING_ACTS = (
    "housing act", "rent act", "landlord and tenant act", "tenancy act", "leasehold reform act", "homelessness act",
    "right to buy", "assured tenancy", "secure tenancy", "housing benefit", "universal credit", "tenant fees act",
    "protection from eviction act", "rent assessment committee",
    "renters rights bill", "homelessness reduction act 2017", "defective premises act 1972", "mobile homes act",
    "caravan sites act", "houses in multiple occupation", "housing and planning act 2016",
    "leasehold reform housing and urban development act 1993", "commonhold and leasehold reform act 2002",
)
HOUSING_EXCLUDED = (
    "criminal", "police", "immigration", "tax", "company", "employment", "education", "health", "transport", "planning",
    "environmental", "planning permission", "building regulations",
)
HOUSING_CORE = ("housing", "tenancy", "landlord", "eviction", "possession")
HOUSING_CASE_TERMS = (
    *HOUSING_TENANCY[:9], "residential tenancy", "commercial tenancy", "business tenancy", *HOUSING_EVICTION,
    "breach of tenancy", "anti-social behaviour", *HOUSING_RIGHTS, "housing benefit", "universal credit",
    "deposit protection", "disrepair", "condensation", "damp", "mould", "heating", "hot water", "structural defects",
    "electrical safety", "gas safety", "fire safety", "energy efficiency", "houses in multiple occupation", "hmo",
    "licensing", "service charge", "ground rent", "major works", "section 20", "consultation", "reserve fund",
    "administration charge", "lease extension", "enfranchisement", "right to manage", "forfeiture", "housing", "tenant",
    "tenancy", "landlord", "rent", "rental", "leasehold", "freehold", "deposit", "letting", "residential", "dwelling",
    "premises", "property",
)

# --- copyright ------------------------------------------------------------------------------------------------
COPYRIGHT_TERMS = (
    "copyright", "intellectual property", "patent", "trademark", "design", "moral rights", "performers rights",
    "database rights", "broadcast rights", "authorship", "originality", "substantial part", "fair dealing",
    "permitted acts", "infringement", "remedies", "licensing", "collective licensing", "orphan works",
    "digital copyright", "cdpa", "copyright designs and patents act", "berne convention", "wipo", "trips agreement",
    "information society directive", "rental and lending directive", "software directive", "database directive",
    "orphan works directive",
)
COPYRIGHT_PATTERNS = (
    r"intellectual\s+property", r"copyright.*act", r"patent.*act", r"trademark.*act", r"design.*act",
    r"performers.*rights", r"broadcast.*rights", r"database.*rights", r"moral\s+rights", r"fair\s+dealing",
    r"substantial\s+part",
)

# --- concepts -------------------------------------------------------------------------------------------------
KEY_CONCEPTS = (
    "section", "act", "regulation", "case", "precedent", "court", "defendant", "plaintiff", "liability", "damages",
    "contract", "tort", "statutory", "common law", "jurisdiction", "appeal",
    "income tax", "vat", "corporation tax", "capital gains", "allowance", "relief", "deduction", "exemption", "rate",
    "threshold", "compliance", "filing", "payment", "penalty", "hmrc",
)

# --- citation relationships -----------------------------------------------------------------------------------
RELATIONSHIPS = (
    ("follows", (
        r"follow(?:s|ing)?\s+(?:the\s+)?(?:decision|ruling|principle)\s+in\s+(.+?)(?:\s|;|\.)",
        r"as\s+(?:held|decided|established)\s+in\s+(.+?)(?:\s|;|\.)",
        r"in\s+accordance\s+with\s+(.+?)(?:\s|;|\.)",
    )),
    ("distinguishes", (
        r"distinguish(?:es|able|ed)?\s+(?:from\s+)?(.+?)(?:\s|;|\.)",
        r"(?:can|may)\s+be\s+distinguished\s+from\s+(.+?)(?:\s|;|\.)",
        r"unlike\s+(?:in\s+)?(.+?)(?:\s|;|\.)",
    )),
    ("overrules", (
        r"overrul(?:es?|ed|ing)\s+(.+?)(?:\s|;|\.)",
        r"reverses?\s+(?:the\s+decision\s+in\s+)?(.+?)(?:\s|;|\.)",
        r"no\s+longer\s+follows?\s+(.+?)(?:\s|;|\.)",
    )),
    ("applies", (
        r"appl(?:ies|ying|ied)\s+(?:the\s+principle\s+from\s+)?(.+?)(?:\s|;|\.)",
        r"using\s+(?:the\s+test\s+from\s+)?(.+?)(?:\s|;|\.)",
        r"pursuant\s+to\s+(.+?)(?:\s|;|\.)",
    )),
    ("considers", (
        r"consider(?:s|ed|ing)\s+(.+?)(?:\s|;|\.)",
        r"having\s+regard\s+to\s+(.+?)(?:\s|;|\.)",
        r"with\s+reference\s+to\s+(.+?)(?:\s|;|\.)",
    )),
)
BASE_STRENGTH = (("follows", 1.0), ("applies", 0.9), ("considers", 0.6), ("distinguishes", 0.4), ("overrules", 1.0))
STRENGTH_WORDS = ("clearly", "explicitly", "directly", "specifically", "definitively", "unambiguously", "precisely")
WEAKNESS_WORDS = ("arguably", "possibly", "potentially", "might", "could", "perhaps", "seemingly")

# --- compliance -----------------------------------------------------------------------------------------------
DISCLAIMER_PATTERNS = (
    r"not\s+(?:formal\s+)?legal\s+advice",
    r"informational\s+purposes?\s+only",
    r"consult\s+(?:with\s+)?(?:a\s+)?qualified\s+(?:legal\s+professional|solicitor|barrister)",
    r"professional\s+legal\s+advice",
    r"specific\s+(?:to\s+your\s+)?circumstances",
    r"may\s+not\s+reflect\s+(?:the\s+)?(?:most\s+)?(?:current|recent)",
    r"ai\s+system",
    r"disclaimer",
)
OVERCONFIDENT_PATTERNS = (
    r"definitely\s+will",
    r"guaranteed\s+(?:to\s+)?(?:win|succeed)",
    r"certain\s+(?:to\s+)?(?:win|succeed)",
    r"no\s+chance\s+of\s+(?:losing|failing)",
    r"absolutely\s+certain",
)
FORMAL_TERMS = (
    "pursuant to", "notwithstanding", "whereas", "hereby", "therein", "aforementioned", "inter alia", "prima facie",
    "ultra vires",
)
UNPROFESSIONAL_PATTERNS = (
    r"always\s+win", r"never\s+(?:fail|lose)", r"guaranteed\s+success", r"impossible\s+to\s+lose", r"easy\s+case",
    r"slam\s+dunk", r"obvious(?:ly)?\s+(?:win|guilty|liable)",
)
REASONING_TERMS = (
    "legal framework", "analysis", "application", "conclusion", "relevant law", "applicable", "principle", "precedent",
)
UNETHICAL_PATTERNS = (
    r"encourage\s+(?:illegal|unlawful)", r"evade\s+(?:tax|legal)", r"false\s+(?:statement|claim)",
    r"mislead\s+(?:court|authority)", r"conceal\s+(?:evidence|information)",
)
MENTIONED_JURISDICTIONS = (
    ("england_wales", ("england", "wales", "english", "welsh")),
    ("scotland", ("scotland", "scottish")),
    ("northern_ireland", ("northern ireland", "ni")),
    ("uk_wide", ("uk", "united kingdom", "britain", "british")),
)
AREA_CHECKS = (
    ("criminal", ("crime", "criminal", "prosecution", "defendant", "guilty")),
    ("tax", ("tax", "hmrc", "revenue", "vat", "duty")),
    ("employment", ("employment", "worker", "employer", "dismissal")),
    ("property", ("property", "land", "conveyancing", "lease")),
    ("contract", ("contract", "agreement", "breach", "terms")),
)
CONTEXT_WORDS = ("held", "decided", "established", "case", "judgment", "ruling")
COMPLIANCE_WEIGHTS = (("disclaimer", 0.25), ("citations", 0.20), ("standards", 0.20), ("ethics", 0.15), ("facts", 0.20))

# --- evaluation of answers ------------------------------------------------------------------------------------
STRUCTURE_PATTERNS = (
    r"(?:Introduction|Background|Legal Framework|Analysis|Conclusion)",
    r"(?:pursuant to|in accordance with|as provided by)",
    r"(?:s\.|section)\s*\d+",
    r"(?:para\.|paragraph)\s*\d+",
)
HIERARCHY_PATTERNS = (r"Supreme Court|UKSC", r"Court of Appeal|EWCA", r"High Court|EWHC", r"authority|precedent|binding")
COHERENCE_PATTERNS = (
    r"therefore|thus|consequently|accordingly",
    r"however|nevertheless|notwithstanding",
    r"furthermore|moreover|additionally",
    r"step \d+|firstly|secondly|finally",
)
EVALUATION_FORMAL_TERMS = (
    "notwithstanding", "pursuant", "whereas", "hereby", "therein", "aforementioned", "inter alia", "prima facie",
    "ultra vires", "obiter dicta", "ratio decidendi",
)
STYLE_PATTERNS = (r"\[(\d{4})\]\s+[A-Z]+\s+\d+", r"[A-Z][a-z]+\s+v\s+[A-Z][a-z]+", r"\(\d{4}\)\s+\d+\s+[A-Z]+")
EVALUATION_DISCLAIMERS = (r"professional legal advice", r"qualified legal professional", r"specific circumstances", r"disclaimer")

# --- training phases: name, longest answer, complexity --------------------------------------------------------
PHASES = (
    ("phase_1_foundation", 1024, "basic"),
    ("phase_2_reasoning", 2048, "intermediate"),
    ("phase_3_expertise", 4096, "advanced"),
    ("phase_4_adversarial", 4096, "adversarial"),
)

# --- acquisition (fixed values) -------------------------------------------------------------------------------
CASE_DATABASES = (
    "/ew/cases/EWCA/Civ/", "/ew/cases/EWCA/Crim/", "/ew/cases/EWHC/Admin/", "/ew/cases/EWHC/Admlty/", "/ew/cases/EWHC/Ch/",
    "/ew/cases/EWHC/Comm/", "/ew/cases/EWHC/Costs/", "/ew/cases/EWHC/Exch/", "/ew/cases/EWHC/Fam/", "/ew/cases/EWHC/Mercantile/",
    "/ew/cases/EWHC/Patents/", "/ew/cases/EWHC/KB/", "/ew/cases/EWHC/QB/", "/ew/cases/EWHC/TCC/", "/ew/cases/EWPCC/",
    "/ew/cases/EWHC/IPEC/", "/ew/cases/EWCOP/", "/ew/cases/EWFC/", "/ew/cases/EWFC/HCJ/", "/ew/cases/EWFC/OJ/",
    "/ew/cases/EWMC/FPC/",
    "/uk/cases/UKPC/", "/uk/cases/UKHL/", "/uk/cases/UKSC/", "/uk/cases/UKUT/AAC/", "/uk/cases/UKUT/TCC/", "/uk/cases/UKUT/IAC/",
    "/uk/cases/UKUT/LC/", "/uk/cases/UKFTT/GRC/", "/uk/cases/UKFTT/HESC/", "/uk/cases/UKFTT/PC/", "/uk/cases/UKFTT/TC/",
    "/uk/cases/CAT/", "/uk/cases/DRS/", "/uk/cases/SIAC/", "/uk/cases/UKEAT/", "/uk/cases/UKET/", "/uk/cases/UKFSM/",
    "/uk/cases/UKIAT/", "/uk/cases/UKAITUR/", "/uk/cases/UKIT/", "/uk/cases/UKSPC/", "/uk/cases/UKSSCSC/",
)
#: Acts and instruments that housing work starts from: type, year, number.
HOUSING_ACTS_BY_NUMBER = (
    ("ukpga", 1985, 68), ("ukpga", 1988, 50), ("ukpga", 1996, 52), ("ukpga", 2004, 34),
    ("ukpga", 1977, 42), ("ukpga", 1965, 75),
    ("ukpga", 1985, 70), ("ukpga", 1987, 31), ("ukpga", 1954, 56),
    ("ukpga", 1967, 88), ("ukpga", 1993, 28), ("ukpga", 2002, 15),
    ("ukpga", 2016, 22), ("ukpga", 2019, 4), ("ukpga", 2017, 13),
    ("ukpga", 1977, 43), ("ukpga", 1972, 35),
    ("ukpga", 2013, 5), ("ukpga", 1983, 34), ("ukpga", 1968, 52),
    ("ukpga", 2020, 17), ("ukpga", 1988, 9), ("ukpga", 2014, 6),
    ("uksi", 1988, 2203), ("uksi", 1997, 194), ("uksi", 2006, 2825), ("uksi", 2007, 1903), ("uksi", 2019, 947),
    ("uksi", 2020, 914), ("uksi", 2021, 15),
)
HOUSING_SEARCH_TERMS = (
    "housing", "tenancy", "landlord", "tenant", "rent", "eviction", "possession", "assured shorthold", "section 21", "section 8",
    "deposit", "leasehold", "service charge", "disrepair", "harassment", "illegal eviction", "notice to quit",
)
