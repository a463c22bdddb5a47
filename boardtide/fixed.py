"""Fixed values.

Everything in this module is a value that results depend on: vocabularies, lookup tables,
thresholds and match patterns.  They are stated as plain text, in the order in which they
apply.  No logic lives here.
"""

# --- fixed values: vocabularies ----------------------------------------------------------

PLATFORMS = (
    "greenhouse", "lever", "ashby", "smartrecruiters", "workable", "workday",
    "successfactors", "oracle_orc", "eightfold", "phenom", "browser", "mcf",
)
PORTAL_PLATFORM = "mcf"
STATUSES = ("open", "closed", "reposted", "unknown")
DATE_BASES = ("published", "updated", "observed")
FIRM_STATUSES = ("wired", "probed_not_used", "unavailable", "todo")
ROBOTS_STATUSES = ("allowed", "disallowed", "unknown")

FAMILY_GROUPS = {
    "strategy_consulting": "Strategy & Consulting",
    "management_consulting": "Strategy & Consulting",
    "strategy_operations": "Strategy & Consulting",
    "quant_trading": "Quant & Trading",
    "quant_research": "Quant & Trading",
    "quant_dev": "Quant & Trading",
    "data_science": "Data & Analytics",
    "data_analyst": "Data & Analytics",
    "business_analyst": "Data & Analytics",
    "software_engineering": "SWE & Technical",
    "operations": "Operations",
    "supply_chain": "Supply Chain",
    "investment": "Investment",
    "product_management": "Product",
    "risk_compliance": "Risk & Compliance",
    "finance_accounting": "Finance",
    "engineering": "Engineering",
    "science_lab": "Science & Lab",
    "sales_marketing": "Sales & Marketing",
    "human_resources": "People",
    "legal": "Legal",
    "general_management": "General Management",
    "other": "Other",
}
PRIORITY_GROUPS = (
    "Strategy & Consulting", "Quant & Trading", "Data & Analytics",
    "SWE & Technical", "Operations", "Supply Chain",
)
ROLE_TYPE_BY_BASIS = {
    "route:programme": "Graduate programme",
    "route:states-fresh-grad": "Graduate role",
    "route:entry-level-title": "Graduate role",
    "route:zero-years": "Entry level",
    "route:experience-level": "Entry level",
}
ROLE_TYPE_DEFAULT = "Graduate role"
ROLE_TYPE_INTERNSHIP = "Internship"
ROLE_TYPE_NONE = "Not graduate"
SELECTABLE_ROLE_TYPES = ("Graduate programme", "Graduate role", "Entry level")

# platform -> registry columns a wired row must fill
REQUIRED_FIELDS = {
    "greenhouse": ("ats_token",),
    "lever": ("ats_token",),
    "ashby": ("ats_token",),
    "smartrecruiters": ("ats_token",),
    "workable": ("ats_token",),
    "workday": ("ats_host", "ats_token", "board_site"),
    "successfactors": ("ats_host",),
    "oracle_orc": ("ats_host",),
    "eightfold": ("ats_host",),
    "phenom": ("ats_host",),
    "browser": ("careers_url",),
    "mcf": (),
}

# --- fixed values: text cleaning ----------------------------------------------------------

CLEAN_ENTITIES = (
    ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"'),
)
DESCRIPTION_CAP = 8000
FAMILY_BODY_CHARS = 600

# --- fixed values: eligibility patterns (all ignore case) ---------------------------------

SUBJECT_MATTER = (
    r"\bgraduate (stud(y|ies)|school|admission|programme office|program office|affairs|"
    r"educat|recruit|coordinator)\b|\bpostgraduate (stud|admission|programme)"
)
NOT_A_ROLE = (
    r"\b(recruitment event|networking event|info(rmation)? session|open house|career fair|"
    r"webinar|meet[- ]?(the|and)[- ]?(team|greet)|talent (community|network|pool)|"
    r"expression of interest|speculative application|do not apply|test (post|req|requisition))\b"
    r"|\[[^\]]*\btest\b[^\]]*\]"
)
ACADEMIC_TRACK = (
    r"\b(research fellow|post[- ]?doc|postdoctoral|adjunct|professor|lecturer|tutor|"
    r"teaching assistant|dean|provost)\b"
)
SENIORITY = (
    r"\b(senior|snr|lead|principal|staff|head|director|manager|managing|chief|"
    r"vice president|vp|svp|evp|avp|partner|supervisor|superintendent|expert|iii|iv)\b"
)
YEARS_LEAD_IN = r"(?:at least |minimum (?:of )?|min\.? )?"
YEARS_DEMANDED = (
    r"\b" + YEARS_LEAD_IN + r"(\d{1,2})\+?\s*(?:-\s*\d{1,2}\s*)?"
    r"(?:years?|yrs?)\b[^.]{0,40}?\b(?:experience|exp\b)"
)
YEARS_AS_HISTORY = (
    r"\b(?:over|more than|for|nearly|almost|past|last|about|around|"
    r"founded|since|history of|track record of|experience of)"
)
YEARS_VETO = 3
PROGRAMME_TITLE = (
    r"\b(graduate|new grad|newgrad|fresh grad(uate)?|campus|"
    r"analyst programme|analyst program|associate programme|associate program|"
    r"rotational programme|rotational program|leadership programme|leadership program|"
    r"development programme|development program|early career(s)?|apprentice(ship)?)\b"
    r"|\b20\d\d\s*(start|intake|cohort)\b|\bclass of 20\d\d\b"
)
ANCHORED_PROGRAMME = (
    r"^[\W\d_]*(?:\[[^\]]*\]\s*|\([^)]*\)\s*)*"
    r"(management (associate|trainee)|graduate (management )?(associate|trainee))\b"
)
STATED_FRESH_GRAD = (
    r"\b(fresh grad(uate)?s?|recent grad(uate)?s?|new grad(uate)?s?|final[- ]year|"
    r"penultimate|graduating in 20\d\d|no (prior|previous|relevant) (work )?experience|"
    r"no experience (required|needed)|"
    r"0\s*[-–to]{1,3}\s*[1-5]\s*years?|"
    r"(?:directly|straight|right)\s+(?:from|out of)\s+(?:school|university|college|campus)|"
    r"entry[ -]?level)\b"
)
FRESH_GRAD_REDIRECT = (
    r"\b(?:see|refer to|visit|check|browse|explore|consider|apply (?:to|through|via))\b"
    r"[^.]{0,40}?\b(?:campus|university|student|graduate|early[ -]?career|intern)\b"
    r"[^.]{0,20}?\b(?:postings?|programmes?|programs?|opportunities|roles?|openings?|page|site)\b"
    r"|\bnot (?:intended|suitable|designed|open|available) for\b"
    r"|\bthis (?:role|position|opening|posting) is not\b"
)
REDIRECT_BEFORE = 130
REDIRECT_AFTER = 160
# shortest text the fresh-graduate pattern can match ("0-1year")
FRESH_GRAD_MIN_CHARS = 7
ENTRY_TITLE = r"\b(entry[ -]?level|junior|trainee|graduate)\b"
LEVEL_ENTRY = (
    r"^\s*(entry[ -]?level|graduate|student|intern(ship)?|apprentice|"
    r"trainee|junior|new grad(uate)?|no experience)\b"
)
LEVEL_SENIOR = (
    r"\b(mid[- ]?senior|senior|director|executive|principal|lead|manager|"
    r"vice president|head)\b"
)
INTERNSHIP_TITLE = (
    r"\b(intern|interns|internship|attachment|traineeship|co[- ]?op|placement year|"
    r"industrial placement|vacation scheme|summer analyst|off[- ]?cycle)\b"
)
INTERNSHIP_TYPES = ("internship", "attachment")
JUNIOR_ALTERNATIVE_SPLIT = r"[/|]|\bor\b"

# (pattern, weight, signal name)
SCORE_SIGNALS = (
    (r"\bgraduate\b", 3.0, "title:graduate"),
    (r"\b(new grad|newgrad|fresh grad(uate)?)\b", 3.5, "title:new-grad"),
    (r"\b(management associate|management trainee|graduate programme)\b", 3.0, "title:programme"),
    (r"\b(campus|early career(s)?|apprentice(ship)?)\b", 2.5, "title:campus"),
    (r"\b20\d\d\s*(start|intake|cohort)\b|\bclass of 20\d\d\b", 2.0, "title:intake-year"),
    (r"\bentry[ -]?level\b", 2.0, "title:entry-level"),
    (r"\bjunior\b", 1.0, "title:junior"),
    (r"\btrainee\b", 1.5, "title:trainee"),
)
POSITION_LEVEL_WEIGHTS = {
    "fresh/entry level": 2.0,
    "junior executive": 1.0,
    "non-executive": 0.5,
    "professional": 0.0,
    "executive": 0.0,
    "senior executive": -1.0,
    "manager": -1.5,
    "middle management": -2.0,
    "senior management": -2.0,
}
YEARS_WEIGHTS = {0: 2.0, 1: 1.0, 2: -1.0}

# --- fixed values: job family rules, first match wins -------------------------------------

FAMILY_RULES = (
    ("quant_trading",
     r"\b(quant(itative)?[ -](trader|trading)|trader|trading (analyst|associate|desk)|"
     r"market mak(er|ing)|execution trad|prop(rietary)? trad|"
     r"trading(?!\s+(operations|support|settlement|ops|controls?)))\b"),
    ("quant_research",
     r"\b(quant(itative)?[ -]research|quant(itative)? researcher|"
     r"systematic research|quant(itative)? strateg)\b"),
    ("quant_dev",
     r"\b(quant(itative)?[ -](developer|dev|engineer|technolog)|"
     r"quant(itative)? analyst|quant)\b"),
    ("strategy_operations",
     r"\bstrategy (and|&) (operations|ops)\b|\bbiz ?ops\b|\bstrat(egy)? ?ops\b"),
    ("strategy_consulting",
     r"\b(strategy consult|strategic consult|parthenon|strategy (and|&) execution|"
     r"corporate strategy|commercial strategy|"
     r"strategy (analyst|associate|consultant|intern(ship)?)|"
     r"transaction (advisory|services)|deal advisory|due diligence)\b"),
    ("management_consulting",
     r"\b(management consult|business consult|consulting (analyst|associate|graduate)|"
     r"associate consultant|consultant|advisory (analyst|associate)|business advisory|"
     r"case team)\b"),
    ("supply_chain",
     r"\b(supply chain|procurement|logistics|sourcing|demand planning|supply planning|"
     r"inventory|warehouse|fulfil?lment|freight|shipping|materials management)\b"),
    ("product_management",
     r"\b(product manager|product management|product owner|apm)\b"),
    ("data_science",
     r"\b(data scien(ce|tist)|machine learning|deep learning|ml|mlops|"
     r"algorithm engineer|applied scientist|research scientist|"
     r"ai (engineer|scientist|algorithm)|data (&|and) ai|nlp|computer vision|mllm)\b"),
    ("data_analyst",
     r"\b(data analyst|data analytics|business intelligence|bi (analyst|developer)|"
     r"reporting analyst|insights analyst|analytics (associate|graduate))\b"),
    ("business_analyst",
     r"\b(business analyst|product analyst|process analyst|systems analyst|"
     r"business systems)\b"),
    ("software_engineering",
     r"\b(software engineer|software develop|swe|back[- ]?end|front[- ]?end|"
     r"full[- ]?stack|web develop|mobile (engineer|develop)|android|ios|"
     r"devops|site reliability|sre|platform engineer|infrastructure engineer|"
     r"cloud engineer|security engineer|systems engineer|embedded|firmware|"
     r"data engineer|big data engineer|solutions? architect|developer|programmer|"
     r"qa engineer|test engineer|automation engineer)\b"),
    # no closing word boundary: several of these are stems
    ("science_lab",
     r"\b(biotechnolog|laborator|lab technician|microbiolog|chemist|"
     r"analytical (chemist|scientist|develop)|formulation|bioinformatic|"
     r"clinical (research|trial|operation)|quality (control|assurance)|"
     r"chemical (technician|analyst|specialist|operator)|"
     r"qc (specialist|technician|analyst|scientist)|"
     r"qa (specialist|technician|analyst|scientist)|"
     r"molecular|genomic|assay|pharmacovigilance|regulatory affairs|"
     r"process (chemist|scientist)|upstream|downstream)"),
    ("investment",
     r"\b(investment (analyst|associate|banking|management|professional)|"
     r"equity research|portfolio manage|asset management|private equity|"
     r"venture capital|ibd|corporate finance|mergers|m&a|capital markets|"
     r"wealth manage|fund manage)\b"),
    ("risk_compliance",
     r"\b(risk (analyst|management|associate|officer)|credit risk|market risk|"
     r"operational risk|compliance|aml|kyc|financial crime|regulatory|"
     r"internal audit|audit (analyst|associate|graduate)|assurance)\b"),
    ("human_resources",
     r"\b(human resources|hr (analyst|associate|graduate|executive|generalist)|"
     r"talent acquisition|people (operations|analyst|partner)|recruitment|"
     r"compensation (and|&) benefits|learning (and|&) development)\b"),
    ("sales_marketing",
     r"\b(sales|marketing|brand manage|account (executive|manage)|"
     r"business development|growth (marketing|manager|associate|analyst|strateg)|"
     r"customer success|category manage|merchandis|public relations|"
     r"corporate communications)\b"),
    ("legal", r"\b(legal|counsel|paralegal|contracts? (analyst|manage))\b"),
    ("engineering",
     r"\b(mechanical|electrical|electronics|civil|structural|chemical|process|"
     r"manufacturing|industrial|production|quality|reliability|field service|"
     r"application|design|test|equipment|maintenance|facilit(y|ies)|"
     r"r&d|research and development)\b[^.]{0,20}\bengineer"),
    ("operations",
     r"\b(operations|operational|ops|service delivery|process improvement|"
     r"operational excellence)\b"),
    ("finance_accounting",
     r"\b(accountant|accounting|treasury|taxation|tax|controller|fp&a|"
     r"finance|financial)\b"),
    ("general_management",
     r"\b(management associate|management trainee|graduate (management|trainee|"
     r"program(me)?s?|associate|engineer|opportunit)|rotational|"
     r"leadership program(me)?s?|general management)\b"),
    ("engineering", r"\bengineer(ing)?\b"),
)
FAMILY_CONFIDENCE = {"title": 0.9, "department": 0.6, "description": 0.4, "sector-residual": 0.3,
                     "unmatched": 0.0, "manual-override": 1.0}
SECTOR_RESIDUAL = {"consulting": "management_consulting"}
FAMILY_UNMATCHED = "other"

# --- fixed values: employer names ---------------------------------------------------------

LEGAL_WORDS = (
    r"\b(pte|ltd|limited|llp|llc|inc|plc|private|pvt|co|corp|corporation|company|"
    r"branch|headquarters|hq|and|the|of)\b"
)
GEO_WORDS = (
    r"\b(holdings?|group|international|global|asia|apac|pacific|singapore|sg|regional)\b"
)
NAME_MATCH_THRESHOLD = 92
MIN_BRAND_CHARS = 4
TITLE_MATCH_THRESHOLD = 88
MERGE_WINDOW_DAYS = 14

# --- fixed values: board discovery --------------------------------------------------------

BOARD_NOISE_WORDS = (
    r"\b(inc|ltd|limited|llc|llp|plc|pte|group|holdings|international|company|co|corp|"
    r"corporation|the|and|of|technologies|technology|global|asia|pacific|singapore)\b"
)
TENANT_NOISE_WORDS = (
    r"\b(inc|ltd|limited|llc|llp|plc|pte|group|holdings|international|company|co|corp|"
    r"corporation|the|and|of|technologies|technology|global|asia|pacific|singapore|bank)\b"
)
CAMPUS_SUFFIXES = ("campus", "students", "university", "grads", "graduates", "earlycareers")
ATS_HOSTS = (
    "greenhouse.io", "lever.co", "ashbyhq.com", "smartrecruiters.com", "workable.com",
    "myworkdayjobs.com", "icims.com", "successfactors.com",
)
MIN_TOKEN_CHARS = 3
MIN_TRUSTED_TOKEN_CHARS = 4
BOARD_NAME_THRESHOLD = 85
BOARD_TOKEN_THRESHOLD = 90
MIN_SUBSET_CHARS = 5
MIN_ONE_WORD_COVERAGE = 0.6
TENANT_PATTERN = r"^[a-z0-9][a-z0-9-]{0,28}[a-z0-9]$"
TENANT_THRESHOLD = 78
INITIALISM_CHARS = 6
NON_SITE_SEGMENTS = (
    "refreshfacet", "wday", "talentcommunity", "talent_community", "static", "assets",
)
SITE_IN_SITEMAP = r"myworkdayjobs\.com/([A-Za-z0-9_\-]+)/"

# --- fixed values: payload formats --------------------------------------------------------

PLACE = "singapore"
PLACE_CODES = ("sg", "sgp", "singapore")
PLACE_CODE_PATTERN = r"\bsingapore\b|\bsg\b|\bsgp\b"
PLACE_NAME = "Singapore"
RELATIVE_DATE = r"posted\s+(?:(\d+)\+?\s+days?\s+ago|(today)|(yesterday))"
MULTI_LOCATION = r"^\s*\d+\s+locations?\s*$"
WORTH_DETAIL = (
    r"\b(graduate|grad|campus|intern|trainee|junior|entry|associate|analyst|"
    r"early career|apprentice|programme|program|20\d\d)\b"
)
DETAIL_BUDGET = 80
MAX_JOB_PAGES = 120
AD_SECTIONS = ("jobDescription", "qualifications", "additionalInformation", "companyDescription")
TILE_MARKER = r'<li class="job-tile job-id-'
TILE_URL = r'data-url="([^"]+)"'
TILE_TITLE = r'class="jobTitle-link[^"]*"[^>]*>\s*(.*?)\s*</a>'
TILE_SECTION = (
    r'class="section-field (\w+)[^"]*"[^>]*>(.*?)(?=<div class="section-field|</div>\s*</div>)'
)
TILE_LABEL = (
    r"^(location|department|posting date|date|shift ?type|job ?type|category|"
    r"requisition ?id|country|city)\b[:\s]*"
)
SITEMAP_LOC = r"<loc>\s*(.*?)\s*</loc>"
JOB_PAGE_URL = r"/job/(\d+)/"
LD_JSON_BLOCK = r"<script[^>]+application/ld\+json[^>]*>(.*?)</script>"
PUBLIC_URL_SMARTRECRUITERS = "https://jobs.smartrecruiters.com/%s/%s"
PUBLIC_URL_WORKDAY = "https://%s/en-US/%s%s"
SWEEP_FIRM_ID = "_mcf_sweep"
ERROR_CHARS = 200

# --- fixed values: serving ----------------------------------------------------------------

DIGEST_CHARS = 3800
REPLY_CHARS = 3500
DIGEST_TITLE_CHARS = 90
DIGEST_FIRM_CHARS = 40
REPLY_TITLE_CHARS = 80
REPLY_FIRM_CHARS = 38
NEW_WINDOW_DAYS = 3
NEW_MARK = "🆕"
LATEST_DEFAULT = 15
LATEST_MAX = 50
SEARCH_LIMIT = 40
CANDIDATES_SHOWN = 40
CANDIDATES_WRITTEN = 200
CANDIDATES_REPORTED = 25
FAILURES_REPORTED = 50
BROKEN_THRESHOLD = 1.0
DIGEST_RULE = "\n\n---\n\n"
