"""Fixed values of the catalogue: columns, enumerations, word lists and patterns.

Everything here must equal the published data model for results to agree.
"""

from __future__ import annotations

# The 22 output columns, in order.
COLUMNS = (
    "payer_name", "payer_alias", "state_or_region", "line_of_business", "document_title", "document_type",
    "document_url", "source_page_url", "discovery_path", "file_type", "policy_number", "effective_date",
    "last_updated_date", "http_status", "content_hash_sha256", "file_size_bytes", "requires_auth", "render_mode",
    "extraction_method", "confidence_score", "scrape_timestamp_utc", "notes",
)
# Defaults of the columns that are not empty by default.
DEFAULTS = {"line_of_business": "Unknown", "document_type": "other", "file_type": "other", "http_status": "0", "requires_auth": "N", "render_mode": "static", "extraction_method": "sitemap", "confidence_score": "0.50"}

# Enumerations.
LINE_OF_BUSINESS = ("Commercial", "Medicare", "Medicaid", "Exchange", "Federal", "Multiple", "Unknown")
DOCUMENT_TYPE = ("medical_policy", "pharmacy_policy", "coverage_guideline", "pa_form", "pa_list", "formulary", "drug_list", "provider_manual", "bulletin", "other")
FILE_TYPE = ("html", "pdf", "doc", "docx", "xls", "xlsx", "other")
RENDER_MODE = ("static", "headless", "api")
EXTRACTION_METHOD = ("css_selector", "xpath", "regex", "json_api", "sitemap", "pdf_text", "pdf_annotation", "url_pattern", "manual")
USPS_CODES = tuple("AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY PR VI GU AS MP".split())
STATE_OR_REGION = (*USPS_CODES, "National")
PLACEHOLDERS = ("none", "null", "n/a", "na", "-", "--", "tbd", "nan", "not applicable")
PAYER_STATUSES, TERMINAL_STATUSES = ("pending", "in_progress", "done", "blocked", "failed"), ("done", "blocked")

# Code points deleted from texts, and those read as a space.
ZERO_WIDTH = "".join(map(chr, (0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0xFEFF, 0x00AD)))
SPACES = "".join(map(chr, (0x00A0, 0x1680, 0x2007, 0x202F, 0x205F, 0x3000, 0x2028, 0x2029)))

# URL shapes.
DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".rtf")
NEGATIVE_EXTENSIONS = (
    ".css", ".js", ".mjson", ".json", ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".ico", ".woff", ".woff2", ".ttf",
    ".eot", ".otf", ".mp4", ".mp3", ".webm", ".mov", ".avi", ".zip", ".exe", ".dmg", ".rss", ".atom", ".map",
)
DOCUMENT_QUERY_HINTS = ("download", "attachment", "getfile", "getdocument", "docid", "fileid", "assetid", "contentid", "streamfile", "viewfile", "openfile", "blobid")
ASSET_ROUTES = ("/download", "/attachment", "/getfile", "/streamdocument", "/documents/", "/assets/", "/dam/", "/media/", "/content/dam/")
ASSET_STEMS = ("polic", "guideline", "formular", "manual", "bulletin", "auth", "drug", "criteria", "coverage")
INDEX_TEXT_HINTS = (
    "policies", "policy list", "guidelines", "medical policy", "clinical policy", "coverage policies", "policy index", "view all",
    "see all", "browse", "a-z", "a to z", "index", "library", "search policies", "all policies", "policy updates", "bulletins",
    "newsletters", "provider manual", "prior authorization", "formulary", "drug list", "pharmacy policy",
)
POLICY_PATH_HINTS = (
    "medical-polic", "medicalpolic", "medical_polic", "clinical-polic", "clinicalpolic", "clinical-criteria", "clinical-guideline",
    "coverage-polic", "coverage-guideline", "coverage-determination", "payment-polic", "reimbursement-polic", "administrative-polic",
    "pharmacy-polic", "pharmacy-guideline", "drug-polic", "drug-list", "formular", "preferred-drug", "specialty-drug", "medication-polic",
    "prior-auth", "priorauth", "pre-auth", "preauth", "precertification", "prior-approval", "authorization-requirement",
    "provider-manual", "provider-administrative", "provider-reference", "provider-polic", "provider-resource", "provider-notice",
    "provider-bulletin", "policies-and-procedures", "policy-and-procedure", "bulletin", "newsletter", "provider-update",
    "network-notification", "utilization-management", "um-guideline", "mcg", "interqual", "cob-polic", "coding-polic", "claims-polic", "claim-edit",
)
NOISE_PATH_HINTS = (
    "/careers", "/jobs", "/news/", "/press", "/newsroom", "/about-us", "/aboutus", "/investor", "/legal", "/privacy", "/terms", "/sitemap",
    "/search?", "/login", "/register", "/contact", "/find-a-doctor", "/find-care", "/shop", "/plans/", "/quote", "/enroll", "/broker",
    "/employer", "/individual", "/wellness", "/blog/", "/events", "/webinar", "/social", "/espanol", "/language", "/accessibility",
    "/nondiscrimination", "/site-map", "/cookie", "/es-us/", "/es_us/", "/es/", "/zh-", "/vi-", "/ko-", "/ru-", "/fr-", "/spanish",
    "/chinese", "/vietnamese", "/korean", "/tagalog", "/knowledge-center/hw/", "/healthwise", "/health-topics",
)
HELPFUL_BLOCKED_HINTS = ("search", "polic", "guideline", "criteria", "formular", "drug", "coverage", "medical", "pharmac", "provider", "document", "download", "bulletin", "manual", "library", "catalog", "browse")
NEVER_HELPFUL_HINTS = (
    "admin", "/user", "login", "logout", "signin", "sign-in", "register", "password", "account", "cart", "checkout", "comment", "node/add",
    "oembed", "filter/tips", "ajax", "cron", "install", "update.php", "wp-", "cgi-bin", "/print", "email", "captcha", "session", "profile", "preferences",
)
HTML_POLICY_MARKERS = ("effective date", "policy number", "coverage rationale", "medical necessity", "clinical evidence", "cpt code", "hcpcs")
INDEX_FILE_NAMES = ("index.html", "index.htm", "default.aspx", "index.aspx")
TRACKING_PREFIXES = ("utm_", "gclid", "fbclid", "mc_cid", "mc_eid", "_ga", "msclkid", "sessionid", "jsessionid", "phpsessid", "cachebust", "_t", "ts", "srsltid", "wbraid", "gbraid")
TWO_LABEL_TLDS = ("co.uk", "com.au", "co.nz", "com.br", "co.jp", "org.uk", "net.au")
SKIPPED_SCHEMES = ("mailto:", "tel:", "javascript:", "data:", "#", "sms:", "ftp:", "file:")
COMMON_SITEMAP_PATHS = ("/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml", "/sitemap.xml.gz", "/sitemaps/sitemap.xml", "/sitemap/sitemap-index.xml")

# Candidate scores.
SCORE_WEIGHTS = (
    ("medical polic", 1.5), ("clinical polic", 1.5), ("coverage polic", 1.3), ("medical-polic", 1.5), ("clinical-polic", 1.5),
    ("coverage-polic", 1.3), ("pharmacy polic", 1.2), ("pharmacy-polic", 1.2), ("prior auth", 1.1), ("prior-auth", 1.1),
    ("formular", 1.0), ("guideline", 0.9), ("criteria", 0.8), ("provider manual", 0.9), ("provider-manual", 0.9), ("bulletin", 0.6),
    ("drug list", 0.8), ("polic", 0.5), ("provider", 0.3),
)
SCORE_PENALTIES = (("archive", 0.8), ("historical", 0.8), ("retired", 1.0), ("inactive", 0.8), ("member", 0.4), ("espanol", 1.0), ("spanish", 0.6), ("brochure", 0.5))

# Document types with their key phrases, in order of precedence.
TYPE_RULES = (
    ("pa_list", ("prior authorization list", "pa list", "precertification list", "prior auth list", "authorization requirements list", "services requiring prior authorization", "pa-list", "palist", "prior-authorization-list", "code list", "cpt code list")),
    ("pa_form", ("prior authorization form", "pa form", "request form", "authorization form", "precertification request", "prior-authorization-form", "pa-form", "prior auth form", "exception request", "coverage determination request", "predetermination form", "referral form", "appeal form")),
    ("formulary", ("formulary", "preferred drug list", "pdl", "covered drug list", "drug formulary", "comprehensive formulary")),
    ("drug_list", ("drug list", "specialty drug", "medication list", "self-administered drug", "drug-list", "step therapy list", "quantity limit")),
    ("pharmacy_policy", ("pharmacy policy", "pharmacy medical necessity", "drug policy", "medication policy", "pharmacy-polic", "drug-polic", "pharmacy guideline", "specialty pharmacy")),
    ("provider_manual", ("provider manual", "provider administrative manual", "administrative guide", "provider guide", "provider reference", "care provider manual", "provider-manual", "administrative-guide", "handbook", "provider administrative guide")),
    ("bulletin", ("bulletin", "newsletter", "network notification", "provider update", "policy update", "medical policy update", "announcement", "provider notice", "network bulletin", "provider news", "policy-update", "notification")),
    ("coverage_guideline", ("coverage guideline", "coverage determination", "utilization management guideline", "um guideline", "clinical guideline", "clinical criteria", "coverage-guideline", "clinical-guideline", "medical necessity criteria", "coverage summary", "clinical utilization management")),
    ("medical_policy", ("medical policy", "clinical policy", "coverage policy", "medical coverage", "payment policy", "reimbursement policy", "administrative policy", "medical-polic", "clinical-polic", "coverage-polic", "policy", "coverage rationale")),
)
# Lines of business with their key phrases.
LOB_RULES = (
    ("Medicare", ("medicare", "medicare advantage", " ma ", "part d", "part b", "dual eligible", "d-snp", "dsnp", "c-snp", "chronic snp", "pdp")),
    ("Medicaid", ("medicaid", "chip ", "managed medicaid", "medi-cal", "husky", "familycare", "healthchoice", "community plan", "star kids", "long-term services and supports", "ltss")),
    ("Exchange", ("exchange", "marketplace", "aca ", "individual and family", "qhp", "on-exchange", "off-exchange", "healthcare.gov")),
    ("Federal", ("federal employee", "fehb", "fep ", "federal employee program", "tricare", "veterans", "va community care")),
    ("Commercial", ("commercial", "employer group", "group health", "self-funded", "fully insured", "aso ", "administrative services only", "small group", "large group", "ppo", "hmo", "epo")),
)
# State names and their codes.
STATE_NAMES = (
    ("alabama", "AL"), ("alaska", "AK"), ("arizona", "AZ"), ("arkansas", "AR"), ("california", "CA"), ("colorado", "CO"), ("connecticut", "CT"),
    ("delaware", "DE"), ("district of columbia", "DC"), ("florida", "FL"), ("georgia", "GA"), ("hawaii", "HI"), ("idaho", "ID"), ("illinois", "IL"),
    ("indiana", "IN"), ("iowa", "IA"), ("kansas", "KS"), ("kentucky", "KY"), ("louisiana", "LA"), ("maine", "ME"), ("maryland", "MD"),
    ("massachusetts", "MA"), ("michigan", "MI"), ("minnesota", "MN"), ("mississippi", "MS"), ("missouri", "MO"), ("montana", "MT"), ("nebraska", "NE"),
    ("nevada", "NV"), ("new hampshire", "NH"), ("new jersey", "NJ"), ("new mexico", "NM"), ("new york", "NY"), ("north carolina", "NC"),
    ("north dakota", "ND"), ("ohio", "OH"), ("oklahoma", "OK"), ("oregon", "OR"), ("pennsylvania", "PA"), ("rhode island", "RI"),
    ("south carolina", "SC"), ("south dakota", "SD"), ("tennessee", "TN"), ("texas", "TX"), ("utah", "UT"), ("vermont", "VT"), ("virginia", "VA"),
    ("washington", "WA"), ("west virginia", "WV"), ("wisconsin", "WI"), ("wyoming", "WY"), ("puerto rico", "PR"), ("virgin islands", "VI"), ("guam", "GU"),
)

# Patterns (Java syntax, no flags inside; callers add them).
POLICY_NUMBER_PATTERNS = (
    r"(?i)\b(?:policy|guideline|bulletin|document|coverage)\s*(?:number|no\.?|#|id)\s*[:\-]?\s*([A-Z0-9][A-Z0-9._\-/]{2,24})",
    r"(?i)\b(?:policy|number)\s*[:\-]\s*([A-Z]{1,5}[\-_. ]?\d{2,8}[A-Z0-9.\-]{0,8})",
    r"\b((?:CS|MP|CP|CPG|UM|MED|PHARM|DRUG|ADMIN|CLPD|MCP|MPP|SURG|LAB|RAD|TRANS|GENE|DME|BEH)[\-_. ]?\d{2,6}(?:\.\d{1,4})?)\b",
    r"\b(\d{4}-\d{3,5})\b",
)
_DATE_VALUE = (
    r"((?:\d{1,2}[/-]\d{1,2}[/-]\d{2,4})|(?:\d{4}-\d{2}-\d{2})"
    r"|(?:(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)\.?\s+\d{1,2},?\s+\d{4})"
    r"|(?:\d{1,2}\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}))"
)
EFFECTIVE_DATE = r"(?i)(?:effective|effective\s+date|date\s+effective|in\s+effect)\b\s*(?:date)?\s*[:\-]?\s*" + _DATE_VALUE
UPDATED_DATE = r"(?i)(?:last\s+(?:updated|revised|reviewed|review)|revised|revision\s+date|updated|reviewed|last\s+modified|approval\s+date|publish(?:ed)?\s+date)\b\s*(?:date)?\s*[:\-]?\s*" + _DATE_VALUE
DATE_LABEL = r"(?i)^(effective(\s+date)?|revised|reviewed|updated|last\s+updated|last\s+reviewed|published|date)\b[:\s]*"
TITLE_NOISE = (
    r"\b(?:january|february|march|april|may|june|july|august|september|october|november|december)\s+\d{1,2}?,?\s*(?:19|20)\d{2}\b",
    r"\b\d{1,2}[/\-.]\d{1,2}[/\-.](?:19|20)?\d{2}\b",
    r"\b(?:19|20)\d{2}[-/]\d{1,2}(?:[-/]\d{1,2})?\b",
    r"\b(?:effective|revised|reviewed|updated|last\s+updated|version|ver\.?|rev\.?|revision)\b\s*[:#-]?\s*[\w./-]*",
    r"\bq[1-4]\s*(?:19|20)\d{2}\b",
    r"\b(?:19|20)\d{2}\b",
    r"\b(?:pdf|final|draft|copy|clean|redline|track\s*changes)\b",
)
TITLE_STOPWORDS = ("the", "a", "an", "and", "or", "of", "for", "to", "in", "on", "policy", "policies", "guideline", "guidelines", "medical", "clinical", "coverage")
SITE_NAMES = (
    r"UHCprovider\.com|UnitedHealthcare|Horizon\s+BCBSNJ|Horizon\s+Blue\s+Cross[^|]*|Cigna(?:\s+Healthcare)?|UPMC(?:\s+Health\s+Plan)?"
    r"|Anthem(?:\s+Blue\s+Cross[^|]*)?|Elevance\s+Health|CareSource|Centene|Geisinger(?:\s+Health\s+Plan)?|Highmark(?:\s+Blue[^|]*)?"
    r"|BlueCross\s+BlueShield[^|]*|BCBST"
)
TITLE_BOILERPLATE = r"(?i)\s*[|\-:–—]\s*(?:" + SITE_NAMES + r")\s*$"
ANCHOR = r"""(?is)<a\b[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)[^>]*>(.*?)</a\s*>"""
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
SOFT_404_MARKERS = ("page not found", "not found", "error", "no results", "we couldn't find", "we could not find", "access denied", "under construction", "coming soon", "unavailable", "sorry", "invalid request", "bad request")
GENERIC_PDF_TITLES = ("untitled", "document", "document1", "print", "form", "pdf")

# HTTP.
RETRYABLE_STATUS = (408, 425, 429, 500, 502, 503, 504)
BLOCK_STATUS = (401, 403, 406, 407, 451)
CHALLENGE_MARKERS = (
    "just a moment", "attention required! | cloudflare", "checking your browser before accessing", "enable javascript and cookies to continue",
    "request unsuccessful. incapsula incident id", "access denied", "you have been blocked", "radware", "captcha", "px-captcha",
    "_incapsula_resource", "distil_r_captcha", "bot detection",
)
AUTH_MARKERS = ("sign in to continue", "please sign in", "please log in", "login required", "you must be logged in", "session has expired", "one healthcare id", "register for an account")
AUTH_FRAGMENTS = ("/login", "/signin", "/sign-in", "secure.", "auth0", "/idp/", "adfs", "b2clogin", "/account/login")
# (first bytes in hex, kind)
MAGIC_PREFIXES = (("255044462D", "pdf"), ("D0CF11E0A1B11AE1", "ole"), ("504B0304", "zip"), ("7B5C727466", "doc"))
CONTENT_TYPES = (
    ("application/pdf", "pdf"), ("application/x-pdf", "pdf"), ("text/html", "html"), ("application/xhtml+xml", "html"), ("text/xml", "html"),
    ("application/xml", "html"), ("application/msword", "doc"), ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", "docx"),
    ("application/vnd.ms-excel", "xls"), ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "xlsx"),
)

# Seed list headers and their fields.
HEADER_ALIASES = {
    "payer_name": ("payer", "payername", "name"), "payer_alias": ("payeralias", "alias", "shortname"),
    "hint_host": ("hinthost", "host", "hostname", "domain", "seedhost", "website", "url"),
    "default_state_or_region": ("stateorregion", "state", "region", "defaultstateorregion"),
    "default_line_of_business": ("lineofbusiness", "lob", "defaultlineofbusiness"), "seed_paths": ("seedpaths", "paths"),
    "extra_hosts": ("extrahosts", "additionalhosts"), "notes": ("notes", "note"), "payer_id": ("id", "payerid"),
}
RESERVED_NAMES = ("con", "prn", "aux", "nul", *(f"com{d}" for d in range(1, 10)), *(f"lpt{d}" for d in range(1, 10)))
ROBOTS_DIRECTIVES = ("user-agent", "allow", "disallow", "crawl-delay", "sitemap", "request-rate", "visit-time", "noindex")
TIERS = ("content_hash", "policy_number", "title")
ORIGIN_METHODS = (("sitemap", "sitemap"), ("sitemap_doc", "sitemap"), ("anchor", "css_selector"), ("index", "css_selector"), ("html_policy", "css_selector"), ("url_pattern", "url_pattern"))
