"""Fixed values of the analytics, as parameters' defaults."""

# Headings, keywords, thresholds.
OVERVIEW_HEADINGS = ("SOP Activities Overview", "Activities Overview", "Process Overview")
DETAIL_HEADINGS = ("Detailed Process Steps", "Process Detail", "Process Steps", "Procedure")
PERFORMANCE_KEYWORDS = ("process performance", "sla", "kpi")
RISK_KEYWORDS = ("process risk",)
RISK_TITLE = "PROCESS RISKS? AND MITIGATION"
RISK_STOPS = "POLICIES|PROCESS PERFORMANCE|PROCESS CONTACT|RECORD RETENTION|APPENDIX"
MIN_WORDS, TOP_STEPS, MAX_FEATURES = 20, 5, 5000
EMBEDDING_THRESHOLD, TFIDF_THRESHOLD = 0.35, 0.12

# Patterns of header fields.
PLACEHOLDER = r"(?i)SOP\s+REFERENCE\s+NO|REFERENCE\s+NO\.?\s+AND\s+(?:SOP\s+)?NAME|(?:INSERT|ENTER|TYPE|ADD)\s+\w+\s+HERE|^(N/A|TBD|NA|TO\s+BE\s+DETERMINED)$"
HINT = r"(?i)should|come from|process map|refer|insert|enter|type|tbd|n/a|placeholder|from the"
BAD_LABEL = r"[\\@\x80-\xff]|HYPERLINK|MERGEFORMAT|REF |gd[A-Z]|Ifa|OJQJ"
BAD_VALUE = r"\\\\|OJQJ|Ifa|gdE|\\\\^J"
LABEL_SCORE = r"(?i)organ|process map|sop no|sop number|sla|title"

# Heading patterns and whitelists.
CAPS_HEADING = r"^(\d+[\.\s]+)?[A-Z][A-Z\s/\-–—&()]{4,}$"
NOT_HEADING = r"(?i)^(Note|Reference|Refer|Include|List|Embed|Provide|NA\b|Yes\b|No\b)"
SINGLE_HEADINGS = ("OBJECTIVE", "DEFINITIONS", "POLICIES", "APPENDIX", "OVERVIEW")
NAMESPACE_URLS = ("http://schemas.", "http://www.w3.", "http://purl.", "https://schemas.", "http://schemas.microsoft", "http://schemas.openxmlformats", "http://dublincore.org/schemas")

# Noise in steps, codes and words that are no codes.
STEP_NOISE = r"(?iU)\b(germany|german|austria|austrian|uk|united kingdom|india|indian|france|french|usa|america|singapore|apac|emea|gbp|usd|eur|inr|sgd|vat|gst|tds|mwst|hmrc)\b"
CODE_PATTERNS = (
    r"[Tt][-\s]?[Cc]ode[s]?\s*[:\(]?\s*([A-Z][A-Z0-9_\-]{1,29})\)?",
    r"(?i)Run\s+([A-Z][A-Z0-9_\-]{1,29})\s+(?:SAP|[Tt]code|[Tt]ransaction)\b",
    r"(?i)Run\s+SAP\s+[Tt]code\s+([A-Z][A-Z0-9_\-]{1,29})",
    r"[Tt]ransaction\s+([A-Z][A-Z0-9_\-]{1,29})\b",
    r"(?i)\bOpen\s+[Tt]ransaction\s+([A-Z][A-Z0-9_\-]{1,29})",
    r"(?i)\b(S_ALR_[A-Z0-9_]+)\b",
    r"(?i)\bGo\s+to\s+(?:the\s+)?transaction\s+([A-Z][A-Z0-9_\-]{1,29})",
    r"(?i)\bGo\s+to\s+([A-Z][A-Z0-9_\-]{1,29})\s+in\s+SAP",
)
NO_CODES = (
    "THE", "AND", "FOR", "RUN", "SAP", "CODE", "WITH", "FROM", "THIS", "THAT", "WILL", "CAN", "NOT", "ALL", "BUT", "USE", "NEW", "OLD", "END", "ADD", "SET", "GET", "OUT",
    "YES", "NO", "OK", "GO", "DO", "IN", "IS", "IT", "OF", "ON", "OR", "TO", "UP", "WE", "TCODE", "TRANSACTION", "REPORT", "SYSTEM", "TABLE", "FIELD", "VALUE", "MENU",
    "DIFF", "DEP", "STEP", "NOTE", "BACK", "SAVE", "EXIT", "VIEW", "LIST", "OPEN",
)

# Synonyms, and words of group names.
SYNONYMS = {
    "bill": "invoice", "bills": "invoices", "supplier": "vendor", "suppliers": "vendors", "creditor": "vendor", "wage": "salary", "wages": "salaries", "entry": "posting",
    "entries": "postings", "verify": "validate", "check": "review", "confirm": "approve", "authorise": "approve", "authorize": "approve", "disposal": "retirement",
    "capitalize": "capitalise", "capitalization": "capitalisation",
}
VERBS = (
    "posting", "payment", "approval", "settlement", "reconciliation", "processing", "depreciation", "capitalisation", "capitalization", "retirement", "allocation",
    "invoicing", "closing", "validation", "calculation", "onboarding", "budgeting", "reporting", "clearance", "transfer", "accrual", "extraction", "analysis",
    "creation", "review", "preparation",
)
NOUNS = (
    "invoice", "vendor", "asset", "payroll", "salary", "ledger", "account", "budget", "cost", "project", "employee", "payment", "journal", "balance", "capital",
    "depreciation", "period", "order", "expense", "bank", "data", "transaction", "request", "report", "entries", "items",
)
SKIP = (
    "the", "and", "for", "in", "on", "at", "to", "of", "with", "by", "from", "is", "are", "was", "were", "be", "have", "has", "do", "does", "this", "that", "it", "as", "if",
    "not", "no", "can", "will", "may", "all", "any", "use", "new", "old", "step", "steps", "click", "select", "enter", "please", "must", "user", "document", "file", "system",
    "process", "procedure", "sap", "transaction", "tcode", "code", "run", "go", "see", "note", "page", "section", "based", "only", "should", "whether", "also", "then",
    "after", "before", "into", "such", "these", "those", "each",
)

# Object types by program and by extension, the first that fits.
OBJECT_TYPES = (
    ("Excel", ("Excel",), (".xlsx", ".xls", ".xlsm")), ("PDF", ("Acro", "PDF"), (".pdf",)), ("Word", ("Word",), (".docx", ".doc")),
    ("MSG", ("Package",), (".msg",)), ("VSD", ("Visio",), (".vsd", ".vsdx")), ("PPTX", ("PowerPoint",), (".pptx", ".ppt")),
)

# A labelled paragraph of a target cell, heading styles, step columns and the words of sentinel rows.
LABELLED = r"^\*{0,2}((?:\S+ ?){1,6}?)\*{0,2}\s*:\s+\S"
HEADING_STYLES = ("heading", "title", "toc")
STEP_COLUMNS = ("step", "activity", "description", "process")
OVERVIEW_COLUMNS, DETAIL_COLUMNS = ("description", "activity", "process"), ("description", "detail", "instruction", "work")
SOURCES = ("SOP Activities Overview", "Detailed Process Steps", "Activities Overview + Detailed Steps", "Paragraph steps (fallback)")
NUMBER_FORMATS = ("decimal", "ordinal")
NO_SECTION, NO_TABLE, NO_LINK, BAD_TABLE, NO_RISK = "Section {} Not Found", "Table Not Found", "No Hyperlink found", "Table Structure Not Correct", "Process Risk Section Not Found"
