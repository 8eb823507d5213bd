"""Fixed values.

Word lists, patterns and default settings that decide what the results are.
They are stated here once, in natural order, and used everywhere else by name.
"""

# Document types, in listing order.
DOC_TYPES = (
    "invoice",
    "purchase_order",
    "contract",
    "receipt",
    "statement",
    "annual_report",
    "quarterly_report",
    "current_report",
    "proxy_statement",
    "earnings_transcript",
    "news_article",
    "market_analysis",
    "research_report",
    "financial_statement",
    "press_release",
    "other",
)

# Types that count as financial documents.
FINANCIAL_DOC_TYPES = (
    "annual_report",
    "quarterly_report",
    "current_report",
    "earnings_transcript",
    "financial_statement",
    "invoice",
    "purchase_order",
    "contract",
)

# Finance words looked for in document text.
FINANCE_TERMS = (
    "invoice", "purchase", "order", "payment", "amount", "total",
    "subtotal", "tax", "discount", "quantity", "price", "cost",
    "vendor", "supplier", "customer", "client", "billing", "account",
    "contract", "agreement", "terms", "conditions", "due", "date",
)

# Keywords that make a sentence a key section of a long document.
SECTION_KEYWORDS = (
    "revenue", "earnings", "profit", "loss", "cash flow", "assets", "liabilities",
    "equity", "debt", "margin", "growth", "dividend", "eps", "ebitda",
    "operating income", "net income", "gross profit", "balance sheet",
    "income statement", "financial position", "liquidity", "capital",
    "investment", "acquisition", "merger", "outlook", "guidance", "forecast",
)

# Patterns, in Java syntax with Unicode digit, letter and space classes.
AMOUNT_PATTERN = r"\$?\p{Nd}{1,3}(?:,\p{Nd}{3})*(?:\.\p{Nd}{2})?"
DATE_PATTERN = r"\p{Nd}{1,2}[/-]\p{Nd}{1,2}[/-]\p{Nd}{2,4}"
INVOICE_PATTERN = r"(?iU)(?:invoice|inv)[\s\x1c-\x1f#]*([\p{L}\p{N}_]+)"
PO_PATTERN = r"(?iU)(?:po|purchase[\s\x1c-\x1f]+order)[\s\x1c-\x1f#]*([\p{L}\p{N}_]+)"
TOKEN_PATTERN = r"\b[a-zA-Z][a-zA-Z0-9]*\b"
FALLBACK_TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Placeholders put in by the patterns, in the order they are applied.
AMOUNT_TOKEN = "AMOUNT_TOKEN"
DATE_TOKEN = "DATE_TOKEN"
INVOICE_TOKEN = "INVOICE_TOKEN"
PO_TOKEN = "PO_TOKEN"

# Sparse index defaults.
MAX_FEATURES = 10_000
MIN_DF = 1
MAX_DF = 0.95
NGRAM_RANGE = (1, 2)
FALLBACK_MAX_FEATURES = 1_000
FALLBACK_FEATURES_PER_DOCUMENT = 100

# Query defaults and bounds.
SIMILARITY_THRESHOLD = 0.1
MAX_RESULTS = 50
MAX_RESULTS_BOUND = 1_000
BATCH_LIMIT = 10_000
FIRST_YEAR = 1990
YEARS_AHEAD = 10

# Snippets and encoder input.
SNIPPET_LENGTH = 200
SNIPPET_STEP = 20
SNIPPET_TAIL_SHARE = 0.8
EMBEDDING_TEXT_LENGTH = 2_048
KEY_SECTION_LENGTH = 2_000
QUERY_PREFIX = "[SEARCH QUERY]"

# Fusion and vector search defaults.
SPARSE_WEIGHT = 0.4
DENSE_WEIGHT = 0.6
RRF_K = 60
FUSION_THRESHOLD_SHARE = 0.5
SEARCH_OVERFETCH = 2
FUSION_OVERFETCH = 3
IVF_CLUSTERS = 100

# Search modes and thresholds of the sweep report.
SEARCH_MODES = ("tfidf", "transformer", "hybrid")
SWEEP_THRESHOLDS = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)
