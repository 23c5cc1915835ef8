"""Values fixed by the data contract.

Everything in this module must equal the published contract for results to agree
(patterns, enumerations, word lists, budgets, report field names). They are stated
once, as plain text, in natural order. Code elsewhere refers to them by name.
"""

# Record contracts ------------------------------------------------
SCHEMA_VERSION = 1
ALGORITHM_VERSION = "page-spans-v1"
PAPER_FIELDS = ("paper_id", "paper_version", "title", "authors", "published", "pdf_url",
                "source_path")
CITATION_FIELDS = ("paper_id", "paper_version", "title", "authors", "published", "pdf_url")
# Versioned arXiv identifier, whole value, case-sensitive.
PAPER_ID_PATTERN = r"\A(?:[a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})v[1-9]\d*\z"
PAPER_VERSION_PATTERN = r"\Av[1-9]\d*\z"
DATE_PATTERN = r"\A\d{4}-\d{2}-\d{2}\z"
HASH_PATTERN = r"\A[a-f0-9]{64}\z"
PDF_MAGIC = b"%PDF-"
ARXIV_HOST = "arxiv.org"
ARXIV_API_URL = "https://export.arxiv.org/api/query"
ARXIV_MIN_REQUEST_SECONDS = 3.0
ARXIV_CATEGORY_QUERY = "cat:cs.AI"

# White space -----------------------------------------------------
# The 29 code points that count as white space, as a regex class body and as a string.
WHITESPACE_CLASS_BODY = (r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029"
                         r"\u202f\u205f\u3000")
WHITESPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000")

# Chunking profiles -----------------------------------------------
CHUNK_PROFILES = ("boundary_characters", "fixed_characters", "tokenizer")
DEFAULT_CHUNK_SETTINGS = {
    "profile": "boundary_characters",
    "size": 1800,
    "overlap": 200,
    "token_budget": 200,
    "token_overlap": 40,
    "max_input_tokens": 256,
}
# Preferred breaks, strongest first: blank line, sentence end, any white space.
BREAK_PATTERNS = (r"\n\s*\n", r"[.!?][\"')\]]*\s+", r"\s+")
IDENTITY_FIELDS = ("paper_id", "paper_version", "title", "authors", "published", "pdf_url",
                   "page_number", "start_character", "end_character", "page_text_sha256",
                   "chunking_profile_sha256", "text")

# Outcomes and reports --------------------------------------------
SUCCESS, PARTIAL_FAILURE, FAILURE = "success", "partial_failure", "failure"
EXIT_CODES = {"success": 0, "partial_failure": 2, "failure": 3}
FAILURE_CATEGORIES = ("missing_pdfs", "parsing_failures", "papers_without_usable_text",
                      "missing_page_papers")
INPUT_MODES = ("existing_pages", "pdf_pipeline")
TOKENIZER_VALIDATION = {
    True: "local_asset_counts_verified; model_identity_declared_not_authenticated",
    False: "not_requested",
}

# Index and search ------------------------------------------------
EMBEDDING_MODEL = "all-MiniLM-L6-v2"
EMBEDDING_PROBE = "validated-passage-index-embedding-probe-v1"
AGENT_TOP_K = 6
MAX_SEARCH_ROUNDS = 3
UNTITLED = "Untitled chat"
NO_PASSAGES_ANSWER = "No relevant passages found."
NO_PASSAGES_TOOL = "No passages found."
MESSAGE_ROLES = ("user", "agent")
BOUNDS = {"limit": (1, 500), "offset": (0, None), "k": (1, 20), "n": (1, 100)}

# Corpus summary --------------------------------------------------
BAD_TITLE_HINTS = ("microsoft word", ".docx", ".tex", ".dvi", "untitled", "untitled document")
KEYWORD_PATTERN = r"[A-Za-z][A-Za-z'-]+"
ABSTRACT_LIMIT = 1200
ABSTRACT_PREVIEW = 300
KEYWORD_LIMIT = 8
DEFAULT_THEME = "General AI research"
STOPWORDS = (
    "about", "above", "across", "after", "again", "against", "also", "among", "and", "any",
    "are", "based", "been", "being", "between", "both", "but", "can", "could", "did", "does",
    "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has", "have",
    "having", "here", "how", "into", "its", "itself", "just", "more", "most", "much", "must",
    "new", "nor", "not", "now", "off", "once", "only", "other", "our", "out", "over", "own",
    "paper", "papers", "research", "results", "same", "should", "some", "study", "such", "task",
    "tasks", "than", "that", "the", "their", "them", "then", "there", "these", "they", "this",
    "those", "through", "too", "under", "until", "used", "using", "very", "was", "were", "what",
    "when", "where", "which", "while", "who", "why", "will", "with", "within", "without", "work",
    "model", "models", "you", "your")
THEMES = (
    ("Inference routing & model efficiency",
     ("route", "routing", "inference", "cost", "allocation", "efficiency", "model selection")),
    ("AI agents & self-improvement",
     ("agent", "agents", "recursive", "self-improvement", "computer-use", "task model")),
    ("Behavior modeling & forecasting",
     ("travel", "behavior", "demand", "forecast", "weather", "survey", "data collection")),
    ("Medical AI & patient communication",
     ("medical", "patient", "clinical", "healthcare", "checklist", "radiology")),
)
