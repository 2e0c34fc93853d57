"""Values that decide results and therefore must not drift."""

# --- fixed values: cleansing -------------------------------------------------
LINE_BREAKS = r"[\r\n\t]+"
SPACES = r"\s+"
LATEX_MATH = r"\$.*?\$"
MATH_TOKEN = " [MATH] "
LATEX_COMMAND_WITH_ARGUMENT = r"\\[a-zA-Z]+\{[^}]*\}"
LATEX_COMMAND = r"\\[a-zA-Z]+"
CONTROL_CHARACTERS = r"[\x00-\x1F\x7F]"
URL_PREFIX = "https://arxiv.org/abs/"

# --- fixed values: feed ------------------------------------------------------
FEED_URL_PREFIX = "https://arxiv.org/"
GUID_ID = r"arXiv\.org:([A-Za-z.-]+/\d+(?:v\d+)?|[\w.-]+)"
LINK_ID = r"/abs/([A-Za-z.-]+/\d+(?:v\d+)?|[\w.-]+)"
ID_VERSION = r"v\d+$"
ABSTRACT_HEADER = r"^arXiv:.*?\bAbstract:\s*"
MARKUP_TAG = r"<[^>]+>"
MAX_CATEGORIES_CHARS = 255

# --- fixed values: quality gate ----------------------------------------------
MIN_ABSTRACT_CHARS = 20
MAX_ID_CHARS = 64
BACKFILL_ERROR_LIMIT = 0.01
DAILY_ERROR_LIMIT = 0.10
EMBEDDING_DIM = 384

# --- fixed values: retrieval -------------------------------------------------
RRF_K = 60
MISSING_RANK = 999
CANDIDATES = 20
SEARCH_LIMIT = 5
MAX_SEARCH_LIMIT = 50
ASK_LIMIT = 3
BM25_K1 = 1.2
BM25_B = 0.75

# --- fixed values: enrichment ------------------------------------------------
METADATA_FIELDS = ("core_method", "dataset_used", "key_findings")
NOT_SPECIFIED = "Not specified"
EXTRACTION_ERROR = "Extraction Error"
METADATA_BATCH_ROWS = 50
EMBEDDING_BATCH_ROWS = 200
TEXT_SEPARATOR = ". "
RESPONSE_FENCES = ("```json", "```")
RESPONSE_LEADING_COMMA = r"^\{\s*,\s*"
RESPONSE_WIDEST_OBJECT = r"\{.*\}"
RESPONSE_FIELD = r'"{field}"\s*:\s*"(.*?)(?:"\s*[,}}]|$)'

# --- fixed values: context ---------------------------------------------------
NO_MATCH_CONTEXT = "No specific matching papers found in the local database."
DEFAULT_MODEL_TAG = "gemini-3.7-flash"
MODEL_MAP = {
    "gpt-4o-mini": "openai/gpt-4o-mini",
    "gpt-4o": "openai/gpt-4o",
    "DeepSeek-V3": "deepseek/deepseek-chat",
    "Claude-3.5": "anthropic/claude-3.5-sonnet",
    "gemini-3.7-flash": "google/gemini-3.7-flash",
}

# --- fixed values: English stop words of the public Snowball list -------------
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now"
).split()
