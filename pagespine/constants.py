"""Names and numbers shared by every step."""

# They decide the results and must not change.
HEADING_KEYWORDS = ("introduction", "overview", "methodology", "appendix")
KEYWORD_TRIM = "•*: "
UNKNOWN_STYLE = ("Unknown", 0.0)
DEFAULT_CENTERING_OFFSET = 999.0
UNTITLED = "Untitled Document"
HEADING_LEVELS = ("H1", "H2", "H3")
RANKED_LABELS = ("Title", "H1", "H2", "H3", "Body")
FIRST_ON_PAGE_SPACE = 100.0
STAGES = ("parsing", "build_vectors", "cluster_and_label", "generate_outline")

# Defaults that a caller may override.
N_CLUSTERS = 5
MIN_BLOCKS = 10
STD_THRESHOLD = 0.5
UNIQUE_THRESHOLD = 2
PUNCTUATION_SHARE = 0.8
TITLE_WORDS = 25
REPEAT_PAGES = 2
MAX_HEADING_WORDS = 15

# How work is split, never what comes out of it. A bucket of a document spans
# PAGES_PER_BUCKET pages and, on each of them, BLOCKS_PER_BUCKET blocks.
LINES_PER_STRETCH = 4096
PAGES_PER_BUCKET = 256
BLOCKS_PER_BUCKET = 4096
BLOCKS_PER_TASK = 20000
BROADCAST_DOCUMENTS = 10000  # names only
BROADCAST_BYTES = 8 << 20
