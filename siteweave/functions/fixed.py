"""Results depend on these exact words, codes and formats."""

# Company chain.
EXCLUDED_INDUSTRY = "automotive"
BLOCKED_HOSTS = ("facebook", "linkedin", "wordpress", "instagram")
HTTP_ERROR = "HTTP Error"
REQUEST_ERROR = "Request Error"
VIEW_COUNTRY = "US"

# Game type codes.
GAME_TYPES = {
    0: "main_game",
    1: "dlc_addon",
    2: "expansion",
    3: "bundle",
    4: "standalone_expansion",
    5: "mod",
    6: "episode",
    7: "season",
    8: "remake",
    9: "remaster",
    10: "expanded_game",
    11: "port",
    12: "fork",
    13: "pack",
    14: "update",
}

# Sizes.
TOP_GAMES = 10
STREAMS_PER_TOP_GAME = 5
STREAMS_PER_SIMILAR_GAME = 3
SITE_TEXT_CHARS = 2000
SAMPLE_ROWS = 10
THUMB_WIDTH = 150
THUMB_HEIGHT = 200

# Colours of the graph page, in the order they are handed out.
PALETTE = (
    "#FF5733",
    "#33FF57",
    "#3357FF",
    "#FF33A1",
    "#A133FF",
    "#33FFF3",
    "#FFD133",
    "#FF3333",
    "#75FF33",
    "#FF8F33",
)

# Prompts, one slot each.
COMPANY_PROMPT = "Give me a 500 character summary about the %s game company."
SITE_PROMPT = "Summarize this webpage in 300 max characters:\n%s"
PERSONA_PROMPT = (
    "Please parse the raw text of this company's website and define a buying persona out of it %s?"
)

# Answers of the game -> company -> website lookup when a stage has nothing.
NO_GAME = "Game not found."
NO_COMPANIES = "No company information available."
NO_INVOLVEMENT = "Company ID not found."
NO_COMPANY_ID = "Company details missing."
NO_WEBSITE = "Company website not found."

# Token patterns of the schema text.
LABEL_TOKEN = r":([A-Z][A-Za-z0-9_]*)"
REL_TOKEN = r"-\[:([A-Z_][A-Za-z0-9_]*)\]-"
PROPERTY_TOKEN = r"\.([a-zA-Z_][A-Za-z0-9_]*)"

# Node labels and relationship types.
GAME = "Game"
CATALOG_ID = "Catalog_ID"
STREAM = "Stream"
RELEASE_YEAR = "Release_Year"
FRANCHISE = "Franchise"
GAME_TYPE = "GameType"
GENRE = "Genre"
COMPANY = "Company"
WEBSITE = "Website"
SUMMARY = "Summary"
COMPANY_SUMMARY = "AI_Company_Summary"
AVERAGE_VIEWS = "Average_View_Count"
COUNTRY = "Country"
PRODUCT = "Product"

# The property that a node's key is, by label.
KEY_PROPERTY = {
    GAME: "catalog_id",
    CATALOG_ID: "id",
    STREAM: "id",
    RELEASE_YEAR: "year",
    FRANCHISE: "id",
    GAME_TYPE: "id",
    GENRE: "id",
    COMPANY: "id",
    WEBSITE: "url",
    COMPANY_SUMMARY: "summary",
    AVERAGE_VIEWS: "value",
    COUNTRY: "code",
    PRODUCT: "name",
}

HAS_CATALOG_ID = "HAS_CATALOG_ID"
HAS_STREAM = "HAS_STREAM"
RELEASED_IN = "RELEASED_IN"
PART_OF_FRANCHISE = "PART_OF_FRANCHISE"
HAS_TYPE = "HAS_TYPE"
SIMILAR_TO = "SIMILAR_TO"
HAS_GENRE = "HAS_GENRE"
INVOLVES_COMPANY = "INVOLVES_COMPANY"
HAS_AVERAGE_VIEW_COUNT = "HAS_AVERAGE_VIEW_COUNT"
HAS_WEBSITE = "HAS_WEBSITE"
HAS_SUMMARY = "HAS_SUMMARY"
LOCATED_IN = "LOCATED_IN"
SELLS = "SELLS"
