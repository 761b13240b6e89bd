"""Fixed values. Results depend on these exact lists, names and limits."""

# --- column names and orders (fixed values) ---------------------------------

ID_COL = "Spotify_ID"
TITLE_COL = "Track_Name"
PEOPLE_COL = "Artist"
TEXT_COL = "Lyrics"
URL_COL = "Preview_Audio_URL"

FEATURE_COLS = [
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "duration_ms", "time_signature",
]
INT_FEATURES = ["key", "mode", "time_signature"]
FLOAT_FEATURES = [c for c in FEATURE_COLS if c not in INT_FEATURES]

PRIORITY_COLS = [
    "Spotify_ID", "Track_Name", "Artist", "Lyrics", "Popularity",
    "Duration_MS", "Preview_Audio_URL", "Release_Date",
]

RENAMES = {
    "name": "Track_Name",
    "popularity": "Popularity",
    "duration_ms": "Duration_MS",
    "preview_url": "Preview_Audio_URL",
    "album.release_date": "Release_Date",
}

# --- whitespace (fixed values): every character a text is stripped of ---------

WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- missing values (fixed values): what a CSV reader takes for "no value" ---

MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

NO_TEXT = "No Lyrics"
UNKNOWN = "Unknown"
UNKNOWN_LANGUAGE = "unknown"
NOTE_MARK = "♪"

# --- compilation titles (fixed values) --------------------------------------

COMPILATION_KEYWORDS = [
    "liên khúc", "lien khuc",
    "mashup", "mash up", "mash-up",
    "medley",
    "lk ", " lk", "[lk]", "(lk)", "lk.", "lk-",
    "nonstop", "non-stop", "non stop",
    "megamix", "mega mix",
    "mixtape", "mix tape",
    "live set", "dj set", "djset",
    "vietmix", "viet mix", "club mix",
    "vina house nonstop", "vinahouse nonstop",
    " mix ",
    "tuyển tập", "tuyen tap",
    "tổng hợp", "tong hop",
    "chọn lọc", "chon loc",
    "the best of", "best of",
    "greatest hits", "collection",
    "những bài hát", "nhung bai hat",
    "những ca khúc", "nhung ca khuc",
    "ca khúc hay nhất", "ca khuc hay nhat",
    "tuyệt phẩm", "tuyet pham",
    "đỉnh cao", "dinh cao",
    "để đời", "de doi",
    "full album", "album full",
    "trọn bộ", "tron bo",
    "cd1", "cd 1", "cd2", "cd 2", "full cd",
    "nhạc sống", "nhac song",
    "kẹo kéo", "keo keo",
]

# A line that holds only a bracketed title. Flags: m = per line, d = only \n
# ends a line, U = Unicode blanks.
MARKER_LINE = r"(?mdU)^\s*[(\[【].*?[)\]】]\s*$"
MIN_MARKER_LINES = 3
MAX_TEXT_CHARS = 6000

# --- text features (fixed values) -------------------------------------------

# Letters carrying tone class 1, 2, 3, 4, 5; every other letter is class 0.
TONE_LETTERS = [
    "àằầèềìòồờùừỳ",
    "áắấéếíóốớúứý",
    "ảẳẩẻểỉỏổởủửỷ",
    "ãẵẫẽễĩõỗỡũữỹ",
    "ạặậẹệịọộợụựỵ",
]
# Class 4 as older encodings have it, without "ễ".
LEGACY_TONE_4 = "ãẵẫẽĩõỗỡũữỹ"

PAD_ID = 0
UNKNOWN_ID = 1
FIRST_TOKEN_ID = 2
ENCODED_LENGTH = 200
MIN_TOKEN_FREQ = 2

# --- two-axis classes (fixed values) ----------------------------------------

AXIS_CUT = 0.5
QUADRANT_NAMES = {
    0: "Buồn - Êm dịu (Low V, Low E)",
    1: "Căng - Sôi động (Low V, High E)",
    2: "Vui - Êm dịu (High V, Low E)",
    3: "Vui - Sôi động (High V, High E)",
}
BAR_LENGTH = 20
DOMINANT_PCT = 40.0
SCARCE_PCT = 10.0

# --- fetch log statuses (fixed values) --------------------------------------

STATUS_SUCCESS = "[THÀNH CÔNG]"
STATUS_SKIP = "[BỎ QUA ĐÃ TẢI]"
STATUS_HTTP_ERROR = "[LỖI HTTP]"
STATUS_NETWORK_ERROR = "[LỖI MẠNG]"

# --- asset files, sampling and evaluation (fixed values) --------------------

ASSET_EXTENSIONS = [".mp3", ".wav", ".ogg", ".flac"]
SMOOTH_EPS = 0.05
L1_WEIGHT = 0.1
MIXUP_ALPHA = 0.4
FOLDS = 5
SEED = 42
SCALE_EPS = 1e-6
DB_FLOOR = 1e-10
DB_RANGE = 80.0
FRAME_FLOOR = 1024
FRAME_HOPS = 4
