"""Values other systems depend on: ids, filters and results are only right with exactly these."""

# Accented letters folded by the name normaliser, and what they become.
FOLD_FROM = "áàäâéèëêíìïîóòöôúùüûñ"
FOLD_TO = "aaaaeeeeiiiioooouuuun"

# Text patterns (ASCII word and space classes, as in a plain JVM pattern).
NON_WORDS = r"\W+"
SPACES = r"\s+"

# Fixed value: a parenthetical holding the whole word "take", with the blanks before it.
TAKE_PARENTHETICAL = r"(?i:\s*\([^)]*\btake\b[^)]*\))"

# Track-title cleaner, one (pattern, replacement) per step, applied in this order.
# Flags: i = ignore case, U = Unicode classes, d = only \n ends a line.
TITLE_STEPS = [
    (r"(?iUd)^(.*)(\s+-.*take.*)\n?$", "$1"),
    (r"(?iUd)^(.*)\s+-.*(\([^)]*orig[^)]*\))\s*$", "$1"),
    (r"(?iUd)^(.*)\s+(\([^)]*orig[^)]*\))\s*$", "$1"),
    (r"(?iUd)^\s*Band\s*#\d+\s*[:\-]?\s*", ""),
    (r"(?Ud)\s+\(?[A-Z]{1,3}\d{3,5}.*$", ""),
    (r"(?Ud)\s*-\s*\d{1,2}\s*$", ""),
    (r"(?iUd)^(.*?)\s*(\([^)]*\btake\b[^)]*\))\s*$", "$1"),
    (r"(?iUd)\s*(?:-|—)?\s*(?:New|Short|Orig(?:inal)?\.?|Only)\s+Take(?:\s*#?\s*\d+)?\s*$", ""),
    (r"""(?Ud)^\s*(["“”'])(.+)\1\s*$""", "$2"),
    (r"(?Ud)\s{2,}", " "),
    (r"(?Ud)^\s+|\s+$", ""),
]

# Fixed value: a title that stands for "no title".
NO_TITLE = "-"

# Disambiguation numbers on label and artist names.
LABEL_NUMBER = r"(?Ud)^(.*)\s+\(\d+\)$"
ARTIST_NUMBER = r"(?Ud)\s*\(\d+\)$"

# Format words that mark a single rather than an album.
SINGLE_FORMATS = ["45 rpm", "78 rpm", '7"', "7 inch"]

# Fixed value: ensemble credit of a compilation.
COMPILATION_CREDIT = "various"

# Fixed value: text printed for an empty list.
NOT_AVAILABLE = "(Not available)"

# Studied years, both inclusive, and the years a query may ask for.
FIRST_YEAR, LAST_YEAR = 1953, 1967
QUERY_YEAR_MIN, QUERY_YEAR_MAX = 1900, 2100

# Styles and whether they are studied.
STYLES = {
    "bop": True,
    "hard bop": True,
    "modal": True,
    "post bop": True,
    "cool jazz": True,
    "swing": False,
    "big band": False,
    "contemporary jazz": False,
    "vocal": False,
    "fusion": False,
    "jazz-funk": False,
    "soul-jazz": False,
    "latin jazz": False,
    "free improvisation": False,
    "free jazz": False,
    "smooth jazz": False,
    "bossa nova": False,
    "ballad": False,
    "avant-garde jazz": False,
}

# Label keys, canonical names and whether they are enabled.
LABELS = {
    "verve": ("Verve", False),
    "blue note": ("Blue Note", False),
    "riverside": ("Riverside", False),
    "columbia": ("Columbia", False),
    "prestige": ("Prestige", False),
    "atlantic": ("Atlantic", False),
    "impulse": ("Impulse!", False),
    "pacific": ("Pacific", False),
    "jazzland": ("Jazzland", False),
    "emarcy": ("EmArcy", False),
    "savoy": ("Savoy", False),
    "dial": ("Dial", False),
    "vee jay": ("Vee Jay", False),
    "capitol": ("Capitol", False),
    "roost": ("Roost", False),
    "norgran": ("Norgran", False),
    "argo": ("Argo", False),
    "moodsville": ("Moodsville", False),
    "clef": ("Clef", False),
    "mercury": ("Mercury", False),
    "new jazz": ("New Jazz", True),
    "fantasy": ("Fantasy", True),
}

# Role words of people who play.
PERFORMING_ROLES = [
    "saxophone", "alto saxophone", "tenor saxophone", "baritone saxophone",
    "soprano saxophone", "trumpet", "trombone", "flugelhorn", "cornet",
    "guitar", "piano", "bass", "double bass", "contrabass",
    "drums", "percussion", "vibraphone", "marimba", "xylophone",
    "cello", "violin", "viola", "flute", "clarinet", "oboe", "bassoon",
    "harmonica", "organ", "harp", "accordion",
    "vocals", "voice", "singer",
]

# Role words of people who do not play.
EXCLUDED_ROLES = [
    "recorded by", "recording engineer", "engineer", "assistant engineer",
    "mixed by", "mix engineer", "remix", "mastered by", "remaster", "remastered by",
    "edited by", "digital edit", "transfer", "audio restoration", "restoration",
    "lacquer cut by", "cut by", "producer", "executive producer", "compilation producer",
    "reissue producer", "production coordinator", "production manager", "coordinator",
    "a&r", "management", "booking", "legal", "public relations", "promotion",
    "supervised by", "supervision",
    "artwork", "art direction", "design", "graphic", "layout",
    "cover", "sleeve", "booklet", "insert", "typography", "calligraphy",
    "photography", "photo", "illustration", "printed by", "lithography",
    "liner notes", "notes", "essay by", "text by",
    "composed by", "written-by", "lyrics by", "lyricist", "words by",
    "music by", "score by", "theme by", "adapted by",
    "arranged by", "orchestrated by", "orchestration", "copyist",
    "music preparation", "transcribed by", "transcription",
    "reissue", "research", "archiv", "curation",
    "technician", "piano technician", "drum technician", "guitar technician",
    "instrument technician", "backline", "stage manager", "roadie",
    "pressed by", "manufactured by", "made by", "duplicated by", "distributed by",
    "orchestra", "ensemble", "band", "choir", "group", "a&r", "art direction",
    "coordination", "legacy", "reissue producer",
]

# Roles of an album credit.
LEADER, MUSICIAN = "leader", "musician"

# Fixed value: columns of a landed album record.
ALBUM_DDL = (
    "artists STRING, title STRING, id LONG, year STRING, label STRING, "
    "tracklist ARRAY<STRING>, musicians ARRAY<STRING>, leaders ARRAY<STRING>, "
    "style ARRAY<STRING>, cover_url STRING"
)
CORRUPT_COLUMN = "_corrupt"
# Partition columns of bronze: which ingest (checkpoint) a batch belongs to, and its number there.
INGEST_COLUMN = "_ingest_id"
BATCH_COLUMN = "_batch_id"

# Ingestion defaults.
MAX_FILES_PER_TRIGGER = 100
# The file source forgets files older than this, against the newest one seen: as good as never.
MAX_FILE_AGE = "36500d"
SINK_BATCH_ROWS = 1000
