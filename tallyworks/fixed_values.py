"""Word lists, maps, levels, patterns and column lists.

Results agree only if these are exactly as written, and the text rules only in
exactly this order.
"""

# --- meet results -----------------------------------------------------------

# Age classes, youngest first.
AGE_CLASSES = [
    "5-12", "13-15", "16-17", "18-19", "20-23", "24-34", "35-39", "40-44",
    "45-49", "50-54", "55-59", "60-64", "65-69", "70-74", "75-79", "80-999",
]

# Columns of the meet results.
ATTEMPT_COLUMNS = [
    "Squat1Kg", "Squat2Kg", "Squat3Kg",
    "Bench1Kg", "Bench2Kg", "Bench3Kg",
    "Deadlift1Kg", "Deadlift2Kg", "Deadlift3Kg",
]
BEST_LIFTS = {
    "SquatRatio": "Best3SquatKg",
    "BenchRatio": "Best3BenchKg",
    "DeadliftRatio": "Best3DeadliftKg",
}
UNUSED_RESULT_COLUMNS = [
    "State", "Country", "Age", "BirthYearClass", "MeetTown", "Dots",
    "Glossbrenner", "Goodlift", "MeetState", "Squat4Kg", "Bench4Kg", "Deadlift4Kg",
]
MEET_COLUMNS = ["MeetName", "MeetCountry", "Date", "Federation", "ParentFederation"]

# --- release decisions --------------------------------------------------------

# Accepted spellings, after trimming and lowering.
GENDERS = {"male": "Male", "female": "Female"}
RACES = {
    "black": "Black",
    "white": "White",
    "hispanic": "Hispanic",
    "hispanic/latin/mexican": "Hispanic",
} | dict.fromkeys(
    [
        "other asian", "asian", "chinese", "filipino", "cambodian",
        "pacific islander", "asian indian", "hawaiian", "vietnamese", "laotian",
        "korean", "japanese", "guamanian", "samoan",
    ],
    "Asian/Pacific Islander",
)
SCORE_LEVELS = ["0", "1", "2", "3", "4", "5+"]

# --- case notes ---------------------------------------------------------------

# What a missing field of a case note stands for.
NOTE_DEFAULTS = {
    "Gender": "Other/Unknown",
    "Race": "Other/Unknown",
    "Risk": "Not Assessed",
    "arrests_past_year": 0,
    "ProbationType": "Misdemeanor Probation",
    "DaysOnProbation": 0,
    "EpicsDosagePastYear": 0,
}

# Fixed values: (pattern, replacement) rules of the note cleaning, in order.
# Rules that could never apply, because an earlier one removed a character they
# need, are left out.
NOTE_CONTRACTIONS = [
    (r"(?<![\p{L}\p{N}_])[uU](?![\p{L}\p{N}_])", "you"),
    ("what's", "what is "),
    ("can't", "cannot "),
    ("i'm", "i am "),
    ("'ll", " will "),
    ("'scuse", " excuse "),
    ("[:|♣'§♠*/?=%&#•~^><►_]", " "),
]
NOTE_ABBREVIATIONS = [
    (" ct ", " court "),
    (" cort ", " court "),
    (" crt ", " court "),
    ("ov ", "office visit "),
    ("ovwd", "office visit with defendant "),
    ("hv ", "home visit "),
    ("h v ", " home visit "),
    (" jl ", " jail "),
    (" ltr ", " letter "),
    (" vm ", " voicemail "),
    (" msg ", " message "),
    ("lm ", " left message "),
    ("l m ", " left message "),
    ("vm ", " voicemail "),
    ("v m ", " voicemail "),
    (" bw ", " bench warrant "),
    (" vop ", " violation of probation "),
    (" returbnd ", " returned "),
    (" comp ", " completed "),
    (" att ", " attempted "),
    ("att ", "attempted "),
    ("recvd ", " received "),
    ("recv ", " received "),
    ("t c ", " call "),
    ("tc ", " call "),
    (" thru ", " through "),
    (" rpt ", " report "),
    (" rptd ", " reported "),
    (" wdef ", " with defendant "),
    (" d ", " defendant "),
    ("def ", " defendant "),
    ("def[^\\n] ", " defendant "),
    (" presemt ", " present "),
    (" yr ", " year "),
]
NOTE_OUTCOME_PHRASES = [
    "death", "passed away", "deceased", "closed", "file close", "terminated",
    "convicted", "conviction", "sentenced", "prison sentence", "jail sentence",
]
NOTE_TIDYING = [
    (r"(?U)[\s\x1c-\x1f]+", " "),
    (r"(.)\1+", "$1$1"),
    (r"([a-zA-Z]+)([/!?.])([a-zA-Z]+)", "$1 $2 $3"),
    (" s ", " "),
    (r"([*!?']+)", " $1 "),
    (r"[ ]{2,}", " "),
]

# Limits of the note vocabulary and models.
MIN_DOCUMENTS = 2
MAX_DOCUMENT_SHARE = 0.5
MAX_TERMS = 15_000
LONGEST_NGRAM = 4
NEIGHBOURS = 5
TEST_SHARE = 0.3
FOREST_TREES = 500
RIDGE_PENALTY = 1.0

# --- quotes -------------------------------------------------------------------

# Columns kept of a quote snapshot, and their names in the table.
QUOTE_COLUMNS = {
    "id": "CoinID",
    "name": "Name",
    "symbol": "Symbol",
    "circulating_supply": "Circulating_Supply",
    "total_supply": "Total_Supply",
    "cmc_rank": "CMC_Rank",
    "quote_USD_price": "Quote_USD_Price",
    "quote_USD_volume_24h": "Quote_USD_Volume_24h",
    "timestamp": "API_TimeStamp",
}
