"""Word tables for the invented text of the test corpus; a deployment passes its own tables instead."""

from __future__ import annotations

from opinara.functions.lexicon import SentimentLexicon, TopicTable

SENTIMENT_ENTRIES = (
    ("thing", "pos", "strong"),
    ("sur", "pos", "strong"),
    ("von", "pos", "strong"),
    ("ther", "pos", "moderate"),
    ("est", "pos", "moderate"),
    ("pour", "pos", "moderate"),
    ("then", "pos", "moderate"),
    ("sur", "pos", "moderate"),
    ("than", "pos", "moderate"),
    ("erin", "neg", "strong"),
    ("das", "neg", "strong"),
    ("dans", "neg", "strong"),
    ("thin", "neg", "moderate"),
    ("los", "neg", "moderate"),
    ("mit", "neg", "moderate"),
    ("qui", "neg", "moderate"),
    ("eren", "neg", "moderate"),
    ("für", "neg", "moderate"),
    ("than", "neg", "moderate"),
)

# A topic's list joins its French and English keywords; a keyword of both languages stands twice.
TOPIC_KEYWORDS = {
    "finance": ("thble", "eaupa", "kei", "thble", "tionre"),
    "politique": ("heit", "auxe", "ouelle", "ntst", "edre"),
    "sport": ("iere", "tour", "rain", "orth", "thatth", "eerst", "hathe"),
    "meteo": ("acion", "wind", "reath"),
    "sante": ("lich", "mente", "ungen", "hand", "anter", "gol"),
    "culture": ("xylophone", "vernissage"),
}

# Stand-ins for watch keywords, crisis and event patterns (title substrings per theme).
WATCH_KEYWORDS = ("thble", "heit", "èai")
THEME_STEMS = {"financier": ("financ", "thbl", "eaup"), "rare": ("xyloph",)}
CRISIS_PATTERNS = {
    "floods": ("iere", "orth"),
    "heat": ("auxe", "kei"),
    "health": ("lich", "hand", "mente"),
    "safety": ("ntst", "thatth"),
    "climate": ("heit",),
}
EVENT_PATTERNS = {"cup": ("hathe", "tour"), "games": ("iere", "thatth")}

LEXICON = SentimentLexicon.from_entries(SENTIMENT_ENTRIES)
TOPICS = TopicTable(TOPIC_KEYWORDS)

# Large tables for the same text, made by rule from the syllables it is built of: 806 keywords in 19 topics, 800 words.
SYLLABLES = "th er on an re he in ed nd ha at en es or nt ea ti to it st io le is ou ar as de rt ve ch ung eau".split()
PAIRS = [a + b for a in SYLLABLES for b in SYLLABLES if a != b]
LARGE_TOPICS = TopicTable({f"topic{t:02d}": tuple(PAIRS[t:806:19]) for t in range(19)})
LARGE_LEXICON = SentimentLexicon.from_entries(
    (word, ("pos", "neg")[i % 2], ("strong", "moderate")[i // 2 % 2]) for i, word in enumerate([*SYLLABLES, *PAIRS][:800])
)
