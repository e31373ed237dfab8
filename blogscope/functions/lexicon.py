"""Word lists and lookup tables.

FIXED VALUES. Everything in this module is data, not logic: values that have to
be exactly these for results to line up with the behaviour being reproduced
(segment names, placeholder texts, entity replacements, the fallback taxonomy),
plus small hand-written word lists (stop words, month names) used by the
set-oriented replacements of the NLP-library steps.
"""

from __future__ import annotations

# --- demographic segments (names as they appear in the reports) -------------
SEGMENT_MALE = "Male"
SEGMENT_FEMALE = "Female"
SEGMENT_AGE_LE20 = "Age <=20"
SEGMENT_AGE_GT20 = "Age >20"
SEGMENT_STUDENTS = "Students"
SEGMENT_NON_STUDENTS = "Non-Students"
SEGMENT_EVERYONE = "Everyone"

AGE_LE20 = "<=20"
AGE_GT20 = ">20"
STUDENT_INDUSTRY = "Student"

# --- placeholders of the top-2 summaries -----------------------------------
NO_SECOND_CATEGORY = "No second category"
NO_CATEGORIES = "No categories found"
NO_SECOND_TOPIC = "No second topic"
NO_TOPICS = "No topics found"
UNKNOWN_TOPIC_LABEL = "unknown_topic"

# --- content clean-up (order matters) ---------------------------------------
CONTENT_LITERAL_REPLACEMENTS = [
    ("urlLink", ""),
    ("nbsp", ""),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&ndash;", "-"),
    ("&mdash;", "-"),
]

HTML_ENTITY_REPLACEMENTS = [
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&ndash;", "-"),
    ("&mdash;", "-"),
]

# The five XML entities decoded after tag extraction (&amp; last).
XML_ENTITY_REPLACEMENTS = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&amp;", "&"),
]

# --- fallback taxonomy: 8 majors x 4 subtopics, in this order ---------------
FALLBACK_TAXONOMY = {
    "automotive": ["cars", "trucks", "vehicles", "driving"],
    "business": ["finance", "work", "career", "money"],
    "entertainment": ["movies", "music", "tv", "games"],
    "food": ["cooking", "recipes", "restaurants", "dining"],
    "health": ["fitness", "nutrition", "medical", "wellness"],
    "sports": ["football", "basketball", "soccer", "athletics"],
    "technology": ["computers", "internet", "software", "tech"],
    "travel": ["vacation", "tourism", "destinations", "trips"],
}

# --- English stop words (token filters of the frequency and topic paths) ----
ENGLISH_STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "also", "am",
    "an", "and", "any", "are", "as", "at", "be", "because", "been", "before",
    "being", "below", "between", "both", "but", "by", "can", "could", "did",
    "do", "does", "doing", "down", "during", "each", "even", "ever", "every",
    "few", "for", "from", "further", "had", "has", "have", "having", "he",
    "her", "here", "hers", "herself", "him", "himself", "his", "how", "however",
    "i", "if", "in", "into", "is", "it", "its", "itself", "just", "least",
    "less", "may", "me", "might", "more", "most", "much", "must", "my",
    "myself", "neither", "no", "nor", "not", "now", "of", "off", "often", "on",
    "once", "only", "or", "other", "our", "ours", "ourselves", "out", "over",
    "own", "same", "she", "should", "since", "so", "some", "still", "such",
    "than", "that", "the", "their", "theirs", "them", "themselves", "then",
    "there", "these", "they", "this", "those", "though", "through", "thus",
    "to", "too", "under", "until", "up", "upon", "us", "very", "was", "we",
    "were", "what", "when", "where", "whether", "which", "while", "who",
    "whom", "whose", "why", "will", "with", "within", "without", "would",
    "yet", "you", "your", "yours", "yourself", "yourselves",
]

# --- language vote: function words per language ------------------------------
LANGUAGE_STOP_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu",
           "von", "mit", "für", "auf", "den", "dem", "sich", "auch", "es",
           "im", "wie", "sie", "ich", "aus", "bei", "oder"],
    "en": ["the", "and", "of", "to", "is", "was", "with", "for", "that",
           "this", "by", "as", "on", "it", "are", "from", "be", "at", "have",
           "not", "or", "which", "an", "were", "but"],
    "es": ["el", "los", "las", "del", "y", "para", "por", "con", "una",
           "es", "se", "lo", "su", "como", "pero", "muy", "sin", "sobre",
           "este", "esta", "al", "son", "más", "ya", "fue"],
    "fr": ["le", "les", "des", "du", "et", "une", "qui", "pour", "dans",
           "au", "aux", "est", "elle", "il", "sur", "pas", "ce", "avec",
           "sont", "mais", "ou", "nous", "vous", "leur", "cette"],
}

# --- month names for the day-first date parser ------------------------------
MONTH_NAMES = {
    "en": ["january", "february", "march", "april", "may", "june", "july",
           "august", "september", "october", "november", "december"],
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet",
           "août", "septembre", "octobre", "novembre", "décembre"],
    "de": ["januar", "februar", "märz", "april", "mai", "juni", "juli",
           "august", "september", "oktober", "november", "dezember"],
    "es": ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
           "agosto", "septiembre", "octubre", "noviembre", "diciembre"],
}

# FIXED VALUES: plural endings and what they become, longest first when applied; None protects
# the ending.
NOUN_SUFFIX_RULES = {
    "s": "", "ses": "s", "xes": "x", "zes": "z", "ches": "ch", "shes": "sh", "men": "man", "ies": "y", "ves": "f",
    "ss": None, "us": None, "is": None,
}

# FIXED VALUES: irregular plurals.
IRREGULAR_PLURALS = {
    "children": "child", "feet": "foot", "teeth": "tooth", "geese": "goose", "mice": "mouse", "lice": "louse",
    "oxen": "ox", "wives": "wife", "lives": "life", "knives": "knife", "criteria": "criterion",
    "phenomena": "phenomenon", "indices": "index", "analyses": "analysis", "crises": "crisis", "theses": "thesis",
}
