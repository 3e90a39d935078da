"""Configuration data whose content defines the results."""

# Names of the model's input columns, in the order of the feature vector.
FEATURES = [
    "url_length",
    "url_depth",
    "title_length",
    "text_length",
    "text_density",
    "has_date_pattern_in_url",
    "xpath_depth",
    "xpath_contains_article",
    "xpath_contains_main_content",
    "xpath_contains_story",
    "is_article_in_category",
]

# A date in the path of a URL.
DATE_PATH = r"(?U)/\d{4}/\d{2}/\d{2}/"

# Characters of text and of title that an article has more than.
ARTICLE_TEXT_CHARS, ARTICLE_TITLE_CHARS = 150, 10

# Least characters of a text node of the fallback, and what makes it look like code.
FALLBACK_NODE_CHARS = 20
CODE_LIKE = r"(?isU)[{};]|\b(?:var|function|script)\b"

# Characters that a block of text costs, what a character of a link counts against it, and what a block
# in an article counts more than its characters.
BLOCK_CHARS, LINK_WEIGHT, ARTICLE_BONUS = 30, 3, 200

# Name of the total row of the reports.
TOTAL = "TOTAL PIPELINE PERFORMANCE"

# A line holding one of these phrases is boilerplate on every site.
BOILERPLATE_PHRASES = ["Ακολουθήστε μας", "Follow us", "Διαβάστε ακόμη"]

# Hrefs with these beginnings are no page links.
SKIPPED_HREF_PREFIXES = ["javascript", "mailto", "#"]

# Parts of an href that mark an article link anywhere on a page.
ARTICLE_HREF_PARTS = ["/article", "/story", "/news"]

# Default title of a stored article.
NO_TITLE = "No Title"

# The effect of each storage status, as shown in the efficiency report.
STATUS_IMPACT = {
    "NEW": "Dataset Expansion.",
    "UNCHANGED": "Storage & I/O Optimization.",
    "UPDATED": "Content Freshness Maintenance.",
}

# Initial site registry (domain, start_url, active, priority).
SEED_SITES = [
    ("protothema.gr", "https://www.protothema.gr", True, 10),
    ("newsit.gr", "https://www.newsit.gr", True, 9),
    ("news247.gr", "https://www.news247.gr", True, 8),
    ("iefimerida.gr", "https://www.iefimerida.gr", True, 7),
    ("naftemporiki.gr", "https://www.naftemporiki.gr", True, 6),
    ("efsyn.gr", "https://www.efsyn.gr", True, 5),
    ("in.gr", "https://www.in.gr", True, 4),
    ("kathimerini.gr", "https://www.kathimerini.gr", True, 3),
    ("tanea.gr", "https://www.tanea.gr", True, 2),
    ("tovima.gr", "https://www.tovima.gr", True, 1),
    ("cnn.gr", "https://www.cnn.gr", True, 10),
    ("skai.gr", "https://www.skai.gr", True, 10),
    ("newsbeast.gr", "https://www.newsbeast.gr", True, 10),
    ("newsbomb.gr", "https://www.newsbomb.gr", True, 10),
    ("capital.gr", "https://www.capital.gr", True, 10),
    ("huffingtonpost.gr", "https://www.huffingtonpost.gr", True, 10),
    ("documentonews.gr", "https://www.documentonews.gr", True, 10),
    ("ertnews.gr", "https://www.ertnews.gr", True, 7),
    ("forbesgreece.gr", "https://www.forbesgreece.gr", True, 5),
    ("athensvoice.gr", "https://www.athensvoice.gr", True, 5),
    ("gazzetta.gr", "https://www.gazzetta.gr", True, 7),
]

# URL keywords of category pages, by topic.
CATEGORY_KEYWORDS = {
    "sports": [
        "sports", "sport", "football", "basketball", "game", "coach", "player", "goal",
        "ποδόσφαιρο", "μπάσκετ", "αγώνας", "προπονητής", "αθλητής", "γκόλ",
    ],
    "politics": [
        "politiki", "politics", "government", "election", "parliament", "minister",
        "κυβέρνηση", "υπουργός", "εκλογές", "βουλή",
    ],
    "technology": [
        "technology", "tech", "gadget", "app", "computer", "smartphone",
        "εφαρμογή", "τεχνολογία", "υπολογιστής", "koinwnia", "politiki",
    ],
    "economy": ["oikonomia", "economy", "market", "agores", "χρηματιστήριο"],
    "health": ["ygeia", "health", "diatrofi", "iatriki", "υγεία", "διατροφή"],
    "culture": [
        "politismos", "culture", "tehni", "vivlio", "μουσική", "κινηματογράφος", "θέατρο",
    ],
    "life": ["zoi", "life", "gynaika", "lifestyle", "συνταγή", "σχέσεις"],
    "world": ["kosmos", "world", "international", "κόσμος"],
    "local": ["ellada", "local", "athina", "thessaloniki", "Κρήτη", "Πειραιάς", "Λάρισα"],
}
GENERAL_CATEGORY_KEYWORDS = ["category", "categories"]

# A URL holding one of these is not followed.
IRRELEVANT_KEYWORDS = [
    "widget", "inview/intalks", "inview/bulletin", "privacy", "advertising", "terms",
    "tavtotita", "elamefora", "inview/inshorts", "contact", "login", "subscribe", "about",
    "print", "pdf", "amp", "tag", "author", "404", "search", "rss", "tel", "fax", "admin",
    "help",
]

# Ordered removal patterns per site.
SITE_RULES = [
    {
        "domain": "athensvoice.gr",
        "patterns": [
            r"(\s*-\s*CITY GUIDE\s*-\s*PODCAST\s*-\s*\d+°\s*)",
            r"(\s*ΤΑ ΠΙΟ ΔΗΜΟΦΙΛΗ\s*ΔΕΙΤΕ ΕΠΙΣΗΣ.*)",
            r"(\s*Έχετε δει \d+ από \d+ άρθρα\.\s*)",
        ],
    },
    {
        "domain": "protothema.gr",
        "patterns": [r"(\[IMPROVED LOGGING\] - [\s\S]*)"],
    },
    {
        "domain": "in.gr",
        "patterns": [
            r"(\s*Πηγή: .*\s*)",
            r"(\s*Δείτε επίσης: .*\s*)",
            r"(\n\s*-\s*.*)+",
            r"(\n\s*(Daily\s+)?Headlines[\s\S]*)",
            r"(\s*Ακολουθήστε το in\.gr στο Google News.*)",
        ],
    },
    {
        "domain": "tovima.gr",
        "patterns": [r"(\s*Διαβάστε περισσότερα\s*)", r"(\s*© ΤΟ ΒΗΜΑ.*)"],
    },
]
