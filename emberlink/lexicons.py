"""Word lists and search grids.

Fixed values: keywords, place names, search cells, topic names and limits have to be
exactly these for results to agree, so they are stated as plain text.
"""

from __future__ import annotations

WILDFIRE = "wildfire"
LANDSLIDE = "landslide"

# ---- news search (batch) ----------------------------------------------------------------
NEWSAPI_TYPES = {
    WILDFIRE: [
        "Waldbrand", "Vegetationsbrand", "Flächenbrand", "Buschbrand", "Großbrand",
        "Feuer", "brennt", "Brandherd", "Löscheinsatz", "Feuerwehr", "Flammen", "Brandopfer",
        "Funkenflug", "Evakuierung", "Löschflugzeug", "Feueralarm", "Löscharbeiten",
        "wildfire", "forest fire", "bushfire", "firefighting", "burning",
    ],
    LANDSLIDE: [
        "Erdrutsch", "Hangrutschung", "Bergsturz", "Murenabgang", "Schlammlawine",
        "Hangbewegung", "Gerölllawine", "Hangrutsch", "Erdrutsche", "Lawine", "Felssturz",
        "landslide", "rockfall", "mudslide", "debris flow", "mass movement",
    ],
}
NEWSAPI_PLACES = ["Germany", "Deutschland", "Switzerland", "Schweiz", "Blatten", "Valais"]
NEWSAPI_LANGUAGES = ["de", "en"]

# ---- relief feed ------------------------------------------------------------------------
RELIEFWEB_TYPES = {
    WILDFIRE: [
        "wildfire", "forest fire", "bushfire", "vegetation fire", "Waldbrand", "Buschbrand",
        "Feuer", "Flammen",
    ],
    LANDSLIDE: [
        "landslide", "mudslide", "debris flow", "rockfall", "Erdrutsch", "Schlammlawine",
        "Bergsturz", "Murenabgang",
    ],
}
RELIEFWEB_PLACES = [
    "Germany", "Deutschland", "Switzerland", "Schweiz", "Blatten", "Wallis", "Bern", "Valais",
    "Europe", "Alps", "Central Europe",
]

# ---- forum posts ------------------------------------------------------------------------
REDDIT_KEYWORDS = [
    "Waldbrand", "Flächenbrand", "Vegetationsbrand", "Feuer", "Brand", "Löschflugzeug",
    "wildfire", "forest fire", "landslide", "Erdrutsch", "mudslide", "Bergsturz", "rockfall",
]
REDDIT_SUBREDDITS = ["germany", "de", "switzerland", "europe", "natureisfuckinglit", "news"]
REDDIT_STREAM_TYPES = {
    WILDFIRE: [
        "Waldbrand", "Vegetationsbrand", "Flächenbrand", "Buschbrand", "Feuer", "Brand",
        "Löschflugzeug", "Flammen", "fire", "wildfire", "forest fire",
    ],
    LANDSLIDE: [
        "Erdrutsch", "Hangrutschung", "Bergsturz", "Schlammlawine", "Felssturz",
        "landslide", "mudslide", "rockfall", "debris flow",
    ],
}

# ---- relevance scoring ------------------------------------------------------------------
RELEVANCE_FIRE = [
    "Waldbrand", "Vegetationsbrand", "Flächenbrand", "Buschbrand", "Großbrand",
    "Feuer", "brennt", "Brandherd", "Löscheinsatz", "Feuerwehr", "Flammen", "Brandopfer",
    "Funkenflug", "Evakuierung", "Löschflugzeug", "Feueralarm", "Löscharbeiten",
]
RELEVANCE_PLACES = [
    "wald", "forst", "berg", "naturpark", "landkreis", "gebirge", "täler", "alpen",
    "schwarzwald", "bayern", "brandenburg", "niedersachsen", "rheinland", "sachsen", "thüringen",
    "mecklenburg", "hessen", "pfalz", "saarland", "hamburg", "berlin", "bremen",
]
PRIORITY_PLACES = ["Blatten", "Wallis", "Valais"]

# ---- search grids: keyword x country x language per source ------------------------------
GNEWS_GRID = {
    "types": {WILDFIRE: ["wildfire", "Waldbrand"], LANDSLIDE: ["landslide", "Erdrutsch"]},
    "countries": ["Germany", "Switzerland"],
    "languages": ["en", "de"],
}
GNEWS_STREAM_GRID = {
    "types": {
        None: [
            "wildfire", "landslide", "Waldbrand", "Erdrutsch", "Flächenbrand", "Bergsturz",
            "Valais", "Blatten",
        ]
    },
    "countries": ["Germany", "Switzerland", "Deutschland", "Schweiz"],
    "languages": ["en", "de"],
}
GOOGLE_RSS_GRID = {
    "types": {WILDFIRE: ["wildfire", "Waldbrand"], LANDSLIDE: ["landslide", "Erdrutsch"]},
    "countries": ["Germany", "Deutschland", "Switzerland", "Schweiz"],
    "languages": ["en", "de"],
}
GOOGLE_RSS_STREAM_QUERIES = [
    "wildfire Germany", "wildfire Switzerland", "Waldbrand Deutschland", "Waldbrand Schweiz",
    "landslide Germany", "landslide Switzerland", "Erdrutsch Deutschland", "Erdrutsch Schweiz",
]
MEDIASTACK_GRID = {
    "types": {
        WILDFIRE: [
            "Waldbrand", "Vegetationsbrand", "Flächenbrand", "wildfire", "forest fire", "Feuer",
        ],
        LANDSLIDE: ["Erdrutsch", "Hangrutsch", "landslide", "mudslide", "rockfall", "Bergsturz"],
    },
    "countries": ["DE", "CH"],
    "languages": ["en", "de"],
}
MEDIASTACK_STREAM_GRID = {
    "types": {
        None: ["Waldbrand", "Vegetationsbrand", "Flächenbrand", "Feuer", "Erdrutsch", "landslide"]
    },
    "countries": ["de", "ch"],
    "languages": ["en", "de"],
}
NEWSAPI_STREAM_TERMS = ["wildfire", "Waldbrand", "landslide", "Erdrutsch"]
GDACS_TITLE_TERMS = ["landslide"]

# ---- limits -----------------------------------------------------------------------------
POSTS_PER_SUBREDDIT = 100
RESULTS_PER_SEARCH = 50
REDDIT_DAYS = 10
RELIEFWEB_DAYS = 14
HAZARD_DAYS = 30
GNEWS_DAYS = 5
NEWSAPI_STREAM_DAYS = 3
NEWS_WINDOW_DAYS = 5
SEMANTIC_THRESHOLD = 0.4
LINK_MIN_SEMANTIC = 0.2
LINK_DAYS = 2
LINK_KM = 50.0
LINK_DAY_WEIGHT = 10.0

# ---- topics -----------------------------------------------------------------------------
TOPICS = {
    "gnews": "gnews_articles",
    "google_rss": "google_rss_articles",
    "mediastack": "mediastack_articles",
    "newsapi": "newsapi_articles",
    "reddit": "reddit_articles",
}
