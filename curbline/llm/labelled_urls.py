"""A small labelled URL table: what the URL model learns from when no other table is given.

Blocked hosts are built from the vocabulary of unwanted sites (pharmacy spam, gambling, adult, link farms, trackers,
malware, scams), allowed ones from the vocabulary of ordinary sites; both get the same mix of subdomains, endings and
paths, so that only the words tell them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: words of unwanted and of ordinary host names
UNWANTED = ["online-casino", "casino-bonus", "jackpot-slots", "poker-room", "sports-betting", "bet-now", "betting-odds",
            "lottery-winner", "roulette-king", "discount-pharmacy", "pills-online", "viagra-shop", "weight-loss-pills",
            "no-prescription-meds", "adult-cams", "adult-dating", "xxx-videos", "porn-tube", "sex-chat", "escort-girls",
            "spam-links", "link-exchange", "buy-backlinks", "article-spinner", "ad-tracker", "ads-server", "banner-ads",
            "popup-ads", "click-track", "tracking-pixel", "malware-host", "phishing-login", "account-verify-now", "free-gift-cards",
            "win-prize", "claim-reward", "payday-loans", "quick-cash", "crypto-doubler", "replica-watches", "get-rich-fast",
            "hot-singles", "casino-games", "casino-vip", "win-cash-now", "spam-mailer", "bulk-spam", "adult-shop",
            "adult-movies", "link-network", "warez-crack", "keygen-download", "cheap-cigarettes", "free-ringtones", "work-from-home-cash"]
ORDINARY = ["news", "library", "university", "museum", "weather", "cooking", "garden", "history", "science", "travel",
            "music", "school", "hospital", "city-council", "railway", "theatre", "books", "research", "language", "health",
            "forum", "wiki", "photography", "football", "cycling", "astronomy", "geology", "recipes", "painting",
            "software", "parish", "college", "orchestra", "gazette", "observer", "chronicle", "journal", "institute", "academy",
            "archive", "gallery", "bakery", "brewery", "vineyard", "farmhouse", "village", "harbour", "island", "mountain",
            "river-trust", "birdwatch", "gardening", "knitting", "woodwork", "chess-club", "rowing", "hiking", "camping",
            "architecture", "engineering", "mathematics", "physics", "chemistry", "biology", "medicine", "nursing",
            "law-review", "parliament", "embassy", "tourism", "airport", "bus-timetable", "post-office", "bank", "insurance",
            "furniture-maker", "bookshop", "toy-store", "market-hall", "restaurant", "hotel", "kitchen", "family-tree",
            "genealogy", "folklore", "poetry", "novels", "grammar", "dictionary", "encyclopedia", "podcast", "radio",
            "television", "cinema", "festival", "charity", "volunteers", "church", "monastery", "climate", "energy",
            "recycling", "forestry", "fishing", "veterinary", "open-source", "compiler", "database", "network", "robotics"]
_PREFIXES = ["", "www.", "blog.", "m."]
_ENDINGS = ["example.com", "example.org", "example.net"]
_PATHS = ["/en/{n}", "/de/{n}.html", "/fr/{n}?page=2&ref=x", "/es/{n}/", "/en/{n}#top", "", "/de/{n}?utm_source=feed"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """Columns ``url`` and ``verdict``: two urls of each word."""
    rows = []
    for verdict, words in (("block", UNWANTED), ("allow", ORDINARY)):
        for k, word in enumerate(words):
            for turn in (k, k + len(words) + 1):
                path = _PATHS[turn % len(_PATHS)].format(n=7 * turn + 11)
                rows.append((f"http{'s' * (turn % 2)}://{_PREFIXES[turn % 4]}{word}.{_ENDINGS[turn % 3]}{path}", verdict))
    return spark.createDataFrame(rows, "url string, verdict string")
