"""Features of ad text and the parsing of generated copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .numbers import as_column, round_half_up

# Keyword lists and their order decide the results.
MENTION_WORDS = ["free", "new", "now", "today", "limited", "exclusive", "guaranteed", "proven"]
REAL_ESTATE_WORDS = ["property", "real estate", "investment", "portfolio"]
DATA_WORDS = ["data", "analytics", "insights", "intelligence"]
PROFESSIONAL_WORDS = ["professional", "expert", "certified", "qualified"]
URGENCY_WORDS = ["now", "today", "limited", "hurry", "quick", "fast"]
SOCIAL_PROOF_WORDS = ["trusted", "proven", "award", "leader", "top"]
CTA_WORDS = [
    ("learn_more", ["learn more", "discover", "find out", "explore"]),
    ("get_started", ["get started", "start now", "begin", "try now"]),
    ("download", ["download", "get your", "claim"]),
    ("contact", ["contact us", "reach out", "talk to", "speak with"]),
    ("register", ["register", "sign up", "join", "subscribe"]),
    ("buy", ["buy", "purchase", "order", "get yours"]),
    ("demo", ["demo", "see it", "watch", "view"]),
    ("quote", ["quote", "estimate", "pricing"]),
]

# Patterns with Unicode meaning: blanks are all Unicode blanks and the four separators 1C-1F.
WORD = r"(?U)[\S&&[^\x1C-\x1F]]++"
SENTENCE_END = r"[.!?]+"
DIGIT = r"\p{Nd}"
UPPERCASE = r"\p{IsUppercase}"
CAPITALS = r"[A-Z][A-Z]"
ALL_CAPS_WORD = r"(^|[^\p{L}\p{N}_])[A-Z]{2,}($|[^\p{L}\p{N}_])"

HEADLINE_LIMIT = 70
DESCRIPTION_LIMIT = 150

COPY_SCHEMA = "array<struct<headline:string,description:string,cta:string,angle:string>>"


def contains_any(lowered: Column, words) -> Column:
    found = lowered.contains(words[0])
    for word in words[1:]:
        found = found | lowered.contains(word)
    return found


def cta_type(lowered: Column) -> Column:
    """First class, in list order, one of whose phrases occurs."""
    name, words = CTA_WORDS[0]
    chain = F.when(contains_any(lowered, words), name)
    for name, words in CTA_WORDS[1:]:
        chain = chain.when(contains_any(lowered, words), name)
    return chain.otherwise("other")


def combined_text(headline, description) -> Column:
    """Headline, a blank, description; a missing half counts as empty."""
    empty = F.lit("")
    return F.concat(F.coalesce(as_column(headline), empty), F.lit(" "), F.coalesce(as_column(description), empty))


def text_features(text, lowered=None) -> dict[str, Column]:
    """The 25 features, keyed by column name; all NULL for missing or empty text.

    ``text`` must be NULL where empty and ``lowered`` its lower case; ``add_text_features`` supplies
    both as columns.
    """
    t = as_column(text)
    low = F.lower(t) if lowered is None else as_column(lowered)
    features = {
        "word_count": F.regexp_count(t, F.lit(WORD)),
        "char_count": F.length(t),
        "sentence_count": F.regexp_count(t, F.lit(SENTENCE_END)) + F.lit(1),
        "has_numbers": t.rlike(DIGIT),
        "has_percent": t.contains("%"),
        "has_dollar": t.contains("$"),
        "has_question": t.contains("?"),
        "has_exclamation": t.contains("!"),
        # More bytes than characters: some character is not ASCII.
        "has_emoji": F.octet_length(t) != F.length(t),
        "uppercase_ratio": F.regexp_count(t, F.lit(UPPERCASE)).cast("double") / F.length(t),
        # The cheap pattern first; most text has no two capitals in a row.
        "has_all_caps_word": t.rlike(CAPITALS) & t.rlike(ALL_CAPS_WORD),
    }
    for word in MENTION_WORDS:
        features[f"mention_{word}"] = low.contains(word)
    features["mention_real_estate"] = contains_any(low, REAL_ESTATE_WORDS)
    features["mention_data"] = contains_any(low, DATA_WORDS)
    features["mention_professional"] = contains_any(low, PROFESSIONAL_WORDS)
    features["cta_type"] = F.when(t.isNotNull(), cta_type(low))
    features["has_urgency"] = contains_any(low, URGENCY_WORDS)
    features["has_social_proof"] = contains_any(low, SOCIAL_PROOF_WORDS)
    return features


FEATURE_NAMES = (
    ["word_count", "char_count", "sentence_count"]
    + ["has_numbers", "has_percent", "has_dollar", "has_question", "has_exclamation", "has_emoji"]
    + ["uppercase_ratio", "has_all_caps_word"]
    + [f"mention_{w}" for w in MENTION_WORDS]
    + ["mention_real_estate", "mention_data", "mention_professional"]
    + ["cta_type", "has_urgency", "has_social_proof"]
)

# The earlier, smaller feature set.
BASIC_FEATURE_NAMES = [
    "word_count", "char_count", "has_numbers", "has_percent", "has_dollar", "has_question", "has_exclamation",
    "mention_free", "mention_new", "mention_now", "mention_today", "mention_data", "mention_exclusive",
    "uppercase_ratio",
]


def _with_text(df: DataFrame, text) -> DataFrame:
    """Adds the text (NULL where empty) and its lower case as columns.

    Features refer to these columns: an expression repeated in every branch of a CASE would be
    computed again in each.
    """
    t = F.nullif(as_column(text), F.lit(""))
    return df.withColumns({"_text": t, "_lower": F.lower(t)})


def add_text_features(df: DataFrame, text: str, names=None) -> DataFrame:
    features = text_features("_text", "_lower")
    return _with_text(df, text).withColumns({n: features[n] for n in (names or FEATURE_NAMES)}).drop("_text", "_lower")


def add_basic_features(df: DataFrame, text: str) -> DataFrame:
    """14 features; here ``mention_data`` is the single word, and empty text has counts and ratio 0."""
    features = text_features("_text", "_lower")
    features["mention_data"] = F.col("_lower").contains("data")
    zero = {"word_count": 0, "char_count": 0, "uppercase_ratio": 0.0}
    empty = as_column(text) == ""
    columns = {n: F.when(empty, F.lit(zero.get(n, False))).otherwise(features[n]) for n in BASIC_FEATURE_NAMES}
    return _with_text(df, text).withColumns(columns).drop("_text", "_lower")


def money(x) -> Column:
    """Two decimals as text; rounded first so every engine prints the same digits."""
    return F.format_string("%.2f", round_half_up(x, 2))


def thousands(x) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(as_column(x), 0)


def unfence(response) -> Column:
    """Text between the first pair of code fences (``json`` fence first), else the whole text."""
    r = as_column(response)
    tagged = F.regexp_extract(r, r"(?s)```json(.*?)```", 1)
    plain = F.regexp_extract(r, r"(?s)```(.*?)```", 1)
    return F.trim(F.when(r.contains("```json"), tagged).when(r.contains("```"), plain).otherwise(r))


def parse_copy(df: DataFrame, response: str) -> DataFrame:
    """One row per generated variation; a response that is no JSON array gives no rows."""
    others = [c for c in df.columns if c != response]
    items = F.from_json(unfence(response), COPY_SCHEMA)
    rows = df.select(*others, F.posexplode(items).alias("position", "item"))
    return rows.select(
        *others,
        "position",
        "item.*",
        (F.length("item.headline") <= HEADLINE_LIMIT).alias("headline_fits"),
        (F.length("item.description") <= DESCRIPTION_LIMIT).alias("description_fits"),
    )
