"""URL filter: list rules by host and path, and a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.common import ascii_lower

# Terms of the vocabulary. One strict term rejects a URL, soft ones by their number.
STRICT = ("porn", "xxx", "hentai", "escort", "camgirl", "gangbang", "bdsm", "warez", "viagra", "casino")
SOFT = (
    "sex", "adult", "nude", "hot", "dating", "poker", "bet", "betting", "gambling", "loan", "pills", "crack", "keygen",
    "torrent", "hack", "milf", "fetish", "lingerie",
)

# (verdict, rule): a rule is a host and the beginning of a path.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


class Vocabulary:
    """Strict and soft terms in one automaton. A hit counts where no ASCII letter or digit touches it."""

    def __init__(self, strict, soft):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, terms in ((0, soft), (1, strict)):
            for term in terms:
                self.automaton.add_word(term.lower(), (kind, term.lower()))
        self.automaton.make_automaton()

    @staticmethod
    def _inside(text: str, i: int) -> bool:
        return 0 <= i < len(text) and text[i].isascii() and text[i].isalnum()

    def hits(self, text: str) -> tuple[int, int]:
        """Numbers of distinct strict and soft terms in a lower-cased text."""
        found = {
            hit
            for end, hit in self.automaton.iter(text)
            if not self._inside(text, end + 1) and not self._inside(text, end - len(hit[1]))
        }
        strict = sum(kind for kind, _ in found)
        return strict, len(found) - strict


_vocabularies: dict[tuple, Vocabulary] = {}


def vocabulary(strict: tuple, soft: tuple) -> Vocabulary:
    if (strict, soft) not in _vocabularies:
        _vocabularies[strict, soft] = Vocabulary(strict, soft)
    return _vocabularies[strict, soft]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The lower-cased host behind the first ``://`` and the path behind it; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return tuple(F.coalesce(c, F.lit("")) for c in (ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)))


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, max_soft: int = 2) -> DataFrame:
    """page_id, host, path, rule, verdict, and the distinct ``strict_hits`` and ``soft_hits`` of every url.

    The longest rule whose host is the url's or a parent of it and whose path begins the url's decides. Without one, a url
    with a strict term or ``max_soft`` distinct soft terms is blocked, any other allowed. The url is compared as it stands,
    A-Z lower-cased, without percent decoding. NULL urls and urls without ``://`` have empty host and path; a NULL url has
    no hits and is allowed. ``rules`` and terms are configuration (a few thousand at most, held by each worker). Repeated
    rows are judged one by one; other columns are ignored; an empty table gives no rows.
    """
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("strict int, soft int")
    def hits(urls: pd.Series) -> pd.DataFrame:
        found = vocabulary(strict, soft)
        return pd.DataFrame([found.hits(u) for u in urls], columns=["strict", "soft"], dtype="int32")

    host, path = host_and_path(F.col("url"))
    judged = pages.select(
        "page_id", host.alias("host"), path.alias("path"), hits(F.coalesce(ascii_lower(F.col("url")), F.lit(""))).alias("hits")
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = (F.col("host") == name) | F.col("host").endswith("." + name)
        fits &= F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    rejected = (F.col("hits.strict") > 0) | (F.col("hits.soft") >= max_soft)
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"),
    )


def _matches(term: str) -> str:
    letters = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_matches({letters}, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INT"


SQL = rf"""
WITH split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
         ({' + '.join(map(_matches, STRICT))})::INT AS strict_hits,
         ({' + '.join(map(_matches, SOFT))})::INT AS soft_hits
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN strict_hits > 0 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM ruled"""
