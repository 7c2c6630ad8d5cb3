"""DuckDB SQL that checks the registered queries, written against the driver's tables.

Each statement is put together from named sub-queries; ``sql(body, *names)`` prefixes those needed.
"""

from __future__ import annotations

from datetime import date, timedelta

from .functions import text as tx
from .operators.alarms import Alarm
from .settings import AS_OF
from .sources.tables import CTA_PHRASES


# Character classes written out, because \s, \d and \b differ between regex engines.
WORD = r"[^\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
SENTENCE_END = r"[.!?]+"
DIGIT = r"\p{Nd}"
NON_ASCII = r"[^\x{0}-\x{7F}]"
UPPERCASE = (
    r"[\p{Lu}\x{2160}-\x{216F}\x{24B6}-\x{24CF}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}]"
)
ALL_CAPS_WORD = r"(^|[^\p{L}\p{N}_])[A-Z]{2,}($|[^\p{L}\p{N}_])"


def hu(x: str, digits: int = 2) -> str:
    """Half-up rounding of a double."""
    s = f"{10**digits}::DOUBLE"
    return f"floor(({x}) * {s} + 0.5) / {s}"


def ratio(n: str, d: str, scale: float = 1.0, digits: int | None = 2) -> str:
    num = f"CAST({n} AS DOUBLE)" + (f" * {scale}::DOUBLE" if scale != 1.0 else "")
    q = f"{num} / NULLIF(CAST({d} AS DOUBLE), 0)"
    return q if digits is None else hu(q, digits)


def pct(n: str, d: str, digits: int | None = 2) -> str:
    return ratio(n, d, 100.0, digits)


def avg(x: str, digits: int = 2) -> str:
    """Mean of values with a fixed number of decimals, free of summation order."""
    s = f"{10**digits}::DOUBLE"
    units = f"CAST(floor(({x}) * {s} + 0.5) AS BIGINT)"
    return f"(CAST(SUM({units}) AS DOUBLE) / NULLIF(COUNT({x}) * {s}, 0))"


def isum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def usd(x: str) -> str:
    return f"printf('%.2f', {hu(x)})"


def days(n: int, column: str = "report_date", as_of: date = AS_OF) -> str:
    return f"{column} BETWEEN DATE '{as_of - timedelta(days=n)}' AND DATE '{as_of}'"


def _elements(creative: str) -> str:
    clicks = "CASE WHEN l_quantity > 2 THEN CAST(l_quantity AS BIGINT) * (4 + l_partkey % 50) ELSE 0 END"
    price = "(8 + (l_partkey % 50 * 7) % 40 + round(l_discount * 100))"
    return f"""
  SELECT CAST(l_shipdate AS DATE) AS report_date,
         l_shipdate + to_hours(CAST(((l_linenumber - 1) % 4) * 6 AS BIGINT)) AS pulled_ts,
         'cmp_' || (l_suppkey % 10) AS campaign_id,
         'Campaign ' || (l_suppkey % 10) AS campaign_name,
         CASE WHEN l_suppkey % 10 < 8 THEN 'ACTIVE' ELSE 'PAUSED' END AS campaign_status,
         CAST(5000 * (1 + l_suppkey % 5) AS DOUBLE) AS daily_budget,
         CAST(4 + l_suppkey % 10 AS DOUBLE) AS unit_cost,
         'cr_' || ({creative}) AS creative_id,
         CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN 0
              ELSE CAST(l_quantity * 1000 AS BIGINT) END AS impressions,
         {clicks} AS clicks,
         CAST(({clicks}) * {price} AS DOUBLE) / 4 AS cost,
         CASE WHEN l_quantity > 2 THEN CAST(floor(({clicks}) * round(l_tax * 100) / 100) AS BIGINT) ELSE 0 END AS conversions,
         CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(floor(l_quantity * 1000 * 4 / 5) AS BIGINT) END AS unique_impressions
  FROM lineitem"""


def _cp(source: str) -> str:
    return f"""
  SELECT report_date, campaign_id, creative_id, total_impressions, total_clicks, total_cost, total_conversions, unique_impressions,
         {pct('total_clicks', 'total_impressions')} AS ctr_percent,
         {ratio('total_cost', 'total_clicks')} AS avg_cpc,
         {ratio('total_cost', 'total_conversions')} AS cost_per_conversion,
         {pct('total_conversions', 'total_clicks')} AS conversion_rate_percent
  FROM (SELECT report_date, campaign_id, creative_id,
               {isum('impressions')} AS total_impressions, {isum('clicks')} AS total_clicks, SUM(cost) AS total_cost,
               {isum('conversions')} AS total_conversions, {isum('unique_impressions')} AS unique_impressions
        FROM {source} WHERE impressions IS NOT NULL GROUP BY 1, 2, 3)"""


_PHRASE = "CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(CTA_PHRASES)) + " END"


def any_of(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def text_columns(t: str, names=None) -> str:
    """Select list of the text features of expression ``t`` (NULL or empty gives NULL)."""
    v = f"NULLIF({t}, '')"
    low = f"lower({v})"

    def count(pattern: str) -> str:
        return f"CAST(len(regexp_extract_all({v}, '{pattern}')) AS INTEGER)"

    cta = " ".join(f"WHEN {any_of(low, words)} THEN '{name}'" for name, words in tx.CTA_WORDS)
    cols = {
        "word_count": count(WORD),
        "char_count": f"CAST(length({v}) AS INTEGER)",
        "sentence_count": count(SENTENCE_END) + " + 1",
        "has_numbers": f"regexp_matches({v}, '{DIGIT}')",
        "has_percent": f"contains({v}, '%')",
        "has_dollar": f"contains({v}, '$')",
        "has_question": f"contains({v}, '?')",
        "has_exclamation": f"contains({v}, '!')",
        "has_emoji": f"regexp_matches({v}, '{NON_ASCII}')",
        "uppercase_ratio": f"CAST({count(UPPERCASE)} AS DOUBLE) / length({v})",
        "has_all_caps_word": f"regexp_matches({v}, '{ALL_CAPS_WORD}')",
    }
    for w in tx.MENTION_WORDS:
        cols[f"mention_{w}"] = f"contains({low}, '{w}')"
    cols["mention_real_estate"] = any_of(low, tx.REAL_ESTATE_WORDS)
    cols["mention_data"] = any_of(low, tx.DATA_WORDS)
    cols["mention_professional"] = any_of(low, tx.PROFESSIONAL_WORDS)
    cols["cta_type"] = f"CASE WHEN {v} IS NULL THEN NULL {cta} ELSE 'other' END"
    cols["has_urgency"] = any_of(low, tx.URGENCY_WORDS)
    cols["has_social_proof"] = any_of(low, tx.SOCIAL_PROOF_WORDS)
    return ", ".join(f"{cols[n]} AS {n}" for n in (names or cols))


def _optimal_bid(ctr: str, rate: str, cpc: str) -> str:
    scaled = f"{cpc} * greatest(0.5::DOUBLE, least(2.0::DOUBLE, 2.0::DOUBLE / NULLIF({ctr}, 0)))"
    limited = f"CASE WHEN {rate} > 0 THEN least({scaled}, 100.0::DOUBLE * {rate} / 100.0::DOUBLE) ELSE {scaled} END"
    bid = hu(f"greatest(1.0::DOUBLE, least(20.0::DOUBLE, {limited}))")
    return f"CASE WHEN {ctr} IS NULL OR {cpc} IS NULL OR {ctr} = 0 THEN {cpc} ELSE {bid} END"


def _heuristic_bid(ctr: str, cpc: str) -> str:
    scaled = f"{cpc} * (2.0::DOUBLE / NULLIF({ctr}, 0))"
    limited = f"greatest({cpc} * 0.7::DOUBLE, least({cpc} * 1.5::DOUBLE, {scaled}))"
    bid = hu(f"greatest(1.0::DOUBLE, least(15.0::DOUBLE, {limited}))")
    return (
        f"CASE WHEN {ctr} = 0 THEN {cpc} WHEN {ctr} IS NULL OR {cpc} IS NULL THEN NULL ELSE {bid} END"
    )


def perf_sql(as_of: date = AS_OF, n: int = 7) -> str:
    return f"""
  SELECT creative_id, campaign_id, {avg('ctr_percent')} AS avg_ctr, {avg('avg_cpc')} AS avg_cpc,
         {isum('total_clicks')} AS total_clicks, {isum('total_impressions')} AS total_impressions,
         SUM(total_cost) AS total_cost, {isum('total_conversions')} AS total_conversions,
         COUNT(DISTINCT report_date) AS days_active
  FROM cp WHERE {days(n, as_of=as_of)} GROUP BY 1, 2 HAVING SUM(total_clicks) >= 100"""


def bids_sql(perf: str) -> str:
    return f"""
  SELECT campaign_id, avg_ctr, old_bid, total_cost, new_bid, new_bid - old_bid AS change
  FROM (SELECT campaign_id, avg_ctr, avg_cpc AS old_bid, total_cost, {_heuristic_bid('avg_ctr', 'avg_cpc')} AS new_bid
        FROM (SELECT campaign_id, {avg('avg_ctr', 6)} AS avg_ctr, {avg('avg_cpc', 6)} AS avg_cpc, SUM(total_cost) AS total_cost
              FROM {perf} GROUP BY 1))"""


_SIMPLE_SUMS = f"{isum('impressions')} AS impressions, {isum('clicks')} AS clicks, SUM(cost) AS cost"

# name -> (sub-query, names it needs)
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "el": (_elements("l_partkey % 50"), ()),
    "elp": (_elements("l_partkey"), ()),
    "cp": (_cp("el"), ("el",)),
    "cpp": (_cp("elp"), ("elp",)),
    "ds": (
        f"""
  SELECT *, {pct('clicks', 'impressions')} AS ctr, {ratio('cost', 'clicks')} AS cpc,
         {ratio('cost', 'conversions')} AS cpa, {pct('conversions', 'clicks')} AS conversion_rate
  FROM (SELECT report_date, campaign_id, campaign_name, campaign_status, daily_budget, unit_cost, {_SIMPLE_SUMS},
               {isum('conversions')} AS conversions, {isum('unique_impressions')} AS unique_impressions
        FROM el WHERE impressions IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6)""",
        ("el",),
    ),
    "totals": (
        f"""
  SELECT *, {pct('total_clicks', 'total_impressions')} AS overall_ctr, {ratio('total_cost', 'total_clicks')} AS overall_cpc,
         {ratio('total_cost', 'total_conversions')} AS overall_cpa,
         {pct('total_conversions', 'total_clicks')} AS overall_conversion_rate
  FROM (SELECT campaign_id, campaign_name, MIN(report_date) AS first_seen, MAX(report_date) AS last_seen,
               COUNT(DISTINCT report_date) AS days_active, {isum('impressions')} AS total_impressions,
               {isum('clicks')} AS total_clicks, SUM(cost) AS total_cost, {isum('conversions')} AS total_conversions
        FROM el WHERE impressions IS NOT NULL GROUP BY 1, 2)""",
        ("el",),
    ),
    "docs": (
        "SELECT DISTINCT report_date, campaign_id, pulled_ts, strftime(pulled_ts, '%Y-%m-%dT%H:%M:%S.%f') AS pulled_at FROM el",
        ("el",),
    ),
    "perf": (perf_sql(), ("cp",)),
    "classified": (
        f"""
  SELECT *, CASE WHEN avg_ctr < 1.0 AND total_clicks >= 100 THEN 'paused' WHEN avg_cpc > 8.0 THEN 'paused'
                 WHEN avg_ctr > 3.0 THEN 'top_performer' END AS action,
         CASE WHEN avg_ctr < 1.0 AND total_clicks >= 100 THEN 'Low CTR (' || {usd('avg_ctr')} || '%) below threshold'
              WHEN avg_cpc > 8.0 THEN 'High CPC ($' || {usd('avg_cpc')} || ') above threshold'
              WHEN avg_ctr > 3.0 THEN 'High CTR (' || {usd('avg_ctr')} || '%) - candidate for scaling' END AS reason,
         CASE WHEN avg_ctr < 1.0 AND total_clicks >= 100 THEN avg_ctr WHEN avg_cpc > 8.0 THEN NULL
              WHEN avg_ctr > 3.0 THEN avg_ctr END AS metric_ctr,
         CASE WHEN avg_ctr < 1.0 AND total_clicks >= 100 THEN NULL WHEN avg_cpc > 8.0 THEN avg_cpc END AS metric_cpc
  FROM perf""",
        ("perf",),
    ),
    "acts": ("SELECT * FROM classified WHERE action IS NOT NULL", ("classified",)),
    "bids": (bids_sql("perf"), ("perf",)),
    "bidacts": (
        f"SELECT *, 'Bid optimization: $' || {usd('old_bid')} || ' → $' || {usd('new_bid')} AS reason FROM bids WHERE abs(change) >= 0.5",
        ("bids",),
    ),
    "summary": (
        f"""SELECT COALESCE({isum('total_impressions')}, 0) AS total_impressions, COALESCE({isum('total_clicks')}, 0) AS total_clicks,
         COALESCE(SUM(total_cost), 0.0) AS total_cost, {avg('avg_ctr', 6)} AS avg_ctr, {avg('avg_cpc', 6)} AS avg_cpc FROM perf""",
        ("perf",),
    ),
    "counts": (
        """SELECT a.total + b.n AS total_actions, a.paused, b.n AS bid_adjustments, a.top AS top_performers
  FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (action = 'paused') AS paused, COUNT(*) FILTER (action = 'top_performer') AS top FROM acts) a,
       (SELECT COUNT(*) AS n FROM bidacts) b""",
        ("acts", "bidacts"),
    ),
    "health": (
        """SELECT COUNT(*) AS total_creatives, COUNT(*) - COUNT(*) FILTER (action = 'paused') AS active_creatives,
         COUNT(*) FILTER (avg_ctr > 3.0) AS high_performers, COUNT(*) FILTER (avg_ctr < 1.0) AS underperformers FROM classified""",
        ("classified",),
    ),
    "content": (
        f"""
  SELECT 'cr_' || n AS creative_id, p_name AS headline, p_brand || ' ' || p_type || ' ' || phrase AS description, phrase AS cta,
         p_name || ' ' || p_brand || ' ' || p_type || ' ' || phrase AS combined_text
  FROM (SELECT *, p_partkey % 50 AS n, {_PHRASE} AS phrase,
               row_number() OVER (PARTITION BY p_partkey % 50 ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
        (),
    ),
    "contentp": (
        f"""
  SELECT 'cr_' || p_partkey AS creative_id, p_name AS headline, p_brand || ' ' || p_type || ' ' || {_PHRASE} AS description,
         {_PHRASE} AS cta, p_name || ' ' || p_brand || ' ' || p_type || ' ' || {_PHRASE} AS combined_text FROM part""",
        (),
    ),
    "cbase": (
        f"""
  SELECT creative_id, {avg('ctr_percent')} AS avg_ctr, {avg('avg_cpc')} AS avg_cpc, {isum('total_impressions')} AS total_impressions,
         {isum('total_clicks')} AS total_clicks, SUM(total_cost) AS total_cost, {isum('total_conversions')} AS total_conversions,
         {avg('conversion_rate_percent')} AS avg_conversion_rate, COUNT(DISTINCT report_date) AS days_active
  FROM cpp WHERE {days(60)} GROUP BY 1 HAVING SUM(total_impressions) > 100""",
        ("cpp",),
    ),
    "cset": (
        f"""
  SELECT b.*, COALESCE(headline, '') AS headline, COALESCE(description, '') AS description, COALESCE(cta, '') AS cta,
         COALESCE(combined_text, '') AS creative_text, {text_columns("COALESCE(combined_text, '')")},
         {AS_OF.month} AS month, {AS_OF.weekday()} AS day_of_week
  FROM cbase b LEFT JOIN contentp USING (creative_id)""",
        ("cbase", "contentp"),
    ),
    "bbase": (
        f"""
  SELECT campaign_id, hour_of_day, day_of_week, {avg('ctr')} AS avg_ctr, {avg('cpc')} AS avg_cpc,
         {avg('conversion_rate')} AS avg_conversion_rate, {isum('impressions')} AS total_impressions,
         {isum('clicks')} AS total_clicks, SUM(cost) AS total_cost
  FROM (SELECT *, {pct('clicks', 'impressions')} AS ctr, {ratio('cost', 'clicks')} AS cpc, {pct('conversions', 'clicks')} AS conversion_rate
        FROM (SELECT campaign_id, CAST(extract(hour FROM pulled_ts) AS INTEGER) AS hour_of_day,
                     CAST(extract(dow FROM pulled_ts) AS INTEGER) AS day_of_week, report_date, {_SIMPLE_SUMS},
                     {isum('conversions')} AS conversions
              FROM el WHERE impressions IS NOT NULL AND {days(30)} GROUP BY 1, 2, 3, 4))
  GROUP BY 1, 2, 3 HAVING SUM(impressions) > 10""",
        ("el",),
    ),
    "bset": (
        f"""
  SELECT *, CASE WHEN day_of_week IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour_of_day BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
         CASE WHEN hour_of_day BETWEEN 10 AND 14 THEN 1 ELSE 0 END AS is_peak_hours,
         {_optimal_bid('avg_ctr', 'avg_conversion_rate', 'avg_cpc')} AS optimal_bid
  FROM bbase""",
        ("bbase",),
    ),
    "weekly": (
        f"""
  SELECT *, {ratio('cost', 'clicks')} AS cpc, {pct('clicks', 'impressions')} AS ctr, {ratio('cost', 'conversions')} AS cpa
  FROM (SELECT CAST(date_trunc('week', report_date) AS DATE) AS week_start, campaign_id, {isum('total_impressions')} AS impressions,
               {isum('total_clicks')} AS clicks, SUM(total_cost) AS cost, {isum('total_conversions')} AS conversions,
               {avg('ctr_percent')} AS avg_ctr, {avg('avg_cpc')} AS avg_cpc
        FROM cp WHERE {days(180)} GROUP BY 1, 2)""",
        ("cp",),
    ),
    "allweeks": (
        f"""
  SELECT *, {ratio('cost', 'clicks')} AS cpc, {pct('clicks', 'impressions')} AS ctr, {ratio('cost', 'conversions')} AS cpa
  FROM (SELECT CAST(date_trunc('week', report_date) AS DATE) AS week_start, campaign_id, {isum('total_impressions')} AS impressions,
               {isum('total_clicks')} AS clicks, SUM(total_cost) AS cost, {isum('total_conversions')} AS conversions,
               {avg('ctr_percent')} AS avg_ctr, {avg('avg_cpc')} AS avg_cpc
        FROM cp GROUP BY 1, 2)""",
        ("cp",),
    ),
    "daily": (
        f"""
  SELECT report_date, campaign_id, COUNT(DISTINCT creative_id) AS total_creatives, {isum('total_impressions')} AS impressions,
         {isum('total_clicks')} AS clicks, SUM(total_cost) AS cost, {isum('total_conversions')} AS conversions,
         {avg('ctr_percent')} AS avg_ctr, {avg('avg_cpc')} AS avg_cpc, {avg('cost_per_conversion')} AS avg_cpa
  FROM cp WHERE {days(90)} GROUP BY 1, 2""",
        ("cp",),
    ),
    "meta": (
        f"""
  SELECT *, CASE WHEN avg_ctr >= 3 THEN 'high' WHEN avg_ctr >= 1.5 THEN 'medium' WHEN avg_ctr >= 0.5 THEN 'low' ELSE 'very_low' END AS performance_category
  FROM (SELECT creative_id, campaign_id, {isum('total_impressions')} AS lifetime_impressions, {isum('total_clicks')} AS lifetime_clicks,
               SUM(total_cost) AS lifetime_cost, {isum('total_conversions')} AS lifetime_conversions, {avg('ctr_percent')} AS avg_ctr,
               {avg('avg_cpc')} AS avg_cpc, MIN(report_date) AS first_seen, MAX(report_date) AS last_seen,
               COUNT(DISTINCT report_date) AS days_active FROM cp GROUP BY 1, 2)""",
        ("cp",),
    ),
    "winners": (
        f"""
  SELECT creative_id, campaign_id, {avg('ctr_percent')} AS avg_ctr, {avg('avg_cpc')} AS avg_cpc, {isum('total_clicks')} AS total_clicks,
         {isum('total_conversions')} AS total_conversions
  FROM cp WHERE {days(30)} AND ctr_percent >= 3.0 GROUP BY 1, 2 HAVING SUM(total_clicks) > 100
  ORDER BY avg_ctr DESC NULLS LAST, creative_id, campaign_id LIMIT 10""",
        ("cp",),
    ),
    "runs": (
        f"""
  SELECT pulled_ts AS ts, CAST(impressions AS DOUBLE) AS impressions, CAST(clicks AS DOUBLE) AS clicks, cost, CAST(pulls AS DOUBLE) AS pulls,
         {pct('clicks', 'impressions', None)} AS ctr, {ratio('cost', 'clicks', digits=None)} AS cpc
  FROM (SELECT pulled_ts, COALESCE({isum('impressions')}, 0) AS impressions, COALESCE({isum('clicks')}, 0) AS clicks,
               COALESCE(SUM(cost), 0.0) AS cost, COUNT(DISTINCT campaign_id) AS pulls FROM el GROUP BY 1)""",
        ("el",),
    ),
    "runmetrics": (
        """
  SELECT ts, name, unit, value FROM (
    SELECT ts, 'TotalImpressions' AS name, 'Count' AS unit, impressions AS value FROM runs
    UNION ALL SELECT ts, 'TotalClicks', 'Count', clicks FROM runs
    UNION ALL SELECT ts, 'TotalCost', 'None', cost FROM runs
    UNION ALL SELECT ts, 'CTR', 'Percent', ctr FROM runs
    UNION ALL SELECT ts, 'CPC', 'None', cpc FROM runs
    UNION ALL SELECT ts, 'SuccessfulPulls', 'Count', pulls FROM runs) WHERE value IS NOT NULL""",
        ("runs",),
    ),
    "pm": (
        """
  SELECT ts, 'cmp_' || (user_id % 5) AS campaign_id, CAST(event_type = 'view' AS BIGINT) AS impressions,
         CAST(event_type = 'click' AS BIGINT) AS clicks, CAST(event_type = 'purchase' AS BIGINT) AS conversions,
         CAST(event_type = 'error' AS BIGINT) AS errors, CASE WHEN event_type = 'click' THEN value ELSE 0.0 END AS cost
  FROM events""",
        (),
    ),
    "roll": (
        f"""
  SELECT period_start, impressions, clicks, conversions, errors, executions, cost, {pct('clicks', 'impressions')} AS ctr,
         {ratio('cost', 'clicks')} AS cpc
  FROM (SELECT time_bucket(INTERVAL 6 HOURS, ts) AS period_start, {isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
               {isum('conversions')} AS conversions, {isum('errors')} AS errors, COUNT(*) AS executions,
               {hu('SUM(cost)', 6)} AS cost FROM pm GROUP BY 1)""",
        ("pm",),
    ),
    "eventmetrics": (
        """
  SELECT ts, name, value FROM (
    SELECT period_start AS ts, 'TotalImpressions' AS name, CAST(impressions AS DOUBLE) AS value FROM roll
    UNION ALL SELECT period_start, 'TotalClicks', CAST(clicks AS DOUBLE) FROM roll
    UNION ALL SELECT period_start, 'TotalCost', cost FROM roll
    UNION ALL SELECT period_start, 'CTR', ctr FROM roll
    UNION ALL SELECT period_start, 'CPC', cpc FROM roll
    UNION ALL SELECT period_start, 'CollectionFailure', CAST(errors AS DOUBLE) FROM roll) WHERE value IS NOT NULL""",
        ("roll",),
    ),
}


def _collect(names, seen: list[str]) -> list[str]:
    for n in names:
        if n not in seen:
            _collect(PARTS[n][1], seen)
            seen.append(n)
    return seen


def sql(body: str, *names: str) -> str:
    """``body`` preceded by the named sub-queries and those they need."""
    order = _collect(names, [])
    ctes = ",\n".join(f"{n} AS ({PARTS[n][0].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()


def alarm_sql(source: str, alarms: list[Alarm], parts: tuple[str, ...], final: str) -> str:
    """Alarm states per period; ``source`` yields (ts, name, value) rows."""
    branches = []
    for a in alarms:
        stat = "SUM(value) / COUNT(value)" if a.stat == "Average" else "SUM(value)"
        step = f"INTERVAL {a.period} SECONDS"
        per = f"""SELECT make_timestamp(CAST(floor(epoch(ts) / {a.period}) * {a.period} AS BIGINT) * 1000000) AS period_start,
                 {hu(stat, 6)} AS value FROM {source} WHERE name = '{a.metric}' GROUP BY 1"""
        branches.append(f"""
    SELECT '{a.name}' AS alarm, {a.periods} AS needed, s.period_start, v.value, COALESCE(v.value {a.op} {a.threshold}, false) AS breach
    FROM (SELECT unnest(generate_series(MIN(period_start), MAX(period_start), {step})) AS period_start FROM ({per})) s
    LEFT JOIN ({per}) v USING (period_start)""")
    union = "\n    UNION ALL".join(branches)
    states = f"""
  (SELECT alarm, period_start, value, breach, breach_run, CASE WHEN breach_run >= needed THEN 'ALARM' ELSE 'OK' END AS state
   FROM (SELECT *, CASE WHEN breach THEN row_number() OVER (PARTITION BY alarm, island ORDER BY period_start)
                        - (CASE WHEN island = 0 THEN 0 ELSE 1 END) ELSE 0 END AS breach_run
         FROM (SELECT *, SUM(CASE WHEN breach THEN 0 ELSE 1 END) OVER (PARTITION BY alarm ORDER BY period_start) AS island
               FROM ({union}))))"""
    return sql(final.replace("STATES", states), *parts)
