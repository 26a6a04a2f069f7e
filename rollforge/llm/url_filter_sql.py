"""The URL query in SQL: the same estimates, written out."""

from __future__ import annotations

from collections.abc import Sequence

from rollforge.llm.url_filter import LIMIT, LONG_SUFFIXES, RULES, Rule, Z

_LONG = ", ".join(f"'{x}'" for x in LONG_SUFFIXES)


def _rule_sql(rules: Sequence[Rule], value: str) -> str:
    cases = []
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        out = r.name if value == "name" else "allow" if r.allow else "block"
        cases.append(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{out}'"
        )
    return f"CASE {' '.join(cases)} END"


def _level_sql(name: str, rows: str) -> str:
    """Prior strength of a level and the posterior of its rows (n, bad, parent_rate, parent_variance)."""
    return f"""
{name}_fit AS (SELECT sum(n * pow(bad / n - parent_rate, 2)) AS spread, sum(parent_rate * (1 - parent_rate)) AS single,
  sum(parent_rate * (1 - parent_rate) * (n - 1)) AS extra FROM ({rows}) WHERE n > 0),
{name}_strength AS (SELECT CASE WHEN extra IS NULL OR extra <= 0 THEN 1e0
  WHEN greatest(0e0, (spread - single) / extra) <= 0 THEN 1000e0
  ELSE least(1000e0, greatest(1e0, 1 / least(1e0, (spread - single) / extra) - 1)) END AS fitted FROM {name}_fit),
{name}_prior AS (SELECT x.*, greatest(0.5e0, parent_rate * (1 - parent_rate) / (parent_rate * (1 - parent_rate) / (fitted + 1)
  + parent_variance * (fitted / (fitted + 1))) - 1) AS s FROM ({rows}) x, {name}_strength),
{name}_beta AS (SELECT *, parent_rate * s + bad AS alpha, (1 - parent_rate) * s + n - bad AS beta FROM {name}_prior),
{name} AS (SELECT *, alpha / (alpha + beta) AS rate,
  sqrt(alpha * beta / (pow(alpha + beta, 2) * (alpha + beta + 1))) AS sd FROM {name}_beta)"""


_SUFFIXES = """SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS parent_rate,
  any_value(rate * (1 - rate) / (total + 2e0)) AS parent_variance FROM base, root GROUP BY suffix"""
_DOMAINS = """SELECT b.suffix, b.domain, sum(b.n) AS n, sum(b.bad) AS bad, any_value(u.rate) AS parent_rate,
  any_value(u.sd * u.sd) AS parent_variance FROM base b JOIN suffixes u ON b.suffix = u.suffix GROUP BY b.suffix, b.domain"""
_HOSTS = """SELECT b.host, b.n, b.bad, u.rate AS parent_rate, u.sd * u.sd AS parent_variance
  FROM base b JOIN domains u ON b.suffix = u.suffix AND b.domain = u.domain"""

OP8_SQL = f"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest
    FROM pages)
), ruled AS (
  SELECT *, {_rule_sql(RULES, "name")} AS rule, {_rule_sql(RULES, "verdict")} AS by_rule FROM cut
), counted AS (
  SELECT host, count(by_rule) AS n, CAST(count(*) FILTER (WHERE by_rule = 'block') AS DOUBLE) AS bad FROM ruled GROUP BY host
), bared AS (
  SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS w FROM counted
), tails AS (
  SELECT *, array_to_string(w, '.') AS bare, w[-1] AS last, array_to_string(w[-2:], '.') AS tail2,
    array_to_string(w[-3:], '.') AS tail3 FROM bared
), base AS (
  SELECT host, n, bad,
    CASE WHEN regexp_matches(last, '^[0-9]+$') OR contains(bare, ']') THEN bare
      WHEN tail2 IN ({_LONG}) THEN tail3 ELSE tail2 END AS domain,
    CASE WHEN regexp_matches(last, '^[0-9]+$') OR contains(bare, ']') THEN ''
      WHEN tail2 IN ({_LONG}) THEN tail2 ELSE last END AS suffix FROM tails
), root AS (SELECT sum(n) AS total, (sum(bad) + 0.5e0) / (sum(n) + 1e0) AS rate FROM base),
{_level_sql("suffixes", _SUFFIXES)},
{_level_sql("domains", _DOMAINS)},
{_level_sql("hosts", _HOSTS)}
SELECT page_id, r.host, path, rule, coalesce(by_rule, CASE WHEN rate - {Z}e0 * sd > {LIMIT}e0 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r JOIN hosts h ON r.host = h.host
"""
