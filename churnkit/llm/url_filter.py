"""URL filter: allow and block rules by host and path, else a weighted vocabulary matched by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

#: One hit of these rejects.
STRICT = ("adult", "casino", "escort", "hentai", "malware", "phishing", "poker", "porn", "sex", "spam", "viagra", "xxx")
#: Several distinct hits of these reject.
SOFT = ("ads", "bets", "betting", "bonus", "buy", "cheap", "click", "deal", "free", "hot", "loan", "pills", "prize",
        "promo", "slots", "track", "win", "winner")
MIN_SOFT = 2

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def count_terms(url: str, automaton: ahocorasick.Automaton) -> tuple[int, int]:
    """(strict hits, distinct soft terms) of a lower-cased url; a hit has no letter or digit beside it."""
    strict, soft = 0, set()
    for last, (term, is_strict) in automaton.iter(url):
        first = last - len(term) + 1
        if (first == 0 or url[first - 1] not in ALNUM) and (last + 1 == len(url) or url[last + 1] not in ALNUM):
            if is_strict:
                strict += 1
            else:
                soft.add(term)
    return strict, len(soft)


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
                soft: Sequence[str] = SOFT, min_soft: int = MIN_SOFT) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, strict_hits, soft_hits.

    The longest fitting rule decides; without one, a strict term or
    ``min_soft`` distinct soft terms block.  A null url or one without ``://``
    has empty host and path and no rule; a null url has no hits and is
    allowed.  Repeated rows are judged alike; other columns are ignored.  Rows
    are independent, so nothing is shuffled."""
    url = F.col(url_col)
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    base = df.select(
        F.col(id_col).alias("page_id"), F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER).alias("low"),
        F.translate(F.coalesce(F.regexp_extract(url, parts, 1), F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce(F.regexp_extract(url, parts, 2), F.lit("")).alias("path"))

    def fits(h: str, p: str):
        return ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)

    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    rule = F.coalesce(*[F.when(fits(h, p), h + p) for _, h, p in ordered], F.lit(None).cast("string"))
    decided = F.coalesce(*[F.when(fits(h, p), v) for v, h, p in ordered], F.lit(None).cast("string"))
    id_type = df.schema[id_col].dataType.simpleString()

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for terms, is_strict in ((soft, False), (strict, True)):
            for t in terms:
                automaton.add_word(t, (t, is_strict))
        if len(automaton):
            automaton.make_automaton()
        for b in batches:
            found = [count_terms(u, automaton) if u and len(automaton) else (0, 0) for u in b.column("low").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("host"), b.column("path"), b.column("rule"), b.column("decided"),
                 pa.array([x for x, _ in found], pa.int32()), pa.array([x for _, x in found], pa.int32())],
                ["page_id", "host", "path", "rule", "decided", "strict_hits", "soft_hits"])

    counted = base.select("page_id", "low", "host", "path", rule.alias("rule"), decided.alias("decided")).mapInArrow(
        hits, f"page_id {id_type}, host string, path string, rule string, decided string, strict_hits int, soft_hits int")
    method = F.when((F.col("strict_hits") > 0) | (F.col("soft_hits") >= min_soft), "block").otherwise("allow")
    return counted.select("page_id", "host", "path", "rule", F.coalesce("decided", method).alias("verdict"),
                          "strict_hits", "soft_hits")


def sql() -> str:
    """The query over ``pages`` in DuckDB SQL: the same vocabulary as boundary-checked patterns."""
    def hit(terms) -> str:
        return f"(^|[^a-z0-9])({'|'.join(terms)})([^a-z0-9]|$)"

    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    fits = {r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')" for r in RULES}
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r[1]}{r[2]}'" for r in ordered) + " END"
    verdict = " ".join(f"WHEN {fits[r]} THEN '{r[0]}'" for r in ordered)
    soft = " + ".join(f"regexp_matches(low, '{hit([t])}')::INT" for t in SOFT)
    strict = " + ".join(f"len(regexp_extract_all(wide, '{hit([t])}'))" for t in STRICT)
    return rf"""
    WITH parts AS (
      SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
             translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
             coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
      FROM pages),
    wide AS (SELECT *, regexp_replace(low, '([^a-z0-9])', '\1\1', 'g') AS wide FROM parts),  -- hits may share a boundary
    hits AS (SELECT *, CAST({strict} AS INT) AS strict_hits, CAST({soft} AS INT) AS soft_hits FROM wide)
    SELECT page_id, host, path, {rule} AS rule,
           CASE {verdict} WHEN strict_hits > 0 OR soft_hits >= {MIN_SOFT} THEN 'block' ELSE 'allow' END AS verdict,
           strict_hits, soft_hits
    FROM hits"""
