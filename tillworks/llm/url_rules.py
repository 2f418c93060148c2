"""URL filter: pattern rules behind an index on each rule's rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens
(runs of a-z, 0-9) that every matching URL must hold.  One pass counts how many
URLs hold each of these tokens; a rule is filed under its rarest one.  A URL's
tokens then fetch the candidates and only those run their expression.  The
index is a literal array of hash buckets, each a line of text that is taken apart
where it is fetched, so a lookup costs the same for ten rules or ten thousand, and
judging needs no shuffle.

Cases: a null URL or one without ``://`` has an empty host and path; null ids,
repeated rows and very long URLs are judged row by row; an empty table gives an
empty result.  Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 50_000
# Characters that no URL rule holds, between buckets, rules and fields.
BUCKET, RULE, FIELD = "\x01", "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``rank`` decides between rules that fit: higher wins, then the later name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    listed: bool = False


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def prefix_rule(text: str, verdict: str) -> Rule:
    """``host/path``: that host with its subdomains, and paths that start so."""
    host, _, rest = text.partition("/")
    whole = f"{host}/{rest}"
    # A last token that the rule leaves open may go on in the URL.
    closed = re.sub(r"[a-zA-Z0-9]+$", "", whole).translate(str.maketrans(UPPER, LOWER))
    tokens = tuple(dict.fromkeys(re.findall(r"[a-z0-9]+", closed)))
    return Rule(text, verdict, rf"^(?:[^/]*\.)?{_literal(whole)}", tokens, 1_000_000 + len(text), True)


def host_word_rule(word: str, verdict: str) -> Rule:
    """Hosts that hold ``word`` as a whole token."""
    return Rule(
        f"host:{word}", verdict, rf"^(?:[^/]*[^a-z0-9/])?{word}(?:[^a-z0-9]|$)", (word,), len(word)
    )


# The listed rules, and words of hosts that serve no articles.
LISTED = (
    prefix_rule("net/", "block"),
    prefix_rule("example.net/en/", "allow"),
    prefix_rule("example.com/de/", "block"),
    prefix_rule("org/fr/", "allow"),
)
PATTERNS = tuple(
    host_word_rule(w, "block")
    for w in ("ads", "adserver", "casino", "malware", "phishing", "pills", "porn", "spam", "viagra", "xxx")
)
RULES = LISTED + PATTERNS


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(target: Column) -> Column:
    return F.array_distinct(
        F.filter(F.split(F.translate(target, UPPER, LOWER), "[^a-z0-9]+"), lambda t: t != "")
    )


def rule_index(urls: DataFrame, rules: tuple[Rule, ...]) -> list[str]:
    """Hash buckets of rules, each filed under its rarest token over all ``urls``.

    A bucket is its rules joined by ``RULE``, a rule its fields joined by ``FIELD``.

    ``urls`` has the column ``_tokens``.  Rules without a token are filed under
    the empty one.  Counts are kept for the rules' own tokens alone.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is built for {MAX_RULES} at most")
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    # Tokens travel as rows: thousands of literals or columns take minutes to plan.
    rows = lambda tokens: spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(tokens)), "array<string>")).alias("token"))
    # The rules' own tokens, bounded by MAX_RULES.
    counts = urls.select(F.explode("_tokens").alias("token")).join(F.broadcast(rows(wanted)), "token").groupBy("token").count().collect()
    seen = {row["token"]: row["count"] for row in counts}
    filed = [(min(r.tokens, key=lambda t: (seen.get(t, 0), t), default=""), r) for r in rules]
    n_buckets = max(1, len(rules))
    keys = sorted({t for t, _ in filed})
    bucket = dict(rows(keys).select("token", F.pmod(F.xxhash64("token"), F.lit(n_buckets)).cast("int")).collect())
    buckets: list[list[str]] = [[] for _ in range(n_buckets)]
    for token, rule in filed:
        fields = (token, rule.name, rule.verdict, rule.pattern, str(rule.rank), str(int(rule.listed)))
        buckets[bucket[token]].append(FIELD.join(fields))
    return [RULE.join(b) for b in buckets]


def judge_urls(
    df: DataFrame, id_column: str, url_column: str, rules: tuple[Rule, ...] = RULES, default: str = "allow"
) -> DataFrame:
    """``id, host, path, rule, verdict, pattern_rule`` for every row.

    The listed rule of the highest rank decides; without one the pattern rule
    of the highest rank (longest word); without any, ``default``.
    """
    split = df.select(
        F.col(id_column), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path")
    ).withColumn("_tokens", F.concat(tokens_of(F.concat("host", "path")), F.array(F.lit(""))))
    buckets = rule_index(split, rules)
    # Splitting a literal is done once, when the query is planned.
    index = F.split(F.lit(BUCKET.join(buckets)), BUCKET)
    target = F.concat("host", "path")

    def rules_of(t: Column) -> Column:
        bucket = F.element_at(index, (F.pmod(F.xxhash64(t), F.lit(len(buckets))) + 1).cast("int"))
        return F.filter(F.transform(F.split(bucket, RULE), lambda r: F.split(r, FIELD)), lambda r: r[0] == t)

    candidates = F.flatten(F.transform("_tokens", rules_of))
    fitting = F.filter(candidates, lambda r: F.rlike(target, F.get(r, 3)))
    best = F.array_max(
        F.transform(
            fitting,
            lambda r: F.struct(r[4].cast("int").alias("rank"), r[1].alias("name"), r[2].alias("verdict"), (r[5] == "1").alias("listed")),
        )
    )
    return split.withColumn("_best", best).select(
        id_column,
        "host",
        "path",
        F.when(F.col("_best.listed"), F.col("_best.name")).alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("_best.listed"), F.col("_best.name")).alias("pattern_rule"),
    )


def judge_sql(rules: tuple[Rule, ...] = RULES, default: str = "allow") -> str:
    """The same verdicts as SQL: every rule is tried in the order of its rank."""
    order = sorted(rules, key=lambda r: (r.rank, r.name), reverse=True)

    def cases(what) -> str:
        return " ".join(f"WHEN regexp_matches(host || path, '{r.pattern}') THEN {what(r)}" for r in order)

    text = lambda v: f"'{v}'"
    upper_lower = f"'{UPPER}', '{LOWER}'"
    return f"""
    WITH split AS (
      SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {upper_lower}) AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
      FROM pages)
    SELECT page_id, host, path,
      CASE {cases(lambda r: text(r.name) if r.listed else "NULL")} END AS rule,
      CASE {cases(lambda r: text(r.verdict))} ELSE '{default}' END AS verdict,
      CASE {cases(lambda r: "NULL" if r.listed else text(r.name))} END AS pattern_rule
    FROM split"""
