"""Quality rules as weak supervision, in DataFrame functions throughout.

Each rule votes good, bad or abstains on a document.  Documents are counted by
their votes (at most ``3 ** rules`` patterns, whatever the corpus), and
expectation-maximisation over these counts estimates how often each rule gives
each vote on good and on bad documents.  The posterior probability of "good"
then decides, instead of a demand that all rules pass.

Cases: a null or empty text has no words and fails the base rules; nulls in
other columns are carried along; repeated rows are judged alike; an empty table
gives an empty result (the estimates then stay at their starting values).
Working columns start with ``_q_``; other columns may have any other name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import WHITE
from tillworks.session import materialize

GOOD, BAD, ABSTAIN = 1, 0, 2
ROUNDS = 100
LEAST_ODDS = 2.0
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``STATS`` and those the rules need, as ``_q_`` columns.

    Every step is a column of its own, so that later ones refer to its value.
    """
    steps = df.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    steps = steps.withColumn("_q_trim", F.btrim("_q_text", F.lit(" \t\n\x0b\x0c\r")))
    words = F.when(F.col("_q_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_q_trim", WHITE))
    # What is left without lower-case letters and white space is short, and holds all that is counted.
    steps = steps.withColumns(
        {
            "_q_words": words,
            "_q_lines": F.filter(F.split("_q_text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))),
            "_q_rest": F.regexp_replace("_q_text", r"[\p{Ll}\x20\x09-\x0D]+", ""),
        }
    ).withColumn("_q_n", F.size("_q_words"))
    # A window of three words is known by its hash.
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_q_n") - 3),
        lambda i: F.xxhash64(F.get("_q_words", i), F.get("_q_words", i + 1), F.get("_q_words", i + 2)),
    )
    steps = steps.withColumn("_q_windows", F.when(F.col("_q_n") >= 3, windows).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    steps = steps.withColumn(
        "_q_placed",
        F.when(F.size(F.array_distinct("_q_windows")) < F.size("_q_windows"), placed).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        ),
    )
    # Neighbours of equal hash in the sorted array are windows found twice or more.
    same = lambda x, i: x["h"].eqNullSafe(F.get("_q_placed", i - 1)["h"]) | x["h"].eqNullSafe(F.get("_q_placed", i + 1)["h"])
    twice = F.sort_array(F.transform(F.filter("_q_placed", same), lambda x: x["i"]))
    steps = steps.withColumn("_q_twice", F.when(F.size("_q_placed") > 0, twice).otherwise(F.array().cast("array<int>")))
    # Each covers three words, or those up to the next one.
    covered = F.when(
        F.size("_q_twice") > 0,
        F.aggregate(
            F.transform("_q_twice", lambda x, i: F.least(F.coalesce(F.get("_q_twice", i + 1) - x, F.lit(3)), F.lit(3))),
            F.lit(0),
            lambda total, x: total + x,
        ),
    ).otherwise(F.lit(0))
    counted = lambda pattern: F.regexp_count("_q_rest", F.lit(pattern)).cast("long")
    chars = F.length(F.array_join("_q_words", "")).cast("long")
    return steps.select(
        *df.columns,
        F.col("_q_n").cast("long").alias("_q_n_words"),
        chars.alias("_q_word_chars"),
        counted(r"[#*$%&|<>]").alias("_q_n_symbols"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("_q_n_dup_lines"),
        covered.cast("long").alias("_q_n_repeat_words"),
        counted(r"\p{Lu}").alias("_q_n_upper"),
        counted(r"[^\p{L}]").alias("_q_n_marks"),
        counted(r"[!?]").alias("_q_n_loud"),
        counted(r"\.").alias("_q_n_stops"),
        F.size("_q_lines").cast("long").alias("_q_n_lines"),
        F.size(F.array_distinct("_q_words")).cast("long").alias("_q_n_distinct"),
    )


def _ratio(a: str, b: str) -> Column:
    return F.col(f"_q_{a}") / F.greatest(F.col(f"_q_{b}"), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))


def rule_votes() -> dict[str, Column]:
    """The rules.  Finding no flaw of one kind says little, so most rules vote bad or
    abstain; two look at what prose has and vote either way."""
    symbols, upper, loud = _ratio("n_symbols", "n_words"), _ratio("n_upper", "word_chars"), _ratio("n_loud", "n_words")
    repeat, dup = _ratio("n_repeat_words", "n_words"), _ratio("n_dup_lines", "n_lines")
    stops, mean = _ratio("n_stops", "n_words"), _ratio("word_chars", "n_words")
    distinct = _ratio("n_distinct", "n_words")
    letters = 1 - _ratio("n_marks", "word_chars")
    prose = (stops > 0.02) & (stops < 0.3) & (symbols < 0.05) & (upper < 0.2) & (repeat < 0.2)
    return {
        "prose": _vote((stops < 0.01) | (symbols > 0.2) | (upper > 0.4) | (repeat > 0.4), prose),
        "letters": _vote(letters < 0.88, letters > 0.92),
        "symbols": _vote(symbols > 0.25, F.lit(False)),
        "upper_case": _vote(upper > 0.5, F.lit(False)),
        "loud": _vote(loud > 0.25, F.lit(False)),
        "repeats": _vote(repeat > 0.3, F.lit(False)),
        "dup_lines": _vote(dup > 0.4, F.lit(False)),
        "vocabulary": _vote((distinct < 0.15) & (F.col("_q_n_words") < 2000), F.lit(False)),
        "word_length": _vote((mean < 2) | (mean > 15), F.lit(False)),
    }


def estimate(counts: dict[tuple[int, ...], int], n_rules: int) -> tuple[float, list[list[list[float]]]]:
    """EM over vote patterns: the share of good documents, and ``P(vote | class)`` per rule.

    An abstention is an outcome like a vote, so flaws that no rule names still
    weigh little.  It starts from the votes with bad ones counted fourfold, and a
    half count per cell keeps every estimate away from 0 and 1.  Rules are taken
    to be better than chance: a vote's odds are held at ``LEAST_ODDS`` at least.
    """
    total = sum(counts.values())
    prior = 0.5
    given = [[[0.3, 0.2, 0.5], [0.1, 0.4, 0.5]] for _ in range(n_rules)]
    if not total:
        return prior, given
    belief = {
        p: (1 + sum(v == GOOD for v in p)) / (2 + sum(v == GOOD for v in p) + 4 * sum(v == BAD for v in p))
        for p in counts
    }
    for _ in range(ROUNDS):
        prior = min(0.98, max(0.02, sum(belief[p] * n for p, n in counts.items()) / total))
        for j in range(n_rules):
            cells = [[0.5] * 3, [0.5] * 3]
            for p, n in counts.items():
                cells[1][p[j]] += belief[p] * n
                cells[0][p[j]] += (1 - belief[p]) * n
            rows = [[x / sum(c) for x in c] for c in cells]
            for vote in (GOOD, BAD):
                # The other class gives this vote at most once for each LEAST_ODDS here.
                rows[1 - vote][vote] = min(rows[1 - vote][vote], rows[vote][vote] / LEAST_ODDS)
            given[j] = rows
        fresh = {p: 1 / (1 + math.exp(-_log_odds(p, prior, given))) for p in counts}
        moved = max(abs(fresh[p] - belief[p]) for p in counts)
        belief = fresh
        if moved < 1e-9:
            break
    return prior, given


def _log_odds(votes: tuple[int, ...], prior: float, given: list[list[list[float]]]) -> float:
    odds = math.log(prior / (1 - prior))
    for j, v in enumerate(votes):
        odds += math.log(given[j][1][v] / given[j][0][v])
    return max(-30.0, min(30.0, odds))


def judge_quality(df: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """All rows of ``df`` with the columns ``keep`` and ``_q_`` columns for the counts,
    ``_q_p_good``, ``_q_base_failed`` and ``_q_kept``.

    Texts are counted once; the counts are written and serve both the estimates
    and the verdicts.  Only numbers by vote pattern reach the driver.
    """
    rules = rule_votes()
    stats = with_stats(df, text)
    stats = materialize(stats.select(*keep, *[c for c in stats.columns if c.startswith("_q_")]), "quality")
    voted = stats.withColumns({f"_q_vote_{k}": v for k, v in rules.items()})
    votes = [f"_q_vote_{k}" for k in rules]
    failed = (F.col("_q_n_words") < 50) | (100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_n_words"))
    # Documents that the base rules reject are decided already and teach nothing.
    patterns = voted.filter(~failed).groupBy(*votes).count().collect()
    counts = {tuple(int(v) for v in row[:-1]): row["count"] for row in sorted(patterns)}
    prior, given = estimate(counts, len(votes))
    odds = F.lit(math.log(prior / (1 - prior)))
    for j, name in enumerate(votes):
        weight = [math.log(given[j][1][v] / given[j][0][v]) for v in (BAD, GOOD, ABSTAIN)]
        odds = odds + F.when(F.col(name) == BAD, weight[0]).when(F.col(name) == GOOD, weight[1]).otherwise(weight[2])
    return (
        voted.withColumn("_q_p_good", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds)))))
        .withColumn("_q_base_failed", failed)
        .withColumn("_q_kept", ~F.col("_q_base_failed") & (F.col("_q_p_good") >= threshold))
    )
