"""Thousands of path rules: the same verdicts as trying every rule, and only candidates run their expression."""

import random
import re

from tillworks.llm.common import settings as session_settings
from tillworks.llm.url_rules import RULES, Rule, judge_urls


def path_rules(n):
    """A rule per section and topic of a site: ``/section/topicN``, some with a pattern between."""
    draw, out = random.Random(9), []
    for i in range(n):
        section, topic = f"sec{i % 40}", f"topic{i}"
        between = draw.choice(["/", "/[0-9]+/", "/(?:[^/]*/)?"])
        out.append(Rule(f"path:{section}:{topic}", draw.choice(["block", "allow"]), rf"^[^/]*/{section}{between}{topic}(?:/|$)", (section, topic), 100 + i))
    return tuple(out)


def test_thousands_of_path_rules(spark):
    session_settings(spark)
    rules, draw = path_rules(4000), random.Random(1)
    urls = [f"https://www.site.example.edu/sec{draw.randrange(41)}{draw.choice(['/', '/12/', '/x/', '/x/y/'])}topic{draw.randrange(4200)}{draw.choice(['', '/', '/more', 's'])}" for _ in range(600)]
    urls += [f"https://www.example.edu/sec{i % 40}/topic{i}" for i in range(0, 4000, 31)] + [None, "no scheme", "http://casino.example/", "HTTP://X.net/a"]
    found = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), "page_id", "url", RULES + rules).collect()
    fits, tried = 0, [(r, re.compile(r.pattern)) for r in RULES + rules]
    for row in found:
        url = urls[row.page_id] or ""
        host, path = re.match(r"^.*?://([^/?#]*)([^?#]*)", url).groups() if "://" in url else ("", "")
        best = max((r for r, p in tried if p.search(host.lower() + path)), key=lambda r: (r.rank, r.name), default=None)
        assert row.verdict == (best.verdict if best else "allow")
        assert (row.rule, row.pattern_rule) == ((best.name, None) if best and best.listed else (None, best.name if best else None))
        fits += best is not None
    assert fits > 40


def test_only_candidates_run_their_expression(spark):
    """A broken expression raises when it runs: it runs only for URLs that hold its rarest token."""
    session_settings(spark)
    broken = Rule("broken", "block", "(", ("common", "rare"), 5)
    urls = spark.createDataFrame([(i, f"http://a.example/common/{i}") for i in range(50)] + [(99, "http://a.example/rare")], "page_id int, url string")
    judged = judge_urls(urls, "page_id", "url", (broken,))
    assert judged.filter("page_id < 99").count() == 50
    try:
        judged.collect()
    except Exception as error:
        assert "(" in str(error)
    else:
        raise AssertionError("the rarest token fetches the rule")
