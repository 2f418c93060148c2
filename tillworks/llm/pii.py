"""Personal data: patterns, and a skip-chain conditional random field over mentions.

Patterns with their checks (octets, Luhn, digit counts) give the base spans.
What matches a pattern but fails its check is a mention in doubt.  Mentions of a
document form a field of binary variables (personal data or not): base spans
are fixed, the evidence of doubtful ones comes from a logistic model, successive
mentions share a chain potential, and mentions that repeat or resemble each
other, however far apart, share a skip potential: all pairs of like strings are
found by keys they must share.  Digit runs and tokens that match no pattern but
resemble a base span of the document are doubtful mentions too.  Loopy message passing
spreads the labels over the document; doubtful mentions that end above
``THRESHOLD`` are added.

Evidence and both potentials are fitted together by pseudo-likelihood on a bounded
sample of documents.  There the field sees what it is for: each base span comes a
second time with a wrong character, which is personal data, beside the doubtful
mentions the documents have of themselves, which are not (those like a base span
are left out: they can be either); a mention's neighbours count by their labels.  Without any base span in the sample nothing is added.

Cases: a null text is an empty one without spans; offsets are code points;
patterns take linear time on any text, links time in proportion to the doubtful
strings and those that share a block with them; repeated rows are handled alike;
an empty table gives an empty result; a mention is linked to one mention of each
like string, one that passes if there is any.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import beside

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 4096
ROUNDS = 8
THRESHOLD = 0.5
FIXED = 12.0
CHAIN_GAP = 40
# Far enough behind a text that no chain reaches what is planted there.
GAP = "\n" + " " * 60
MOST_PLANTED, MOST_EXAMPLES = 16, 64

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOOSE_DOMAIN = re.compile(r"@[A-Za-z0-9-]+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])+")
TOKEN = re.compile(r"[^\s,;:!?\"'<>\[\]{}]+")
# Phones are alike by so many last digits: a country or area code may be missing.
SUFFIX = 7

Mention = tuple[str, int, int, bool]


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mentions(text: str) -> list[Mention]:
    """All matches as ``(kind, start, end, passes)``, leftmost and apart within a kind."""
    out: list[Mention] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at:
            whole = DOMAIN.match(text, at)
            found = whole or LOOSE_DOMAIN.match(text, at)
            if found:
                out.append(("email", start, found.end(), bool(whole)))
            if whole:
                done = whole.end()
        # What lies before this sign cannot begin a later match.
        done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            out.append(("ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) >= 11:
                out.append(("card", m.start(), m.end(), 13 <= len(digits) <= 19 and luhn(digits)))
        for m in PHONE.finditer(text):
            n = sum(c.isdigit() for c in m[0])
            out.append(("phone", m.start(), m.end(), 9 <= n <= 15))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(k, a, b) for k in KINDS for kind, a, b, ok in mentions(text) if kind == k and ok]


def _plain(text: str, m: Mention) -> str:
    return re.sub(r"[^0-9a-z@]", "", text[m[1] : m[2]].lower())


def _features(text: str, m: Mention) -> list[float]:
    """Evidence that does not repeat the check itself: kind, length, what stands around."""
    plain = _plain(text, m)
    usual = {"email": 26, "ip": 10, "card": 16, "phone": 11}[m[0]]
    before, after = text[m[1] - 1 : m[1]], text[m[2] : m[2] + 1]
    return [
        1.0,
        *[float(m[0] == k) for k in KINDS[1:]],
        min(abs(len(plain) - usual), 20) / 5.0,
        float(before == "" or before.isspace()),
        float(after == "" or after.isspace() or after in ",.;:!?"),
    ]


def _alike(a: str, b: str) -> bool:
    """Equal, or of one length with at most one character in eight different."""
    return a == b or (len(a) == len(b) and 8 * sum(x != y for x, y in zip(a, b, strict=True)) <= len(a))


def _keys(kind: str, p: str) -> Iterator[tuple]:
    """Keys of a string; two alike strings of a kind share one at least.

    Of one block more than characters may differ, one block is the same.
    """
    blocks = len(p) // 8 + 1
    for k in range(blocks):
        yield kind, len(p), k, p[len(p) * k // blocks : len(p) * (k + 1) // blocks]
    if kind == "phone" and len(p) >= SUFFIX:
        yield kind, p[-SUFFIX:]


def _like(kind: str, a: str, b: str) -> bool:
    return _alike(a, b) or (kind == "phone" and min(len(a), len(b)) >= SUFFIX and a[-SUFFIX:] == b[-SUFFIX:])


def edges(text: str, found: list[Mention]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between neighbours and skip edges between like mentions."""
    order = sorted(range(len(found)), key=lambda i: (found[i][1], found[i][2], found[i][0]))
    chain = [(a, b) for a, b in zip(order, order[1:], strict=False) if found[b][1] - found[a][2] <= CHAIN_GAP]
    same: dict[tuple[str, str], list[int]] = {}
    for i in order:
        same.setdefault((found[i][0], _plain(text, found[i]).replace("@", "")), []).append(i)
    # Of equal strings one stands for all, one that passes if there is any.
    first = {s: next((i for i in at if found[i][3]), at[0]) for s, at in same.items()}
    doubtful = {s: [i for i in at if not found[i][3]] for s, at in same.items()}
    skip = {(min(i, first[s]), max(i, first[s])) for s, at in same.items() for i in at if i != first[s]}
    index: dict[tuple, list[str]] = {}
    # Strings that only pass are sure already: they are there to be found by others.
    for kind, p in same:
        if not doubtful[kind, p]:
            for key in set(_keys(kind, p)):
                index.setdefault(key, []).append(p)
    for kind, p in same:
        if not doubtful[kind, p]:
            continue
        near = {q for key in set(_keys(kind, p)) for q in index.get(key, ())}
        for q in near:
            if _like(kind, p, q):
                s, t = (kind, p), (kind, q)
                pairs = [(first[s], first[t]), *((i, first[t]) for i in doubtful[s]), *((i, first[s]) for i in doubtful[t])]
                skip.update((min(x), max(x)) for x in pairs)
        for key in set(_keys(kind, p)):
            index.setdefault(key, []).append(p)
    return chain, sorted(skip)


def resembling(text: str, found: list[Mention]) -> list[Mention]:
    """Doubtful mentions that match no pattern: digit runs and tokens like a passing mention."""
    index: dict[tuple, set[str]] = {}
    lengths = set()
    for m in found:
        if m[3]:
            p = _plain(text, m).replace("@", "")
            lengths.add((m[0] == "phone", len(p)))
            for key in _keys(m[0], p):
                index.setdefault(key, set()).add(p)
    if not index:
        return []
    sizes = {n for _, n in lengths}
    phones = any(phone for phone, _ in lengths)
    out: list[Mention] = []
    taken = sorted((a, b) for _, a, b, _ in found)
    starts = [a for a, _ in taken]
    reach = list(accumulate((b for _, b in taken), max))
    spans: set[tuple[int, int]] = set()
    for pattern in (RUN, TOKEN):
        for hit in pattern.finditer(text):
            a, b = hit.span()
            while b > a and pattern is TOKEN and text[b - 1] in ".)":
                b -= 1
            k = bisect_left(starts, b)
            if (a, b) in spans or (k and reach[k - 1] > a):
                continue
            p = _plain(text, ("", a, b, False))
            for kind in KINDS:
                # Only digits make a phone by their end.
                suffix = kind == "phone" and phones and p.isdigit() and len(p) >= SUFFIX
                if not suffix and len(p) not in sizes or len(p) < 4:
                    continue
                if any(_like(kind, p, q) if suffix else _alike(p, q) for key in _keys(kind, p) for q in index.get(key, ())):
                    out.append((kind, a, b, False))
                    spans.add((a, b))
                    break
    return out


def marginals(theta: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Loopy belief propagation on binary variables with agreement potentials (log-odds form)."""
    if not pairs:
        return 1 / (1 + np.exp(-theta))
    a = np.array([p[0] for p in pairs] + [p[1] for p in pairs])
    b = np.array([p[1] for p in pairs] + [p[0] for p in pairs])
    j = np.tanh(np.array([p[2] for p in pairs] * 2) / 2)
    back = np.r_[np.arange(len(pairs), 2 * len(pairs)), np.arange(len(pairs))]
    message = np.zeros(len(a))
    for _ in range(ROUNDS):
        total = theta + np.bincount(b, message, len(theta))
        cavity = np.tanh((total[a] - message[back]) / 2)
        message = 0.5 * message + 0.5 * 2 * np.arctanh(np.clip(j * cavity, -0.999999, 0.999999))
    return 1 / (1 + np.exp(-np.clip(theta + np.bincount(b, message, len(theta)), -50, 50)))


def all_spans(text: str, model: tuple[np.ndarray, float, float]) -> tuple[list, list]:
    """Base spans, and base with added spans, both by kind as listed and start."""
    found = mentions(text)
    base = [m[:3] for m in found if m[3]]
    added: list = []
    found = found + resembling(text, found) if base else found
    if len(base) < len(found):
        weights, chain_weight, skip_weight = model
        theta = np.array([FIXED if m[3] else float(np.dot(weights, _features(text, m))) for m in found])
        chain, skip = edges(text, found)
        p = marginals(theta, [(i, j, chain_weight) for i, j in chain] + [(i, j, skip_weight) for i, j in skip])
        taken = sorted((a, b) for _, a, b in base)
        for m, q in zip(found, p, strict=True):
            if not m[3] and q > THRESHOLD and all(m[2] <= a or b <= m[1] for a, b in taken):
                added.append(m[:3])
                taken.append(m[1:3])
    by = lambda s: (KINDS.index(s[0]), s[1])
    return sorted(base, key=by), sorted(base + added, key=by)


def misspelt(text: str) -> tuple[str, int]:
    """``text`` with its base spans once more behind it, each with one character changed, and where these begin."""
    parts, begin = [text], len(text) + len(GAP)
    for kind, a, b in base_spans(text)[:MOST_PLANTED]:
        span = text[a:b]
        places = [i for i, c in enumerate(span) if c.isalnum()]
        # The place and the change follow from the span itself.
        draw = int.from_bytes(hashlib.blake2b(f"{kind}:{span}".encode("utf-8", "surrogatepass"), digest_size=4).digest())
        i = places[draw % len(places)]
        other = str((int(span[i]) + 1 + draw % 9) % 10) if span[i].isascii() and span[i].isdigit() else "x" if span[i] != "x" else "y"
        parts.append(span[:i] + other + span[i + 1 :])
    return GAP.join(parts), begin


def examples(text: str) -> list[list[float]]:
    """Label, evidence, and the sums over chain and skip neighbours (1 or -1 each) of doubtful mentions."""
    whole, begin = misspelt(text)
    if len(whole) == len(text):
        whole, begin = text, len(text)
    found = mentions(whole)
    found = found + resembling(whole, found)
    label = [1.0 if m[3] or m[1] >= begin else 0.0 for m in found]
    chain, skip = edges(whole, found)
    # What the document has of itself beside a like base span can be either, and says nothing of others.
    unknown = {x for i, j in skip for x, y in ((i, j), (j, i)) if not label[x] and found[y][3]}
    sign = [0.0 if i in unknown else 2 * y - 1 for i, y in enumerate(label)]
    sums = np.zeros((len(found), 2))
    for k, pairs in enumerate((chain, skip)):
        for i, j in pairs:
            sums[i, k] += sign[j]
            sums[j, k] += sign[i]
    doubtful = [i for i, m in enumerate(found) if not m[3] and i not in unknown][:MOST_EXAMPLES]
    return [[label[i], *_features(whole, found[i]), *sums[i]] for i in doubtful]


def train(df: DataFrame, id_column: str, text: str) -> tuple[np.ndarray, float, float]:
    """Evidence weights, chain and skip potential, fitted on about ``SAMPLE_DOCS`` documents.

    Documents are drawn by a hash of id and text; at most ``MOST_EXAMPLES`` doubtful mentions of one travel.
    """
    n = df.count()
    draw = F.pmod(F.xxhash64(F.lit("pii"), F.col(id_column), F.col(text)), F.lit(1 << 30)) / float(1 << 30)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            # A batch without examples has no column type.
            if found := [x for t in part["t"] for x in examples(t or "")]:
                yield pd.DataFrame({"x": pd.Series(found, dtype=object)})

    sample = (
        df.filter(draw < min(1.0, SAMPLE_DOCS / max(n, 1)))
        .select(F.col(text).alias("t"), F.xxhash64(text).alias("_order"))
        # Copies are one example, and their number stays bounded where many rows share a hash.
        .dropDuplicates(["_order"]).sort("_order").limit(2 * SAMPLE_DOCS)
        .select("t").mapInPandas(rows, "x array<double>").toPandas()
    )
    size = len(_features("", ("email", 0, 0, True)))
    if not len(sample):
        return np.zeros(size), 0.0, 0.0
    data = np.array(sample["x"].tolist())
    data = data[np.lexsort(data.T)]
    y, x = data[:, 0], data[:, 1:]
    if not y.any():
        return np.zeros(size), 0.0, 0.0
    # Labels as +-1 on both sides of an edge: the log-odds of a mention are its evidence and the sums.
    weights = np.zeros(x.shape[1])
    # Each class weighs the same, as planted repeats have no natural share.
    weigh = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        h = x.T @ (x * (weigh * p * (1 - p))[:, None]) + np.eye(len(weights))
        weights = weights + np.linalg.solve(h, x.T @ (weigh * (y - p)) - weights)
    return weights[:size], float(weights[size]), float(weights[size + 1])


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(df: DataFrame, model, id_column: str, text: str) -> DataFrame:
    """``id``, base counts, the digest of the base spans and all spans, for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    added = [*[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string", "n_added long"]

    def run(texts: list[str]) -> list:
        out = []
        for t in texts:
            base, spans = all_spans(t, shared.value)
            counts = [sum(s[0] == k for s in base) for k in KINDS]
            out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
        return list(zip(*out, strict=True)) if out else [[]] * len(added)

    return beside(df, [id_column], [F.coalesce(F.col(text), F.lit(""))], ", ".join(added), lambda: run)


def redact(df: DataFrame, model, text: str) -> DataFrame:
    """All rows and columns of ``df`` with each span of ``text`` replaced by its kind in brackets.

    Overlapping spans are replaced as one, by the kind of the first.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        parts, at = [], 0
        for a, kind, b in sorted((a, k, b) for k, a, b in all_spans(t, shared.value)[1]):
            if a >= at:
                parts += [t[at:a], f"[{kind.upper()}]"]
            at = max(at, b)
        return "".join(parts) + t[at:] if parts else t

    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            yield batch.set_column(place, text, pa.array([clean(t) for t in column.to_pylist()], column.type))

    return df.mapInArrow(run, df.schema)
