"""URL filter: rules by host and path first, then logistic regression on hashed character n-grams of host and path.

The model is trained on the driver from a small labelled table of URLs, a parameter; its weights are one array of fixed size
that goes to the executors. Scoring is one pass without a shuffle, however common a host is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, SIZES = 1 << 16, (3, 4, 5)
STEPS, RATE, PENALTY = 1000, 4.0, 1e-5
THRESHOLD = 0.5
#: Rules and labelled URLs are held by every worker; larger tables are refused.
MOST_RULES, MOST_LABELLED = 1_000_000, 100_000
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: (url, 1 to block), made of words that such hosts and paths are named with and of ordinary ones."""
    subjects = "adult porn sex xxx casino poker slots bet bets pills viagra pharma spam loan ads track popup warez crack escort".split()
    manners = "free win cheap best farm x online hot deal easy".split()
    plain = "news city house garden river school science music travel food history weather sport health library museum market forum blog shop theory person station water".split()
    second = "daily open north green union first little world home press".split()
    out = []
    for i, (a, b) in enumerate(product(subjects, manners)):
        host = (f"{a}-{b}", f"{b}-{a}", f"{a}{b}", f"{b}{a}")[i % 4]
        out.append((f"https://{('', 'www.', 'm.', 'blog.')[i // 4 % 4]}{host}.{('com', 'net', 'org')[i % 3]}/{('en', 'de', 'fr', 'es')[i % 4]}/{1000 + 37 * i}", 1))
    for i, (a, b) in enumerate(product(plain, second)):
        host = (f"{a}{b}", f"{b}-{a}", a, f"{a}-{b}")[i % 4]
        out.append((f"https://{('', 'www.', 'm.', 'blog.')[i // 4 % 4]}{host}.{('com', 'net', 'org')[i % 3]}/{('en', 'de', 'fr', 'es')[i % 4]}/{1000 + 37 * i}", 0))
    # hosts of all sorts, whose pages are told apart by their paths alone; bad hosts stay bad whatever the path says
    tops = "com org net de fr es co.uk io info eu edu gov nl it at ch".split()
    known = "wikipedia github google bbc lemonde spiegel elpais nytimes python mozilla apache nasa mit stanford arxiv nature stackoverflow archive gutenberg reuters guardian zeit lefigaro marca amazon ebay microsoft apple debian kernel".split()
    syllables = "ba ke lo mi nu ra se ti vo zan kur tel mar pol ven dor gri hal fen wick".split()
    hosts = [f"{k}.{tops[i % len(tops)]}" for i, k in enumerate([*known, *plain])]
    hosts += [f"{x}{y}{syllables[(3 * i + 1) % len(syllables)] if i % 2 else ''}.{tops[i % len(tops)]}" for i, (x, y) in enumerate(product(syllables, syllables))]
    hosts = [("", "www.", "en.", "docs.", "m.", "blog.", "")[i % 7] + h for i, h in enumerate(hosts)]

    def path(i: int, a: str, b: str) -> str:
        return (f"/{a}/{b}", f"/{b}-{a}.html", f"/en/{a}-{b}/{37 * i}", f"/{a}", f"/category/{a}/{b}-{i}", f"/wiki/{a.title()}_{b.title()}", f"/{i}/{b}/{a}/index.php", f"/{b}{a}/")[i % 8]

    bad = [(a, b) for a in subjects for b in [*manners, *subjects]]
    good = [(a, b) for a in [*plain, *"about contact article page index docs guide help events people research".split()] for b in [*second, *plain]]
    for i, (a, b) in enumerate(bad):
        out.append((f"https://{hosts[17 * i % len(hosts)]}{path(i // 3, a, b)}", 1))
    for i, (a, b) in enumerate(good):
        out.append((f"https://{hosts[17 * i % len(hosts)]}{path(i // 3, a, b)}", 0))
    out += [(f"https://{h}{('/', '', '/en/12', '/2024/01/31/')[i % 4]}", 0) for i, h in enumerate(hosts)]
    for i, (a, b) in enumerate(product(subjects, manners)):
        c, d = good[13 * i % len(good)]
        out.append((f"https://{('', 'www.', 'm.')[i % 3]}{(f'{a}{b}', f'{b}-{a}')[i % 2]}.{tops[i % len(tops)]}{path(i // 2, c, d)}", 1))
    sounds = "th er on in an re nd ti es or te of ed is it al ar st to nt".split()
    for i in range(600):  # names without meaning are ordinary too
        host = "".join(sounds[(i * m + m * m) % len(sounds)] for m in (3, 7, 11)[: 2 + i % 2])
        out.append((f"http://{('', 'www.', 'm.', 'blog.')[i % 4]}{host}.example.{('com', 'net', 'org')[i % 3]}/{('en', 'de', 'fr', 'es')[i // 4 % 4]}/{500 + 91 * i}{('', '.html', '/')[i % 3]}", 0))
    for i, (a, b) in enumerate(product(subjects, manners)):
        out.append((f"http://{('', 'www.', 'm.', 'blog.')[i % 4]}{a}-{b}.example.{('com', 'net', 'org')[i % 3]}/{('en', 'de', 'fr', 'es')[i // 4 % 4]}/{500 + 91 * i}{('', '.html', '/')[i % 3]}", 1))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path on from there to ``?``, ``#`` or the end."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    stop = min((k for k in (rest.find("?"), rest.find("#")) if k >= 0), default=len(rest))
    slash = rest.find("/", 0, stop)
    cut = slash if slash >= 0 else stop
    host = rest[:cut]
    return host.lower() if host.isascii() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[cut:stop]


def features(host: str, path: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of host and path and their values: the host's and the path's each make a vector of length 1.

    Digits of paths are all alike.
    """
    parts, values = [], []
    for mark, s in ((1, f"^{host}$"), (2, "".join("0" if "0" <= c <= "9" else c for c in f"^{path}$"))):
        b = s.encode("utf-8", "replace")
        grams = {zlib.crc32(b[i : i + n], mark) % buckets for n in SIZES for i in range(len(b) - n + 1)}
        parts.append(np.fromiter(sorted(grams), np.int64, len(grams)))
        values.append(np.full(len(grams), 1 / max(1, len(grams)) ** 0.5))
    return np.concatenate(parts), np.concatenate(values)


def train(table: list[tuple[str, int]], buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """Weights and intercept of logistic regression with a ridge penalty, both classes weighing alike; always the same for the same table."""
    if len(table) > MOST_LABELLED:
        raise ValueError(f"at most {MOST_LABELLED} labelled URLs")
    y = np.array([label for _, label in table], float)
    if not 0 < y.sum() < len(y):
        raise ValueError("URLs of both labels are needed")
    found = [features(*split_url(u), buckets) for u, _ in table]
    row = np.repeat(np.arange(len(found)), [len(x) for x, _ in found])
    column, value = (np.concatenate(x) for x in zip(*found, strict=True))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, b, old_w, old_b = np.zeros(buckets), 0.0, np.zeros(buckets), 0.0
    for step in range(STEPS):  # gradient steps from a point ahead, by how far the last one went
        push = step / (step + 3)
        ahead_w, ahead_b = w + push * (w - old_w), b + push * (b - old_b)
        p = 1 / (1 + np.exp(-(np.bincount(row, ahead_w[column] * value, len(y)) + ahead_b)))
        g = share * (p - y)
        old_w, old_b = w, b
        w = ahead_w - RATE * (np.bincount(column, g[row] * value, buckets) + PENALTY * ahead_w)
        b = ahead_b - RATE * g.sum()
    return w, b


def score(weights: np.ndarray, intercept: float, host: str, path: str) -> float:
    x, value = features(host, path, len(weights))
    return float(1 / (1 + np.exp(-(weights[x] @ value + intercept))))


class Rules:
    """Rules by host: one fits its host and all below it, if the path starts with the rule's; the longest wins, then the first by name."""

    def __init__(self, rules):
        if len(rules) > MOST_RULES:
            raise ValueError(f"at most {MOST_RULES} rules")
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, at = (0, "", ""), 0
        while True:
            for start, rule, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(start) and (not best[1] or (-len(rule), rule) < best[:2]):
                    best = (-len(rule), rule, verdict)
            at = host.find(".", at) + 1
            if not at:
                return (best[1], best[2]) if best[1] else (None, None)


def judge(pages: DataFrame, rules=RULES, table: list[tuple[str, int]] | None = None, threshold: float = THRESHOLD, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """Per page: page_id, host, path, rule (or null), verdict (allow or block), score (the model's, that of a rule's page too).

    A null url, or one without ``://``, has an empty host and path and is left to the model. Repeated rows are judged alike;
    other columns are ignored.
    """
    weights, intercept = train(table if table is not None else labelled_urls())
    held, known = pages.sparkSession.sparkContext.broadcast(weights.astype(np.float32)), Rules(rules)
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = held.value
        for batch in batches:
            rows = []
            for u in batch.column("url").to_pylist():
                host, path = split_url(u)
                rule, verdict = known.find(host, path)
                s = score(weights, intercept, host, path)
                rows.append((host, path, rule, verdict or ("block" if s >= threshold else "allow"), s))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array(c, pa.string()) for c in columns[:4]), pa.array(columns[4], pa.float64())], ["page_id", "host", "path", "rule", "verdict", "score"])

    kind = own.schema["page_id"].dataType.simpleString()
    return own.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
