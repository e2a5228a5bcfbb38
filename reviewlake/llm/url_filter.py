"""URL filters: allow and block rules, and a trained model for the rest.

The model is a logistic regression on hashed character n-grams of host and
path, fitted in numpy on the small labelled table below. Rules decide first:
a rule fits its host and all subdomains where the path starts with the rule's
path; the longest rule wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.words import BASE, U64, mix, numbers, string_slices

# Sites labelled by hand, as (name, path). Each is taken under every domain, so that
# the table teaches names and paths and no domain leans to either side.
DOMAINS = ("com", "net", "org", "info", "edu", "de")
ALLOW_SITES = [
    ("www", "/articles/history-of-rome"), ("docs", "/guide/install"), ("news", "/2021/05/science-report"),
    ("blog", "/posts/gardening-tips"), ("library", "/catalog/book/1284"), ("en.wiki", "/wiki/Mathematics"),
    ("forum", "/t/how-to-fix-a-bike/912"), ("university", "/courses/physics"), ("museum", "/en/collection"),
    ("recipes", "/soup/lentil"), ("weather", "/de/berlin"), ("journal", "/papers/2019/17"), ("shop", "/books/novels"),
    ("travel", "/fr/paris"), ("health", "/advice/sleep"), ("code", "/project/readme"), ("m", "/es/noticias/25"),
    ("school", "/lessons/reading"), ("city", "/services/parks"), ("radio", "/shows/jazz"), ("archive", "/letters/1890"),
    ("www", "/about"), ("maps", "/trails/north"), ("www", "/en/page/310"), ("data", "/census/tables"),
    ("teacher", "/notes/algebra"), ("films", "/reviews/drama"), ("site7", "/de/artikel/77"), ("farm", "/fr/legumes"),
    ("law", "/acts/1999"), ("site12", "/en/25"), ("site3", "/fr/140"), ("site40", "/es/8"), ("site25", "/de/1203"),
    ("www", "/"), ("garden", "/plants/roses.html"), ("sports", "/results/2020/final"), ("music", "/albums/live"),
]
BLOCK_SITES = [
    ("free-casino-bonus", "/win"), ("best-poker-slots", "/jackpot"), ("cheap-pills-online", "/buy-now"),
    ("xxx-videos", "/adult/hot"), ("porn-tube", "/sex/live"), ("win-lottery-now", "/claim-prize"),
    ("crack-download", "/keygen/free"), ("warez-torrent", "/full-movie-free"), ("earn-money-fast", "/bitcoin-doubler"),
    ("replica-watches", "/cheap/sale"), ("payday-loans", "/instant-cash"), ("hot-singles", "/dating/click"),
    ("betting-odds", "/casino/signup-bonus"), ("viagra-cialis", "/order"), ("free-gift-card", "/winner/survey"),
    ("login-verify-account", "/secure/update"), ("seo-backlinks", "/buy/links"), ("miracle-diet", "/lose-weight-fast"),
    ("adult-cams", "/xxx/live"), ("clickbait", "/you-wont-believe"), ("hacked-cheats", "/aimbot/download"),
    ("slots", "/free-spins"), ("escort-girls", "/sexy"), ("pirate-movies", "/watch-free-stream"),
    ("cheap-followers", "/buy-likes"), ("crypto-giveaway", "/claim-now"), ("casino-royal", "/poker/bonus"),
    ("nude-pics", "/porn"), ("spam-mailer", "/bulk-email"), ("fake-designer", "/outlet-sale"),
    ("m", "/casino/free-spins"), ("www", "/porn/videos/xxx"), ("online-poker", "/bonus/signup"), ("sex-chat", "/adult/cams"),
    ("cheap-viagra", "/pills/order"), ("free-slots", "/jackpot/win"), ("instant-loans", "/payday/cash"), ("torrent-crack", "/warez/keygen"),
]
#: (host, path, label) with 1: block.
LABELLED = [(f"{name}.example.{d}", path, y) for y, sites in ((0, ALLOW_SITES), (1, BLOCK_SITES))
            for name, path in sites for d in DOMAINS]
#: (verdict, host, path) of the production rules.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
SIZES, BUCKETS = (3, 4, 5), 1 << 14
_HOST, _PATH = numbers(41, 256), numbers(43, 256)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for null or without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; of equals the first listed. Null where none fits."""
    order = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in reversed(order):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _grams(col: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram; strings count with a mark at each end."""
    rows, at = [], []
    for lo, _, data, off in string_slices(col):
        n = len(off) - 1
        wide = np.zeros(len(data) + 2 * n, np.uint8)                  # one zero byte before and after
        inside = np.ones(len(wide), bool)
        start = off[:-1] + 2 * np.arange(n)
        end = off[1:] + 2 * np.arange(n) + 1
        inside[start] = inside[end] = False
        wide[inside] = data
        row = np.repeat(np.arange(n), np.diff(off) + 2)
        last = end[row]
        h = table[wide]
        for size in SIZES:
            m = len(wide) - size + 1
            if m <= 0:
                continue
            with np.errstate(over="ignore"):
                acc = h[:m].copy()
                for j in range(1, size):
                    acc = acc * BASE + h[j:j + m]
                acc = mix(acc + U64(size))
            ok = np.arange(m) + size - 1 <= last[:m]
            rows.append(lo + row[:m][ok])
            at.append((acc[ok] % U64(BUCKETS)).astype(np.int64))
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(rows), cat(at)


class UrlModel:
    """Weights by bucket; a URL's n-grams share a vector of length one."""

    def __init__(self):
        self.w, self.bias = np.zeros(BUCKETS), 0.0

    @staticmethod
    def features(host: pa.Array, path: pa.Array):
        (r1, a1), (r2, a2) = _grams(host, _HOST), _grams(path, _PATH)
        row, at = np.concatenate((r1, r2)), np.concatenate((a1, a2))
        n = np.bincount(row, minlength=len(host))
        return row, at, 1 / np.sqrt(np.maximum(n, 1))

    def probability(self, host: pa.Array, path: pa.Array, features=None) -> np.ndarray:
        row, at, scale = features or self.features(host, path)
        z = np.bincount(row, self.w[at], minlength=len(host)) * scale + self.bias
        return 1 / (1 + np.exp(-z))

    def fit(self, host: list[str], path: list[str], y: np.ndarray, steps: int = 600, rate: float = 4.0,
            l2: float = 1e-4) -> UrlModel:
        feats = self.features(pa.array(host), pa.array(path))
        row, at, scale = feats
        for _ in range(steps):
            d = (self.probability(host, path, feats) - y) / len(y)
            g = np.bincount(at, (d * scale)[row], minlength=BUCKETS) + l2 * self.w
            self.w -= rate * g
            self.bias -= rate * d.sum()
        return self


def train(labelled: list[tuple[str, str, int]] = LABELLED) -> UrlModel:
    """Fit on a table of (host, path, label), a driver-side list, small by definition."""
    host, path, y = zip(*labelled)
    return UrlModel().fit([h.lower() for h in host], list(path), np.array(y, float))


def _judge(model: UrlModel, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.probability(b.column(names[0]), b.column(names[1]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=[*b.schema.names, names[2]])
    return run


def judge(pages: DataFrame, url_col: str = "url", *, rules: list[tuple[str, str, str]] = RULES,
          model: UrlModel | None = None) -> DataFrame:
    """``pages`` plus host, path, rule, score (of block) and verdict.

    Null URLs and those without ``://`` have an empty host and path: no rule
    fits and the model judges the empty strings. Every row is judged by
    itself. Columns that have one of the new names are replaced.
    """
    new = ["host", "path", "rule", "score", "verdict"]
    host, path = host_and_path(F.col(f"`{url_col}`"))
    same = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in new]
    split = pages.select(*same, host.alias("host"), path.alias("path"))
    schema = T.StructType([*split.schema.fields, T.StructField("score", T.DoubleType())])
    scored = split.mapInArrow(_judge(model or train(), ["host", "path", "score"]), schema)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(verdict, learned)})
