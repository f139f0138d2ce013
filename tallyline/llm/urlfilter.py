"""URL filter: host and path rules first, then logistic regression on hashed character n-grams of host and path.

The model is learnt from a small labelled table of URLs: at most `most_labelled` rows (in the order of a hash of the URL, so a larger
table gives a fixed sample) reach the driver, where all weights are fitted at once. Every URL of the table to judge is scored.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; path: from there up to `?`, `#` or the end. A rule fits its
host and all subdomains if the URL's path starts with the rule's; the longest fitting rule wins, then the first in the list.

Defined results: a null URL, or one without `://`, has an empty host and path and is judged by the model's intercept. Repeated rows
get equal results, null ids are kept, extra columns are not read. With one label only, or none, the model allows everything that the
rules do not block.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyline.llm.words import U64, mix

BUCKETS, SIZES, RIDGE, STEPS, MOST_LABELLED = 1 << 14, (3, 4, 5), 1e-3, 400, 5000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# fixed values: the rules of the registered query
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
# words of which the small labelled table is made
BLOCKED = "casino pills adult bets spam ads-track warez payday replica lottery poker xxx".split()
ALLOWED = "news library garden weather science history recipes travel music school museum blog wiki forum city books".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table (url, blocked): hosts made of one word and a plain part, over common endings and paths."""
    parts, ends, paths = ("win", "online", "best"), ("com", "net", "org"), ("/en/1", "/de/20.html", "/fr/", "/index.html")
    rows = []
    for label, stems in ((1, BLOCKED), (0, ALLOWED)):
        for k, (stem, part) in enumerate(product(stems, parts)):
            host = f"{stem}.{ends[k % 3]}" if k % 4 == 0 else f"{stem}-{part}.{ends[k % 3]}" if k % 2 else f"www.{part}-{stem}.{ends[k % 3]}"
            rows.append((f"http://{host}{paths[k % 4]}", label))
    return spark.createDataFrame(rows, "url string, blocked int")


def host_of(url: str = "url") -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def features(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram buckets of one URL (host and path have buckets of their own) and their weights, of length one together."""
    found = []
    for space, text in ((U64(1), f"^{host}$"), (U64(2), f"^{path}$")):
        codes = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(U64)
        for size in SIZES:
            n = max(0, len(codes) - size + 1)
            gram = np.full(n, space)
            for k in range(size):
                gram = (gram << U64(8)) | codes[k : k + n]
            found.append(mix(gram))
    bucket, n = np.unique((np.concatenate(found) % U64(BUCKETS)).astype(np.int64), return_counts=True)
    weight = np.sqrt(n)
    return bucket, weight / max(1.0, np.linalg.norm(weight))


def fit(labelled: DataFrame, most_labelled: int = MOST_LABELLED) -> np.ndarray:
    """Weights of the buckets, and the intercept last: ridge logistic regression by accelerated gradient steps from zero."""
    rows = labelled.where("blocked is not null").select("url", host_of().alias("host"), path_of().alias("path"), "blocked")
    rows = rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(most_labelled).collect()
    weights = np.zeros(BUCKETS + 1)
    labels = np.array([float(r["blocked"]) for r in rows])
    if len(set(labels)) < 2:
        weights[-1] = -10.0
        return weights
    matrix = np.zeros((len(rows), BUCKETS + 1), np.float32)
    for k, r in enumerate(rows):
        bucket, value = features(r["host"], r["path"])
        matrix[k, bucket] = value
    matrix[:, -1] = 1.0
    used = np.flatnonzero(matrix.any(axis=0))
    x = matrix[:, used].astype(float)
    ridge = np.where(used == BUCKETS, 0.0, RIDGE)
    w = ahead = np.zeros(len(used))
    rate = 4.0 / (np.linalg.norm(x, 2) ** 2 / len(x) + 4 * RIDGE)
    for k in range(STEPS):
        p = 1.0 / (1.0 + np.exp(-x @ ahead))
        new = ahead - rate * (x.T @ (p - labels) / len(x) + ridge * ahead)
        w, ahead = new, new + k / (k + 3) * (new - w)
    weights[used] = w
    return weights


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule (text of the winning rule, else null), verdict, score (the model's probability of block)."""
    weights = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession)).astype(np.float32)

    @F.pandas_udf("double")
    def probability(host: pd.Series, path: pd.Series) -> pd.Series:
        def one(h: str, p: str) -> float:
            bucket, value = features(h, p) if h or p else (np.zeros(0, np.int64), np.zeros(0))
            return 1.0 / (1.0 + np.exp(-(float(weights[bucket] @ value) + float(weights[-1]))))

        return pd.Series([one(h, p) for h, p in zip(host, path, strict=True)], dtype=float)

    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the last condition put on top wins, so the longest rules come last, and of equal ones the first in the list
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    told = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    told = told.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("score", probability("host", "path"))
    model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return told.select("page_id", "host", "path", "rule", F.coalesce("ruled", model).alias("verdict"), "score")
