"""URL filters: rules by host and path, and logistic regression for the rest.

The model sees hashed character n-grams of the host and of the path, told apart by a mark. It
learns from a small labelled table, by default from a sample of the URLs that rules decide:
at most about SAMPLE_ROWS distinct pairs of host and path, half of them per verdict, chosen by
a hash of both, so copies of a URL change nothing. Weights are BUCKETS numbers; they travel
with the tasks. Host, path and rules are plain column expressions.

A null URL or one without `://` has an empty host and path, which the model judges too. With
no labelled URL, or labels of one kind only, the verdict is that kind, or `allow` if none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.staging import inputs

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
SAMPLE_ROWS = 4000
#: Steps and strength of the fit.
STEPS = 200
RATE = 0.5
PENALTY = 1e-4


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


# The rules that the query applies.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part behind the first `://` up to `/`, `?` or `#`, A-Z in lower case; then up to `?` or `#`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def decided(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.host + rule.path).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each URL, and the bounds of each URL in them."""
    parts = [f"\x02{h}\x03{p}\x04".encode() for h, p in zip(hosts, paths, strict=True)]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data))
    path_starts = starts + np.fromiter((len(h.encode()) + 1 for h in hosts), np.int64, len(parts))
    in_path = place >= np.repeat(path_starts, sizes)
    left = np.repeat(starts + sizes, sizes) - place
    out = np.full((len(data), len(ORDERS)), -1, np.int64)
    for j, order in enumerate(ORDERS):
        value = in_path.astype(np.uint64) + np.uint64(16 * order)
        for k in range(order):
            value = texts.mix(value + np.roll(data, -k))
        out[:, j] = np.where(left >= order, (value >> np.uint64(40)).astype(np.int64) % BUCKETS, -1)
    keep = out >= 0
    counts = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])
    return out[keep], counts[np.concatenate([starts, [len(data)]])]


@dataclass
class Model:
    weights: np.ndarray
    offset: float

    def margin(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Log-odds of `block`."""
        at, bounds = features(hosts, paths)
        return _means(self.weights[at], bounds) + self.offset


def _means(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over each URL's n-grams, scaled by the root of their number."""
    return np.add.reduceat(np.append(values, 0.0), bounds[:-1]) / np.sqrt(np.diff(bounds)) if len(bounds) > 1 else np.empty(0)


def fit(hosts: list[str], paths: list[str], block: np.ndarray) -> Model:
    """Logistic regression by gradient descent with step sizes per weight."""
    if not len(block) or block.all() or not block.any():
        return Model(np.zeros(BUCKETS), 1.0 if len(block) and block.all() else -1.0)
    at, bounds = features(hosts, paths)
    owner = np.repeat(np.arange(len(block)), np.diff(bounds))
    scale = 1 / np.sqrt(np.diff(bounds))
    weights, offset, seen, seen_offset = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    # Both kinds weigh the same.
    share = np.where(block, 0.5 / block.mean(), 0.5 / (1 - block.mean())) / len(block)
    for _ in range(STEPS):
        error = (1 / (1 + np.exp(-(_means(weights[at], bounds) + offset))) - block) * share
        slope = np.bincount(at, (error * scale)[owner], BUCKETS) + PENALTY * weights
        seen += slope**2
        seen_offset += error.sum() ** 2
        weights -= RATE * slope / np.sqrt(seen)
        offset -= RATE * error.sum() / np.sqrt(seen_offset)
    return Model(weights, offset)


def labelled_sample(pages: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(url, label): URLs that rules decide, with their verdicts; about `sample_rows` distinct ones, cut to host and path."""
    host, path = host_and_path(F.col("url"))
    rows = inputs(pages, url=url_col).select(host.alias("host"), path.alias("path"))
    rows = rows.withColumn("label", decided(F.col("host"), F.col("path"), rules)[1]).where("label IS NOT NULL")
    # 53 bits, as many as a share has.
    rows = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64("host", "path"), 11))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.countDistinct("place").alias("n")).collect()}
    share = F.lit(0.0)
    for label, count in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, sample_rows / 2 / count)).otherwise(share)
    chosen = rows.where(F.col("place") < share * (1 << 53)).select("host", "path", "label").distinct()
    return chosen.select(F.concat(F.lit("://"), "host", "path").alias("url"), "label")


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the model to a small table (url, label); refuses one that is not small."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.select(host.alias("host"), path.alias("path"), F.col("label")).distinct().limit(4 * sample_rows + 1).collect()
    if len(rows) > 4 * sample_rows:
        raise ValueError("the labelled table is too large; sample it")
    rows.sort()
    return fit([r.host for r in rows], [r.path for r in rows], np.array([r.label == "block" for r in rows], bool))


def judged(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id_col, host, path, rule, verdict, score) per row; the score is the model's probability of `block`."""
    rows = inputs(pages, id=id_col, url=url_col)
    host, path = host_and_path(F.col("url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "path"):
            margin = model.margin(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-margin)))], ["id", "host", "path", "score"])

    scored = rows.mapInArrow(run, f"id {kind}, host string, path string, score double")
    rule, verdict = decided(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")
