"""URL filters: rules on hosts and paths, then gradient-boosted trees on lexical features.

The rules label URLs: block, allow, and unlisted, which counts as allowed as long
as nothing speaks against it.  The trees learn from a bounded sample of each, with
weights that restore their shares, and judge the unlisted by length, depth, digits,
entropy, parameters, and how often pages under the host's last label, and under the path's
first segment, are blocked, counted over all pages.  Statistics of longer suffixes would
tell listed hosts apart so well that nothing was learnt about others.

URLs are dealt into FOLDS parts by a hash.  The trees, and the counts under suffixes,
that judge a part come from the other parts only, so that no URL is judged by what was
learnt from itself; accuracy() says how such verdicts agree with the rules' labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exchange import spread
from .repetition import per_row
from .words import raw

#: URLs of each label that the trees are fitted on, at most.
SAMPLE = 5000
TREES, DEPTH, SEED = 12, 4, 5
#: Tasks that a round of fitting takes.
PARTS = 4
FOLDS = 2
#: What pages are counted for: the host's last label and the path's first segment.
COUNTED = ("suffix", "segment")
#: Pseudo-counts that draw a block rate to the overall rate, and pages that a rate needs: that of fewer would tell a URL's own label.
SMOOTH, FEWEST = 20.0, 50
STEP_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


RULES = [Rule("block", "com", "/en/"), Rule("allow", "example.com", "/en/7"), Rule("block", "net", "/de/"), Rule("block", "example.net", "/de/8"), Rule("block", "org", "/es/")]

NAMES = ["length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "labels", "fragment", "secure"]


def host(url: str) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def decide(rules: list[Rule], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def counted(name: str) -> Column:
    """Of host and path, what pages are counted for."""
    return {"suffix": F.substring_index("host", ".", -1), "segment": F.regexp_extract("path", "^/([^/]*)", 1)}[name]


def lexical(urls: pa.Array, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
    """A row of NAMES for each URL."""
    data, at = raw(urls)
    n, length = len(urls), np.diff(at)
    byte = lambda chars: np.isin(data, np.frombuffer(chars, np.uint8))
    _, host_at = raw(hosts)
    path_data, path_at = raw(paths)
    host_data, _ = raw(hosts)
    entropy = np.zeros(n)
    row = np.repeat(np.arange(n), length)
    pairs, times = np.unique(row * 256 + data, return_counts=True)
    share = times / np.maximum(length, 1)[pairs // 256]
    entropy = np.bincount(pairs // 256, -share * np.log2(share), n) if n else entropy
    secure = np.array([u is not None and u[:6].lower() == "https:" for u in urls.to_pylist()], float)
    return np.column_stack([
        length, np.diff(host_at), np.diff(path_at), per_row(path_at, path_data == ord("/")), per_row(at, byte(b"0123456789")) / np.maximum(length, 1), entropy,
        per_row(at, byte(b"?&")), per_row(at, byte(b"-")), per_row(host_at, host_data == ord(".")) + (np.diff(host_at) > 0), per_row(at, byte(b"#")) > 0, secure,
    ]).astype(float)


def add_features(rows: DataFrame) -> DataFrame:
    """rows (url, host, path and others) with `lexical`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spread(batch["url"], STEP_BYTES):
                part = batch.slice(a, b - a)
                table = lexical(part["url"], part["host"], part["path"])
                yield part.append_column("lexical", pa.FixedSizeListArray.from_arrays(pa.array(table.reshape(-1)), len(NAMES)).cast(pa.list_(pa.float64())))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("lexical", T.ArrayType(T.DoubleType()))]))


def _judged(pages: DataFrame, rules: list[Rule], key: str, url: str, sample: int) -> DataFrame:
    """key, url, host, path, decision and p, the trees' chance of block, for every row."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host(url).alias("host"), path(url).alias("path"))
    rows = rows.withColumn("decision", decide(rules, F.col("host"), F.col("path"))).withColumn("fold", F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), F.lit("fold")), F.lit(FOLDS)).cast("int"))
    given = rows.where("url IS NOT NULL").withColumn("verdict", F.coalesce("decision.verdict", F.lit("unlisted")))
    counts = {(r.fold, r.verdict): r["count"] for r in given.groupBy("fold", "verdict").count().collect()}
    blocked = (F.col("verdict") == "block").cast("long")
    rates = []
    for k in COUNTED:
        g = given.groupBy(counted(k).alias(k), "fold").agg(F.sum(blocked).alias("b"), F.count(F.lit(1)).alias("n"))
        rates.append(g.groupBy(k).agg(F.collect_list(F.struct("fold", "b", "n")).alias(f"known_{k}")))  # an entry per fold

    def with_rates(df: DataFrame, fold: int, rate: float) -> DataFrame:
        """df with what COUNTED names, and the block rate (rate_) of each outside the fold."""
        for k, known in zip(COUNTED, rates, strict=True):
            other = F.filter(F.coalesce(f"known_{k}", F.array().cast("array<struct<fold:int,b:bigint,n:bigint>>")), lambda x: x["fold"] != fold)
            total = lambda c, o=other: F.aggregate(o, F.lit(0).cast("long"), lambda s, x: s + x[c])
            df = df.withColumn(k, counted(k)).join(known, k, "left").withColumn(f"rate_{k}", F.when(total("n") >= FEWEST, (total("b") + SMOOTH * rate) / (total("n") + SMOOTH)).otherwise(rate)).drop(f"known_{k}")
        return df

    def share(fold: int) -> float:
        n = sum(c for (f, _), c in counts.items() if f != fold)
        return sum(c for (f, v), c in counts.items() if f != fold and v == "block") / n if n else 0.0

    vector = array_to_vector(F.concat("lexical", F.array(F.col("rate_suffix"), F.col("rate_segment"), F.length("suffix").cast("double"))))
    picked = None
    for f, v in sorted(counts):
        one = given.where((F.col("fold") == f) & (F.col("verdict") == v)).groupBy("url", "host", "path", "fold", "verdict").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.xxhash64("url"), "url").limit(sample)
        picked = one if picked is None else picked.unionByName(one)
    if picked is None or not any(0 < share(f) < 1 for f in range(FOLDS)):
        return rows.withColumn("p", F.lit(0.0))
    labelled = add_features(picked).withColumn("label", (F.col("verdict") == "block").cast("double")).coalesce(PARTS).persist()
    try:
        # each URL stands for its rows, and those of a fold's label for all rows of it
        weight = F.lit(1.0)
        for r in labelled.groupBy("fold", "verdict").agg(F.sum("n_rows").alias("n")).collect():
            weight = F.when((F.col("fold") == r.fold) & (F.col("verdict") == r.verdict), F.col("n_rows") * (counts[r.fold, r.verdict] / r.n)).otherwise(weight)

        def fit(fold: int):
            if not 0 < share(fold) < 1:
                return None
            # few rows: joined to rates they'd be in as many parts as a shuffle has, each a task in every round of every tree
            examples = with_rates(labelled.where(F.col("fold") != fold), fold, share(fold)).select("label", weight.alias("weight"), vector.alias("features")).repartition(PARTS)
            return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32, weightCol="weight").fit(examples)

        with ThreadPoolExecutor(FOLDS) as pool:
            models = list(pool.map(fit, range(FOLDS)))
    finally:
        labelled.unpersist()
    out = None
    for fold, model in enumerate(models):
        part = rows.where(F.col("fold") == fold)
        if model is None:
            part = part.withColumn("p", F.lit(0.0))
        else:
            part = model.transform(add_features(with_rates(part, fold, share(fold))).withColumn("features", vector)).withColumn("p", F.element_at(_array(F.col("probability")), 2))
        part = part.select("key", "url", "host", "path", "decision", "p")
        out = part if out is None else out.unionByName(part)
    return out


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None, key: str = "page_id", url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """key, host, path, rule (null if none fits), verdict (allow or block) and block_score (null where a rule decides).

    The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z
    lower-cased; the path follows up to `?`, `#` or the end.  A rule fits its host and
    all subdomains if the path starts with the rule's; the longest wins.

    Null URL or none with `://`: empty host and path, judged by the trees.  If the
    rules block no URL, or all, the trees can't be fitted and the rest is allowed.
    Keys are carried along, null and repeated ones too; a repeated URL counts as often
    as it occurs.  Further columns don't matter.  Empty table: empty result.
    """
    judged = _judged(pages, RULES if rules is None else rules, key, url, sample)
    verdict = F.coalesce("decision.verdict", F.when(F.col("p") > 0.5, "block").otherwise("allow"))
    return judged.select(F.col("key").alias(key), "host", "path", F.col("decision.rule").alias("rule"), verdict.alias("verdict"), F.when(F.col("decision").isNull(), F.col("p")).alias("block_score"))


def accuracy(pages: DataFrame, rules: list[Rule] | None = None, key: str = "page_id", url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """(label, rows, blocked): of the rows that the rules block, allow or leave unlisted, how many the trees that haven't seen them would block."""
    judged = _judged(pages, RULES if rules is None else rules, key, url, sample).where("url IS NOT NULL")
    return judged.groupBy(F.coalesce("decision.verdict", F.lit("unlisted")).alias("label")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p") > 0.5).alias("blocked"))


def _array(vector: Column) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(vector)
