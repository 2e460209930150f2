"""URL verdicts: host and path rules, and boosted trees where no rule fits.

A rule is a host and a path prefix with a verdict; it fits its host and all
subdomains, and the longest fitting rule wins. URLs that a rule fits are the
labelled ones. Gradient-boosted trees over lexical features (lengths, depth,
digit ratio, entropy, parameter counts, suffix statistics) learn from them and
judge the rest.

The rows stay in Spark's own expressions throughout: features are columns, the
labelled sample is cut into quantile bins and summed per cell by Spark, and the
trees are scored as CASE expressions. Only the cells of at most ``train_rows``
labelled URLs (those with the smallest hashes) reach the driver, where the trees
are grown from them.

Suffix statistics cover all labelled URLs and every suffix, as a table that is
joined. Hosts are dealt to ``FOLDS`` folds, and a URL that is learned from is given the
statistics of the other folds, so its own label is not among its features.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits
no rule and is judged by the trees like any other. Without labelled rows of both
verdicts every other URL gets the commoner verdict, or ``allow`` where there is
none. Repeated URLs get the same verdict. An empty table gives an empty result.
Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import written

BLOCK, ALLOW = "block", "allow"
BINS = 8
TREES, DEPTH, RATE, LEAST = 24, 3, 0.3, 5.0
#: Parts of the hosts; a labelled URL sees the suffix statistics of the other parts.
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = after_scheme(url)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text and verdict of the longest rule that fits, or null."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (len(r.text), r.text), reverse=True)
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<text:string,verdict:string>"))


def occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits per character of the character frequencies."""
    total = F.length(text)
    shares = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (total - F.length(F.replace(text, c, F.lit("")))) / F.greatest(total, F.lit(1)),
    )
    return F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy",
    "parameters", "query_length", "suffix_block_rate",
)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Feature columns, all but the suffix statistic."""
    shown = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(shown, r"(?s)\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(shown, "[^0-9]", ""))
    numbers = {
        "url_length": F.length(shown),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": occurrences(path, "/"),
        "labels": occurrences(host, "."),
        "digit_ratio": digits / F.greatest(F.length(shown), F.lit(1)),
        "hyphens": occurrences(host, "-"),
        "entropy": entropy(shown),
        "parameters": occurrences(query, "="),
        "query_length": F.length(query),
    }
    return {name: c.cast("double") for name, c in numbers.items()}


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """Labelled and blocked URLs per suffix and fold, summed ahead of the shuffle."""
    return labelled.groupBy("__suffix", "__fold").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__y").alias("__blocked")
    )


def grow_trees(cells: np.ndarray, rows: np.ndarray, blocked: np.ndarray) -> tuple[float, list[dict]]:
    """Boosted trees for the logistic loss over binned cells.

    ``cells`` holds a bin per feature; ``rows`` and ``blocked`` how many URLs fall
    into the cell. Returns the starting log-odds and the trees.
    """
    share = (blocked.sum() + 0.5) / (rows.sum() + 1.0)
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(cells), base), []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = blocked - rows * chance, rows * chance * (1 - chance)

        def grow(chosen: np.ndarray, depth: int, slope=slope, bend=bend) -> dict:
            total, weight = slope[chosen].sum(), bend[chosen].sum()
            leaf = {"value": float(RATE * total / (weight + 1.0))}
            best, where = 1e-6, None
            for f in range(cells.shape[1]) if depth else ():
                g = np.bincount(cells[chosen, f], slope[chosen], BINS + 1).cumsum()
                h = np.bincount(cells[chosen, f], bend[chosen], BINS + 1).cumsum()
                n = np.bincount(cells[chosen, f], rows[chosen], BINS + 1).cumsum()
                gain = g**2 / (h + 1) + (total - g) ** 2 / (weight - h + 1) - total**2 / (weight + 1)
                gain[(n < LEAST) | (n[-1] - n < LEAST)] = 0
                if gain.max() > best:
                    best, where = gain.max(), (f, int(gain.argmax()))
            if where is None:
                return leaf
            left = cells[chosen, where[0]] <= where[1]
            return {
                "feature": where[0], "bin": where[1],
                "left": grow(chosen[left], depth - 1), "right": grow(chosen[~left], depth - 1),
            }

        tree = grow(np.arange(len(cells)), DEPTH)
        trees.append(tree)
        score = score + np.array([tree_value(tree, c) for c in cells])
    return base, trees


def tree_value(tree: dict, cell: np.ndarray) -> float:
    while "value" not in tree:
        tree = tree["left"] if cell[tree["feature"]] <= tree["bin"] else tree["right"]
    return tree["value"]


def tree_column(tree: dict, bins: Sequence[Column]) -> Column:
    if "value" in tree:
        return F.lit(tree["value"])
    left, right = (tree_column(tree[side], bins) for side in ("left", "right"))
    return F.when(bins[tree["feature"]] <= tree["bin"], left).otherwise(right)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    train_rows: int = 20_000,
    unseen: Column | None = None,
) -> DataFrame:
    """key, host, path, rule, verdict, score (chance of ``block`` by the trees).

    Labelled URLs for which ``unseen`` holds (a condition on ``host`` and ``path``)
    are not learned from, so that their scores measure the trees.
    """
    slim = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    parted = slim.withColumns({"host": host, "path": path})
    ruled = parted.withColumn("__fits", fitting_rule(F.col("host"), F.col("path"), rules)).select(
        "__key", "__url", "host", "path", F.col("__fits.text").alias("rule"), F.col("__fits.verdict").alias("__ruled")
    )
    parted_by = ruled.withColumns(
        {"__suffix": suffix(F.col("host")), "__fold": F.pmod(F.xxhash64("host"), F.lit(FOLDS))}
    )
    labelled = parted_by.filter("__ruled IS NOT NULL").withColumn("__y", (F.col("__ruled") == BLOCK).cast("long"))
    if unseen is not None:
        labelled = labelled.filter(~F.coalesce(unseen, F.lit(False)))
    counts = written(suffix_counts(labelled), "suffix-counts")
    sample = written(
        labelled.orderBy(F.xxhash64("__url"), "__url", "__key")
        .limit(train_rows)
        .select("__url", "host", "path", "__suffix", "__fold", "__y"),
        "labelled-urls",
    )
    of_all = counts.groupBy("__suffix").agg(F.sum("__n").alias("__n"), F.sum("__blocked").alias("__blocked"))

    def featured(df: DataFrame) -> DataFrame:
        """``df`` has the rows' counts in ``__n`` and ``__blocked``, null for an unknown suffix."""
        rate = F.coalesce((F.col("__blocked") + 1) / (F.col("__n") + 2), F.lit(0.5))
        found = lexical(F.col("__url"), F.col("host"), F.col("path")) | {"suffix_block_rate": rate}
        return df.withColumns({f"__{name}": found[name] for name in FEATURES})

    shares = [i / BINS for i in range(BINS + 1)]
    own = counts.withColumnsRenamed({"__n": "__own_n", "__blocked": "__own_blocked"})
    learned = featured(
        sample.join(of_all, "__suffix", "left")
        .join(own, ["__suffix", "__fold"], "left")
        .withColumns({f"__{c}": F.col(f"__{c}") - F.coalesce(f"__own_{c}", F.lit(0)) for c in ("n", "blocked")})
    )
    quantiles = learned.agg(*[F.percentile_approx(f"__{n}", shares, 10_000).alias(n) for n in FEATURES]).first()
    # Cuts lie half-way between quantiles, so that new values fall to the nearer side.
    held = [sorted(set(quantiles[n] or [])) for n in FEATURES]
    edges = [[(a + b) / 2 for a, b in zip(values, values[1:], strict=False)] for values in held]

    def bin_of(name: str, cuts: Sequence[float]) -> Column:
        """How many cuts lie below the value."""
        return sum(((F.col(f"__{name}") > cut).cast("int") for cut in cuts), F.lit(0))

    bins = {f"__bin_{n}": bin_of(n, cuts) for n, cuts in zip(FEATURES, edges, strict=True)}
    cells = (
        learned.withColumns(bins)
        .groupBy(*bins)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("blocked"))
        .orderBy(*bins)
        .collect()
    )
    if cells:
        grid = np.array([[c[b] for b in bins] for c in cells])
        base, trees = grow_trees(grid, np.array([float(c["n"]) for c in cells]), np.array([float(c["blocked"]) for c in cells]))
    else:
        base, trees = -1.0, []
    judged = featured(parted_by.join(of_all, "__suffix", "left")).withColumns(bins)
    margin = sum((tree_column(t, [F.col(b) for b in bins]) for t in trees), F.lit(base))
    judged = judged.withColumn("score", 1 / (1 + F.exp(-margin)))
    verdict = F.coalesce("__ruled", F.when(F.col("score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return judged.select(F.col("__key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "score")
