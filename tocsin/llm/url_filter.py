"""URL verdicts from rules, and where none fits from two character models.

Rules name a host, with all its subdomains, and the start of a path; the longest
that fits wins. URLs that rules allow or block also teach two Markov models of
variable order: the chance of a character after the ``order`` characters before it,
smoothed towards that after one character less, down to an even chance. A URL's score
is the mean over its characters of the difference in log-likelihood, so long URLs
weigh no more than short ones. One in five known URLs is kept out of the counts; the
threshold is where these are told apart best.

Counts are folded in the tasks and summed by Spark over all URLs. The model is a table of
all runs of characters seen ``least`` times or more, at any number of pages. It is never
gathered or broadcast: the distinct runs of the URLs are joined with it, and every URL's
runs with their log ratios. Ratios are summed as whole multiples of ``1 / UNIT``, so that
no score depends on the order of rows.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no
rule and scores 0; without known URLs of both kinds every other URL is allowed; rows
that repeat are judged each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.llm.common import map_arrow, stored

#: Fixed values of the contract: verdict, and host and path of the rule.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BINS = 400
UNIT = 1 << 40


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules: list[tuple[str, str]], value: bool) -> Column:
    """The longest rule that fits, or its verdict; null if none does."""
    found = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(verdict if value else text)).otherwise(found)
    return found


def known(pages: DataFrame, rules: list[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """URL text, the rule's verdict (1 allow, 0 block) and whether it is kept for calibration."""
    url = F.col(url_col)
    verdict = rule(host(url), path(url), rules, True)
    rows = pages.select(F.coalesce(_rest(url), F.lit("")).alias("t"), (verdict == "allow").cast("int").alias("y"))
    return rows.filter("y IS NOT NULL").withColumn("apart", F.pmod(F.xxhash64("t"), F.lit(5)) == 0)


def counts(rows: DataFrame, order: int, held: int) -> DataFrame:
    """``gram, a, r``: how often each run of up to ``order + 1`` characters is in allowed and
    blocked URLs. A task hands its counts on when it has about ``held`` of them."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            grams = sorted(set(seen[0]) | set(seen[1]))
            values = [pa.array([seen[y][g] for g in grams], pa.int64()) for y in (1, 0)]
            return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), *values], ["gram", "a", "r"])

        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                marked = "\x02" + text.lower() + "\x03"
                for n in range(1, order + 2):
                    seen[y].update(marked[i : i + n] for i in range(len(marked) - n + 1))
            if len(seen[0]) + len(seen[1]) > held:
                yield out()
                seen = (Counter(), Counter())
        yield out()

    return map_arrow(rows.select("t", "y"), make, "gram string, a long, r long").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))


class Model:
    """Two smoothed models over the same runs of characters, in memory: what ``scored`` computes, for one text."""

    def __init__(self, grams: dict[str, tuple[int, int]], order: int, weight: float = 2.0):
        self.grams, self.order, self.weight = grams, order, weight
        self.total = [0.0, 0.0]
        #: How often each context has a character after it.
        self.after: dict[str, list[float]] = {}
        for gram, seen in grams.items():
            held = self.after.setdefault(gram[:-1], [0.0, 0.0])
            held[0] += seen[0]
            held[1] += seen[1]
        self.step: dict[str, float] = {}

    def _ratio(self, run: str) -> float:
        """Log ratio of the chances of the last character after those before it."""
        if run in self.step:
            return self.step[run]
        chance = [1 / 256, 1 / 256]
        for n in range(1, len(run) + 1):
            seen, held = self.grams.get(run[-n:], (0, 0)), self.after.get(run[-n:-1])
            if not held:
                break
            chance = [(seen[y] + self.weight * chance[y]) / (held[y] + self.weight) for y in (0, 1)]
        value = log(chance[0]) - log(chance[1])
        if len(self.step) < 500_000:
            self.step[run] = value
        return value

    def score(self, text: str) -> float:
        if not text:
            return 0.0
        marked = "\x02" + text.lower() + "\x03"
        return sum(self._ratio(marked[max(0, i - self.order) : i + 1]) for i in range(1, len(marked))) / (len(marked) - 1)


@dataclass
class Counted:
    """The model as a table: ``gram``, its counts ``a, r`` and those of all that came after it, ``after_a, after_r``."""

    table: DataFrame
    order: int
    totals: tuple[int, int]
    weight: float = 2.0


def fit(rows: DataFrame, order: int, least: int, held: int = 500_000) -> Counted | None:
    kept = stored(counts(rows.filter("NOT apart"), order, held).filter(F.col("a") + F.col("r") >= least), "url_runs")
    sums = kept.agg(F.sum("a"), F.sum("r"), F.sum(F.when(F.length("gram") == 1, F.col("a"))), F.sum(F.when(F.length("gram") == 1, F.col("r")))).first()
    if not sums[0] or not sums[1]:
        return None
    none = F.lit(None).cast("long")
    after = kept.filter(F.length("gram") > 1).select(
        F.expr("substring(gram, 1, length(gram) - 1)").alias("gram"), none.alias("a"), none.alias("r"), F.col("a").alias("after_a"), F.col("r").alias("after_r")
    )
    both = kept.select("gram", "a", "r", none.alias("after_a"), none.alias("after_r")).unionByName(after)
    table = both.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("a", "r", "after_a", "after_r")])
    return Counted(stored(table, "url_model"), order, (sums[2] or 0, sums[3] or 0))


def runs(texts: DataFrame, order: int) -> DataFrame:
    """``h, m, size, run, k``: how often each character of a text comes after the ``order`` before it, and the text's size."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                found, times, at, sizes = [], [], [], []
                for j, text in enumerate(part.column(0).to_pylist()):
                    marked = "\x02" + text.lower() + "\x03"
                    own = Counter(marked[max(0, i - order) : i + 1] for i in range(1, len(marked)))
                    found += own.keys()
                    times += own.values()
                    at += [j] * len(own)
                    sizes += [len(marked) - 1] * len(own)
                keys = [part.column(i).take(pa.array(at, pa.int32())) for i in (1, 2)]
                arrays = [*keys, pa.array(sizes, pa.int32()), pa.array(found, pa.string()), pa.array(times, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, ["h", "m", "size", "run", "k"])

    return map_arrow(texts.filter("t != ''").select("t", "h", "m"), make, "h long, m int, size int, run string, k int")


def steps(found: DataFrame, model: Counted) -> DataFrame:
    """``run, step``: the log ratio of the chances of each run's last character after those
    before it, in whole multiples of ``1 / UNIT``."""
    most = model.order + 1
    # The last n characters have a count, all but the last of them have one of what came after.
    ends = [F.struct(F.lit(n).alias("n"), F.lit(True).alias("own"), F.expr(f"right(run, {n})").alias("gram")) for n in range(1, most + 1)]
    contexts = [F.struct(F.lit(n).alias("n"), F.lit(False).alias("own"), F.expr(f"left(right(run, {n}), {n - 1})").alias("gram")) for n in range(2, most + 1)]
    parts = found.select("run", F.explode(F.filter(F.array(*ends, *contexts), lambda p: p.n <= F.length("run"))).alias("p")).select("run", "p.*")
    met = parts.join(model.table, "gram", "left")
    picks = [
        F.max(F.when((F.col("n") == n) & (F.col("own") == own), F.col(c))).alias(f"{c}{n}")
        for n in range(1, most + 1) for own, cs in ((True, ("a", "r")), (False, ("after_a", "after_r"))) for c in cs
    ]
    wide = met.groupBy("run").agg(*picks)
    chance = [F.lit(1 / 256), F.lit(1 / 256)]
    w = F.lit(model.weight)
    for n in range(1, most + 1):
        known = F.lit(True) if n == 1 else F.col(f"after_a{n}").isNotNull()
        held = [F.lit(t) if n == 1 else F.col(f"after_{c}{n}") for c, t in zip("ar", model.totals, strict=True)]
        step = [F.when(known, (F.coalesce(F.col(f"{c}{n}"), F.lit(0)) + w * p) / (h + w)).otherwise(p) for c, p, h in zip("ar", chance, held, strict=True)]
        wide = wide.withColumns({f"chance_{c}{n}": x for c, x in zip("ar", step, strict=True)})
        chance = [F.col(f"chance_{c}{n}") for c in "ar"]
    ratio = F.log(chance[0]) - F.log(chance[1])
    return wide.select("run", F.round(ratio * UNIT).cast("long").alias("step"))


def scored(rows: DataFrame, model: Counted, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``score`` of the URL text in ``t``."""
    marked = rows.select("t", *keep, F.xxhash64("t").alias("h"), F.hash("t").alias("m"))
    own = runs(marked.select("t", "h", "m").distinct(), model.order)
    ratios = stored(steps(own.select("run").distinct(), model), "url_steps")
    sums = own.join(ratios, "run").groupBy("h", "m").agg((F.sum(F.col("k") * F.col("step")) / F.lit(float(UNIT)) / F.max("size")).alias("score"))
    return marked.join(stored(sums, "url_scores"), ["h", "m"], "left").select(*keep, F.coalesce("score", F.lit(0.0)).alias("score"))


def threshold(scores: DataFrame) -> float:
    """The score that tells known URLs apart best, both kinds weighing alike."""
    bins = scores.groupBy("y", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + 2) / 4 * BINS))).cast("int").alias("bin"))
    seen = np.zeros((2, BINS))
    for r in bins.count().collect():
        seen[r.y, r.bin] = r["count"]
    if not seen.sum(axis=1).all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(seen, axis=1)], axis=1) / seen.sum(axis=1, keepdims=True)
    right = below[0] - below[1]
    best = np.nonzero(right >= right.max() - 1e-12)[0]
    return float((best[0] + best[-1]) / 2 / BINS * 4 - 2)


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]] | None = None,
    order: int = 4,
    least: int = 2,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row."""
    rules = RULES if rules is None else rules
    examples = known(pages, rules, url_col)
    model = fit(examples, order, least)
    url = F.col(url_col)
    rows = pages.select(
        F.coalesce(_rest(url), F.lit("")).alias("t"), F.col(id_col).alias("page_id"),
        F.coalesce(host(url), F.lit("")).alias("host"), F.coalesce(path(url), F.lit("")).alias("path"),
    )
    keep = ["page_id", "host", "path"]
    if model:
        edge = threshold(scored(examples.filter("apart"), model, ["y"]))
        judged = scored(rows, model, keep)
    else:
        edge, judged = 0.0, rows.select(*keep, F.lit(0.0).alias("score"))
    at = F.col("host"), F.col("path")
    return judged.select(
        *keep, rule(*at, rules, False).alias("rule"),
        F.coalesce(rule(*at, rules, True), F.when(F.col("score") >= edge, "allow").otherwise("block")).alias("verdict"), "score",
    )
