"""Quality rules: robust multivariate outliers.

Counts of each text become a vector of five transformed statistics. For every language and source the minimum covariance
determinant gives a centre and a covariance that up to a quarter of odd rows can't move, and a row whose Mahalanobis distance
from the centre is above the 99.9 % point of chi-square with five degrees (20.5) is rejected.

The estimate runs as aggregations over a narrow table. Two starts (medians and quartiles; plain mean and covariance) are
improved by concentration steps: rows are counted and summed by bins of their distance, the bins that hold the nearest three
quarters are added up to the next centre and covariance, and the start with the smaller determinant goes on. One aggregation
with map-side sums is one step, whatever a group's share of the rows; no group is ever gathered. Statistics are rounded to
1/256, so that sums are whole numbers and don't depend on the order of tasks. What a statistic varies by, given those before
it, is taken as its floor where it is less, since most texts have no symbols or repeated lines at all. The floors are such that
in the shortest text that passes the base rule the chance of its words' lengths (0.3 is their mean's deviation), one symbol, one
repeated line or one repeated triple is no outlier by itself.

An estimate needs `least` rows (100) that pass the base rule. A language and source with so many is judged by its own; those of one language with
fewer are judged together, by an estimate of all of them; what has fewer than 100 rows of a language left in that way is taken
together over all languages. If even that is fewer than 100 rows, they are judged by the estimate of all rows of the table, and if the
table has fewer than 100 rows, nothing is estimated. So every row is judged by the closest group that is large enough, at every size.

Cases: null and empty texts have no words and fail the base rule; a null language or source is one of its own; ties and
repeated rows get equal verdicts; with fewer rows than a group needs, in all, nothing is rejected beyond the base rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchlake.operators.sizing import measured
from catchlake.session import materialize

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
PLACE_BITS = 31  #: as many places as an array has
SCALE = 256
QUARTILE_BINS = 64
D = 5
ALL = "every"  #: the group whose estimate is that of all rows


@dataclass(frozen=True)
class McdSettings:
    floors: tuple[float, ...] = (0.1, 0.3, 0.25, 0.25, 0.57)  #: least standard deviations of the five statistics
    share: float = 0.75  #: of the rows that the covariance is taken from
    steps: int = 2  #: concentration steps of each start
    more: int = 2  #: and of the better one
    least: int = 100  #: rows that a group needs
    quantile: float = 0.999  #: of chi-square: the squared distance above which a row is rejected
    bins: int = 40  #: of distances, in each step of e

    @property
    def cut(self) -> float:
        return chi2_point(self.quantile, D)


def chi2_cdf(x: float, k: int) -> float:
    """By the series of the incomplete gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-15 * total:
        n += 1
        term *= z / (a + n)
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a))


def chi2_point(share: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < share else (low, mid)
    return low


def consistency(share: float) -> float:
    """What a covariance of the nearest share of normal rows must be multiplied by."""
    return share / chi2_cdf(chi2_point(share, D), D + 2)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of whole texts; the text goes."""
    kept = [c for c in docs.columns if c != text]
    body = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    body = body.select(
        *kept, F.array_remove(F.split("_t", BLANK), "").alias("_w"),
        F.length(F.translate("_t", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    # hashes of word triples, each with its place in the low bits: sorted, equal triples lie side by side
    low = F.lit((1 << PLACE_BITS) - 1)
    keys = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - F.lit(3), F.lit(0))), lambda i: F.xxhash64(
        F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("bigint")))
    body = body.withColumn("_k", F.when(F.size("_w") >= 3, F.sort_array(keys)).otherwise(F.array().cast("array<bigint>")))
    of = lambda x: F.shiftright(x, PLACE_BITS)
    twice = F.filter("_k", lambda x, i: (of(x) == of(F.get("_k", i + 1))) | (of(x) == of(F.get("_k", i - 1))))
    body = body.withColumn("_c", F.transform(twice, lambda x: x.bitwiseAND(low).cast("int")))
    # the few that share a hash are compared as words
    grams = F.sort_array(F.transform("_c", lambda p: F.struct(
        F.concat_ws(" ", F.get("_w", p), F.get("_w", p + 1), F.get("_w", p + 2)).alias("g"), p.alias("p"))))
    body = body.withColumn("_g", grams)
    same = F.filter("_g", lambda x, i: (x["g"] == F.get("_g", i + 1)["g"]) | (x["g"] == F.get("_g", i - 1)["g"]))
    body = body.withColumn("_p", F.sort_array(F.transform(same, lambda x: x["p"])))
    steps = F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - p, F.lit(3))))
    return body.select(
        *kept, F.size("_w").cast("bigint").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def statistics() -> list[Column]:
    """The transformed statistics, in whole steps of 1/256."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    rate = lambda c: F.log1p(F.lit(100.0) * F.col(c) / n)
    values = [F.log1p("n_words"), F.col("word_chars") / n, rate("n_symbols"), rate("n_dup_lines"), rate("n_repeat_words")]
    return [F.round(v * SCALE).cast("bigint").alias(f"x{i}") for i, v in enumerate(values)]


def _grouped(rows: DataFrame, least: int) -> tuple[DataFrame, bool]:
    """Add _g: language and source; the small sources of a language, or the small languages, together; ALL if those are few,
    and null if all rows are few. And whether some rows have ALL."""
    own = F.concat(F.coalesce(F.hex("lang"), F.lit("-")), F.lit("/"), F.coalesce(F.hex("source"), F.lit("-")))
    lang = F.coalesce(F.hex("lang"), F.lit("-"))
    rows = rows.withColumns({"_own": own, "_lang": lang})
    counts = rows.filter(~F.col("_failed")).groupBy("_own", "_lang").count()
    rest = counts.withColumn("_rest", F.sum(F.when(F.col("count") < least, F.col("count"))).over(W.partitionBy("_lang")))
    level = F.when(F.col("count") >= least, F.concat(F.lit("s"), "_own")).when(F.col("_rest") >= least, F.concat(F.lit("l"), "_lang")).otherwise(F.lit("all"))
    rest = materialize(rest.select(F.col("_own").alias("_own2"), level.alias("_g"), "count"), "groups")
    small, whole = rest.agg(F.coalesce(F.sum(F.when(F.col("_g") == "all", F.col("count"))), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    if small < least:
        rest = rest.withColumn("_g", F.when(F.col("_g") != "all", F.col("_g")).otherwise(F.lit(ALL if whole >= least else None)))
    groups = measured(groups=rest.drop("count"))["groups"]
    return rows.join(groups, F.col("_own") == F.col("_own2"), "left").drop("_own", "_own2", "_lang"), 0 < small < least <= whole


PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(D)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS]]


def _estimate(sums: DataFrame, factor: float, s: McdSettings) -> DataFrame:
    """Centres m, rows w of the inverted Cholesky factor and the log determinant, from counts and sums."""
    kept = [c for c in sums.columns if c in ("_g", "_start")]
    mean = {i: F.col(f"s{i}") / F.col("n") / SCALE for i in range(D)}
    out = sums.select(*kept, *[mean[i].alias(f"m{i}") for i in range(D)], *[
        ((F.col(f"s{i}{j}") / F.col("n") / (SCALE * SCALE) - mean[i] * mean[j]) * factor).alias(f"c{i}{j}") for i, j in PAIRS])
    return _factor(out, kept, s)


def _factor(out: DataFrame, kept: list[str], s: McdSettings) -> DataFrame:
    for i in range(D):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(s.floors[i] ** 2))) if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(D):
        for j in range(i + 1):
            rest = F.lit(1.0) if i == j else F.lit(0.0)
            for k in range(j, i):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
            out = out.withColumn(f"w{i}{j}", rest / F.col(f"l{i}{i}"))
    logdet = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, D)), F.log("l00"))
    return out.select(*kept, *[f"m{i}" for i in range(D)], *[f"w{i}{j}" for i, j in PAIRS], logdet.alias("_logdet"))


def distance() -> Column:
    """The squared Mahalanobis distance of a row that is joined to its group's estimate."""
    z = [sum((F.col(f"w{i}{j}") * (F.col(f"x{j}") / SCALE - F.col(f"m{j}")) for j in range(1, i + 1)),
             F.col(f"w{i}0") * (F.col("x0") / SCALE - F.col("m0"))) for i in range(D)]
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _joined(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(measured(e=estimates)["e"], "_g")


def _first_estimates(rows: DataFrame, s: McdSettings) -> DataFrame:
    """Both starts of every group."""
    plain = _estimate(rows.groupBy("_g").agg(*_sums()), 1.0, s).withColumn("_start", F.lit(0))
    # quartiles by bins of 1/64 in the logarithm, of which there are a few thousand whatever the rows: summed map-side, short windows
    values = rows.select("_g", F.posexplode(F.array(*[F.floor(F.log1p(f"x{i}") * QUARTILE_BINS) for i in range(D)])).alias("_i", "_x"))
    counts = values.groupBy("_g", "_i", "_x").count()
    up = W.partitionBy("_g", "_i").orderBy("_x")
    ranked = counts.withColumns({"_to": F.sum("count").over(up), "_n": F.sum("count").over(W.partitionBy("_g", "_i"))})
    at = lambda q: F.expm1(F.min(F.when(F.col("_to") >= F.col("_n") * q, F.col("_x"))) / QUARTILE_BINS) / SCALE
    quart = ranked.groupBy("_g", "_i").agg(at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("b"))
    wide = quart.groupBy("_g").agg(*[
        F.max(F.when(F.col("_i") == i, F.col(c))).alias(f"{c}{i}") for i in range(D) for c in ("a", "m", "b")])
    spread = lambda i: F.pow((F.col(f"b{i}") - F.col(f"a{i}")) / 1.349, 2)
    diagonal = wide.select("_g", *[f"m{i}" for i in range(D)],
                           *[(spread(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS])
    robust = _factor(diagonal, ["_g"], s).withColumn("_start", F.lit(1))
    return materialize(plain.unionByName(robust), "mcd")


def _concentrate(rows: DataFrame, estimates: DataFrame, s: McdSettings, factor: float) -> DataFrame:
    """One concentration step of every group and start."""
    near = _joined(rows, estimates).withColumn("_bin", F.floor(F.log(distance() + 1e-6) * s.bins).cast("int"))
    bins = near.groupBy("_g", "_start", "_bin").agg(*_sums())
    of = W.partitionBy("_g", "_start")
    bins = bins.withColumns({"_to": F.sum("n").over(of.orderBy("_bin")), "_n": F.sum("n").over(of)})
    kept = bins.filter(F.col("_to") - F.col("n") < F.ceil(F.col("_n") * s.share))
    totals = kept.groupBy("_g", "_start").agg(*[F.sum(c).alias(c) for c in ("n", *[f"s{i}" for i in range(D)], *[f"s{i}{j}" for i, j in PAIRS])])
    return materialize(_estimate(totals, factor, s), "mcd")


def estimates_of(rows: DataFrame, s: McdSettings) -> DataFrame:
    """The estimate of each group: m, w by _g. rows has _g and x0 to x4."""
    factor = consistency(s.share)
    now = _first_estimates(rows, s)
    for _ in range(s.steps):
        now = _concentrate(rows, now, s, factor)
    best = W.partitionBy("_g").orderBy("_logdet", "_start")
    now = materialize(now.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank"), "mcd")
    for _ in range(s.more):
        now = _concentrate(rows, now, s, factor)
    return now.drop("_start", "_logdet")


def rule_verdicts(docs: DataFrame, s: McdSettings = McdSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: its counts, base_failed, the squared distance and kept."""
    read = docs.select(F.col(key).alias("doc_id"), "lang", "source", F.col(text).alias("text"))
    rows = with_counts(read).withColumn("_failed", base_failed())
    rows = materialize(rows.select("*", *statistics()), "statistics")
    rows, leftovers = _grouped(rows, s.least)
    names = F.array(F.when(F.col("_g") != ALL, F.col("_g")), F.when(F.lit(leftovers), F.lit(ALL)))
    inner = rows.filter(~F.col("_failed") & F.col("_g").isNotNull()).select(F.explode(F.array_compact(names)).alias("_g"), *[f"x{i}" for i in range(D)])
    inner = materialize(inner, "vectors")
    estimates = measured(e=estimates_of(inner, s).withColumnRenamed("_g", "_g2"))["e"]
    judged = rows.join(estimates, F.col("_g") == F.col("_g2"), "left").withColumn("distance", distance())
    far = F.coalesce(F.col("distance") > s.cut, F.lit(False))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         F.col("_failed").alias("base_failed"), (~F.col("_failed") & ~far).alias("kept"), "distance")
