"""Statistics of features, detector scores and distributions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.columns import divided
from tessella.operators.ranges import largest_gap, percentiles, running
from tessella.operators.tables import numbered, unit_hash

# --- summaries ----------------------------------------------------------------------------


def score_stats(scores: DataFrame, by: str = "id", value: str = "score") -> DataFrame:
    """Mean, population deviation, median and p90 - p10 of each row's ensemble scores (long form)."""
    v = F.col(value)
    shape = scores.groupBy(by).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    points = percentiles(scores, [by], value, {"median": 0.5, "p10": 0.1, "p90": 0.9}).select(F.col(by).alias("__by"), "median", (F.col("p90") - F.col("p10")).alias("spread"))
    return shape.join(points, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")


def size_outliers(files: DataFrame, k: float = 5, value: str = "size") -> DataFrame:
    """Files whose size is outside mean +/- k population deviations."""
    ends = files.agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    return files.join(F.broadcast(ends)).where(F.abs(F.col(value) - F.col("__m")) > k * F.col("__s")).drop("__m", "__s")


def size_stats(df: DataFrame, text: str, ident: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Deviation of document sizes in KB, and the k largest."""
    sized = df.select(ident, (F.octet_length(text) / 1024).alias("kb"))
    return sized.agg(F.stddev_pop("kb").alias("std_kb"), F.count("kb").alias("n")), sized.orderBy(F.col("kb").desc(), ident).limit(k)


def error_summary(df: DataFrame, value: str = "distance", by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"))


def cohen_d(df: DataFrame, region: str, group: str, value: str, a, b, log: bool = False) -> DataFrame:
    """Difference of group means over the pooled sample deviation, by region.

    With ``log`` zeros of either group are dropped and log10 values compared.
    """
    v = F.col(value).cast("double")
    rows = df.where(v > 0) if log else df
    v = F.log10(v) if log else v
    side = lambda g: [F.count(F.when(F.col(group) == g, v)), F.avg(F.when(F.col(group) == g, v)), F.var_samp(F.when(F.col(group) == g, v))]
    (n1, m1, v1), (n2, m2, v2) = side(a), side(b)
    s = rows.groupBy(region).agg(n1.alias("n1"), m1.alias("m1"), v1.alias("v1"), n2.alias("n2"), m2.alias("m2"), v2.alias("v2"))
    pooled = F.sqrt(((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / (F.col("n1") + F.col("n2") - 2))
    return s.where("n1 > 1 and n2 > 1").select(region, F.try_divide(F.col("m1") - F.col("m2"), pooled).alias("d"))


# --- covariance ---------------------------------------------------------------------------


def pairwise_covariance(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, n, cov) over the rows that have both values; means are over rows that have the one.

    Partial sums of products are one aggregate; nothing is sent row by row. Many columns
    are too many expressions for one aggregate, so their partial sums are matrix products.
    """
    if len(columns) > 16:
        return _wide_covariance(df, columns)
    x = [F.col(f"`{c}`").cast("double") for c in columns]
    d = range(len(columns))
    sums = df.agg(
        *(F.avg(x[i]).alias(f"m{i}") for i in d),
        *(F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in d for j in d if i <= j), *(F.count(x[i] + x[j]).alias(f"n{i}_{j}") for i in d for j in d if i <= j),
    )
    cell = lambda i, j: F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"n{i}_{j}").alias("n"), (F.try_divide(F.col(f"s{i}_{j}"), F.col(f"n{i}_{j}").cast("double")) - F.col(f"m{i}") * F.col(f"m{j}")).alias("cov"))
    return sums.select(F.explode(F.array(*(cell(i, j) for i in d for j in d if i <= j))).alias("c")).select("c.*")


def _wide_covariance(df: DataFrame, columns: list[str]) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    d = len(columns)
    i, j = np.triu_indices(d)

    def sums(batches):
        s, n, m, odd = np.zeros((d, d)), np.zeros((d, d)), np.zeros(d), np.zeros((d, d), bool)
        for b in batches:
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
            v = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in b.columns])
            m += v.sum(axis=0)
            wrong = ~np.isfinite(v)
            if wrong.any():  # NaN only where the other value is there too
                odd |= wrong.T.astype(float) @ there > 0
                v = np.where(wrong, 0.0, v)
            s += v.T @ v
            n += there.T @ there
        s[odd | odd.T] = np.nan
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(s[i, j]), pa.array(n[i, j].astype("int64")), pa.array(np.where(i == j, m[i], 0.0))], ["i", "j", "s", "n", "m"])

    rows = df.select(*(F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns))).mapInArrow(sums, "i int, j int, s double, n long, m double")
    cells = rows.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("m").alias("m"))
    # the d means stand beside the cells as one array
    means = cells.where("i = j").agg(F.map_from_entries(F.collect_list(F.struct("i", F.try_divide(F.col("m"), F.col("n").cast("double"))))).alias("means"))
    mean = lambda k: F.col("means")[F.col(k)]
    return cells.crossJoin(F.broadcast(means)).select("i", "j", "n", (F.try_divide(F.col("s"), F.col("n").cast("double")) - mean("i") * mean("j")).alias("cov"))


def pca_from_cov(cov: DataFrame, d: int) -> DataFrame:
    """Eigenvalues and vectors of a d x d covariance, the largest first; one small matrix on the driver."""
    import numpy as np

    m = np.zeros((d, d))
    for r in cov.collect():
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["cov"] or 0.0
    values, vectors = np.linalg.eigh(m)
    order = np.argsort(-values)
    # the largest entry of a vector is positive
    rows = [(int(k), float(values[i]), [float(v) for v in vectors[:, i] * np.sign(vectors[np.argmax(np.abs(vectors[:, i])), i])]) for k, i in enumerate(order)]
    return cov.sparkSession.createDataFrame(rows, "component int, eigenvalue double, vector array<double>")


def eigen_residuals(cov: DataFrame, components: DataFrame) -> DataFrame:
    """Of every component: the largest entry of M v - eigenvalue * v, and how far the vector's length is from 1."""
    whole = cov.select("i", "j", "cov").unionByName(cov.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "cov"))
    entries = components.select("component", "eigenvalue", F.posexplode("vector").alias("i", "v"))
    product = whole.join(entries.select("component", F.col("i").alias("j"), "v"), "j").groupBy("component", "i").agg(F.sum(F.coalesce("cov", F.lit(0.0)) * F.col("v")).alias("mv"))
    joined = entries.join(product, ["component", "i"], "left")
    off = F.max(F.abs(F.coalesce("mv", F.lit(0.0)) - F.col("eigenvalue") * F.col("v")))
    return joined.groupBy("component", "eigenvalue").agg(off.alias("residual"), F.abs(F.sum(F.col("v") * F.col("v")) - 1).alias("length_error"))


# --- patches ------------------------------------------------------------------------------


def patch_moments(pixels: DataFrame, by: str = "patch") -> DataFrame:
    """Raw moments up to third order of mask patches (x, y, v) and the seven invariants of Hu."""
    m = {(p, q): F.sum(F.pow("x", p) * F.pow("y", q) * F.col("v")).alias(f"m{p}{q}") for p in range(4) for q in range(4) if p + q <= 3}
    raw = pixels.groupBy(by).agg(*m.values())
    c = {k: F.col(f"m{k[0]}{k[1]}") for k in m}
    m00, xc, yc = c[0, 0], F.try_divide(c[1, 0], c[0, 0]), F.try_divide(c[0, 1], c[0, 0])
    mu = {
        (2, 0): c[2, 0] - xc * c[1, 0], (1, 1): c[1, 1] - xc * c[0, 1], (0, 2): c[0, 2] - yc * c[0, 1],
        (3, 0): c[3, 0] - 3 * xc * c[2, 0] + 2 * xc * xc * c[1, 0], (2, 1): c[2, 1] - 2 * xc * c[1, 1] - yc * c[2, 0] + 2 * xc * xc * c[0, 1],
        (1, 2): c[1, 2] - 2 * yc * c[1, 1] - xc * c[0, 2] + 2 * yc * yc * c[1, 0], (0, 3): c[0, 3] - 3 * yc * c[0, 2] + 2 * yc * yc * c[0, 1],
    }
    scaled = raw.select("*", *(F.try_divide(v, F.pow(m00, 1 + (p + q) / 2)).alias(f"e{p}{q}") for (p, q), v in mu.items()))
    e = lambda k: F.col(f"e{k}")
    a, b = e("30") + e("12"), e("21") + e("03")
    u, w = e("30") - 3 * e("12"), 3 * e("21") - e("03")
    hu = [
        e("20") + e("02"), F.pow(e("20") - e("02"), 2) + 4 * e("11") * e("11"), u * u + w * w, a * a + b * b,
        u * a * (a * a - 3 * b * b) + w * b * (3 * a * a - b * b), (e("20") - e("02")) * (a * a - b * b) + 4 * e("11") * a * b, w * a * (a * a - 3 * b * b) - u * b * (3 * a * a - b * b),
    ]
    return scaled.select(by, *(f"m{p}{q}" for p, q in m), *(v.alias(f"h{i}") for i, v in enumerate(hu)))


def patch_contrast(pixels: DataFrame, by: list[str] = ("patch", "channel")) -> DataFrame:
    """(mean inside - mean overall) / (mean inside + mean overall)."""
    inside, every = F.avg(F.when(F.col("mask") > 0, F.col("value"))), F.avg("value")
    return pixels.groupBy(*by).agg(divided(inside - every, inside + every).alias("contrast"))


def mean_patch(pixels: DataFrame) -> DataFrame:
    """Mean over patches by pixel, then standardised within its channel."""
    means = pixels.groupBy("channel", "x", "y").agg(F.avg("value").alias("value"))
    ends = means.groupBy("channel").agg(F.avg("value").alias("__m"), F.stddev_pop("value").alias("__s"))
    return means.join(ends, "channel").select("channel", "x", "y", F.try_divide(F.col("value") - F.col("__m"), F.col("__s")).alias("value"))


#: Weights of a smoothed derivative over five pixels along and across: fixed values.
ALONG, ACROSS = (-1, -2, 0, 2, 1), (1, 4, 6, 4, 1)


def gradients(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Derivatives in x and y by a 5 x 5 kernel; pixels without a full neighbourhood go."""
    cells = F.array(*(F.struct(F.lit(i - 2).alias("i"), F.lit(j - 2).alias("j"), F.lit(ALONG[i] * ACROSS[j]).alias("kx"), F.lit(ALONG[j] * ACROSS[i]).alias("ky")) for i in range(5) for j in range(5)))
    spread = pixels.select(*by, "x", "y", "value", F.explode(cells).alias("k"))
    parts = spread.groupBy(*by, (F.col("x") - F.col("k.i")).alias("x"), (F.col("y") - F.col("k.j")).alias("y"))
    return parts.agg(F.sum(F.col("value") * F.col("k.kx")).alias("gx"), F.sum(F.col("value") * F.col("k.ky")).alias("gy"), F.count(F.lit(1)).alias("n")).where("n = 25").drop("n")


def patch_gradient_features(pixels: DataFrame, mean: DataFrame, by: list[str] = ("patch", "channel")) -> DataFrame:
    """Agreement with the mean patch's gradient, and energy. Both gradients are standardised jointly."""
    g = gradients(pixels, list(by))
    m = gradients(mean.select("channel", "x", "y", "value"), ["channel"])
    stat = lambda df, k, n: df.groupBy(*k).agg(F.sqrt(F.avg(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")) / 2).alias(n))
    j = g.join(stat(g, by, "s"), list(by)).join(m.select("channel", "x", "y", F.col("gx").alias("mx"), F.col("gy").alias("my")).join(stat(m, ["channel"], "ms"), "channel"), ["channel", "x", "y"])
    corr = F.avg((F.col("gx") * F.col("mx") + F.col("gy") * F.col("my")) / (F.col("s") * F.col("ms")))
    return j.groupBy(*by).agg(corr.alias("corr"), F.max("s").alias("energy"))


# --- distributions ------------------------------------------------------------------------


def score_cdf(df: DataFrame, label: str = "label", value: str = "score") -> DataFrame:
    """Share of a class's scores before each: rising for positives, falling for negatives."""
    v, up = F.col(value).cast("double"), F.coalesce(F.col(label) == 1, F.lit(False))
    # falling order as rising negatives, with what is not a number before all, and nulls behind
    kind = F.when(up, v.isNotNull().cast("int")).otherwise(F.when(v.isNull(), 2).when(F.isnan(v), 0).otherwise(1))
    placed = numbered(df.withColumns({"__kind": kind, "__v": F.when(up, v).otherwise(-v)}), [label], ["__kind", "__v", "id"], "__before", "__of")
    return placed.select(*df.columns, (F.col("__before") / F.col("__of")).alias("cdf"))


def ks_statistic(a: DataFrame, b: DataFrame, by: list[str] = (), value: str = "v") -> DataFrame:
    """Largest gap (signed) of two empirical distributions and where it is; ties are one step. Nulls are left out.

    Values are counted first, and counts run up over ranges of the values, so one
    group, also that of no ``by`` at all, is spread over tasks.
    """
    side = lambda df, x, y: df.where(F.col(value).isNotNull()).select(*by, value, F.lit(x).cast("long").alias("a"), F.lit(y).cast("long").alias("b"))
    steps = side(a, 1, 0).unionByName(side(b, 0, 1)).groupBy(*by, value).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return largest_gap(steps, list(by), value)


def ks_p_value(gap: Column, n1: Column, n2: Column, terms: int = 20) -> Column:
    """Asymptotic p-value by its alternating series."""
    n = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (n + 0.12 + 0.11 / n) * F.abs(gap)
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2 * k * k * lam * lam) for k in range(1, terms + 1)), F.lit(0.0))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_test(boxes: DataFrame, background: DataFrame, alpha: float = 0.01, by=("box", "feature")) -> DataFrame:
    """Boxes and features whose values differ from the background's.

    The background is counted once a feature. Between two values of a box its own
    share stays and the background's rises, so the largest gap lies at one of the
    box's values or at the last background value before one; a box costs what it
    holds, not a copy of the background.
    """
    own = boxes.where("v is not null").groupBy(*by, "v").agg(F.count(F.lit(1)).alias("a"))
    known = background.where("v is not null").groupBy("feature", "v").agg(F.count(F.lit(1)).alias("b"))
    values = known.unionByName(own.select("feature", "v", F.lit(0).cast("long").alias("b"))).groupBy("feature", "v").agg(F.sum("b").alias("b"))
    placed = running(values.withColumn("seen", F.when(F.col("b") > 0, F.col("v"))), ["feature"], ["v"], ["b"], ["seen"])
    placed = placed.select("feature", "v", "b", F.col("b_until").alias("until"), F.col("b_total").alias("n2"), F.col("seen_before").alias("last")).where("n2 > 0")
    steps = running(own, list(by), ["v"], ["a"]).withColumnsRenamed({"a_until": "mine", "a_total": "n1"}).join(placed, ["feature", "v"])
    gap = lambda mine, theirs: mine / F.col("n1") - theirs / F.col("n2")
    here = F.struct(gap(F.col("mine"), F.col("until")).alias("gap"), F.col("v").alias("at"))
    before = F.struct(gap(F.col("mine") - F.col("a"), F.col("until") - F.col("b")).alias("gap"), F.col("last").alias("at"))
    best = F.max(F.struct(F.abs("g.gap").alias("size"), (-F.col("g.at")).alias("v"), "g.gap", "n1", "n2")).alias("m")
    found = steps.select(*by, "n1", "n2", F.explode(F.array(here, before)).alias("g")).where("g.at is not null").groupBy(*by).agg(best)
    found = found.select(*by, F.col("m.gap").alias("gap"), (-F.col("m.v")).alias("at"), F.col("m.n1").alias("n1"), F.col("m.n2").alias("n2"))
    return found.withColumn("p", ks_p_value(F.col("gap"), F.col("n1"), F.col("n2"))).where(F.col("p") < alpha)


def box_relations(values: DataFrame, significant: DataFrame, pairs: DataFrame) -> DataFrame:
    """Neighbouring boxes (id, other) by feature: agree (p > 0.1), disagree (p < 0.01), neither, not significant."""
    p = pairs.where("id < other")
    a = p.join(values.select(F.col("box").alias("id"), "feature", "v"), "id").select("id", "other", "feature", "v")
    b = p.join(values.select(F.col("box").alias("other"), "feature", "v"), "other").select("id", "other", "feature", "v")
    tested = ks_statistic(a, b, ["id", "other", "feature"]).withColumn("p", ks_p_value(F.col("gap"), F.col("n1"), F.col("n2")))
    known = significant.select(F.col("box").alias("id"), "feature").withColumn("__s", F.lit(True))
    other = significant.select(F.col("box").alias("other"), "feature").withColumn("__t", F.lit(True))
    j = tested.join(known, ["id", "feature"], "left").join(other, ["other", "feature"], "left")
    kind = F.when(F.col("__s").isNull() | F.col("__t").isNull(), "not_significant").when(F.col("p") > 0.1, "agree").when(F.col("p") < 0.01, "disagree").otherwise("neither")
    return j.select("id", "other", "feature", kind.alias("relation"))


# --- thresholds and confusion -------------------------------------------------------------


def _by_threshold(df: DataFrame, thresholds: list[float], truth: Column, p: str) -> DataFrame:
    """Counts of rows above each threshold by truth, from one histogram over the thresholds' gaps.

    Rows are placed between thresholds and counted; running sums over those few
    counts give every threshold, so rows are never repeated.
    """
    cuts = sorted(set(map(float, thresholds)))
    # number of thresholds below the value
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t < F.col(p)))
    counts = df.groupBy(place.alias("k")).agg(F.count_if(truth).alias("t"), F.count_if(~truth).alias("f"))
    every = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("nt"), F.coalesce(F.sum("f"), F.lit(0)).alias("nf"), F.collect_list(F.struct("k", "t", "f")).alias("c"))  # thresholds + 1 rows
    rows = every.select("nt", "nf", "c", F.posexplode(F.array(*map(F.lit, cuts))).alias("i", "threshold"))
    above = lambda name: F.aggregate(F.filter("c", lambda s: s["k"] > F.col("i")), F.lit(0).cast("long"), lambda acc, s: acc + s[name])
    return rows.select("threshold", above("t").alias("tp"), above("f").alias("fp"), "nt", "nf")


def pixel_confusion(df: DataFrame, thresholds: list[float], y: str = "y", p: str = "p", cut: float = 0.4) -> DataFrame:
    """Confusion and rates of predictions above each threshold; truth is y > cut."""
    c = _by_threshold(df, thresholds, F.col(y) > cut, p)
    c = c.select("threshold", "tp", "fp", (F.col("nf") - F.col("fp")).alias("tn"), (F.col("nt") - F.col("tp")).alias("fn"))
    return c.withColumns({"tpr": divided(F.col("tp"), F.col("tp") + F.col("fn")), "fpr": divided(F.col("fp"), F.col("fp") + F.col("tn"))})


def roc(df: DataFrame, y: str = "y", p: str = "p", n: int = 200) -> DataFrame:
    """Rates at n thresholds evenly spaced in the logarithm from 1e-4 to 1."""
    return pixel_confusion(df, [10 ** (-4 + 4 * i / (n - 1)) for i in range(n)], y, p).select("threshold", "tpr", "fpr")


def error_by_threshold(df: DataFrame, thresholds: list[float], label: str = "label", value: str = "score") -> DataFrame:
    """Share of positives at or below each threshold and of negatives above it."""
    c = _by_threshold(df, thresholds, F.col(label) == 1, value)
    return c.select("threshold", divided(F.col("nt") - F.col("tp"), F.col("nt")).alias("error_1"), divided(F.col("fp"), F.col("nf")).alias("error_0"))


def selective_stats(df: DataFrame, low: float, high: float, label: str = "label", value: str = "score") -> DataFrame:
    """Accuracy where scores outside [low, high] decide: of all, of the positive and the negative side."""
    pos, neg, truth = F.col(value) > high, F.col(value) < low, F.col(label) == 1
    c = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(pos).alias("np"), F.count_if(neg).alias("nn"), F.count_if(pos & truth).alias("rp"), F.count_if(neg & ~truth).alias("rn"))
    return c.select("n", (F.col("n") - F.col("np") - F.col("nn")).alias("abstained"), divided(F.col("rp") + F.col("rn"), F.col("np") + F.col("nn")).alias("accuracy"), divided(F.col("rp"), F.col("np")).alias("positive"), divided(F.col("rn"), F.col("nn")).alias("negative"))


def error_ranges(df: DataFrame, n: int, share: float, thresholds: list[float], bins: int = 10) -> DataFrame:
    """Range of thresholds at which repeated samples' error_1 falls into each bin.

    A row is in a sample if its hash says so, so samples are repeatable.
    """
    cuts = F.array(*(F.lit(float(t)) for t in sorted(thresholds)))
    place = F.size(F.filter(cuts, lambda t: t < F.col("score")))
    drawn = df.where("label = 1").withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    drawn = drawn.where(F.conv(F.substring(F.md5(F.concat_ws("|", F.col("sample").cast("string"), F.col("id").cast("string"))), 1, 8), 16, 10).cast("long") < int(share * 16**8))
    counts = drawn.groupBy("sample", place.alias("k")).agg(F.count(F.lit(1)).alias("c"))
    each = counts.groupBy("sample").agg(F.sum("c").alias("n"), F.collect_list(F.struct("k", "c")).alias("h"))  # thresholds + 1 at most
    rows = each.select("sample", "n", "h", F.posexplode(cuts).alias("i", "threshold"))
    low = F.aggregate(F.filter("h", lambda s: s["k"] <= F.col("i")), F.lit(0).cast("long"), lambda a, s: a + s["c"])
    errors = rows.select("threshold", F.least(F.floor(low / F.col("n") * bins), F.lit(bins - 1)).alias("bin"))
    return errors.groupBy("bin").agg(F.min("threshold").alias("low"), F.max("threshold").alias("high"))


def confusion(df: DataFrame, truth: str, predicted: str, classes: list, normalized: bool = False) -> DataFrame:
    counts = df.groupBy(truth).pivot(predicted, classes).count().na.fill(0)
    if not normalized:
        return counts
    total = sum((F.col(f"`{c}`") for c in classes), F.lit(0))
    return counts.select(truth, *(divided(F.col(f"`{c}`"), total).alias(str(c)) for c in classes))


# --- training tables and models -----------------------------------------------------------


def detections_table(df: DataFrame, decision: Column) -> DataFrame:
    """Decided detections without those that are no cells: eight columns."""
    d = df.withColumn("predictions", decision).where("predictions <> -2")
    return d.select("animal", "section", F.col("y").alias("row"), F.col("x").alias("col"), "label", "mean_score", "std_score", "predictions")


def build_training_set(candidates: DataFrame, positives: list[DataFrame], negatives: DataFrame, manual_sections: DataFrame, d: float, keys: list[str]) -> DataFrame:
    """Candidates near a positive of any source are 1; near a negative, or in hand-marked sections, 0; others go."""
    from tessella.operators.spatial import with_near

    marked = reduce(DataFrame.union, (source.select(*keys, "x", "y") for source in positives))
    rows = with_near(candidates, marked, keys, d, "__p")
    rows = with_near(rows, negatives, keys, d, "__n", asked=~F.col("__p"))  # a positive needs no negative
    # what is near to one row of an id counts for all of them; rows without an id are near to nothing, and spread over tasks
    own = Window.partitionBy("id", F.when(F.col("id").isNull(), F.hash("x", "y")))
    rows = rows.withColumns({c: F.max(c).over(own) & F.col("id").isNotNull() for c in ("__p", "__n")})
    hand = manual_sections.select(*keys).distinct().withColumn("__m", F.lit(True))
    kept = rows.join(hand, keys, "left").where(F.col("__p") | F.col("__n") | F.col("__m")).withColumn("label", F.col("__p").cast("int"))
    return kept.select(*keys, "id", *(c for c in candidates.columns if c not in (*keys, "id")), "label")


def train_ensemble(df: DataFrame, n: int, features: str = "features", label: str = "label", key: str = "id", trees: int = 10) -> list:
    """Boosted trees on n repeatable halves."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.classification import GBTClassifier

    model = GBTClassifier(featuresCol=features, labelCol=label, maxIter=trees, stepSize=0.3, maxDepth=3, seed=1)
    data = df.select(key, features, label).persist()
    fit = lambda k: model.fit(data.where(unit_hash(key, seed=k) < 0.5))
    try:
        with ThreadPool(min(n, 8)) as pool:
            return pool.map(inheritable_thread_target(df.sparkSession)(fit), range(n))
    finally:
        data.unpersist()


def score_ensemble(df: DataFrame, models: list, key: str = "id") -> DataFrame:
    """(key, model, score): each model's margin of each row, in one pass."""
    from pyspark.ml.functions import vector_to_array

    out = df
    for k, m in enumerate(models):
        scored = m.setRawPredictionCol(f"raw{k}").setPredictionCol(f"pred{k}").setProbabilityCol(f"prob{k}").transform(out)
        out = scored.withColumn(f"s{k}", vector_to_array(f"raw{k}")[1]).drop(f"raw{k}", f"pred{k}", f"prob{k}")
    long = F.explode(F.array(*(F.struct(F.lit(k).alias("model"), F.col(f"s{k}").alias("score")) for k in range(len(models))))).alias("m")
    return out.select(key, long).select(key, "m.model", "m.score")


def kmeans_scan(df: DataFrame, ks: list[int], features: str = "features", dim: int = 1) -> DataFrame:
    """BIC and silhouette of k-means by k."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    data = df.persist()
    try:
        n, rows = data.count(), []
        for k in ks:
            model = KMeans(k=k, seed=1, featuresCol=features).fit(data)
            sizes = model.summary.clusterSizes
            variance = max(model.summary.trainingCost / max((n - k) * dim, 1), 1e-12)
            fitted = sum(s * math.log(s / n) for s in sizes if s) - n * dim / 2 * math.log(2 * math.pi * variance) - (n - k) * dim / 2
            silhouette = ClusteringEvaluator(featuresCol=features).evaluate(model.transform(data)) if k > 1 else 0.0
            rows.append((k, float(fitted - k * (dim + 1) / 2 * math.log(n)), float(silhouette)))
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, bic double, silhouette double")
