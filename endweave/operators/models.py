"""Statistical models under grouped maps: negative-binomial tests, usage tests, sample structure.

Fits follow the published methods, not any package's code: results agree in sign, order and
calibration, not digit by digit. Genes are dealt to buckets by a hash and fitted as arrays.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from endweave.functions.genomics import checksum_seed
from endweave.functions.special import chi_square_tail, digamma, f_quantile, log_gamma, normal_tail, trigamma
from endweave.operators.checks import FIT_STATUS
from endweave.operators.design import model_matrix, variables
from endweave.operators.expression import size_factors
from endweave.operators.multitest import adjust_bh, gene_q_values
from endweave.session import cut

#: Genes of a bucket on average, and the dispersions that fits choose from.
BUCKET = 2000
GRID = np.exp(np.linspace(math.log(1e-4), math.log(10.0), 60))

#: The least mean a fit takes for a count, and the weight that keeps coefficients finite.
LEAST, RIDGE = 0.5, 1e-6


def _design(samples: DataFrame, denominator: str, numerator: str, design: str, known=None) -> tuple[list[str], np.ndarray]:
    """(samples of both conditions in order, their model matrix by ``design``): the last column is the
    condition's, and the matrix without it is that of the reduced model."""
    terms = variables(design)
    if "condition" not in terms:
        raise ValueError("a design of a contrast has the condition")
    rows = [r.asDict() for r in samples.filter(F.col("condition").isin(denominator, numerator)).collect()]
    rows = sorted((r for r in rows if known is None or r["sample_id"] in known), key=lambda r: r["sample_id"])
    if bad := [r["sample_id"] for r in rows if any(r[t] is None or r[t] == "" for t in terms)]:
        raise ValueError(f"no value of the design: {bad[0]}")
    if {r["condition"] for r in rows} != {denominator, numerator}:
        raise ValueError("a condition has no samples")
    x = model_matrix([r | {"condition": int(r["condition"] == numerator)} for r in rows], [*[t for t in terms if t != "condition"], "condition"])
    if np.linalg.matrix_rank(x) < x.shape[1]:
        raise ValueError("the design is not of full rank")
    return [r["sample_id"] for r in rows], x


def _buckets(counts: DataFrame, key: str = "gene_id") -> DataFrame:
    n = max(1, -(-counts.select(key).distinct().count() // BUCKET))
    return counts.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)))


def _by_bucket(rows: DataFrame, buckets: DataFrame | None = None) -> GroupedData:
    """Rows by bucket, those of ``buckets``, which are written already. A bucket has few rows and its fit is long: a
    number of partitions that is told keeps adaptive execution from joining buckets in a task."""
    last = (rows if buckets is None else buckets).agg(F.max("bucket")).first()[0] or 0
    return rows.repartition(2 * (last + 1), "bucket").groupBy("bucket")


def sample_distances(values: DataFrame) -> DataFrame:
    """(sample_a, sample_b, distance) of (gene_id, sample_id, value): samples are tens, so that pairs
    within a gene are few."""
    a = values.select("gene_id", F.col("sample_id").alias("sample_a"), F.col("value").alias("a"))
    b = values.select("gene_id", F.col("sample_id").alias("sample_b"), F.col("value").alias("b"))
    pairs = a.join(b, "gene_id").filter("sample_a < sample_b")
    return pairs.groupBy("sample_a", "sample_b").agg(F.sqrt(F.sum(F.pow(F.col("a") - F.col("b"), 2))).alias("distance"))


def principal_components(values: DataFrame, k: int = 2) -> DataFrame:
    """(sample_id, component, score, share) from the Gram matrix of gene-centred values, which is as
    small as the samples are few."""
    centred = values.withColumn("v", F.col("value") - F.avg("value").over(Window.partitionBy("gene_id")))
    a = centred.select("gene_id", F.col("sample_id").alias("i"), F.col("v").alias("x"))
    b = centred.select("gene_id", F.col("sample_id").alias("j"), F.col("v").alias("y"))
    gram = a.join(b, "gene_id").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("g")).collect()
    names = sorted({r["i"] for r in gram})
    at = {n: i for i, n in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for r in gram:
        m[at[r["i"]], at[r["j"]]] = r["g"]
    value, vector = np.linalg.eigh(m)
    order = np.argsort(-value)[: min(k, len(names))]
    total = max(float(value[value > 0].sum()), 1e-300)
    rows = []
    for c, o in enumerate(order):
        v = vector[:, o] * math.sqrt(max(value[o], 0.0))
        v = v * (1 if v[np.abs(v).argmax()] >= 0 else -1)
        rows += [(n, c + 1, float(v[i]), float(max(value[o], 0.0) / total)) for n, i in at.items()]
    return values.sparkSession.createDataFrame(rows, "sample_id string, component int, score double, share double")


def _products(x: np.ndarray) -> np.ndarray:
    return (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)


def _fit(y: np.ndarray, offset: np.ndarray, x: np.ndarray, alpha: np.ndarray, beta: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, means) of each row's log-linear model for dispersions alpha, by scoring with halved
    steps from ``beta``."""
    beta = ((np.log(y + 0.5) - offset) @ np.linalg.pinv(x).T if beta is None else beta).copy()
    xx, p = _products(x), x.shape[1]

    def mean(b: np.ndarray) -> np.ndarray:
        return np.maximum(np.exp(np.clip(b @ x.T + offset, -30, 30)), LEAST)

    def height(b: np.ndarray, m: np.ndarray, at: np.ndarray) -> np.ndarray:
        a = alpha[at, None]
        return (y[at] * np.log(m) - (y[at] + 1 / a) * np.log1p(a * m)).sum(axis=1) - RIDGE / 2 * (b * b).sum(axis=1)

    live = np.arange(len(y))
    mu = mean(beta)
    now = height(beta, mu, live)
    for _ in range(50):
        b, m, a = beta[live], mu[live], alpha[live, None]
        info = ((m / (1 + a * m)) @ xx).reshape(-1, p, p) + RIDGE * np.eye(p)
        step = np.linalg.solve(info, (((y[live] - m) / (1 + a * m)) @ x - RIDGE * b)[..., None])[..., 0]
        step *= np.minimum(1, 5 / np.maximum(np.abs(step @ x.T).max(axis=1), 1e-12))[:, None]
        for _ in range(8):
            m = mean(b + step)
            value = height(b + step, m, live)
            worse = ~(value >= now[live])
            if not worse.any():
                break
            step[worse] /= 2
        good, gain = live[~worse], (value - now[live])[~worse]
        beta[good], mu[good], now[good] = (b + step)[~worse], m[~worse], value[~worse]
        live = good[gain > 1e-8 * (np.abs(now[good]) + 0.1)]
        if not len(live):
            break
    return beta, mu


def _log_nb(y: np.ndarray, mu: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    r = 1 / alpha
    return log_gamma(y + r) - log_gamma(r) + y * np.log(alpha * mu / (1 + alpha * mu)) - r * np.log1p(alpha * mu)


def _matrix(pdf: pd.DataFrame, key: str, samples: list[str]) -> tuple[list, np.ndarray]:
    wide = pdf.pivot_table(index=key, columns="sample_id", values="count", aggfunc="sum", fill_value=0).reindex(columns=samples, fill_value=0)
    return list(wide.index), wide.to_numpy(dtype=float)


def _dispersions(y: np.ndarray, offset: np.ndarray, x: np.ndarray, prior: tuple[np.ndarray, float] | None) -> np.ndarray:
    """The dispersion of the highest likelihood (with a normal prior on its logarithm) on the grid,
    less half the information that the coefficients take (Cox and Reid)."""
    best, out, beta = np.full(len(y), -np.inf), np.full(len(y), GRID[0]), None
    xx, p = _products(x), x.shape[1]
    for a in GRID:
        beta, mu = _fit(y, offset, x, np.full(len(y), a), beta)
        info = ((mu / (1 + a * mu)) @ xx).reshape(-1, p, p) + RIDGE * np.eye(p)
        value = _log_nb(y, mu, np.array(a)).sum(axis=1) - 0.5 * np.linalg.slogdet(info)[1]
        if prior is not None:
            value -= (math.log(a) - np.log(prior[0])) ** 2 / (2 * prior[1])
        better = value > best
        best[better], out[better] = value[better], a
    return out


def _trend(fitted: DataFrame, free: int) -> tuple[float, float, float]:
    """(base, slope, variance) of dispersions over the mean, of (mean, dispersion) fitted with ``free``
    degrees of freedom left: what the fit's own error adds to the variance is taken off."""
    spread = F.stddev(F.when(F.col("dispersion") > float(GRID[0]) * 1.001, F.log("dispersion")))
    bins = (
        fitted.filter("mean > 0").groupBy(F.floor(F.log2("mean")).alias("bin"))
        .agg(F.avg("mean").alias("m"), F.percentile("dispersion", F.lit(0.5)).alias("a"), spread.alias("sd"), F.count(F.lit(1)).alias("n"))
        .collect()
    )  # a row for each doubling of the mean
    if not bins:
        return 0.1, 0.0, 1.0
    x = np.array([[1.0, 1.0 / b["m"]] for b in bins])
    w = np.sqrt(np.array([b["n"] for b in bins], dtype=float))
    middle = (1 - 2 / (9 * max(free, 1))) ** 3  # the median of an estimate over its mean (Wilson and Hilferty)
    a = np.array([b["a"] for b in bins]) / middle
    coef, *_ = np.linalg.lstsq(x * w[:, None], a * w, rcond=None)
    found = [b["sd"] for b in bins if b["sd"] is not None]
    own = float(trigamma(free / 2)) if free > 0 else 0.0
    return max(float(coef[0]), 1e-3), max(float(coef[1]), 0.0), max(float(np.median(found)) ** 2 - own if found else 1.0, 0.25)


#: Fixed values of the published method: the share of an F distribution that no distance exceeds; replicates
#: with which a sample may be an outlier, and with which its count may be replaced; the least dispersion of
#: distances; (replicates up to, share cut off at each end, factor of the trimmed variance).
OUTLYING, ENOUGH, REPLACEABLE, LEAST_SPREAD = 0.99, 3, 7, 0.04
TRIMS = ((3.5, 1 / 3, 2.04), (23.5, 1 / 4, 1.86), (np.inf, 1 / 8, 1.51))


def _trimmed(values: np.ndarray, share: float) -> np.ndarray:
    """The mean of each row without its ``share`` smallest and largest."""
    cut_off = int(values.shape[1] * share)
    return np.sort(values, axis=1)[:, cut_off : values.shape[1] - cut_off].mean(axis=1)


def _cells(x: np.ndarray) -> list[np.ndarray]:
    """The samples of each row of the model matrix that occurs."""
    _, cell = np.unique(x, axis=0, return_inverse=True)
    return [np.flatnonzero(cell.reshape(-1) == c) for c in range(cell.max() + 1)]


def _cooks(y: np.ndarray, s: np.ndarray, x: np.ndarray, alpha: np.ndarray, mu: np.ndarray) -> np.ndarray:
    """Cook's distance of each count: what it moves its gene's coefficients by, from the residual at a
    dispersion that a single count can't raise, and the leverage of the weighted fit."""
    norm, p = y / s, x.shape[1]
    cells = [c for c in _cells(x) if len(c) >= ENOUGH]
    spread = np.zeros(len(y))
    for cell in cells or [np.arange(len(s))]:
        share, factor = next((t, f) for upto, t, f in TRIMS if len(cell) <= upto)
        off = (norm[:, cell] - _trimmed(norm[:, cell], share)[:, None]) ** 2
        spread = np.maximum(spread, factor * _trimmed(off, share))
    mean = norm.mean(axis=1)
    robust = np.maximum((spread - mean) / np.maximum(mean, 1e-12) ** 2, LEAST_SPREAD)[:, None]
    w = mu / (1 + alpha[:, None] * mu)
    info = (w @ _products(x)).reshape(-1, p, p) + RIDGE * np.eye(p)
    leverage = np.clip(w * np.einsum("np,gpq,nq->gn", x, np.linalg.inv(info), x), 0, 1 - 1e-9)
    return (y - mu) ** 2 / (mu + robust * mu**2) / p * leverage / (1 - leverage) ** 2


def _outliers(y: np.ndarray, x: np.ndarray, cooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts that are outliers, those of them that may be replaced). With one factor of two levels a
    count that three others of its gene exceed is none."""
    free = len(x) - x.shape[1]
    cells, out, may = _cells(x), np.zeros(y.shape, dtype=bool), np.zeros(len(x), dtype=bool)
    if free <= 0:
        return out, out
    far = cooks > f_quantile(OUTLYING, x.shape[1], free)
    for cell in cells:
        if len(cell) >= ENOUGH:
            out[:, cell] = far[:, cell]
        may[cell] = len(cell) >= REPLACEABLE
    if len(cells) == 2 and x.shape[1] == 2:
        out &= (y[:, None, :] > y[:, :, None]).sum(axis=2) < 3
    return out, out & may


def negative_binomial_tests(counts: DataFrame, samples: DataFrame, denominator: str, numerator: str, lfc: float = 1.0, design: str = "~ condition") -> DataFrame:
    """(gene_id, base_mean, log2_fold_change, se, stat, pvalue, pvalue_lfc, dispersion, max_cooks, outlier,
    padj): Wald tests of the condition in ``design``, of no change and of a change beyond ``lfc``, from one fit.

    Dispersions are fitted gene by gene, a trend over the mean is fitted to bins of them, and final
    ones are drawn to the trend. A count whose Cook's distance is above the F distribution's OUTLYING is
    an outlier where its cell of the design has ENOUGH replicates; with REPLACEABLE ones it is replaced by
    the gene's trimmed mean and the gene fitted again, without the gene has ``outlier`` and no p-value, and
    takes no part in the adjustment."""
    factors = {r["sample_id"]: r["size_factor"] or 1.0 for r in size_factors(counts).collect()}  # a row for each sample
    names, x = _design(samples, denominator, numerator, design, factors or None)  # all where there are no counts
    s = np.array([factors.get(n, 1.0) for n in names])
    offset = np.log(s)
    rows = cut(_buckets(counts.filter(F.col("sample_id").isin(names))))

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, y = _matrix(pdf, "gene_id", names)
        return pd.DataFrame({"gene_id": ids, "mean": (y / s).mean(axis=1), "dispersion": _dispersions(y, offset, x, None)})

    fitted = _by_bucket(rows).applyInPandas(first, "gene_id string, mean double, dispersion double")
    base, slope, var = _trend(fitted, len(names) - x.shape[1])

    def drawn(y: np.ndarray) -> np.ndarray:
        return _dispersions(y, offset, x, (base + slope / np.maximum((y / s).mean(axis=1), 1e-3), var))

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, y = _matrix(pdf, "gene_id", names)
        mean = (y / s).mean(axis=1)
        alpha = drawn(y)
        beta, mu = _fit(y, offset, x, alpha)
        cooks = _cooks(y, s, x, alpha, mu)
        far, may = _outliers(y, x, cooks)
        if (again := may.any(axis=1)).any():
            y[again] = np.where(may[again], np.round(_trimmed(y[again] / s, 0.2)[:, None] * s), y[again])
            alpha[again] = drawn(y[again])
            beta[again], mu[again] = _fit(y[again], offset, x, alpha[again])
        outlier = (far & ~may).any(axis=1)
        info = ((mu / (1 + alpha[:, None] * mu)) @ _products(x)).reshape(-1, x.shape[1], x.shape[1])
        inverse = np.linalg.inv(info + RIDGE * np.eye(x.shape[1]))
        change = beta[:, -1] / math.log(2)
        se = np.sqrt((inverse @ info @ inverse)[:, -1, -1]) / math.log(2)
        none = y.sum(axis=1) == 0
        stat = np.where(none, np.nan, change / se)
        beyond = np.where(none, np.nan, np.maximum(np.abs(change) - lfc, 0) / se)
        told = lambda p: np.where(outlier, np.nan, p)
        return pd.DataFrame({
            "gene_id": ids, "base_mean": mean, "log2_fold_change": np.where(none, np.nan, change), "se": np.where(none, np.nan, se),
            "stat": stat, "pvalue": told(normal_tail(stat)), "pvalue_lfc": told(np.minimum(1.0, normal_tail(beyond))), "dispersion": alpha,
            "max_cooks": cooks.max(axis=1), "outlier": outlier,
        })

    schema = "gene_id string, base_mean double, log2_fold_change double, se double, stat double, pvalue double, pvalue_lfc double, dispersion double, max_cooks double, outlier boolean"
    told = cut(_by_bucket(rows).applyInPandas(second, schema))
    absent = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return adjust_bh(told.select(*[absent(c) if c in ("pvalue", "pvalue_lfc") else c for c in told.columns]), [])


def usage_tests(counts: DataFrame, samples: DataFrame, denominator: str, numerator: str, design: str = "~ condition") -> DataFrame:
    """(pas_id, gene_id, lr, pvalue, padj, gene_padj): likelihood ratios of negative binomial models of a
    site's counts and those of the rest of its gene. The full model has a level for each sample and,
    for the site, the columns of ``design``; the reduced one is without the site's condition.

    Dispersions are fitted site by site and drawn to a trend over the mean of all sites. gene_padj is
    ``multitest.gene_q_values``."""
    factors = {r["sample_id"]: r["size_factor"] or 1.0 for r in size_factors(counts, "pas_id").collect()}  # a row for each sample
    names, x = _design(samples, denominator, numerator, design, factors or None)  # all where there are no counts
    k = len(names)
    s = np.array([factors.get(n, 1.0) for n in names])
    offset = np.log(np.concatenate([s, s]))
    full = np.hstack([np.vstack([np.eye(k), np.eye(k)]), np.vstack([x, np.zeros_like(x)])])
    rows = cut(_buckets(counts.filter(F.col("sample_id").isin(names))))

    def sites(pdf: pd.DataFrame) -> tuple[list, list, np.ndarray]:
        """(sites, genes, counts of the site and of the others of its gene in each sample)."""
        ids, genes, found = [], [], []
        for gene, part in pdf.groupby("gene_id"):
            own, y = _matrix(part, "pas_id", names)
            ids += own
            genes += [gene] * len(own)
            found.append(np.hstack([y, y.sum(axis=0) - y]))
        return ids, genes, np.vstack(found)

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, _, y = sites(pdf)
        return pd.DataFrame({"pas_id": ids, "mean": (y[:, :k] / s).mean(axis=1), "dispersion": _dispersions(y, offset, full, None)})

    fitted = _by_bucket(rows).applyInPandas(first, "pas_id string, mean double, dispersion double")
    base, slope, var = _trend(fitted, k - x.shape[1])

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, genes, y = sites(pdf)
        mean = (y[:, :k] / s).mean(axis=1)
        alpha = _dispersions(y, offset, full, (base + slope / np.maximum(mean, 1e-3), var))
        height = lambda m: _log_nb(y, _fit(y, offset, m, alpha)[1], alpha[:, None]).sum(axis=1)
        lr = np.maximum(2 * (height(full) - height(full[:, :-1])), 0.0)
        p = [chi_square_tail(float(v), 1) if n else None for v, n in zip(lr, y.sum(axis=1), strict=True)]
        return pd.DataFrame({"pas_id": ids, "gene_id": genes, "lr": lr, "pvalue": pd.Series(p, dtype=object)})

    tested = cut(_by_bucket(rows).applyInPandas(second, "pas_id string, gene_id string, lr double, pvalue double"))
    genes = gene_q_values(tested, [], out="gene_padj").select("gene_id", "gene_padj")
    return adjust_bh(tested, []).join(genes, "gene_id", "left")


def _fit_shares(y: np.ndarray, x: np.ndarray, precision: np.ndarray, beta: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, log-likelihood, log-determinant of the information) of Dirichlet-multinomial models of
    y (genes, sites, samples): logits against the last site are linear in x; by scoring with halved steps."""
    genes, sites, _ = y.shape
    p, total = x.shape[1], y.sum(axis=1)
    size = p * (sites - 1)
    if beta is None:
        logit = np.log(y[:, :-1] + 0.5) - np.log(y[:, -1:] + 0.5)
        beta = np.einsum("pn,gkn->gpk", np.linalg.pinv(x), logit)
    beta = beta.copy()

    def shares(b: np.ndarray) -> np.ndarray:
        eta = np.clip(np.einsum("np,gpk->gkn", x, b), -20, 20)
        e = np.exp(np.concatenate([eta, np.zeros_like(eta[:, :1])], axis=1))
        return e / e.sum(axis=1, keepdims=True)

    def height(b: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        c = precision[at]
        a = c[:, None, None] * q
        value = (log_gamma(y[at] + a) - log_gamma(a)).sum(axis=(1, 2)) + (log_gamma(c)[:, None] - log_gamma(total[at] + c[:, None])).sum(axis=1)
        return value - RIDGE / 2 * (b * b).sum(axis=(1, 2))

    def slopes(b: np.ndarray, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = precision[at][:, None, None]
        a = c * q
        first = c * (digamma(y[at] + a) - digamma(a))
        second = c * c * (trigamma(a) - trigamma(y[at] + a))
        score = q * (first - (q * first).sum(axis=1, keepdims=True))
        jac = np.einsum("gkn,kl->gnkl", q, np.eye(sites)) - np.einsum("gkn,gln->gnkl", q, q)
        info = np.einsum("gnkm,gmn,gnml->gnkl", jac, second, jac, optimize=True)[:, :, :-1, :-1]
        info = np.einsum("np,nq,gnkl->gpkql", x, x, info, optimize=True).reshape(len(at), size, size) + RIDGE * np.eye(size)
        return np.einsum("np,gkn->gpk", x, score[:, :-1]) - RIDGE * b, info

    live = np.arange(genes)
    q = shares(beta)
    now = height(beta, q, live)
    for _ in range(50):
        b = beta[live]
        score, info = slopes(b, q[live], live)
        step = np.linalg.solve(info, score.reshape(len(live), size, 1)).reshape(b.shape)
        step *= np.minimum(1, 5 / np.maximum(np.abs(np.einsum("np,gpk->gkn", x, step)).max(axis=(1, 2)), 1e-12))[:, None, None]
        for _ in range(8):
            new = shares(b + step)
            value = height(b + step, new, live)
            worse = ~(value >= now[live])
            if not worse.any():
                break
            step[worse] /= 2
        good, gain = live[~worse], (value - now[live])[~worse]
        beta[good], q[good], now[good] = (b + step)[~worse], new[~worse], value[~worse]
        live = good[gain > 1e-8 * (np.abs(now[good]) + 0.1)]
        if not len(live):
            break
    return beta, now, np.linalg.slogdet(slopes(beta, q, np.arange(genes))[1])[1]


#: The precisions that usage fits choose from, and the degrees of freedom that the common curve is worth.
PRECISIONS, PRIOR_DF = np.exp(np.linspace(math.log(0.5), math.log(5000.0), 40)), 10.0


def _common_curves(curves: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(doublings of the mean, mean curve of the genes near each) of (mean, curve): genes a doubling away
    count six tenths, those two away an eighth."""
    each = curves.select(F.floor(F.log2("mean")).alias("bin"), F.posexplode("curve").alias("i", "v")).groupBy("bin", "i").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))
    got = each.collect()  # a row for each doubling and precision
    bins = np.array(sorted({r["bin"] for r in got}), dtype=float)
    at = {b: i for i, b in enumerate(bins)}
    sums, n = np.zeros((len(bins), len(PRECISIONS))), np.zeros(len(bins))
    for r in got:
        sums[at[r["bin"]], r["i"]], n[at[r["bin"]]] = r["v"], r["n"]
    near = np.exp(-((bins[:, None] - bins[None, :]) ** 2) / 2)
    return bins, (near @ sums) / np.maximum(near @ n, 1e-12)[:, None]


def dirichlet_tests(counts: DataFrame, samples: DataFrame, denominator: str, numerator: str, design: str = "~ condition") -> DataFrame:
    """(gene_id, feature_id, precision, gene_pvalue, pvalue, retried): Dirichlet-multinomial likelihood ratios
    of the condition in ``design`` for a gene's shares, and beta-binomial ones for each site.

    A gene's precision is moderated. Its profile likelihood, less half the information that the coefficients
    take (Cox and Reid), is worked out on a grid; the curves of genes of like expression are averaged, and
    the gene's own is drawn to theirs, which counts as PRIOR_DF degrees of freedom against those that the
    samples leave. Where a fit fails, a small uniform count is added and the fit repeated."""
    names, x = _design(samples, denominator, numerator, design)
    rows = cut(_buckets(counts.filter(F.col("sample_id").isin(names))))
    reduced = x[:, :-1]
    worth = PRIOR_DF / max(len(names) - x.shape[1], 1)

    def ratios(y: np.ndarray, precision: np.ndarray) -> np.ndarray:
        return np.maximum(2 * (_fit_shares(y, x, precision)[1] - _fit_shares(y, reduced, precision)[1]), 0.0)

    def profile(y: np.ndarray) -> np.ndarray:
        """(gene, precision) likelihoods above each gene's least; genes with equally many sites."""
        curve, beta = np.zeros((len(y), len(PRECISIONS))), None
        for i, c in enumerate(PRECISIONS):
            beta, value, taken = _fit_shares(y, x, np.full(len(y), c), beta)
            curve[:, i] = value - 0.5 * taken
        return curve - curve.max(axis=1, keepdims=True)

    def alike(pdf: pd.DataFrame) -> tuple[list, dict]:
        """(genes that can't be tested with their sites; by number of sites the (gene, sites, counts) of others)."""
        others, found = [], {}
        for gene, part in pdf.groupby("gene_id"):
            ids, y = _matrix(part, "pas_id", names)
            if len(ids) < 2 or not y.sum():
                others.append((gene, ids))
            else:
                found.setdefault(len(ids), []).append((gene, ids, y))
        return others, found

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for genes in alike(pdf)[1].values():
            y = np.stack([g[2] for g in genes])
            curve = profile(y)
            again = ~np.isfinite(curve).all(axis=1)
            if again.any():
                curve[again] = profile(y[again] + 0.1)
            out += [(g[0], float(m), c.tolist(), bool(r)) for g, m, c, r in zip(genes, y.sum(axis=1).mean(axis=1), curve, again, strict=True)]
        return pd.DataFrame(out, columns=["gene_id", "mean", "curve", "retried"])

    curves = cut(_by_bucket(rows).applyInPandas(first, "gene_id string, mean double, curve array<double>, retried boolean"))
    bins, common = _common_curves(curves.filter(~F.exists("curve", lambda v: F.isnan(v))))
    joined = rows.join(curves.select("gene_id", "mean", "curve", "retried"), "gene_id", "left")

    def second(pdf: pd.DataFrame) -> pd.DataFrame:
        others, found = alike(pdf)
        own = pdf.drop_duplicates("gene_id").set_index("gene_id")
        out = [(gene, i, None, None, None, False) for gene, ids in others for i in ids]
        for k, genes in found.items():
            told = own.loc[[g[0] for g in genes]]
            at = np.abs(np.floor(np.log2(told["mean"].to_numpy()))[:, None] - bins[None, :]).argmin(axis=1)
            curve = np.stack(told["curve"].to_list()) + worth * common[at]
            precision, again = PRECISIONS[np.nan_to_num(curve, nan=-np.inf).argmax(axis=1)], told["retried"].to_numpy(dtype=bool)
            y = np.stack([g[2] for g in genes])
            y = np.where(again[:, None, None], y + 0.1, y)

            def tested(y: np.ndarray, precision: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                one = np.stack([y, y.sum(axis=1, keepdims=True) - y], axis=2)  # a site against the others of its gene
                return ratios(y, precision), ratios(one.reshape(-1, 2, y.shape[2]), np.repeat(precision, y.shape[1])).reshape(y.shape[:2])

            lr, sites = tested(y, precision)
            if (bad := ~np.isfinite(lr) & ~again).any():
                lr[bad], sites[bad] = tested(y[bad] + 0.1, precision[bad])
                again = again | bad
            for (gene, ids, _), c, v, each, r in zip(genes, precision, lr, sites, again, strict=True):
                p = chi_square_tail(float(v), k - 1)
                out += [(gene, i, float(c), p, chi_square_tail(float(u), 1), bool(r)) for i, u in zip(ids, each, strict=True)]
        return pd.DataFrame(out, columns=["gene_id", "feature_id", "precision", "gene_pvalue", "pvalue", "retried"])

    schema = "gene_id string, feature_id string, precision double, gene_pvalue double, pvalue double, retried boolean"
    return _by_bucket(joined, rows).applyInPandas(second, schema)


def usage_fit_audit(tests: DataFrame, design: str = "~ condition", contrast: str = "contrast_id") -> DataFrame:
    """(contrast_id, status, fit_policy, multifactor, one_way, add_uniform, seed, first_error, genes, retried)
    of usage fits by contrast, for ``checks.fit_faults``."""
    plain, retry = FIT_STATUS
    per = tests.groupBy(F.col(contrast).alias("contrast_id")).agg(
        F.count_distinct("gene_id").alias("genes"), F.count_distinct(F.when(F.col("retried"), F.col("gene_id"))).alias("retried"), F.min(F.when(F.col("retried"), F.col("gene_id"))).alias("one")
    )
    again, several = F.col("retried") > 0, F.lit(len(variables(design)) > 1)
    return per.select(
        "contrast_id",
        F.when(again, FIT_STATUS[retry]).otherwise(FIT_STATUS[plain]).alias("status"),
        F.when(again, retry).otherwise(plain).alias("fit_policy"),
        several.alias("multifactor"),
        (~several).alias("one_way"),
        again.alias("add_uniform"),
        checksum_seed(F.col("contrast_id")).alias("seed"),
        F.when(again, F.concat(F.lit("no finite likelihood: "), F.col("one"))).otherwise("").alias("first_error"),
        "genes",
        "retried",
    )
