"""Toxicity scores from gradient-boosted trees over a few dense features.

Features are densities: of a lexicon that is learnt from labelled documents (words, and beginnings
of words), of the second person near its terms, of capitals, punctuation and obfuscated words.
Trees are grown on histograms of the features; isotonic regression, on sums of trees that have
not seen the document, turns them into probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.llm.common import columns_of

#: The bound of what is learnt from: about so many labelled documents, drawn by a hash.
SAMPLE = 12_000
#: Terms of the lexicon at most, and the lengths of the beginnings of words among them.
TERMS, STEMS = 256, (5, 6, 7)
#: Documents in which a term must occur: a part of the toxic ones, and a number.
TERM_SHARE, TERM_LEAST, TERM_ODDS = 0.02, 4, 2.5
TREES, DEPTH, RATE, BINS, LEAST = 60, 3, 0.15, 48, 5
#: Folds of the calibration.
FOLDS = 5
#: Characters between a term and a second-person word that belong together.
NEAR = 40
#: The weight of the words that are in the lexicon from the start.
SEED_ODDS = 3.0

#: Common insults, known before any label is read.
INSULTS = frozenset(
    "idiot idiots moron morons stupid imbecile fool fools dumb loser losers trash garbage scum filth pathetic worthless disgusting "
    "clown jerk creep pig vermin freak coward liar ugly hate shut bastard bitch asshole crap damn "
    "idiote imbécile crétin abruti ordure connard salaud dummkopf trottel abschaum arschloch widerlich idiota imbécil estúpido basura escoria asqueroso".split()
)

#: Second-person words of the languages at hand.
SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen euch ihr sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros os vuestro".split()
)
#: Characters that stand for letters in obfuscated words.
LEET = str.maketrans("013457@$!", "oieastasi")

_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"(?<![^\W\d_])[^\W\d_]+(?:[0134579@$!*._-]+[^\W\d_]+)+(?![^\W\d_])")
_RUN = re.compile(r"([^\W\d_])\1\1")
FEATURES = (
    "lexicon_density", "lexicon_distinct", "lexicon_weight", "lexicon_hits", "near_second", "second_density",
    "capitals", "shouted", "exclamations", "punctuation", "obfuscated", "odd_hits", "stretched", "digits", "log_words",
)


def plain(text: str) -> str:
    """The words of a text, case-folded, one blank around each: what the lexicon is looked up in."""
    return " " + " ".join(_WORD.findall(text.lower())) + " "


def _terms(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    out = {f" {w} " for w in words}
    for w in words:
        for n in STEMS:
            if len(w) > n:
                out.add(" " + w[:n])
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, number of documents) of rows (toxic, text)."""
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(1).to_pylist():
            counts.update(_terms(text or ""))
    terms = list(counts)
    for i in range(0, len(terms), 50_000):
        part = terms[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[t] for t in part], pa.int64())], names=["term", "toxic"])


def learn_lexicon(rows: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Term to log odds, TERMS at most and common insults, from rows (toxic, text).

    Candidates are all terms of enough toxic documents; as these are a part of them (TERM_SHARE),
    there are at most so many candidates as a document has terms over that part."""
    least = max(TERM_LEAST, TERM_SHARE * n_toxic)
    toxic = rows.filter("toxic = 1").mapInArrow(_count_terms, "term string, toxic long").groupBy("term")
    chosen = [r["term"] for r in toxic.agg(F.sum("toxic").alias("n")).filter(F.col("n") >= least).collect()]
    seed = {f" {w} ": SEED_ODDS for w in INSULTS}
    if not chosen:
        return seed
    found = rows.mapInArrow(_recount(chosen), "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic"), F.sum("clean"))
    odds = {t: math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1)) for t, a, b in found.collect()}
    best = sorted((-x, t) for t, x in odds.items() if x >= TERM_ODDS)[:TERMS]
    return seed | {t: -x for x, t in best}


def _recount(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(terms)
        seen = {t: [0, 0] for t in terms}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for term in _terms(text or "") & known:
                    seen[term][0 if label else 1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([seen[t][0] for t in terms], pa.int64()), pa.array([seen[t][1] for t in terms], pa.int64())],
            names=["term", "toxic", "clean"],
        )

    return run


def near_any(places: list[int], others: list[int], most: int) -> int:
    """How many of the places have one of the others within ``most``; others come in order."""
    there = np.array(others)
    at = np.array(places)
    after = np.searchsorted(there, at)
    nearest = np.minimum(np.abs(at - there[np.maximum(after - 1, 0)]), np.abs(there[np.minimum(after, len(there) - 1)] - at))
    return int((nearest <= most).sum())


class Extractor:
    """Features of a text; the lexicon is one automaton over ``plain`` text."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for term, odds in lexicon.items():
            self.automaton.add_word(term, (term, odds))
        for word in SECOND:
            key = f" {word} "
            if key not in lexicon:
                self.automaton.add_word(key, (key, 0.0))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> list[float]:
        line = plain(text)
        words = line.count(" ") - 1 if len(line) > 2 else 0
        n = max(words, 1)
        places: dict[int, float] = {}
        kinds: set[str] = set()
        second: list[int] = []
        for end, (term, odds) in self.automaton.iter(line):
            start = end - len(term) + 1
            if term[-1] == " " and term[1:-1] in SECOND:
                second.append(start)
            if odds:
                kinds.add(term)
                places[start] = max(odds, places.get(start, 0.0))  # a word and its beginning are one hit
        near = near_any(list(places), second, NEAR) if second and places else 0
        odd = _ODD.findall(text) if any(c in text for c in "0134579@$!*._-") else []
        odd_hits = 0
        if odd and self.lexicon:
            turned = " ".join([""] + [re.sub(r"[^a-z]+", "", w.lower().translate(LEET)) for w in odd] + [""])
            odd_hits = sum(1 for _, (_, odds) in self.automaton.iter(turned) if odds)
        size = max(len(text), 1)
        ascii_text = text.encode("utf-8", "ignore")
        data = np.frombuffer(ascii_text, dtype=np.uint8)
        upper = (data >= 65) & (data <= 90)
        shouted = int((upper[1:-1] & upper[:-2] & upper[2:]).sum()) if len(data) > 2 else 0
        digits = int(((data >= 48) & (data <= 57)).sum())
        letters = int(((data | 32) >= 97).sum())
        blanks = int((data <= 32).sum())
        return [
            len(places) / n,
            float(len(kinds)),
            max(places.values(), default=0.0),
            float(len(places)),
            float(near),
            len(second) / n,
            int(upper.sum()) / size,
            shouted / size,
            ascii_text.count(b"!") / n,
            max(len(data) - letters - digits - blanks, 0) / size,
            len(odd) / n,
            float(odd_hits),
            sum(1 for _ in _RUN.finditer(line)) / n,
            digits / size,
            math.log1p(words),
        ]


def _features(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(lexicon)
        for batch in batches:
            values = [extract(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))], names=["toxic", "fold", "x"]
            )

    return run


class Trees:
    """Boosted regression trees on logistic loss; splits at quantiles of the features."""

    def __init__(self):
        self.base = 0.0
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # feature (-1: leaf), cut, value

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        p = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
        self.base = math.log(p / (1 - p))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        # A value with more than a bin of its own, as 0 often is, needs a cut on either side of it.
        cuts = [np.unique(np.concatenate([c, np.nextafter(c, np.inf), [x[:, f].min()]])) for f, c in enumerate(cuts)]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, cuts, y - q, q * (1 - q))
            self.nodes.append(tree)
            score += RATE * self._tree(tree, x)
        return self

    def _grow(self, binned, cuts, g, h):
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        rows = {0: np.arange(len(g))}
        for node in range(size):
            if node not in rows:
                continue
            at = rows.pop(node)
            gs, hs = g[at].sum(), h[at].sum()
            value[node] = gs / (hs + 1.0)
            if node >= 2**DEPTH - 1 or len(at) < 2 * LEAST:
                continue
            best = (1e-6, -1, 0)
            for f, c in enumerate(cuts):
                b = binned[f][at]
                gl = np.cumsum(np.bincount(b, weights=g[at], minlength=len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, weights=h[at], minlength=len(c) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(nl < LEAST) | (len(at) - nl < LEAST)] = 0
                k = int(gain.argmax()) if len(gain) else 0
                if len(gain) and gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
            if best[1] >= 0:
                feature[node], cut[node] = best[1], cuts[best[1]][best[2]]
                left = binned[best[1]][at] <= best[2]
                rows[2 * node + 1], rows[2 * node + 2] = at[left], at[~left]
        return feature, cut, value

    @staticmethod
    def _tree(tree, x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            f = feature[node]
            go = f >= 0
            right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
            node = np.where(go, 2 * node + 1 + right, node)
        return value[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.nodes:
            out += RATE * self._tree(tree, x)
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, probability) knots of the rising fit, by pooling neighbours that fall."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, number, sum of scores
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(s)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a, b, c = blocks.pop()
            blocks[-1][0] += a
            blocks[-1][1] += b
            blocks[-1][2] += c
    n = len(y)
    knots = np.array([b[2] / b[1] for b in blocks])
    level = np.array([(b[0] + 0.5 / n) / (b[1] + 1.0 / n) for b in blocks])
    return knots, level


class Model:
    """What scores a text: lexicon, trees and calibration, or a constant where nothing can be learnt."""

    def __init__(self, lexicon: dict[str, float], trees: Trees | None, knots: tuple | None, constant: float):
        self.lexicon, self.trees, self.knots, self.constant = lexicon, trees, knots, constant

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        raw = self.trees.raw(x)
        level = np.interp(raw, *self.knots)
        # Between and beyond knots the order of the trees' sums is kept by a small share of theirs.
        return np.clip(0.99 * level + 0.01 / (1 + np.exp(-raw)), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 5, fold: int = 0) -> Model:
    """The model of about ``sample`` labelled documents (id, text; id, toxic), drawn by a hash, whose
    crc32 of the id modulo ``folds`` is not ``fold``."""
    known = (
        labels.filter("id is not null and toxic is not null")
        .filter(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(folds)) != fold)
        .groupBy("id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    total = known.count()
    if not total:
        return Model({}, None, None, 0.0)
    part = min(1.0, sample / total)
    drawn = known.filter(F.pmod(F.xxhash64("id", F.lit(8)), F.lit(1_000_000)) < part * 1_000_000).select(
        "id", "toxic", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(FOLDS)).cast("int").alias("fold")
    )
    # The sample's bound is that of what is broadcast.
    rows = docs.filter("id is not null").join(F.broadcast(drawn), "id").select("toxic", "fold", "text").repartition(16)
    rows = rows.persist()
    try:
        counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(counts) < 2:
            return Model({}, None, None, float(bool(counts.get(1))))
        lexicon = learn_lexicon(rows.select("toxic", "text"), counts[1], counts[0])
        got = rows.mapInArrow(_features(lexicon), "toxic int, fold int, x array<double>").collect()
    finally:
        rows.unpersist()
    got.sort(key=lambda r: (r["fold"], r["toxic"], r["x"]))
    x, y = np.array([r["x"] for r in got]), np.array([float(r["toxic"]) for r in got])
    part = np.array([r["fold"] for r in got])
    trees = Trees().fit(x, y)
    # Calibration is on sums of trees that have not seen the document: those of the other folds.
    raw = trees.raw(x)
    for f in range(FOLDS):
        seen = part != f
        if seen.all() or len(set(y[seen])) < 2:
            continue
        raw[~seen] = Trees().fit(x[seen], y[seen]).raw(x[~seen])
    return Model(lexicon, trees, isotonic(raw, y), float(y.mean()))


def _score(model: Model, id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(model.lexicon)
        for batch in batches:
            x = np.array([extract(t or "") for t in batch.column(2).to_pylist()]).reshape(-1, len(FEATURES))
            score = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())],
                names=[id_name, "held_out", "score", "predicted"],
            )

    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, folds: int = 5, fold: int = 0
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Rows whose crc32 of the id modulo ``folds`` is ``fold`` are held out: nothing is learnt from
    their labels. A null text is scored as an empty one; a null id is kept and not held out.
    Several labels of one id count as the largest. Where there is no label the score is 0, where
    there is but one kind of label it is that label. An empty table gives an empty result; other
    columns are not read.
    """
    rows = columns_of(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False)).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    known = columns_of(labels, id_col, label_col).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    model = fit(rows.select("id", "text"), known, sample, folds, fold)
    return rows.mapInArrow(_score(model, id_col), f"{id_col} long, held_out boolean, score double, predicted int")
