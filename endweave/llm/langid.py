"""Language identification by inference of language mixtures.

Each language is a distribution over hashed byte n-grams. The n-grams of a document are taken as
drawn from a mixture of languages, whose proportions expectation-maximisation estimates. The set of
languages is searched by its penalised likelihood: from the best single language up, and from the
mixture of all down, sets that add, drop or exchange a language are tried until none is better.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.llm.wordhash import chunks, mix64

#: n-gram length in bytes, and the number of hashed n-grams.
GRAM, SPACE_LOG = 4, 15
#: The bound of what is learnt from: about so many documents of each language, drawn by a hash.
SAMPLE = 2000
#: Added to every count, EM steps over all languages, those over a set at most, and the price of a
#: language in a set: PRICE * ln(n-grams).
SMOOTH, STEPS, SET_STEPS, PRICE = 0.5, 12, 500, 4.0
#: What a set's best mixture may be better at most than that at which EM ends, in units of log-likelihood.
NEAR = 0.01
#: Numbers in an array of (gram, language) at most, but for a single document.
CELLS = 1 << 21
UNDETERMINED = "und"

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct grams, their counts) of each row. Other ASCII than letters is one blank each."""
    n = len(offsets) - 1
    pad = GRAM - 1
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(n), lengths)
    line = np.full(len(data) + pad * (n + 1), 32, dtype=np.uint64)
    line[np.arange(len(data)) + pad * (row + 1)] = _FOLD[data]
    value = np.zeros(len(line) - pad, dtype=np.uint64)
    for i in range(GRAM):
        value = value << np.uint64(8) | line[i : i + len(value)]
    blank = value == np.uint64(0x20202020)
    gram = (mix64(value) >> np.uint64(64 - SPACE_LOG)).astype(np.int64)
    for i in range(n):
        at = offsets[i] + pad * i + 1
        to = offsets[i + 1] + pad * (i + 1)
        own = gram[at:to][~blank[at:to]]
        if len(own) < 4096:
            yield np.unique(own, return_counts=True)
        else:
            counts = np.bincount(own, minlength=1 << SPACE_LOG)
            grams = np.flatnonzero(counts)
            yield grams, counts[grams]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of rows (lang, text)."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for at, _, data, offsets in chunks(batch.column(1)):
            for i, (grams, counts) in enumerate(gram_counts(data, offsets)):
                held = total.setdefault(langs[at + i], np.zeros(1 << SPACE_LOG, dtype=np.int64))
                held[grams] += counts
    for lang, counts in total.items():
        grams = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int32()), pa.array(counts[grams], pa.int64())],
            names=["lang", "gram", "n"],
        )


def learn(rows: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages in order, probability of each gram in each) from rows (id, text, lang).

    Rows without a text or language are left out. About ``sample`` documents of each language
    count, drawn by a hash of their id, whole texts each.
    """
    rows = rows.filter("text is not null and lang is not null")
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(per)
    if not langs:
        return [], np.zeros((1 << SPACE_LOG, 0))
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, min(1.0, sample / per[lang])).otherwise(share)
    drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000)) < share * 1_000_000)
    counts = drawn.select("lang", "text").mapInArrow(_count, "lang string, gram int, n long")
    table = np.full((1 << SPACE_LOG, len(langs)), SMOOTH)
    index = {lang: i for i, lang in enumerate(langs)}
    # As many rows as grams times languages at most, as arrays.
    got = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    at = np.array([index[lang] for lang in got.column("lang").to_pylist()], dtype=np.int64)
    table[got.column("gram").to_numpy(), at] += got.column("n").to_numpy()
    return langs, table / table.sum(axis=0)


def _em(p: np.ndarray, c: np.ndarray, row: np.ndarray, first: np.ndarray, pi: np.ndarray, steps: int) -> tuple[np.ndarray, ...]:
    """(proportions, log-likelihood, what a better mixture can add to it at most) of each row;
    languages with proportion 0 stay out.

    The likelihood is concave in the proportions, and so no mixture beats it by more than
    n * log(max d), where n is the number of grams and d_l what EM would multiply the proportion
    of language l by in its next step."""
    total = np.add.reduceat(c, first)
    for _ in range(steps):
        part = pi[row] * p
        part *= (c / part.sum(axis=1))[:, None]
        pi = np.add.reduceat(part, first, axis=0) / total[:, None]
    each = (pi[row] * p).sum(axis=1)
    d = np.add.reduceat((c / each)[:, None] * p, first, axis=0) / total[:, None]
    return pi, np.add.reduceat(c * np.log(each), first), total * np.log(np.maximum(d.max(axis=1), 1.0))


def mixtures(table: np.ndarray, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Proportions of the languages in each document, 0 outside the selected set.

    Documents without grams have equal proportions. Documents are worked on in batches whose arrays
    hold about CELLS numbers, or one document.
    """
    langs = table.shape[1]
    out = np.full((len(docs), langs), 1.0 / langs)
    some = np.array([i for i, (g, _) in enumerate(docs) if len(g)], dtype=np.int64)
    if not len(some) or langs == 1:
        return out
    upto = np.cumsum([len(docs[i][0]) for i in some]) * langs
    batch = upto // CELLS
    for at in np.split(some, np.flatnonzero(np.diff(batch)) + 1):
        out[at] = _selected(table, [docs[i] for i in at])
    return out


def _selected(table: np.ndarray, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    langs = table.shape[1]
    size = np.array([len(g) for g, _ in docs])
    p = table[np.concatenate([g for g, _ in docs])]
    c = np.concatenate([n for _, n in docs]).astype(float)

    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    everyone = np.arange(len(size))
    pi, most, slack = _em(p, c, np.repeat(everyone, size), first, np.full((len(size), langs), 1.0 / langs), STEPS)
    single = np.add.reduceat(c[:, None] * np.log(p), first, axis=0)
    best = np.zeros((len(size), langs))
    best[everyone, single.argmax(axis=1)] = 1.0
    price = PRICE * np.log(np.maximum(np.add.reduceat(c, first), 2))
    # Where not even the best mixture of all languages can repay the price of two, one it is.
    for i in np.flatnonzero(most + slack - price > single.max(axis=1)):
        own = slice(first[i], first[i] + size[i])
        # A search may end before the best set: it is made from below and from above.
        wide = np.where(pi[i] * c[own].sum() > price[i] / 4, pi[i], 0.0)
        wide = wide / wide.sum() if wide.any() else best[i]
        value, found = searched(p[own], c[own], best[i], float(price[i]))
        if ((wide > 0) != (found > 0)).any():
            value, found = max((value, found), searched(p[own], c[own], wide, float(price[i])), key=lambda t: t[0])
        best[i] = found
    return best


def fitted(p: np.ndarray, c: np.ndarray, pi: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(proportions, log-likelihood, what EM would multiply each language's by next) of one document, from pi
    on, until no mixture of the languages in pi is better by more than NEAR."""
    n, inside = c.sum(), np.flatnonzero(pi)
    own, held = p[:, inside], pi[inside]
    for _ in range(SET_STEPS):
        each = own @ held
        d = (c / each) @ own / n
        if n * np.log(d.max()) < NEAR:
            break
        held = held * d
    out = np.zeros_like(pi)
    out[inside] = held / held.sum()
    each = p @ out
    return out, float(c @ np.log(each)), (c / each) @ p / n


def searched(p: np.ndarray, c: np.ndarray, pi: np.ndarray, price: float) -> tuple[float, np.ndarray]:
    """(penalised likelihood, proportions) of the set of languages at which a search from that of ``pi`` ends:
    of the sets that add a language, drop one or exchange one the best, as long as there is a better one.

    A language is tried where the likelihood could pay for it: it grows by n * log(d) at most, where d is
    what EM would multiply its proportion by."""
    n = c.sum()
    pi, likely, d = fitted(p, c, pi)
    value = likely - price * (np.count_nonzero(pi) - 1)
    better = True
    while better:
        better, size = False, np.count_nonzero(pi)
        best = (value, pi, likely, d)
        for other in np.argsort(-d):
            # An exchange keeps the size, and so has no price to pay.
            if pi[other] > 0 or likely + n * np.log(max(d[other], 1.0)) - price * (size - 1) <= best[0]:
                continue
            start = pi * (1 - 1 / (size + 1))
            start[other] = 1 / (size + 1)
            grown = fitted(p, c, start)
            tried = [(grown[1] - price * size, *grown)]
            if grown[1] - price * (size - 1) > best[0]:
                for gone in np.flatnonzero(pi):
                    less = grown[0].copy()
                    less[gone] = 0.0
                    if less.sum() > 0:
                        left = fitted(p, c, less / less.sum())
                        tried.append((left[1] - price * (size - 1), *left))
            best = max([best, *tried], key=lambda t: t[0])
        if size > 1:
            for gone in np.flatnonzero(pi):
                less = pi.copy()
                less[gone] = 0.0
                left = fitted(p, c, less / less.sum())
                best = max(best, (left[1] - price * (size - 2), *left), key=lambda t: t[0])
        if best[0] > value + NEAR:
            value, pi, likely, d = best
            better = True
    return value, pi


def has_letter(column: pa.Array, data: np.ndarray, offsets: np.ndarray, at: int) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(ch.isalpha() for ch in column[at + int(i)].as_py())
    return out


def _predict(langs: list[str], shared: Broadcast, id_name: str, carried: list[str]):
    names = [id_name, "held_out", "lang_pred", "score", "langs", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            pred, score, chosen = [], [], []
            for at, to, data, offsets in chunks(batch.column(2)):
                letters = has_letter(batch.column(2), data, offsets, at)
                if not langs:
                    pred += [UNDETERMINED] * (to - at)
                    score += [0.0] * (to - at)
                    chosen += [""] * (to - at)
                    continue
                pi = mixtures(table, list(gram_counts(data, offsets)))
                top = pi.argmax(axis=1)
                for i in range(to - at):
                    pred.append(langs[top[i]] if letters[i] else UNDETERMINED)
                    score.append(float(min(pi[i, top[i]], 1.0)) if letters[i] else 0.0)
                    chosen.append(",".join(langs[j] for j in np.flatnonzero(pi[i] > 0)) if letters[i] else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(chosen, pa.string())]
                + [batch.column(3 + i) for i in range(len(carried))],
                names=names,
            )

    return run


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, fold: int = 2, sample: int = SAMPLE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, langs.

    Rows whose crc32 of the id modulo ``folds`` is ``fold`` are held out: nothing is learnt from
    them, nor from rows without id, text or language. lang_pred is the language of the largest
    proportion, score that proportion, langs all selected languages; a row that is there several times, and a
    text of any length, is told like any other, from all of its text. A null text, and one without a
    letter, has ``und``, score 0 and no languages; so has every row where nothing can be learnt. An
    empty table gives an empty result. Columns named in ``carry`` are passed through; others than
    these and the three named are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False)).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        *[F.col(c).alias(f"carried_{c}") for c in carry],
    )
    langs, table = learn(rows.filter("not held_out and id is not null").select("id", "text", "lang"), sample)
    schema = f"{id_col} long, held_out boolean, lang_pred string, score double, langs string"
    types = dict(docs.select(*carry).dtypes) if carry else {}
    schema += "".join(f", {c} {types[c]}" for c in carry)
    read = rows.select("id", "held_out", "text", *[f"carried_{c}" for c in carry])
    # 256 KB for each language, once to an executor.
    shared = docs.sparkSession.sparkContext.broadcast(table)
    return read.mapInArrow(_predict(langs, shared, id_col, list(carry)), schema)
