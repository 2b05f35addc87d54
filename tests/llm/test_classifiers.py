"""Language, toxicity and license scans: held-out accuracy, and brute force where there is one."""

import os
import random
import re
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from endweave.llm import langid, toxicity
from endweave.llm import licenses
from endweave.llm.license_texts import TEMPLATES, WHOLE
from endweave.llm.licenses import BASE, scan_licenses

from .test_duplicates import clashing

FOLDER = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@data
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 100 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_mixture_and_odd_rows(spark):
    rng = random.Random(1)
    words = {"xx": ["alpha", "gamma", "delta", "omega"], "yy": ["bribu", "zukki", "wopto", "fimmi"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=60)), lang) for i in range(80) for lang in [("xx", "yy")[i % 2]]]
    half = " ".join(rng.choices(words["xx"], k=120) + rng.choices(words["yy"], k=60))
    rows += [(200, half, None), (201, None, "xx"), (202, "12 34!", "xx"), (203, "", None), (None, "alpha gamma delta", "yy")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in langid.identify(df, carry=("n", "lang")).collect()}
    assert len(got) == len(rows) and got[200].lang == None  # noqa: E711
    assert got[200].langs == "xx,yy" and got[200].lang_pred == "xx" and abs(got[200].score - 2 / 3) < 0.06
    assert all(got[i].lang_pred == lang and got[i].langs == lang for i, _, lang in rows[:80])
    assert [got[i].lang_pred for i in (201, 202, 203)] == ["und"] * 3 and got[None].lang_pred == "xx" and got[None].held_out is False
    assert langid.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def best_of_all_sets(table, grams, counts):
    """{set: penalised likelihood} of every set of languages, by EM in plain sums until it stands still."""
    p, c = table[grams], counts.astype(float)
    price = langid.PRICE * np.log(max(counts.sum(), 2))
    values = {}
    for k in range(1, table.shape[1] + 1):
        for langs in combinations(range(table.shape[1]), k):
            pi = np.full(k, 1 / k)
            for _ in range(3000):
                part = p[:, langs] * pi
                new = (c[:, None] * part / part.sum(axis=1, keepdims=True)).sum(axis=0) / c.sum()
                done = np.abs(new - pi).max() < 1e-9
                pi = new
                if done:
                    break
            values[langs] = float(c @ np.log(p[:, langs] @ pi)) - price * (k - 1), dict(zip(langs, pi, strict=True))
    return values


def alike_table(seed=4):
    """Five languages of 400 grams, of which the first two share most of their probability."""
    rng = np.random.default_rng(seed)
    table = rng.dirichlet(np.full(400, 0.2), size=5).T + 1e-5
    table[:, 1] = 0.85 * table[:, 0] + 0.15 * table[:, 1]
    return table / table.sum(axis=0)


def test_language_sets_against_all_sets(monkeypatch):
    rng = np.random.default_rng(4)
    table, docs = alike_table(), []
    shares = [(1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0.9, 0, 0.1, 0, 0), (0.8, 0, 0.2, 0, 0), (0, 0.8, 0.2, 0, 0), (0.4, 0.3, 0.3, 0, 0), (0, 0.5, 0, 0.3, 0.2), (0.2,) * 5, (0.994, 0, 0.006, 0, 0)]
    for share in shares:
        for n in (3, 60, 2000, 40_000):
            counts = rng.multinomial(n, table @ np.array(share))
            docs.append((np.flatnonzero(counts), counts[counts > 0]))
    monkeypatch.setattr(langid, "CELLS", 5000)
    got = langid.mixtures(table, docs)
    for row, (grams, counts) in zip(got, docs, strict=True):
        values = best_of_all_sets(table, grams, counts)
        own = tuple(int(i) for i in np.flatnonzero(row > 0))
        assert values[own][0] >= max(v for v, _ in values.values()) - 0.05
        assert all(abs(row[i] - v) < 0.02 for i, v in values[own][1].items())


def test_a_like_language_does_not_hide_another(spark):
    """Two languages that share 85 % of their words, and one that stands beside one of them in a text."""
    rng = random.Random(6)
    make = lambda k: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(k)]
    shared = make(170)
    words = {"da": shared + make(30), "no": shared + make(30), "en": make(200)}
    rows = [(i, " ".join(rng.choices(words[lang], k=300)), lang) for i in range(240) for lang in [("da", "no", "en")[i % 3]]]
    rows += [(500 + share, " ".join(rng.choices(words["no"], k=3000 - 30 * share) + rng.choices(words["en"], k=30 * share)), None) for share in (10, 20, 40)]
    rows += [(520, rows[-2][1], None), (700, " ".join(rng.choices(words["no"], k=200_000)), None)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for share in (10, 20, 40):
        assert got[500 + share].langs == "en,no" and abs(got[500 + share].score - (1 - share / 100)) < 0.03
    assert got[700].langs == "no" and got[700].score == 1.0


def test_a_little_of_a_language_is_found(spark):
    """A hundredth of a long text, and one of many languages."""
    rng = random.Random(5)
    langs = [f"l{i:02}" for i in range(30)]
    words = {lang: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30)] for lang in langs}
    rows = [(i, " ".join(rng.choices(words[langs[i % 30]], k=500)), langs[i % 30]) for i in range(300)]
    rows.append((500, " ".join(rng.choices(words["l03"], k=40_000) + rng.choices(words["l07"], k=300)), None))
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[500].langs == "l03,l07" and got[500].lang_pred == "l03" and 0.98 < got[500].score < 1
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:300])


@data
def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else FOLDER
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    a, b = (np.array([r.score for r in held if r.toxic == t]) for t in (1, 0))
    assert (a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean() > 0.95
    assert (a >= 0.5).mean() > 0.8 and (b >= 0.5).mean() < 0.02


def test_features_by_loops():
    """Counts behind the features, place by place, also of texts that repeat what they say."""
    lexicon = {" idiot ": 3.0, " stupi": 2.0, " hate ": 1.5}
    extract = toxicity.Extractor(lexicon)
    texts = ["", "You idiot!", "calm words only", "stupid stupidity, you hate THIS sooo much 1d1ot", "you " + "x " * 30 + "idiot hate " + "y " * 60 + "hate you", "id.iot you 123"]
    for text in texts + ["you idiot " * 200]:
        words = re.findall(r"[^\W\d_]+", text.lower())
        at, offset = [], 0
        for w in words:  # where each word starts in the line of words
            at.append(offset)
            offset += len(w) + 1
        hit = [max([o for t, o in lexicon.items() if (f" {w} " == t if t[-1] == " " else f" {w}".startswith(t))], default=0) for w in words]
        second = [p for p, w in zip(at, words, strict=True) if w in toxicity.SECOND]
        near = sum(any(abs(p - q) <= toxicity.NEAR for q in second) for p, h in zip(at, hit, strict=True) if h)
        got = dict(zip(toxicity.FEATURES, extract(text), strict=True))
        n, size = max(len(words), 1), max(len(text), 1)
        assert got["lexicon_hits"] == sum(h > 0 for h in hit) and got["near_second"] == near
        assert got["lexicon_density"] == sum(h > 0 for h in hit) / n and got["lexicon_weight"] == max(hit, default=0)
        assert got["second_density"] == len(second) / n
        assert got["capitals"] == sum("A" <= c <= "Z" for c in text) / size and got["digits"] == sum(c in "0123456789" for c in text) / size
        assert got["exclamations"] == text.count("!") / n


def test_nearness_of_very_long_texts():
    began = time.time()
    toxicity.Extractor({" idiot ": 3.0})("you idiot " * 200_000)
    assert time.time() - began < 30


def test_toxicity_odd_rows(spark):
    rows = [(i, "you idiot fool" if i % 4 == 0 else "a calm sentence here") for i in range(200)] + [(500, None), (501, ""), (None, "you idiot"), (502, "x" * 30_000)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(0, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[8].predicted == 1 and got[9].predicted == 0 and got[None].held_out is False
    none = labels.limit(0)
    assert {r.score for r in toxicity.score_toxicity(df, none).collect()} == {0.0}
    assert {r.score for r in toxicity.score_toxicity(df, labels.filter("toxic = 1")).collect()} == {1.0}
    assert toxicity.score_toxicity(df.limit(0), labels).collect() == []


def test_isotonic_and_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-3 * x[:, 0] * (x[:, 1] > 0)))).astype(float)
    trees = toxicity.Trees().fit(x[:2000], y[:2000])
    raw = trees.raw(x[2000:])
    assert np.corrcoef(raw, 3 * x[2000:, 0] * (x[2000:, 1] > 0))[0, 1] > 0.9
    knots, level = toxicity.isotonic(raw, y[2000:])
    assert (np.diff(knots) > 0).all() and (np.diff(level) >= 0).all()
    assert abs(np.interp(raw, knots, level).mean() - y[2000:].mean()) < 0.02


def places(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, found = [], set()
    for label, phrase in BASE:
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                at.append(i)
                found.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(found))


def test_licenses(spark):
    rng = random.Random(2)
    bits = ["MIT", "License", "license", "mit", "apache", "APACHE", "general", "public", "É", "K", "mıt", "3", "gnu", "cc", "by", "nc", "lesser"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice([" ", "-", ".\n", ""]) for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "MIT License"), (902, "MİT license"), (903, "Licensed under CC BY-NC 4.0."), (904, "word " * 20_000 + "mit license"), (903, "GNU Lesser General Public License")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = scan_licenses(df).collect()
    known = Counter((i, *places(t)) for i, t in rows)
    assert Counter(tuple(r)[:6] for r in got) == known
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.score == 1.0 if r.n_base else (r.score > 0) == bool(r.labels)
    assert {r.labels for r in got if r.doc_id == 903} == {"cc-by-nc", "gpl,lgpl"}
    assert scan_licenses(df.limit(0)).collect() == []


def test_key_phrase_is_enough_to_find_a_template(spark):
    """The rarest words of the passage (any, express, implied) do not occur; its key phrase does."""
    df = spark.createDataFrame([(1, "the software is provided as is without warranty of some kind stated or tacit")], "doc_id long, text string")
    row = scan_licenses(df).head()
    assert row.labels == "mit" and 0.6 <= row.score < 1


def labels_by_loops(texts):
    """(labels, score) of each text: every template at every offset."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    files = [split(t) for t in texts]
    everywhere = Counter(w for f in files for w in set(f))
    idf = lambda w: round(np.log((len(files) + 1) / (everywhere[w] + 1)) + 1.0, 9)
    out = []
    for f in files:
        labels, score = set(), 0.0
        for label, key, passage in [*((b, p, p) for b, p in BASE), *TEMPLATES]:
            words, key_words = passage.split(), key.split()
            first = next(i for i in range(len(words)) if words[i : i + len(key_words)] == key_words)
            for at in range(len(f)):
                if f[at + first : at + first + len(key_words)] != key_words:
                    continue
                cover = sum(idf(w) for i, w in enumerate(words) if f[at + i : at + i + 1] == [w]) / sum(map(idf, words))
                if cover >= licenses.COVER:
                    labels.add(label)
                    score = max(score, cover)
        out.append((",".join(sorted(labels)), round(min(score, 1.0), 6)))
    return out


def test_templates_by_loops(spark):
    rng = random.Random(11)
    texts = ["Mozilla Public License, v. 2.0", "Eclipse Public License 2.0", "Redistribution and use in source and binary forms", "license " * 500 + "Boost Software License"]
    for _ in range(150):
        _, _, passage = rng.choice(TEMPLATES)
        words = passage.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["the", "license", "of", "zz", "public", "mit"])
        texts.append(" ".join(rng.choices(["the", "public", "software", "of", "xx", "a", "license"], k=rng.randrange(12)) + words + rng.choices(["and", "use", "qq"], k=3)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.labels, round(r.score, 6)) for r in scan_licenses(df).collect()}
    want = labels_by_loops(texts)
    assert [got[i][0] for i in range(len(texts))] == [x[0] for x in want]
    assert all(abs(got[i][1] - want[i][1]) < 2e-6 for i in range(len(texts)))
    assert [got[i][0] for i in range(3)] == ["mpl", "epl", "bsd"]


def test_votes_change_candidates_not_labels(spark, monkeypatch):
    """Few or many words looked up: other pairs to verify, the same rows. Long files, with many rare words."""
    rng = random.Random(12)
    texts = []
    for _ in range(60):
        picked = [rng.choice(TEMPLATES)[2].split() for _ in range(rng.randint(1, 5))]
        for words in picked:
            for _ in range(rng.randrange(1 + len(words) // 3)):
                words[rng.randrange(len(words))] = rng.choice(["the", "zz", "software", "license"])
        texts.append(" ".join(" ".join(words) + " zz" * rng.randrange(3) for words in picked))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    pairs, voted = [], licenses._voted
    monkeypatch.setattr(licenses, "_voted", lambda *a: pairs.append(voted(*a)) or pairs[-1])
    results = [sorted(map(tuple, scan_licenses(df, rare=rare).collect())) for rare in (0, 2, 16, 10_000)]
    assert all(r == results[0] for r in results) and any(r[6].count(",") for r in results[0])
    assert len({p.count() for p in pairs}) > 2
    want = labels_by_loops(texts)
    assert [r[6] for r in results[0]] == [x[0] for x in want]


def test_identifiers_and_whole_licenses(spark):
    said = {
        "SPDX-License-Identifier: BSD-3-Clause": "bsd",
        "SPDX-License-Identifier: MIT": "mit",
        "GNU GPL v3": "gpl",
        "BSD Zero Clause License": "0bsd",
        "Licensed under either of Apache-2.0 or MIT": "apache,mit",
        "the license of the house, by permission": "",
    }
    for label, _, text in WHOLE:
        # A word of seven is another one, outside the key phrase's beginning.
        words = text.split()
        said[" ".join("xx" if i > len(words) // 2 and i % 7 == 3 else w for i, w in enumerate(words)) + f" {label}"] = label
    rows = list(enumerate(said))
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, label) in enumerate(said.items()):
        assert set(filter(None, label.split(","))) <= got[i] and (label or not got[i]), text
        assert i >= 6 or ",".join(sorted(got[i])) == label


def test_templates_of_ones_own(spark):
    df = spark.createDataFrame([(1, "This is the Acme Licence, all rights kept."), (2, "acme corp")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in scan_licenses(df, templates=(("acme", "acme licence", "the acme licence"),)).collect()}
    assert got == {1: "acme", 2: ""}
    with pytest.raises(ValueError):
        licenses.Index((("acme", "not there", "the acme licence"),))
