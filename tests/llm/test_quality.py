"""Quality rules against loops, and the bounds that they hold."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from endweave.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_exclamations": sum(c in "!?" for c in text),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


ODD = ["", None, " \n\t ", "a", "a b c d e", "x " * 5, "x " * 6, "x " * 60, "a b c d e f a b c d e g", "é ü   ß", "# | #\n# | #\n\n \n# | #", "\x0b\x0c\r", "A!\nA!\r\nA!"]


def test_measures(spark):
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice("abcdefg") + rng.choice(["", "", "\n", "!", "#"]) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    texts += ["w%d " % (i % 7000) * 1 for i in range(3)] + [" ".join(f"w{i % 30_000}" for i in range(60_000)), "z" * 200_000]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = {r.id: r.asDict() for r in q.measured(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in rows:
        if t and len(t) > 100_000:
            continue
        want = measures(t)
        assert {k: got[i][k] for k in want} == want, t
    assert got[len(rows) - 2]["n_repeat_words"] == 60_000 and got[len(rows) - 1]["word_chars"] == 200_000


@pytest.mark.parametrize("n,k", [(1, 0), (92, 0), (153, 2), (4000, 150), (4000, 0), (30, 29), (200_000, 9_700)])
def test_binomial_tail(spark, n, k):
    p = 0.05
    want = 1.0 if k >= n * p else math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
    got = spark.range(1).select(q.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    assert got == pytest.approx(want, rel=1e-7)


def corpus(seed, n=1500):
    """Good and bad documents; in stratum y good ones have symbols too."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang, good = rng.choice(["x", "x", "y", None]), rng.random() < 0.75
        words = [rng.choice("abcdefgh") * rng.randint(2, 6) + str(rng.randint(0, 999)) for _ in range(rng.randint(12, 60))]
        if not good or (lang == "y" and rng.random() < 0.3):
            words = [w + "##" if rng.random() < 0.6 else w for w in words]
        docs.append((i, " ".join(words), lang))
        labels.append((i, int(good)))
    return docs, labels


def by_loops(docs, labels):
    told = {}
    for i, v in labels:
        if i is not None and v in (0, 1):
            told[i] = max(told.get(i, 0), v)
    rows = [(i, lang, measures(t)) for i, t, lang in docs]

    def value(rule, m):
        n, c = m["n_words"], m["word_chars"]
        return {
            "symbols": lambda: m["n_symbols"] * 1000 // n,
            "exclamations": lambda: m["n_exclamations"] * 1000 // n,
            "capitals": lambda: m["n_capitals"] * 1000 // c,
            "long_words": lambda: c * 1000 // n,
            "short_words": lambda: -(c * 1000 // n),
            "dup_lines": lambda: m["n_dup_lines"] * 1000 // m["n_lines"],
            "repeats": lambda: m["n_repeat_words"] * 1000 // n,
        }[rule]()

    rated = [(i, lang, m, told[i] == 1) for i, lang, m in rows if not m["base_failed"] and i in told]
    shaping = [r for r in rated if hashlib.md5(str(r[0]).encode()).hexdigest() < q.SHAPING]
    held = [r for r in rated if hashlib.md5(str(r[0]).encode()).hexdigest() >= q.SHAPING and r[3]]
    series = {}
    for s in {r[1] for r in rated}:
        good, bad = [r for r in shaping if r[1] == s and r[3]], [r for r in shaping if r[1] == s and not r[3]]
        for budget in q.BUDGETS:
            config = {}
            for rule, (_, cuts) in q.RULES.items():
                best = None
                for step, c in enumerate(cuts):
                    g, b = sum(value(rule, r[2]) > c for r in good), sum(value(rule, r[2]) > c for r in bad)
                    if b and b * len(good) > q.LIFT * g * len(bad) and g <= budget * len(good) / len(q.RULES) and (best is None or (b, -step) > best[0]):
                        best = ((b, -step), c)
                if best:
                    config[rule] = best[1]
            if config:
                series[s, budget] = config
    tested = {}
    for (s, budget), config in series.items():
        own = [r for r in held if r[1] == s]
        if own:
            k = sum(any(value(rule, r[2]) > c for rule, c in config.items()) for r in own)
            n = len(own)
            tested[s, budget] = sum(math.comb(n, i) * q.RISK**i * (1 - q.RISK) ** (n - i) for i in range(k + 1)) if k < n * q.RISK else 1.0
    m = max(len({s for s, _ in tested}), 1)
    final = {}
    for s in {s for s, _ in tested}:
        for budget in q.BUDGETS:
            if (s, budget) in tested:
                if tested[s, budget] > q.CHANCE / m:
                    break
                final[s] = series[s, budget]
    out = []
    for i, lang, m in rows:
        fallen = [] if m["base_failed"] else sorted(rule for rule, c in final.get(lang, {}).items() if value(rule, m) > c)
        out.append((i, m["base_failed"], not m["base_failed"] and not fallen, ",".join(fallen)))
    return sorted(out, key=repr), final


def verdicts(df):
    return sorted((tuple(r) for r in df.select("doc_id", "base_failed", "kept", "failed_rules").collect()), key=repr)


def test_rules_as_loops(spark):
    docs, labels = corpus(5)
    docs += [(None, "a b c d e f g h i j", "x"), (3, docs[3][1], "x"), (9001, None, None)]
    labels += [(None, 1), (4, None), (5, 7), (6, 0), (6, 1)]
    want, final = by_loops(docs, labels)
    assert "x" in final and "symbols" in final["x"] and "symbols" not in final.get("y", {})
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    clash = ("id", "stratum", "good", "of", "rule", "step", "budget", "n_words", "kept", "w", "l", "cut_symbols")
    assert verdicts(q.quality_rules(d.repartition(3), lab)) == want
    assert verdicts(q.quality_rules(d.withColumns({c: F.lit(1) for c in clash}), lab.withColumns({c: F.lit(1) for c in clash}))) == want


def test_without_labels_or_rows(spark):
    docs, labels = corpus(6, 60)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    assert all(r[2] != r[1] for r in verdicts(q.quality_rules(d, lab.limit(0))))
    assert all(r[2] != r[1] for r in verdicts(q.quality_rules(d, lab)))  # too few to prove anything
    assert q.quality_rules(d.limit(0), lab).collect() == []


def test_false_rejections_stay_in_bounds(spark):
    """Good documents of fresh draws fall no more often than RISK, whatever the labels are worth."""
    docs, labels = corpus(7, 3000)
    rng = random.Random(8)
    noisy = [(i, v if rng.random() < 0.8 else 1 - v) for i, v in labels]
    got = verdicts(q.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(noisy, "doc_id long, quality int")))
    kept = {r[0]: r[2] for r in got}
    for s in ("x", "y", None):
        good = [i for (i, _, lang), (_, v) in zip(docs, labels, strict=True) if lang == s and v]
        assert sum(not kept[i] for i in good) <= 0.09 * len(good)
