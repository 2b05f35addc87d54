"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from endweave.llm.chat import conversation_digests
from endweave.llm.common import documents
from endweave.llm.exact_dedup import exact_dedup
from endweave.llm.fingerprints import fingerprint_edits
from endweave.llm.jaccard_join import jaccard_components
from endweave.llm.langid import identify
from endweave.llm.licenses import scan_licenses
from endweave.llm.mixing import mix
from endweave.llm.packing import pack
from endweave.llm.quality import BUDGETS, CHANCE, LIFT, RISK, RULES, SHAPING, quality_rules
from endweave.llm.repair import repair
from endweave.llm.sharding import shard
from endweave.llm.toxicity import score_toxicity
from endweave.llm.vector_codes import vector_codes


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return conversation_digests(turns.union(more))


def op5_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), shards=16)


def op6_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))


def op7_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op8_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), k=3, percent=90)


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op11_heap_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_source_mix": op2_source_mix,
        "op3_language_mixture": op3_language_mixture,
        "op4_chat_windows": op4_chat_windows,
        "op5_bounded_ring": op5_bounded_ring,
        "op6_minhash_fingerprints": op6_minhash_fingerprints,
        "op7_license_index": op7_license_index,
        "op8_toxicity_trees": op8_toxicity_trees,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_best_fit": op10_best_fit,
        "op11_heap_codes": op11_heap_codes,
        "op12_viterbi_repair": op12_viterbi_repair,
        "op13_risk_rules": op13_risk_rules,
    }


def _lloyd_sql(rounds: int = 4) -> str:
    """Lloyd rounds as chained tables; distances are sums of doubles that hold integers."""
    far = "list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT p.row, p.part, min({{'d': {far}, 'e': c.e}}) AS best FROM p JOIN c{r} c USING (part) GROUP BY 1, 2
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT part, e, list(m ORDER BY i) AS x FROM (
    SELECT p.part, a.best.e AS e, i, floor(sum(p.x[i + 1]) / count(*)) AS m
    FROM p JOIN a{r} a USING (row, part), range(len(p.x)) t(i) GROUP BY 1, 2, 3) GROUP BY 1, 2
), c{r + 1} AS MATERIALIZED (
  SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (part, e)
)""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding, label) AS row, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT row, CAST(part AS INTEGER) AS part, q[part * len(q) // 4 + 1 : (part + 1) * len(q) // 4] AS x FROM k, range(4) t(part)
), c0 AS MATERIALIZED (
  SELECT part, CAST(row - 1 AS INTEGER) AS e, x FROM p WHERE row <= 256
), {", ".join(steps)}, coded AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY 1
), book AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, e)) AS sha FROM c{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, book.sha AS codebooks_sha256
FROM k JOIN coded USING (row), book
"""


def _quality_sql() -> str:
    """Measures by lists and windows; cutoffs as rows; binomial tails as sums over all terms."""
    value = "CASE r.rule " + " ".join(f"WHEN '{rule}' THEN {of.replace(' div ', ' // ')}" for rule, (of, _) in RULES.items()) + " END"
    cuts = ", ".join(f"('{rule}', {i}, {c})" for rule, (_, cuts) in RULES.items() for i, c in enumerate(cuts))
    blank = r"[\x20\x09-\x0D]"
    term = "exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))".format(p=RISK)
    return rf"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id, text, lang) AS row, doc_id, lang, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{blank}+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls
  FROM documents
), win AS (
  SELECT row, x.i AS i, count(*) OVER (PARTITION BY row, x.w) > 1 AS again
  FROM (SELECT row, unnest(list_transform(range(1, len(ws) - 3), lambda i: {{'i': i, 'w': array_to_string(ws[i : i + 4], ' ')}})) AS x FROM t)
), rep AS (
  SELECT row, count(DISTINCT i + k) AS n FROM win, range(5) o(k) WHERE again GROUP BY 1
), m AS MATERIALIZED (
  SELECT t.row, t.doc_id, t.lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(text, '{blank}+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_exclamations,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
    len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    len(ws) < 10 OR 100 * coalesce(rep.n, 0) > 20 * len(ws) AS base_failed
  FROM t LEFT JOIN rep USING (row)
), r(rule, step, c) AS (VALUES {cuts}), f AS MATERIALIZED (
  SELECT m.row, r.rule, r.step, r.c, {value} > r.c AS falls FROM m, r WHERE NOT base_failed
), lab AS (
  SELECT m.row, m.lang, max(l.quality) = 1 AS good, hex < '{SHAPING}' AS shaping
  FROM (SELECT *, md5(CAST(doc_id AS VARCHAR)) AS hex FROM m WHERE NOT base_failed) m JOIN labels l USING (doc_id) WHERE l.quality IN (0, 1) GROUP BY ALL
), s AS (
  SELECT lang, rule, step, c, count(*) FILTER (good AND falls) AS g, count(*) FILTER (NOT good AND falls) AS b,
    count(*) FILTER (good) AS all_g, count(*) FILTER (NOT good) AS all_b
  FROM lab JOIN f USING (row) WHERE shaping GROUP BY ALL
), series AS MATERIALIZED (
  SELECT lang, budget, rule, arg_max(c, {{'b': b, 's': -step}}) AS c
  FROM s, (VALUES {", ".join(f"({b})" for b in BUDGETS)}) x(budget)
  WHERE b > 0 AND b * all_g > {LIFT} * g * all_b AND g <= budget * all_g / {len(RULES)} GROUP BY ALL
), k AS (
  SELECT series.lang, budget, count(DISTINCT lab.row) AS n, count(DISTINCT lab.row) FILTER (falls) AS k
  FROM series JOIN lab ON lab.lang IS NOT DISTINCT FROM series.lang AND good AND NOT shaping
  JOIN f ON f.row = lab.row AND f.rule = series.rule AND f.c = series.c GROUP BY ALL
), p AS (
  SELECT k.lang, budget, sum({term}) AS p, (SELECT count(DISTINCT coalesce('x' || lang, '')) FROM k) AS m
  FROM k, LATERAL (SELECT unnest(range(k.k + 1)) AS i) GROUP BY ALL
), passed AS (
  SELECT lang, max(budget) AS budget FROM (SELECT *, max(p) OVER (PARTITION BY lang ORDER BY budget) AS worst FROM p) WHERE worst <= {CHANCE} / m GROUP BY 1
), gone AS (
  SELECT m.row, string_agg(f.rule, ',' ORDER BY f.rule) AS rules
  FROM m JOIN passed ON passed.lang IS NOT DISTINCT FROM m.lang
  JOIN series ON series.lang IS NOT DISTINCT FROM m.lang AND series.budget = passed.budget
  JOIN f ON f.row = m.row AND f.rule = series.rule AND f.c = series.c AND falls GROUP BY 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND gone.rules IS NULL AS kept, coalesce(gone.rules, '') AS failed_rules
FROM m LEFT JOIN gone USING (row)
"""


#: Damage, faults and the forward pass as a recursion over rows; states 0 start, 1 system, 2 user, 3 assistant.
_REPAIR_SQL = r"""
WITH RECURSIVE k AS (
  SELECT *, row_number() OVER () AS id, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), c AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS kind
  FROM k
), r AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE kind <> 0
), p AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS ini, coalesce(lag(left(role, 1)) OVER w || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS bad,
    regexp_replace(text, '[ 	-
]+$', '') AS bare
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS MATERIALIZED (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM p
), conv AS (
  SELECT DISTINCT conv_id FROM conversations
), lead(st, ini, nxt, edit, cost) AS (
  VALUES (0, 's', 1, 'K', 0), (0, 'u', 2, 'K', 0), (1, 'u', 2, 'K', 0), (3, 'u', 2, 'K', 0), (2, 'a', 3, 'K', 0),
    (0, '*', 2, 'R', 2), (1, '*', 2, 'R', 2), (2, '*', 3, 'R', 2), (3, '*', 2, 'R', 2), (0, '*', 0, 'D', 3), (1, '*', 1, 'D', 3), (2, '*', 2, 'D', 3), (3, '*', 3, 'D', 3)
), ins(st, nxt, edit, said) AS (
  VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''),
    (0, 2, 'I', chr(10) || 'user:'), (1, 2, 'I', chr(10) || 'user:'), (2, 3, 'I', chr(10) || 'assistant:'), (3, 2, 'I', chr(10) || 'user:'),
    (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), dp(conv_id, i, st, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), nxt, {'cost': CAST(2 * length(edit) AS BIGINT), 'audit': edit, 'said': said} FROM conv, ins WHERE st = 0
  UNION ALL
  SELECT dp.conv_id, f.i, ins.nxt, min({'cost': dp.best.cost + lead.cost + CASE WHEN lead.edit <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END + 2 * length(ins.edit),
    'audit': dp.best.audit || lead.edit || ins.edit,
    'said': dp.best.said || CASE lead.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE dp.st WHEN 2 THEN 'assistant:' ELSE 'user:' END || text END || ins.said})
  FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
    JOIN lead ON lead.st = dp.st AND (lead.ini = '*' OR lead.ini = f.ini) AND (lead.edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
    JOIN ins ON ins.st = lead.nxt
  GROUP BY dp.conv_id, f.i, ins.nxt
), n AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal
  FROM f GROUP BY 1
), e AS (
  SELECT dp.conv_id, min(best) AS best FROM dp LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE dp.i = coalesce(n.n, 0) AND st IN (0, 3) GROUP BY 1
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit, sha256(substr(best.said, 2)) AS repaired_sha256
FROM e LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLE_SQL = {
    "op12_viterbi_repair": _REPAIR_SQL,
    "op13_risk_rules": _quality_sql(),
    "op11_heap_codes": _lloyd_sql(),
    "op1_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
       sha256(t) AS text_sha256,
       CAST(octet_length(encode(t)) AS BIGINT) AS n_bytes
FROM n
""",
    "op4_chat_windows": r"""
WITH raw AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), a AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 4 AS tokens,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM raw
), b AS (
  SELECT *, pos = 1 AND role = 'system' AS sys, CASE WHEN pos = 1 AND role = 'system' THEN 0 ELSE tokens END AS own,
    coalesce(max(CASE WHEN pos = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS used
  FROM a
), c AS (
  SELECT *, greatest(102, floor((1024 - used) * 2 / 5)) AS stride,
    coalesce(sum(own) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    NOT sys AND (pos = 1 OR lag(sys) OVER o OR (role <> 'assistant' AND lag(role) OVER o = 'assistant')) AS begins
  FROM b WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
), c1 AS (
  SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY pos) AS ex FROM c
), c2 AS (
  SELECT *, sum(own) OVER e + used > 1024 AS apart, sum(own) OVER e AS tog, min(start) OVER e AS ex_start FROM c1 WINDOW e AS (PARTITION BY conv_id, ex)
), c3 AS (
  SELECT *, CASE WHEN NOT sys THEN floor(CASE WHEN apart THEN start ELSE ex_start END / stride) END AS blk,
    CASE WHEN NOT sys THEN CASE WHEN apart THEN own ELSE tog END > stride END AS lng
  FROM c2
), d AS (
  SELECT *, (begins OR apart) AND coalesce(lag(blk) OVER o <> blk OR lag(lng) OVER o OR (lag(lng) OVER o IS NOT NULL AND lng), false) AS moved
  FROM c3 WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
), e AS (
  SELECT *, sum(CAST(moved AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY pos) AS win FROM d
), f AS (
  SELECT *, max(win) OVER (PARTITION BY conv_id) AS last,
    sum(own) OVER (PARTITION BY conv_id ORDER BY win RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS nxt,
    row_number() OVER (PARTITION BY conv_id, win ORDER BY pos DESC) AS from_end,
    sum(own) OVER (PARTITION BY conv_id, win ORDER BY pos DESC) AS end_tokens
  FROM e
), g AS (
  SELECT *, CASE WHEN sys THEN last + 1 WHEN from_end <= 2 AND end_tokens + nxt + used <= 1024 THEN 2 ELSE 1 END AS copies,
    12 + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'), chr(10), '<' || chr(92) || ',')) + 1
    + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')) + 11 AS chars
  FROM f
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars * copies) AS BIGINT) AS formatted_chars
FROM g GROUP BY conv_id
""",
    "op9_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), sh AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS s
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY 1
), pr AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), lk AS (
  SELECT x, y FROM pr JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 90 * (nx.n + ny.n - i)
), sym AS (
  SELECT x, y FROM lk UNION ALL SELECT y, x FROM lk
), reach(d, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT sym.y, reach.c FROM reach JOIN sym ON sym.x = reach.d
)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(c) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
""",
}
