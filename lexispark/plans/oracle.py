"""DuckDB twins of the jobs (the correctness oracle).  Text steps come
from ``sql_text`` so both sides use the same fixed lists and patterns."""

from __future__ import annotations

from . import sql_text as S
from .fixtures import FIXTURE_SQL, LEMMA_SQL
from .jobs import (
    PHRASE_SKIPS, RUN_CHUNK_ROWS, TOKEN_SKIPS, TOP_CLASS_N, TOP_PHRASES_N, TOP_TOKENS_N,
)
from ..operators.terms import LEMMA_RULES

ORACLE: dict[str, str] = {}


def sql(name: str, text: str):
    ORACLE[name] = text.strip()


def skip_case(col: str, skips: dict) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN {S.lit(k)} THEN {v}" for k, v in skips.items()) + " ELSE 0 END"


LABELLED = """(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
              FROM documents d LEFT JOIN labels l USING (doc_id))"""

# ---- 1. profile ------------------------------------------------------------

sql("class_distribution", """
SELECT lang AS class, count(*) AS n_docs, count(DISTINCT md5(text)) AS n_distinct_texts
FROM documents GROUP BY lang""")

sql("class_pair_counts", """
SELECT d.lang, l.quality, count(*) AS n
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang, l.quality""")

_cols = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
sql("null_report", "WITH j AS " + LABELLED + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
    f"count(*) > count({c}) AS has_null FROM j" for c in _cols))

# ---- 2. labels -------------------------------------------------------------

sql("label_encode", """
WITH dim AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label
             FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))
SELECT d.doc_id, d.lang, dim.label FROM documents d LEFT JOIN dim USING (lang)""")

# ---- 3. cleaning -----------------------------------------------------------

for _name, _mode in (("clean_corpus", "greedy"), ("clean_corpus_strict", "strict")):
    sql(_name, f"""
WITH src AS ({FIXTURE_SQL}),
c AS (SELECT doc_id, {S.clean_text('text', _mode)} AS clean_text FROM src)
SELECT doc_id, clean_text FROM c WHERE clean_text IS NOT NULL AND clean_text <> ''""")

sql("rejected_docs", f"""
WITH src AS ({FIXTURE_SQL}),
c AS (SELECT doc_id, text, {S.clean_text('text')} AS clean_text FROM src)
SELECT doc_id, CASE WHEN text IS NULL THEN 'null' ELSE 'empty' END AS reason
FROM c WHERE text IS NULL OR clean_text = ''""")

_steps = ["translit", "lower", "contractions", "urls", "letter_runs", "parens", "stopwords"]
_fns = [S.translit, lambda x: f"lower({x})", S.contractions, S.urls, S.letter_runs, S.parens,
        S.stopwords_single_space]
_ctes = ["s0 AS (SELECT lang AS class, CAST(text AS VARCHAR) AS s0 FROM (" + FIXTURE_SQL + "))"]
_cols_so_far = ["class", "s0"]
for _i, _fn in enumerate(_fns, start=1):
    _ctes.append(f"s{_i} AS (SELECT {', '.join(_cols_so_far)}, {_fn(f's{_i - 1}')} AS s{_i} FROM s{_i - 1})")
    _cols_so_far.append(f"s{_i}")
sql("cleaning_audit", "WITH " + ",\n".join(_ctes) + f"""
SELECT class, count(*) AS n_docs, count_if(regexp_matches(s0, {S.lit('[^\\x00-\\x7F]')})) AS n_non_ascii,
""" + ",\n".join(f"count_if(s{i} <> s{i - 1}) AS n_{n}" for i, n in enumerate(_steps, start=1)) + """,
count_if(s7 IS NULL OR s7 = '') AS n_rejected
FROM s7 GROUP BY class""")

# ---- 4. terms --------------------------------------------------------------

sql("stopword_filter", f"""
WITH t AS (SELECT doc_id, {S.word_tokens('lower(text)')} AS toks FROM documents)
SELECT doc_id, CAST(u.pos - 1 AS BIGINT) AS pos, u.token
FROM t, unnest(t.toks) WITH ORDINALITY AS u(token, pos)
WHERE NOT list_contains({S.STOP_LIST}, u.token)""")

_rules = ", ".join(f"({i}, {S.lit(o)}, {S.lit(n)})" for i, (o, n) in enumerate(LEMMA_RULES))
def norm_tokens(source: str = "documents") -> str:
    return f"""
toks AS (SELECT doc_id, {S.normalized_tokens('text')} AS toks FROM {source}),
x AS (SELECT doc_id, CAST(u.pos - 1 AS BIGINT) AS pos, u.token
      FROM toks, unnest(toks.toks) WITH ORDINALITY AS u(token, pos)),
vocab AS (SELECT DISTINCT token AS term FROM x),
rules(ord, old, new) AS (VALUES {_rules}),
cands AS (SELECT v.term, r.ord, left(v.term, length(v.term) - length(r.old)) || r.new AS cand
          FROM vocab v JOIN rules r ON ends_with(v.term, r.old)),
lemmas AS (SELECT term, cand AS lemma FROM cands WHERE cand IN (SELECT term FROM vocab)
           QUALIFY row_number() OVER (PARTITION BY term ORDER BY length(cand), ord) = 1),
lx AS (SELECT x.doc_id, x.pos, coalesce(l.lemma, x.token) AS token FROM x LEFT JOIN lemmas l ON l.term = x.token)"""


NORM_TOKENS = norm_tokens()

sql("lemma_vocab", f"""
WITH vocab AS (SELECT DISTINCT unnest({S.word_tokens('lower(text)')}) AS term FROM documents),
rules(ord, old, new) AS (VALUES {_rules}),
cands AS (SELECT v.term, r.ord, left(v.term, length(v.term) - length(r.old)) || r.new AS cand
          FROM vocab v JOIN rules r ON ends_with(v.term, r.old))
SELECT term, cand AS lemma FROM cands WHERE cand IN (SELECT term FROM vocab)
QUALIFY row_number() OVER (PARTITION BY term ORDER BY length(cand), ord) = 1""")

sql("normalize_terms", f"""
WITH src AS ({LEMMA_SQL}),
{norm_tokens('src')},
g AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS terms FROM lx GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(g.terms, '') END AS terms
FROM documents d LEFT JOIN g USING (doc_id)""")

# ---- 5. token top-k --------------------------------------------------------

CLEAN_TOKENS = f"""
c AS (SELECT doc_id, lang, {S.clean_text('text')} AS clean_text FROM documents),
ct AS (SELECT doc_id, lang, unnest({S.word_tokens('clean_text')}) AS token
       FROM c WHERE clean_text IS NOT NULL AND clean_text <> '')"""

sql("token_topk", f"""
WITH {CLEAN_TOKENS},
f AS (SELECT token, count(*) AS freq FROM ct GROUP BY token)
SELECT row_number() OVER (ORDER BY freq DESC, token) AS rank, token, freq
FROM f ORDER BY freq DESC, token LIMIT {TOP_TOKENS_N}""")

sql("class_token_topk", f"""
WITH {CLEAN_TOKENS},
f AS (SELECT lang, token, count(*) AS freq FROM ct GROUP BY lang, token),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, token) AS rank, token, freq FROM f)
SELECT lang, rank, token, freq FROM r
WHERE rank <= {TOP_CLASS_N} AND rank > {skip_case('lang', TOKEN_SKIPS)}""")

# ---- 6. keyphrases ---------------------------------------------------------

RAKE = f"""
mk AS (SELECT doc_id, lang, list_filter(string_split_regex(array_to_string(list_transform(
          {S.rake_tokens('text')}, lambda t: CASE WHEN {S.is_rake_delimiter('t')} THEN chr(1) ELSE t END), ' '),
          ' ?\\x01 ?'), lambda p: p <> '') AS ph FROM documents),
p AS (SELECT doc_id, lang, u.phrase, u.pidx, CAST(len(string_split(u.phrase, ' ')) AS BIGINT) AS n_words
      FROM mk, unnest(mk.ph) WITH ORDINALITY AS u(phrase, pidx)),
w AS (SELECT doc_id, lang, pidx, phrase, n_words, unnest(string_split(phrase, ' ')) AS word FROM p),
ws AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, word) / count(*) OVER (PARTITION BY doc_id, word) AS wscore FROM w),
ps AS (SELECT doc_id, lang, pidx, phrase, n_words, sum(wscore) AS score FROM ws GROUP BY doc_id, lang, pidx, phrase, n_words),
rk AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, phrase DESC) AS rank,
              phrase, n_words, score FROM ps)"""

sql("rake_phrases", f"WITH {RAKE}\nSELECT doc_id, rank, phrase, n_words, round(score, 6) AS score FROM rk")

sql("phrase_topk", f"""
WITH {RAKE},
f AS (SELECT phrase, count(*) AS freq FROM rk WHERE n_words >= 2 GROUP BY phrase)
SELECT row_number() OVER (ORDER BY freq DESC, phrase) AS rank, phrase, freq
FROM f ORDER BY freq DESC, phrase LIMIT {TOP_PHRASES_N}""")

sql("class_phrase_topk", f"""
WITH {RAKE},
f AS (SELECT lang, phrase, count(*) AS freq FROM rk WHERE n_words >= 2 GROUP BY lang, phrase),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, phrase) AS rank, phrase, freq FROM f)
SELECT lang, rank, phrase, freq FROM r
WHERE rank <= {TOP_CLASS_N} AND rank > {skip_case('lang', PHRASE_SKIPS)}""")

# ---- 7. positions, chunks, splits -------------------------------------------

from .jobs import CHUNK_ROWS, PHRASE_SPLIT, SLICE, SPLIT  # noqa: E402

sql("row_slice", """
SELECT doc_id, lang, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS pos
FROM documents QUALIFY pos BETWEEN 0 AND 500""")

sql("row_slice_window", f"""
SELECT doc_id, lang, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS pos
FROM documents QUALIFY pos BETWEEN {SLICE[0]} AND {SLICE[1]}""")

sql("head_rows", """
SELECT doc_id, lang, text, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS pos
FROM documents QUALIFY pos BETWEEN 0 AND 4""")

sql("chunked_union", f"""
SELECT doc_id, lang, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {CHUNK_ROWS}) AS BIGINT) AS chunk
FROM documents""")


def split_sql(part: str = "", SPLIT: dict = SPLIT) -> str:
    """Split CTE: ``sp(doc_id, lang, text, split)``; ``part`` is a PARTITION
    BY clause body for stratified splits."""
    pb = f"PARTITION BY {part}" if part else ""
    return f"""
h AS (SELECT doc_id, lang, text, md5('{SPLIT['test_seed']}-' || CAST(doc_id AS VARCHAR)) AS k1,
             md5('{SPLIT['valid_seed']}-' || CAST(doc_id AS VARCHAR)) AS k2 FROM documents),
t AS (SELECT *, row_number() OVER ({pb} ORDER BY k1) <= ceil({SPLIT['test_p']} * count(*) OVER ({pb})) AS is_test FROM h),
r AS (SELECT *, row_number() OVER ({pb} ORDER BY k2) <= ceil({SPLIT['valid_p']} * count(*) OVER ({pb})) AS is_valid
      FROM t WHERE NOT is_test),
sp AS (SELECT doc_id, lang, text, 'test' AS split FROM t WHERE is_test
       UNION ALL
       SELECT doc_id, lang, text, CASE WHEN is_valid THEN 'valid' ELSE 'train' END FROM r)"""


sql("exact_split", f"WITH {split_sql()}\nSELECT doc_id, split FROM sp")
sql("exact_split_stratified", f"WITH {split_sql('lang')}\nSELECT doc_id, lang, split FROM sp")

_pairs = [("train", "valid"), ("train", "test"), ("valid", "test")]


def leak_sql(split: str) -> str:
    return f"""
WITH {split},
pt AS (SELECT md5(text) AS h, count_if(split = 'train') AS train, count_if(split = 'valid') AS valid,
              count_if(split = 'test') AS test FROM sp GROUP BY md5(text))
""" + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS split_a, '{b}' AS split_b, count_if({a} > 0 AND {b} > 0) AS n_shared_texts, "
        f"CAST(coalesce(sum(CASE WHEN {a} > 0 AND {b} > 0 THEN {b} ELSE 0 END), 0) AS BIGINT) AS n_leaked_rows FROM pt"
        for a, b in _pairs)


sql("split_leak_report", leak_sql(split_sql()))


def fill_sql(name: str, groups: str, seed: str, p: float) -> str:
    """CTE ``name``(h): the groups that fill ceil(p*n) rows."""
    return f"""
{name}_k AS (SELECT h, size, md5('{seed}-' || h) AS key FROM {groups}),
{name}_n AS (SELECT ceil({p} * coalesce(sum(size), 0)) AS target FROM {groups}),
{name}_r AS (SELECT h, size, key, sum(size) OVER (ORDER BY key) AS upto FROM {name}_k),
{name}_f AS (SELECT h, size FROM {name}_r, {name}_n WHERE upto <= target),
{name}_l AS (SELECT target - coalesce((SELECT sum(size) FROM {name}_f), 0) AS lacking FROM {name}_n),
{name}_s AS (SELECT h, row_number() OVER (ORDER BY key) AS rn FROM {name}_k
             WHERE size = 1 AND h NOT IN (SELECT h FROM {name}_f)),
{name} AS (SELECT h FROM {name}_f UNION ALL SELECT h FROM {name}_s, {name}_l WHERE rn <= lacking)"""


def grouped_split_sql() -> str:
    return f"""
g AS (SELECT coalesce(md5(text), 'null') AS h, count(*) AS size FROM documents GROUP BY 1),
{fill_sql("tst", "g", SPLIT["test_seed"], SPLIT["test_p"])},
g2 AS (SELECT h, size FROM g WHERE h NOT IN (SELECT h FROM tst)),
{fill_sql("val", "g2", SPLIT["valid_seed"], SPLIT["valid_p"])},
sp AS (SELECT doc_id, lang, text, CASE WHEN coalesce(md5(text), 'null') IN (SELECT h FROM tst) THEN 'test'
              WHEN coalesce(md5(text), 'null') IN (SELECT h FROM val) THEN 'valid' ELSE 'train' END AS split FROM documents)"""


sql("exact_split_grouped", f"WITH {grouped_split_sql()}\nSELECT doc_id, split FROM sp")
sql("split_leak_report_grouped", leak_sql(grouped_split_sql()))


# ---- 8-10. features, naive Bayes, reports ----------------------------------

sql("doc_term_counts", f"""
WITH {NORM_TOKENS}
SELECT doc_id, token AS term, count(*) AS tf FROM lx WHERE length(token) >= 2 GROUP BY doc_id, token""")

def model_sql(target: str = "lang", upto: str = "rep") -> str:
    """CTEs of the model jobs, as far as the query needs them."""
    source = "sp" if target == "lang" else f"(SELECT sp.*, l.{target} FROM sp LEFT JOIN labels l USING (doc_id))"
    parts = [("sp", split_sql()), ("lab", f"""
tg AS MATERIALIZED (SELECT * FROM {source}),
dim AS (SELECT {target}, CAST(row_number() OVER (ORDER BY {target}) - 1 AS INTEGER) AS label
        FROM (SELECT DISTINCT {target} FROM tg WHERE {target} IS NOT NULL)),
lab AS MATERIALIZED (SELECT tg.doc_id, tg.split, dim.label FROM tg LEFT JOIN dim USING ({target}))"""),
        ("w", norm_tokens("sp").strip() + """,
tf AS MATERIALIZED (SELECT doc_id, token AS term, count(*) AS tf FROM lx WHERE length(token) >= 2 GROUP BY doc_id, token),
ntr AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab WHERE split <> 'test'),
idf AS MATERIALIZED (SELECT tf.term, ln((1.0 + any_value(ntr.n)) / (1.0 + count(*))) + 1.0 AS idf
        FROM tf JOIN lab USING (doc_id), ntr WHERE lab.split <> 'test' GROUP BY tf.term),
w0 AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term)),
w AS MATERIALIZED (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0)"""),
        ("ct", """
ct AS MATERIALIZED (SELECT lab.label, w.term, sum(w.weight) AS cnt FROM w JOIN lab USING (doc_id)
       WHERE lab.split <> 'test' AND lab.label IS NOT NULL GROUP BY lab.label, w.term),
nv AS (SELECT CAST(count(*) AS DOUBLE) AS v FROM idf),
tot AS (SELECT label, sum(cnt) AS tot FROM ct GROUP BY label),
nc AS (SELECT label, count(*) AS n_c FROM lab WHERE split <> 'test' AND label IS NOT NULL GROUP BY label),
cls AS MATERIALIZED (SELECT nc.label, nc.n_c, coalesce(tot.tot, 0.0) AS tot, nv.v
        FROM nc LEFT JOIN tot USING (label), nv)"""),
        ("preds", """
ntot AS (SELECT CAST(sum(n_c) AS DOUBLE) AS n FROM cls),
test AS (SELECT doc_id, label FROM lab WHERE split = 'test'),
tw AS (SELECT w.doc_id, sum(weight) AS wd FROM w JOIN test USING (doc_id) GROUP BY w.doc_id),
ts AS (SELECT w.doc_id, ct.label, sum(w.weight * ln(ct.cnt + 1.0)) AS s
       FROM w JOIN test USING (doc_id) JOIN ct USING (term) GROUP BY w.doc_id, ct.label),
sc AS (SELECT t.doc_id, c.label AS c,
              ln(c.n_c / ntot.n) + coalesce(ts.s, 0.0) - coalesce(tw.wd, 0.0) * ln(c.tot + c.v) AS score
       FROM test t JOIN cls c ON TRUE JOIN ntot ON TRUE LEFT JOIN tw ON tw.doc_id = t.doc_id
       LEFT JOIN ts ON ts.doc_id = t.doc_id AND ts.label = c.label),
pr AS (SELECT doc_id, c AS pred FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c) = 1),
preds AS MATERIALIZED (SELECT t.doc_id, t.label, pr.pred FROM test t JOIN pr USING (doc_id))"""),
        ("rep", REPORT)]
    names = [n for n, _ in parts]
    return ",\n".join(text.strip() for _, text in parts[:names.index(upto) + 1])


REPORT = """
conf AS (SELECT label, pred, count(*) AS n FROM preds WHERE label IS NOT NULL GROUP BY label, pred),
pcls AS (SELECT c, coalesce((SELECT sum(n) FROM conf WHERE label = c AND pred = c), 0) AS tp,
                coalesce((SELECT sum(n) FROM conf WHERE label = c), 0) AS support,
                coalesce((SELECT sum(n) FROM conf WHERE pred = c), 0) AS predicted
         FROM (SELECT label AS c FROM conf UNION SELECT pred FROM conf)),
pc AS (SELECT c, tp, support, predicted,
              CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pcls),
pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc),
rep AS (SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pcf
        UNION ALL
        SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM pcf
        UNION ALL
        SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM pcf
        UNION ALL
        SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
               sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pcf)"""
MODEL = model_sql()
REPORT_ROWS = ("SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep")

sql("tfidf_weights", f"WITH {model_sql(upto='w')}\nSELECT doc_id, term, tf, round(weight, 6) AS weight FROM w")
sql("phrase_tfidf_weights", f"""WITH {split_sql(SPLIT=PHRASE_SPLIT)},
{RAKE.strip()},
tf AS MATERIALIZED (SELECT rk.doc_id, phrase AS term, count(*) AS tf FROM rk WHERE n_words >= 2 GROUP BY rk.doc_id, phrase),
ntr AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM sp WHERE split <> 'test'),
idf AS (SELECT tf.term, ln((1.0 + any_value(ntr.n)) / (1.0 + count(*))) + 1.0 AS idf
        FROM tf JOIN sp USING (doc_id), ntr WHERE sp.split <> 'test' GROUP BY tf.term),
w0 AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term))
SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w0""")
sql("nb_fit", f"""WITH {model_sql(upto='ct')}
SELECT ct.label, ct.term, round(ct.cnt, 6) AS cnt, round(ln(ct.cnt + 1.0) - ln(cls.tot + cls.v), 6) AS log_theta
FROM ct JOIN cls USING (label)""")
sql("text_classify_nb", f"WITH {model_sql(upto='preds')}\nSELECT doc_id, label, pred FROM preds")
sql("score_saved_nb", f"WITH {model_sql(upto='preds')}\nSELECT doc_id, label, pred FROM preds")
sql("quality_classify_nb", f"WITH {model_sql('quality', 'preds')}\nSELECT doc_id, label, pred FROM preds")
sql("classification_report", f"WITH {MODEL}\n{REPORT_ROWS}")
for _t in ("quality", "toxic"):
    sql(f"{_t}_report", f"WITH {model_sql(_t)}\n{REPORT_ROWS}")
sql("report_long", f"""WITH {MODEL},
lg AS (SELECT class, 'precision' AS metric, precision AS value FROM rep UNION ALL
       SELECT class, 'recall', recall FROM rep UNION ALL SELECT class, 'f1', f1 FROM rep UNION ALL
       SELECT class, 'support', CAST(support AS DOUBLE) FROM rep)
SELECT class, metric, round(value, 6) AS value FROM lg WHERE value IS NOT NULL""")
sql("accuracy_macro_f1", f"""WITH {MODEL}
SELECT CAST(sum(support) AS BIGINT) AS n_rows, round(sum(tp) / sum(support), 6) AS accuracy,
       round(avg(f1), 6) AS macro_f1 FROM pcf""")


# ---- 12. sequences ---------------------------------------------------------

from ..operators.summary import SENTENCE  # noqa: E402
from .jobs import BATCH_SIZE, MAX_LEN  # noqa: E402

_WT = S.word_tokens("lower(text)")
SEQS = f"""
wt AS (SELECT doc_id, {_WT} AS toks FROM documents),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY md5(token)) + 3 AS INTEGER) AS id
          FROM (SELECT DISTINCT unnest(toks) AS token FROM wt)),
x AS (SELECT doc_id, u.token, u.pos FROM wt, unnest(wt.toks[1:{MAX_LEN - 2}]) WITH ORDINALITY AS u(token, pos)),
ids AS (SELECT x.doc_id, list(v.id ORDER BY x.pos) AS ids FROM x JOIN vocab v USING (token) GROUP BY x.doc_id),
seqs AS (SELECT d.doc_id, list_concat([1], coalesce(ids.ids, []::INTEGER[]), [2]) AS seq
         FROM documents d LEFT JOIN ids USING (doc_id))"""

sql("pack_sequences", f"""WITH {SEQS}
SELECT doc_id, array_to_string(seq, ' ') AS input_ids, CAST(len(seq) AS BIGINT) AS n_tokens FROM seqs""")

sql("pack_batches", f"""WITH {SEQS},
{split_sql().strip()},
rn AS (SELECT doc_id, split, seq, len(seq) AS n, row_number() OVER (PARTITION BY split ORDER BY
             CASE WHEN split = 'train' THEN md5('15-' || CAST(doc_id AS VARCHAR)) END, doc_id) AS rn
      FROM seqs JOIN sp USING (doc_id)),
bn AS (SELECT *, CAST(floor((rn - 1) / {BATCH_SIZE}) AS BIGINT) AS batch FROM rn),
m AS (SELECT *, max(n) OVER (PARTITION BY split, batch) AS mx FROM bn)
SELECT doc_id, split, batch, CAST(rn AS BIGINT) AS position,
       array_to_string(list_concat(seq, list_transform(range(mx - n), lambda x: 0)), ' ') AS input_ids,
       array_to_string(list_concat(list_transform(range(n), lambda x: 1), list_transform(range(mx - n), lambda x: 0)), ' ')
         AS attention_mask
FROM m""")

_B = MAX_LEN - 3
_H = _B // 2
sql("pack_pairs", f"""
WITH c AS (SELECT conv_id, turn, role, {_WT} AS toks FROM conversations),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY md5(token)) + 3 AS INTEGER) AS id
          FROM (SELECT DISTINCT unnest(toks) AS token FROM c)),
pairs AS (SELECT u.conv_id, u.turn, u.toks AS at, a.toks AS bt FROM c u
          JOIN c a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'),
ax AS (SELECT conv_id, turn, u.token, u.pos FROM pairs, unnest(pairs.at[1:{_B}]) WITH ORDINALITY AS u(token, pos)),
bx AS (SELECT conv_id, turn, u.token, u.pos FROM pairs, unnest(pairs.bt[1:{_B}]) WITH ORDINALITY AS u(token, pos)),
aid AS (SELECT conv_id, turn, list(v.id ORDER BY ax.pos) AS ids FROM ax JOIN vocab v USING (token) GROUP BY conv_id, turn),
bid AS (SELECT conv_id, turn, list(v.id ORDER BY bx.pos) AS ids FROM bx JOIN vocab v USING (token) GROUP BY conv_id, turn),
pp AS (SELECT p.conv_id, p.turn, coalesce(aid.ids, []::INTEGER[]) AS a, coalesce(bid.ids, []::INTEGER[]) AS b
       FROM pairs p LEFT JOIN aid USING (conv_id, turn) LEFT JOIN bid USING (conv_id, turn)),
cut AS (SELECT *, len(a) AS la, len(b) AS lb FROM pp),
nn AS (SELECT *,
         CASE WHEN la + lb <= {_B} THEN la WHEN la < lb THEN least(la, {_H}) WHEN lb < la THEN {_B} - least(lb, {_H}) ELSE {_H} END AS na,
         CASE WHEN la + lb <= {_B} THEN lb WHEN lb < la THEN least(lb, {_H}) WHEN la < lb THEN {_B} - least(la, {_H}) ELSE {_B - _H} END AS nb
       FROM cut)
SELECT conv_id, turn, array_to_string(list_concat([1], a[1:na], [2], b[1:nb], [2]), ' ') AS input_ids,
       array_to_string(list_concat(list_transform(range(na + 2), lambda x: 0), list_transform(range(nb + 1), lambda x: 1)), ' ')
         AS token_type_ids,
       CAST(na + nb + 3 AS BIGINT) AS n_tokens
FROM nn""")

# ---- 13. scores and losses --------------------------------------------------

LOGITS = """
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
m AS (SELECT e.label, r.i, avg(e.v[r.i]) AS m FROM e, (SELECT unnest(range(1, (SELECT max(len(v)) FROM e) + 1)) AS i) r
      GROUP BY e.label, r.i),
c AS (SELECT label AS c, list(m ORDER BY i) AS cv FROM m WHERE label IS NOT NULL GROUP BY label),
l AS (SELECT vec_id, label, list(list_dot_product(v, cv) ORDER BY c) AS l, list(c ORDER BY c) AS cs
      FROM e, c GROUP BY vec_id, label),
x AS (SELECT vec_id, label, l, cs,
             list_max(l) + ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l))))) - l[list_position(cs, label)] AS loss
      FROM l)"""
sql("argmax_predict", f"WITH {LOGITS}\nSELECT vec_id, label, cs[list_position(l, list_max(l))] AS pred FROM x")
sql("cross_entropy", f"WITH {LOGITS}\nSELECT vec_id, label, round(loss, 6) AS loss FROM x")
sql("batch_losses", f"""WITH {LOGITS},
b AS (SELECT loss, CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) / {BATCH_SIZE}) AS BIGINT) AS batch FROM x)
SELECT batch, count(*) AS n_rows, round(avg(loss), 6) AS loss FROM b GROUP BY batch""")

sql("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")

# ---- 14. histories ---------------------------------------------------------

_EPOCH = "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT)"
sql("epoch_history", f"""
WITH b AS (SELECT {_EPOCH} AS epoch, event_type AS split, event_id % 16 AS batch, avg(value) AS bl
           FROM events GROUP BY ALL)
SELECT epoch, split, round(avg(bl), 6) AS loss FROM b GROUP BY epoch, split""")

sql("best_checkpoint", f"""
WITH e AS (SELECT {_EPOCH} AS epoch, count_if(event_type = 'purchase') / count(*) AS metric FROM events GROUP BY 1),
b AS (SELECT epoch, metric, greatest(0.0, coalesce(max(metric) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING
             AND 1 PRECEDING), 0.0)) AS best_before FROM e)
SELECT epoch, round(metric, 6) AS metric, round(best_before, 6) AS best_before, metric > best_before AS saved FROM b""")

# ---- 15. summaries ---------------------------------------------------------

sql("extractive_summary", f"""
WITH s AS (SELECT doc_id, u.raw, u.sidx - 1 AS sidx
           FROM documents, unnest(regexp_extract_all(text, {S.lit(SENTENCE)})) WITH ORDINALITY AS u(raw, sidx)),
s2 AS (SELECT doc_id, sidx, {S.strip_ws('raw')} AS sentence FROM s),
s3 AS (SELECT * FROM s2 WHERE sentence <> ''),
tk AS (SELECT doc_id, sidx, unnest({S.word_tokens('lower(sentence)')}) AS term FROM s3),
nd AS (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) AS n FROM documents),
dfq AS (SELECT term, count(DISTINCT doc_id) AS df FROM tk GROUP BY term),
idf AS (SELECT term, ln((1.0 + (SELECT n FROM nd)) / (df + 1.0)) + 1.0 AS idf FROM dfq),
sc AS (SELECT doc_id, sidx, avg(idf) AS score, count(*) AS n_tokens FROM tk JOIN idf USING (term) GROUP BY doc_id, sidx),
c AS (SELECT s3.doc_id, s3.sidx, s3.sentence, sc.score, sc.n_tokens FROM s3 JOIN sc USING (doc_id, sidx))
SELECT d.doc_id, CAST(sidx AS BIGINT) AS sentence_index,
       coalesce(array_to_string({S.split_ws('sentence')}[1:30], ' '), '') AS summary,
       round(score, 6) AS score, CAST(coalesce(n_tokens, 0) AS BIGINT) AS n_tokens
FROM documents d LEFT JOIN (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY (n_tokens >= 5) DESC, round(score, 9) DESC, sidx) = 1) b USING (doc_id)""")

# ---- 17. ingestion, resumable chunks, mergeable counts -----------------------

sql("csv_ingest", """
WITH k AS (SELECT *, doc_id % 20 AS m FROM documents),
r AS (SELECT *, m IN (3, 7, 11) AS bad FROM k)
SELECT doc_id, CASE WHEN NOT bad THEN text END AS text, CASE WHEN NOT bad THEN lang END AS lang,
       CASE WHEN NOT bad THEN n_chars END AS n_chars,
       CASE WHEN m = 3 THEN 'type' WHEN bad THEN 'columns' ELSE 'accepted' END AS status,
       CASE WHEN m = 3 THEN 'n_chars' END AS "column", CASE WHEN m = 3 THEN 'many' END AS value
FROM r""")

sql("csv_accounts", """
SELECT CAST(count_if(doc_id % 20 NOT IN (3, 7, 11)) AS BIGINT) AS accepted,
       CAST(count_if(doc_id % 20 IN (3, 7, 11)) AS BIGINT) AS rejected, count(*) AS records FROM documents""")

sql("chunk_run_resumed", f"""
WITH n AS (SELECT doc_id, text, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / {RUN_CHUNK_ROWS}) AS BIGINT) AS chunk
           FROM documents),
c AS (SELECT doc_id, chunk, {S.clean_text('text')} AS clean_text FROM n)
SELECT doc_id, chunk, clean_text FROM c WHERE clean_text IS NOT NULL AND clean_text <> ''""")

sql("token_topk_batches", ORACLE["token_topk"])
