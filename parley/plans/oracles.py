"""The same results in DuckDB's SQL, over the tables of the driver."""

from __future__ import annotations

TARGET = "assistant"

WORDS = r"""
tok0 AS (SELECT conv_id, turn, role, regexp_split_to_array(trim(text), '\s+') AS toks FROM conversations WHERE trim(text) <> ''),
tok AS (SELECT conv_id, turn, role, unnest(toks) AS text, unnest(range(len(toks))) AS p FROM tok0),
w1 AS (SELECT *, row_number() OVER o - 1 AS gpos, lag(text) OVER o AS prev FROM tok WINDOW o AS (PARTITION BY conv_id ORDER BY turn, p)),
w2 AS (SELECT *, CASE WHEN p = 0 OR regexp_matches(prev, '[.?!]$') THEN 1 ELSE 0 END AS b FROM w1),
w3 AS (SELECT *, (sum(b) OVER (PARTITION BY conv_id ORDER BY gpos) - 1)::BIGINT AS seg_idx FROM w2),
w4 AS (SELECT *, (gpos * 400 + sum(b * ((conv_id * 7 + seg_idx * 13) % 5) * 700) OVER (PARTITION BY conv_id ORDER BY gpos))::BIGINT AS ms,
              gpos - min(gpos) OVER (PARTITION BY conv_id, seg_idx) AS pos FROM w3),
words AS (SELECT conv_id AS file_id, seg_idx, pos, gpos, text, ms::DOUBLE / 1000 AS s, (ms + 300)::DOUBLE / 1000 AS e,
                 ((conv_id * 31 + seg_idx * 17 + pos * 7) % 61 + 40)::DOUBLE / 100 AS score, role AS speaker FROM w4)"""
DIAR = """
diar AS (SELECT file_id, min(s) - (seg_idx * 5 % 4) * 0.25::DOUBLE AS ds, max(e) + (seg_idx * 3 % 4) * 0.25::DOUBLE AS de,
                any_value(speaker) AS speaker, seg_idx AS ord FROM words GROUP BY file_id, seg_idx)"""
MULTI = "multi AS (SELECT * REPLACE (CASE WHEN speaker = 'user' THEN 'user_' || (seg_idx % 3)::VARCHAR ELSE speaker END AS speaker) FROM words)"
NOISY = "noisy AS (SELECT * REPLACE (CASE WHEN (gpos * 7 + file_id) % 5 = 0 THEN CASE WHEN speaker = 'assistant' THEN 'user' ELSE 'assistant' END ELSE speaker END AS speaker) FROM words)"


def n_words(c: str) -> str:
    return rf"(CASE WHEN trim(coalesce({c}, '')) = '' THEN 0 ELSE len(regexp_split_to_array(trim({c}), '\s+')) END)::BIGINT"


def last_words(c: str, n: int) -> str:
    parts = rf"regexp_split_to_array(trim({c}), '\s+')"
    return f"CASE WHEN len({parts}) > {n} THEN array_to_string({parts}[-{n}:], ' ') ELSE {c} END"


def toks(c: str) -> str:
    return rf"regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}_]+')"


def sents(c: str) -> str:
    return rf"list_filter(string_split(regexp_replace(coalesce({c}, ''), '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '')"


def ratio(c: str) -> str:
    return f"CASE WHEN len({toks(c)}) = 0 THEN 0.0 ELSE len(list_distinct({toks(c)}))::DOUBLE / len({toks(c)}) END"


def punc(c: str) -> str:
    return f"CASE WHEN len({sents(c)}) = 0 THEN 0.0 ELSE len(list_filter({sents(c)}, lambda y: regexp_matches(trim(y), '[.?!]$')))::DOUBLE / len({sents(c)}) END"


def pairs(source: str = "words") -> str:
    return f"""
segs AS (SELECT file_id, seg_idx, bool_or(speaker = '{TARGET}') AS has_target FROM {source} GROUP BY ALL),
segc AS (SELECT *, coalesce(sum(has_target::INT) OVER (PARTITION BY file_id ORDER BY seg_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ctx_id FROM segs),
wc AS (SELECT w.*, g.has_target, g.ctx_id FROM {source} w JOIN segc g USING (file_id, seg_idx)),
rep AS (SELECT file_id, seg_idx, ctx_id, trim(string_agg(text, ' ' ORDER BY gpos)) AS output, avg(score) AS avg_score, sum(score) AS sum_score, count(score) AS n_score,
               min(s) AS tstart, max(e) AS tend FROM wc WHERE has_target AND speaker = '{TARGET}' GROUP BY ALL),
rep2 AS (SELECT *, {n_words("output")} AS output_len FROM rep),
kept AS (SELECT * FROM rep2 WHERE output_len >= 7 OR (output_len >= 1 AND round(avg_score, 9) >= 0.7)),
c1 AS (SELECT *, CASE WHEN speaker IS NOT DISTINCT FROM lag(speaker) OVER o THEN 0 ELSE 1 END AS c FROM wc WHERE NOT has_target WINDOW o AS (PARTITION BY file_id, ctx_id ORDER BY gpos)),
c2 AS (SELECT *, sum(c) OVER (PARTITION BY file_id, ctx_id ORDER BY gpos) AS turn_no FROM c1),
c3 AS (SELECT file_id, ctx_id, turn_no, any_value(speaker) || ': "' || string_agg(text, ' ' ORDER BY gpos) || '"' AS said FROM c2 GROUP BY file_id, ctx_id, turn_no),
c4 AS (SELECT *, row_number() OVER (PARTITION BY file_id, ctx_id ORDER BY turn_no DESC) AS back FROM c3),
c5 AS (SELECT file_id, ctx_id, string_agg(said, ' ' ORDER BY turn_no) AS full_text, count(*) AS num_context_turns FROM c4 WHERE back <= 10 GROUP BY ALL),
ctx AS (SELECT file_id, ctx_id, {last_words("full_text", 50)} AS input, num_context_turns FROM c5),
pairs AS (SELECT k.*, coalesce(c.input, '') AS input, {n_words("c.input")} AS input_len, coalesce(c.num_context_turns, 0) AS num_context_turns
          FROM kept k LEFT JOIN ctx c USING (file_id, ctx_id)),
g1 AS (SELECT *, CASE WHEN tstart - lag(tend) OVER (PARTITION BY file_id ORDER BY seg_idx) <= 1.5 THEN 0 ELSE 1 END AS fresh FROM pairs),
g2 AS (SELECT *, sum(fresh) OVER (PARTITION BY file_id ORDER BY seg_idx) AS grp FROM g1),
merged AS (SELECT file_id, min(seg_idx) AS seg_idx, arg_min(input, seg_idx) AS input, arg_min(input_len, seg_idx) AS input_len, string_agg(output, ' ' ORDER BY seg_idx) AS output,
                  sum(output_len)::BIGINT AS output_len, arg_min(tstart, seg_idx) AS tstart, arg_max(tend, seg_idx) AS tend, count(*) AS n_merged, sum(sum_score) / sum(n_score) AS avg_score
           FROM g2 GROUP BY file_id, grp)"""


def similarity(a: str, b: str) -> str:
    square = lambda t: f"list_sum(list_transform(list_distinct({t}), lambda w: pow(len(list_filter({t}, lambda x: x = w)), 2)))"
    shared = f"coalesce(list_sum(list_transform(list_distinct(list_intersect({a}, {b})), lambda w: len(list_filter({a}, lambda x: x = w)) * len(list_filter({b}, lambda x: x = w)))), 0)"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE {shared} / sqrt({square(a)} * {square(b)}) END"


def scored(source: str, out: str, diversity: str = "0") -> str:
    return f"""
{out}_0 AS (SELECT *, {toks("input")} AS ta, {toks("output")} AS tb FROM {source}),
{out}_1 AS (SELECT *, coalesce(avg_score, 0) AS conf, CASE WHEN output_len = 0 THEN 0 ELSE input_len::DOUBLE / output_len END AS rat, {punc("output")} AS pun, {similarity("ta", "tb")} AS sim FROM {out}_0),
{out} AS (SELECT *, greatest(0, least(1, (0.2 * conf + 1.0 + 1 / (1 + rat) + sim + 0.2 * pun + 0.1 * {diversity} + 0.1 * least(input_len / 50.0, 1) + 0.1 / (1 + exp(-(output_len - 5)::DOUBLE))) / 3.7))::DOUBLE AS quality_score FROM {out}_1)"""


SCORED = scored("merged", "scored")
REASON = """CASE WHEN NOT (output_len >= 7 OR (output_len >= 1 AND round(coalesce(avg_score, 0), 9) >= 0.85)) THEN 'length'
     WHEN round(avg_score, 9) < 0.5 THEN 'confidence' WHEN quality_score IS NULL OR round(quality_score, 9) < 0.6 THEN 'quality' END"""
CHAIN = f"WITH {WORDS}, {pairs()}, {SCORED}"
VECTORS = """
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y))) AS n FROM embeddings),
d AS (SELECT label, unnest(range(1, len(x) + 1)) AS i, unnest(list_transform(x, lambda y: y / n)) AS y FROM v WHERE n > 0),
m AS (SELECT label, i, avg(y) AS y FROM d GROUP BY ALL),
l AS (SELECT label, sqrt(sum(y * y)) AS n FROM m GROUP BY ALL),
cen AS (SELECT m.label, m.i, m.y / l.n AS y FROM m JOIN l USING (label)),
ref AS (SELECT unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y FROM v WHERE vec_id = 0)"""
SENT = r"""
q1 AS (SELECT *, coalesce(regexp_matches(lag(text) OVER (PARTITION BY file_id ORDER BY gpos), '[.?!]$'), false)::INT AS b2 FROM words),
q2 AS (SELECT *, sum(b2) OVER (PARTITION BY file_id ORDER BY gpos)::BIGINT AS sentence FROM q1),
q3 AS (SELECT file_id, sentence, trim(string_agg(text, ' ' ORDER BY gpos)) AS text, min(gpos) AS first_gpos FROM q2 GROUP BY ALL),
sen AS (SELECT *, suffix(text, '?') OR regexp_replace(lower(string_split(text, ' ')[1]), '^[.,?!]+|[.,?!]+$', '', 'g') IN
  ('what', 'who', 'when', 'where', 'why', 'how', 'is', 'are', 'do', 'does', 'did', 'can', 'could', 'will', 'would', 'should') AS question FROM q3)"""



def relabelled(source: str, gate: str = "true") -> str:
    """`after`: the source with the cascade's changes, judged among the words that pass the gate; `chg`: what it changed."""
    return f"""
gate AS (SELECT n.*, row_number() OVER (PARTITION BY file_id ORDER BY gpos) AS rn FROM {source} n WHERE {gate}),
near AS (SELECT a.file_id, a.rn, any_value(a.gpos) AS gpos, any_value(a.speaker) AS speaker, any_value(length(trim(a.text))) AS len, min(b.rn) AS lo, max(b.rn) AS hi
         FROM gate a JOIN gate b ON a.file_id = b.file_id AND abs(a.s - b.s) <= 1.0::DOUBLE GROUP BY a.file_id, a.rn),
marks AS (SELECT file_id, list((speaker = '{TARGET}')::INT ORDER BY rn) AS lab, count(*) AS n FROM gate GROUP BY file_id),
casc(file_id, k, lab) AS (
  SELECT file_id, 0::BIGINT, lab FROM marks
  UNION ALL
  SELECT c.file_id, c.k + 1, CASE WHEN n.speaker <> '{TARGET}' AND n.len <= 3 AND list_sum(c.lab[n.lo:n.hi]) * 2 > n.hi - n.lo + 1 THEN list_concat(list_concat(c.lab[1:n.rn - 1], [1]), c.lab[n.rn + 1:]) ELSE c.lab END
  FROM casc c JOIN near n ON n.file_id = c.file_id AND n.rn = c.k + 1),
chg AS (SELECT n.file_id, n.gpos FROM near n JOIN marks m USING (file_id) JOIN casc c ON c.file_id = n.file_id AND c.k = m.n WHERE n.speaker <> '{TARGET}' AND c.lab[n.rn] = 1),
after AS (SELECT w.* REPLACE (CASE WHEN chg.gpos IS NOT NULL THEN '{TARGET}' ELSE w.speaker END AS speaker) FROM {source} w LEFT JOIN chg ON chg.file_id = w.file_id AND chg.gpos = w.gpos)"""


def gates() -> str:
    """The confidence and speech gates as a condition on a row `n` of the source; needs `cuts`."""
    return """(n.score IS NULL OR round(n.score, 9) >= (SELECT round(c.cut - 0.1, 9) FROM cuts c WHERE c.file_id = n.file_id AND c.speaker = n.speaker))
  AND EXISTS (SELECT 1 FROM diar d WHERE d.file_id = n.file_id AND d.ord % 2 = 0 AND n.s < d.de AND d.ds < n.e)"""


def cuts(source: str) -> str:
    return f"cuts AS (SELECT file_id, speaker, greatest(0.4, quantile_cont(score, 0.3)) AS cut FROM {source} GROUP BY ALL)"


FLAGGED = f"""{CHAIN}, {DIAR}, ov AS (SELECT w.file_id, w.gpos, any_value(w.seg_idx) AS seg_idx, (coalesce(sum(CASE WHEN d.ds IS NOT NULL THEN least(w.e, d.de) - greatest(w.s, d.ds) END) / any_value(w.e - w.s), 0) > 0.8)::INT AS o
FROM (SELECT c.* FROM wc c JOIN kept k USING (file_id, seg_idx) WHERE c.speaker = '{TARGET}') w LEFT JOIN diar d ON d.file_id = w.file_id AND d.speaker <> '{TARGET}' AND w.s < d.de AND d.ds < w.e GROUP BY w.file_id, w.gpos),
rates AS (SELECT g.file_id, min(g.seg_idx) AS seg_idx, avg(o) AS rate FROM ov JOIN g2 g USING (file_id, seg_idx) GROUP BY g.file_id, g.grp),
flg AS (SELECT file_id, seg_idx, rate, concat_ws(',', CASE WHEN rate >= 0.2 THEN 'high_overlap' END, CASE WHEN round(coalesce(avg_score, 0), 9) < 0.65 THEN 'low_confidence' END, CASE WHEN output_len > 0 AND input_len::DOUBLE / greatest(output_len, 1) > 1.0 THEN 'input_output_ratio' END) AS reasons
        FROM scored JOIN rates USING (file_id, seg_idx))"""
PREPARED = f"WITH RECURSIVE {WORDS}, {DIAR}, {NOISY}, {cuts('noisy')}, {relabelled('noisy', gates())}"


def result_columns(a: str, b: str) -> str:
    return f"len({sents(a)})::BIGINT AS input_sentence_count, len({sents(b)})::BIGINT AS output_sentence_count, round({ratio(a)}, 9) AS input_ttr, round({ratio(b)}, 9) AS output_ttr"


QNA = f"""solo AS (SELECT w.* FROM words w JOIN own USING (file_id) WHERE own.n = 1 OR own.share > 0.98),
{SENT.replace("FROM words", "FROM solo")},
s2 AS (SELECT *, sum(question::INT) OVER (PARTITION BY file_id ORDER BY sentence) AS q FROM sen),
w5 AS (SELECT a.*, s2.q, s2.question FROM q2 a JOIN s2 USING (file_id, sentence) WHERE s2.q > 0),
qg AS (SELECT file_id, q, trim(string_agg(text, ' ' ORDER BY gpos) FILTER (WHERE question)) AS input, trim(string_agg(text, ' ' ORDER BY gpos) FILTER (WHERE NOT question)) AS output,
       avg(score) FILTER (WHERE NOT question) AS avg_score, arg_min(s, gpos) FILTER (WHERE NOT question) AS tstart, arg_max(e, gpos) FILTER (WHERE NOT question) AS tend,
       count(DISTINCT CASE WHEN NOT question AND speaker <> '{TARGET}' THEN speaker END) AS others FROM w5 GROUP BY file_id, q),
qp AS (SELECT *, 'qna-' || (row_number() OVER (PARTITION BY file_id ORDER BY q) - 1)::VARCHAR AS seg_idx, {n_words('input')} AS input_len, {n_words('output')} AS output_len FROM qg WHERE output IS NOT NULL),
{scored("qp", "qscored", "least(1.0, others / 2.0)")},
qres AS (SELECT *, CASE WHEN trim(input) = '' THEN '[MISSING QUESTION]' ELSE input END AS said FROM qscored WHERE ({REASON}) IS NULL)"""
FLOW = f"""WITH RECURSIVE {WORDS}, {DIAR}, {cuts('words')}, {relabelled('words', gates())}, {pairs('after')}, {SCORED},
own AS (SELECT file_id, count_if(speaker = '{TARGET}')::DOUBLE / count(*) AS share, count(DISTINCT speaker) AS n FROM words GROUP BY file_id),
res AS (SELECT *, CASE WHEN trim(input) = '' THEN '[CONTEXT CONTINUES]' ELSE input END AS said FROM scored WHERE ({REASON}) IS NULL), {QNA},
both_ways AS (
  SELECT r.file_id, r.seg_idx::VARCHAR AS seg_idx, said, input_len, output, output_len, avg_score, tstart, tend, quality_score, 'conversational' AS pair_format, share FROM res r JOIN own o ON o.file_id = r.file_id WHERE o.n > 1 AND share <= 0.98
  UNION ALL SELECT r.file_id, r.seg_idx, said, input_len, output, output_len, avg_score, tstart, tend, quality_score, 'qna', share FROM qres r JOIN own o ON o.file_id = r.file_id)
SELECT file_id, seg_idx, said AS input, input_len, output, output_len, round(avg_score, 9) AS avg_score, round(tstart, 9) AS tstart, round(tend, 9) AS tend, round(quality_score, 9) AS quality_score,
       pair_format, round(share, 9) AS target_speaker_word_ratio, {result_columns('said', 'output')} FROM both_ways"""

SQL = {
    "conversation_flow": FLOW,
    "word_normalise": f"WITH {WORDS} SELECT file_id, gpos, text, CASE WHEN gpos % 7 <> 0 THEN round(s, 9) END AS start, score, CASE WHEN gpos % 11 = 0 THEN 'unknown' ELSE speaker END AS speaker FROM words",
    "join_words": f"WITH {WORDS}, j AS (SELECT file_id, seg_idx, trim(string_agg(text, ' ' ORDER BY gpos)) AS text FROM words GROUP BY ALL) SELECT *, {n_words('text')} AS n_words FROM j",
    "word_count": f"SELECT doc_id, {n_words('text')} AS n_words FROM documents",
    "keep_last_words": f"WITH {WORDS}, j AS (SELECT file_id, seg_idx, string_agg(text, ' ' ORDER BY gpos) AS t FROM words GROUP BY ALL), k AS (SELECT file_id, seg_idx, {last_words('t', 5)} AS text FROM j) SELECT *, {n_words('text')} AS n_words FROM k",
    "filler_removal": f"WITH {WORDS} SELECT file_id, gpos, text FROM words WHERE lower(trim(text)) NOT IN ('the', 'of', 'and')",
    "filler_count": f"WITH {WORDS} SELECT file_id, count_if(speaker <> '{TARGET}' AND lower(trim(text)) IN ('the', 'of', 'and'))::BIGINT AS n_fillers FROM words GROUP BY file_id",
    "single_segment": f"WITH {WORDS} SELECT file_id, round(arg_min(s, gpos), 9) AS start, round(arg_max(e, gpos), 9) AS \"end\", count(*) AS n_words FROM words GROUP BY file_id",
    "attach_speaker_max_overlap": f"""WITH {WORDS}, {DIAR},
o AS (SELECT w.file_id, w.gpos, d.speaker, row_number() OVER (PARTITION BY w.file_id, w.gpos ORDER BY least(w.e, d.de) - greatest(w.s, d.ds) DESC, d.ord) AS r
      FROM words w JOIN diar d ON w.file_id = d.file_id AND w.s < d.de AND d.ds < w.e)
SELECT w.file_id, w.gpos, coalesce(o.speaker, 'unknown') AS speaker FROM words w LEFT JOIN o ON o.file_id = w.file_id AND o.gpos = w.gpos AND o.r = 1""",
    "attach_counts": f"WITH {WORDS} SELECT file_id, speaker, count(*) AS n_words FROM words GROUP BY ALL",
    "vad_semi_filter": f"WITH {WORDS}, {DIAR} SELECT file_id, gpos FROM words w WHERE EXISTS (SELECT 1 FROM diar d WHERE d.file_id = w.file_id AND d.ord % 2 = 0 AND NOT (w.e <= d.ds OR w.s >= d.de))",
    "nontarget_overlap_fraction": f"""WITH {WORDS}, {DIAR}
SELECT w.file_id, w.gpos, round(coalesce(sum(CASE WHEN d.ds IS NOT NULL THEN least(w.e, d.de) - greatest(w.s, d.ds) END) / any_value(w.e - w.s), 0), 9) AS overlap_frac
FROM words w LEFT JOIN diar d ON d.file_id = w.file_id AND d.speaker <> '{TARGET}' AND w.s < d.de AND d.ds < w.e GROUP BY w.file_id, w.gpos""",
    "competing_word_max": f"""WITH {WORDS}, {NOISY}, x AS (SELECT * REPLACE (s + 0.9 AS e) FROM noisy)
SELECT a.file_id, a.gpos, coalesce(max(b.score), 0) AS max_comp FROM x a LEFT JOIN x b ON a.file_id = b.file_id AND a.seg_idx = b.seg_idx AND a.speaker <> b.speaker AND a.s < b.e AND b.s < a.e GROUP BY ALL""",
    "neighbour_votes": f"""WITH {WORDS}, {NOISY} SELECT file_id, gpos, count(*) OVER o AS votes, count_if(speaker = '{TARGET}') OVER o::BIGINT AS target_votes FROM noisy
WINDOW o AS (PARTITION BY file_id ORDER BY s RANGE BETWEEN 1.0::DOUBLE PRECEDING AND 1.0::DOUBLE FOLLOWING)""",
    "relabel_single_pass": f"""WITH {WORDS}, {NOISY}, nv AS (SELECT *, count(*) OVER o AS v, count_if(speaker = '{TARGET}') OVER o AS tv FROM noisy
WINDOW o AS (PARTITION BY file_id ORDER BY s RANGE BETWEEN 1.0::DOUBLE PRECEDING AND 1.0::DOUBLE FOLLOWING)),
r AS (SELECT file_id, gpos, speaker, speaker <> '{TARGET}' AND length(trim(text)) <= 3 AND tv * 2 > v AS relabelled FROM nv)
SELECT file_id, gpos, CASE WHEN relabelled THEN '{TARGET}' ELSE speaker END AS speaker, relabelled FROM r""",
    "adaptive_cutoff_p30": "SELECT event_type, round(greatest(0.4, quantile_cont(value, 0.3)), 9) AS cutoff FROM events GROUP BY ALL",
    "adaptive_cutoff_median": "SELECT event_type, round(greatest(0.4, median(value)), 9) AS cutoff FROM events GROUP BY ALL",
    "adaptive_cutoff_words": f"WITH {WORDS} SELECT file_id, speaker, round(greatest(0.4, quantile_cont(score, 0.3)), 9) AS cutoff FROM words GROUP BY ALL",
    "adaptive_filter": f"""WITH {WORDS}, c AS (SELECT file_id, speaker, greatest(0.4, quantile_cont(score, 0.3)) AS cut FROM words GROUP BY ALL)
SELECT file_id, gpos, score FROM words JOIN c USING (file_id, speaker) WHERE score IS NULL OR round(score, 9) >= round(cut - 0.1, 9)""",
    "speaker_dominance": f"WITH {WORDS} SELECT file_id, count(*) AS total, count_if(speaker = '{TARGET}')::BIGINT AS target_words, count(DISTINCT speaker) AS n_speakers, round(count_if(speaker = '{TARGET}')::DOUBLE / count(*), 9) AS target_ratio FROM words GROUP BY file_id",
    "route_mode": f"WITH {WORDS} SELECT file_id, CASE WHEN count(DISTINCT speaker) = 1 OR count_if(speaker = '{TARGET}')::DOUBLE / count(*) > 0.98 THEN 'qna' ELSE 'conversational' END AS mode FROM words GROUP BY file_id",
    "speaker_runs": f"""WITH {WORDS}, {NOISY}, a AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY gpos) THEN 0 ELSE 1 END AS c FROM noisy),
b AS (SELECT *, sum(c) OVER (PARTITION BY file_id ORDER BY gpos)::BIGINT AS run FROM a)
SELECT file_id, run, any_value(speaker) AS speaker, count(*) AS n_words, round(arg_min(s, gpos), 9) AS start, round(arg_max(e, gpos), 9) AS "end" FROM b GROUP BY file_id, run""",
    "context_attach": f"WITH {WORDS}, {pairs()} SELECT file_id, seg_idx, has_target, ctx_id FROM segc",
    "context_turns": f"WITH {WORDS}, {MULTI}, {pairs('multi')} SELECT file_id, ctx_id, input, {n_words('input')} AS input_len, num_context_turns FROM ctx",
    "reply_prefilter": f"WITH {WORDS}, {pairs()} SELECT file_id, seg_idx, output, output_len, round(avg_score, 9) AS avg_score FROM kept",
    "conversation_pairs": f"WITH {WORDS}, {pairs()} SELECT file_id, seg_idx, input, input_len, output, output_len, num_context_turns, row_number() OVER (PARTITION BY file_id ORDER BY seg_idx) = 1 AND input_len = 0 AS is_first_utterance FROM pairs",
    "merge_close_replies": f"WITH {WORDS}, {pairs()} SELECT file_id, seg_idx, input, output, output_len, round(tstart, 9) AS tstart, round(tend, 9) AS tend, n_merged FROM merged",
    "merge_avg_fold": f"""WITH {WORDS}, {pairs()}, f AS (SELECT *, row_number() OVER (PARTITION BY file_id, grp ORDER BY seg_idx) AS i, count(*) OVER (PARTITION BY file_id, grp) AS n FROM g2)
SELECT file_id, min(seg_idx) AS seg_idx, round(sum(avg_score * CASE WHEN i = 1 THEN pow(0.5, n - 1) ELSE pow(0.5, n - i + 1) END), 9) AS avg_score FROM f GROUP BY file_id, grp""",
    "event_gap_merge": """WITH a AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER o <= 21600000000 THEN 0 ELSE 1 END AS fresh FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS grp FROM a)
SELECT user_id, grp, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, round(sum(value), 9) AS total FROM b GROUP BY user_id, grp""",
    "sentence_split": f"WITH {WORDS}, {SENT} SELECT file_id, sentence, text, first_gpos, question FROM sen",
    "qna_pairs": f"""WITH {WORDS}, {SENT}, s2 AS (SELECT *, sum(question::INT) OVER (PARTITION BY file_id ORDER BY sentence) AS q FROM sen),
w5 AS (SELECT a.*, s2.q, s2.question FROM q2 a JOIN s2 USING (file_id, sentence) WHERE s2.q > 0),
g AS (SELECT file_id, q, trim(string_agg(text, ' ' ORDER BY gpos) FILTER (WHERE question)) AS input, trim(string_agg(text, ' ' ORDER BY gpos) FILTER (WHERE NOT question)) AS output,
      avg(score) FILTER (WHERE NOT question) AS a, arg_min(s, gpos) FILTER (WHERE NOT question) AS t0, arg_max(e, gpos) FILTER (WHERE NOT question) AS t1 FROM w5 GROUP BY file_id, q)
SELECT file_id, 'qna-' || (row_number() OVER (PARTITION BY file_id ORDER BY q) - 1)::VARCHAR AS seg_idx, input, {n_words('input')} AS input_len, output, {n_words('output')} AS output_len,
       round(a, 9) AS avg_score, round(t0, 9) AS tstart, round(t1, 9) AS tend FROM g WHERE output IS NOT NULL""",
    "token_ratio": f"SELECT doc_id, round({ratio('text')}, 9) AS ttr FROM documents",
    "sentence_count": f"SELECT doc_id, len({sents('text')})::BIGINT AS n_sentences FROM documents",
    "punctuation_share": f"SELECT doc_id, round({punc('text')}, 9) AS share FROM documents",
    "rich_text": f"SELECT doc_id, len(list_filter({toks('text')}, lambda t: t NOT IN ('the', 'of', 'and', 'a', 'to', 'in'))) >= 1 AS rich FROM documents",
    "quality_score": f"{CHAIN} SELECT file_id, seg_idx, round(quality_score, 9) AS quality_score, round(conf, 9) AS avg_conf, round(rat, 9) AS ratio, round(pun, 9) AS punc_score, round(sim, 9) AS semantic_similarity FROM scored",
    "quality_bucket": f"{CHAIN} SELECT CASE WHEN round(quality_score, 9) >= 0.7 THEN 'clean' WHEN round(quality_score, 9) >= 0.4 THEN 'borderline' ELSE 'flagged' END AS bucket, count(*) AS n FROM scored GROUP BY ALL",
    "postfilter_counts": f"""{CHAIN}, r AS (SELECT {REASON} AS reason FROM scored)
SELECT count(*) AS initial, count_if(reason IS NULL)::BIGINT AS kept, count_if(reason = 'length')::BIGINT AS dropped_by_length, count_if(reason = 'confidence')::BIGINT AS dropped_by_confidence, count_if(reason = 'quality')::BIGINT AS dropped_by_quality FROM r""",
    "postfilter": f"{CHAIN} SELECT file_id, seg_idx, round(quality_score, 9) AS quality_score FROM scored WHERE ({REASON}) IS NULL",
    "auto_flag": f"{FLAGGED} SELECT file_id, seg_idx, round(rate, 9) AS overlap_rate, reasons FROM flg WHERE reasons <> ''",
    "flagged_ids": f"{FLAGGED} SELECT file_id, string_agg(seg_idx::VARCHAR, ',' ORDER BY seg_idx) AS flagged_ids FROM flg WHERE reasons <> '' GROUP BY file_id",
    "chunk_shift": f"WITH {WORDS} SELECT file_id, gpos, round(coalesce(CASE WHEN gpos % 9 <> 0 THEN s END, 0) + (seg_idx % 4) * 30.5::DOUBLE, 9) AS start, round(e + (seg_idx % 4) * 30.5::DOUBLE, 9) AS \"end\" FROM words",
    "segments_sorted": f"""WITH {WORDS}, g AS (SELECT DISTINCT file_id, seg_idx AS was, CASE WHEN seg_idx % 7 <> 0 THEN (seg_idx * 37 % 11)::DOUBLE END AS start FROM words)
SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY coalesce(start, 0), was) - 1 AS seg_idx FROM g""",
    "min_duration": f"WITH {WORDS}, {DIAR} SELECT file_id, ord FROM diar WHERE de - ds >= 1.0",
    "batch_report": f"""WITH {WORDS}, l AS (SELECT DISTINCT file_id, CASE WHEN file_id % 5 = 0 THEN -1.0 ELSE file_id * 7.5 END::DOUBLE AS sec FROM words)
SELECT file_id, CASE WHEN sec < 0 THEN 'FAILED' ELSE 'OK' END AS status, CASE WHEN sec >= 0 THEN floor(sec / 60)::BIGINT END AS minutes, CASE WHEN sec >= 0 THEN sec % 60 END AS rest FROM l""",
    "relabel_cascade": f"WITH RECURSIVE {WORDS}, {NOISY}, {relabelled('noisy')} SELECT a.file_id, a.gpos, a.speaker, chg.gpos IS NOT NULL AS relabelled FROM after a LEFT JOIN chg ON chg.file_id = a.file_id AND chg.gpos = a.gpos",
    "prepared_words": f"{PREPARED} SELECT file_id, gpos, speaker FROM after",
    "target_words_after_relabel": f"{PREPARED} SELECT file_id, count_if(speaker = '{TARGET}')::BIGINT AS target_words FROM after GROUP BY file_id",
    "pair_diversity": f"""WITH {WORDS}, {MULTI} SELECT file_id, (seg_idx // 4)::BIGINT AS seg_idx, least(1.0, count(DISTINCT CASE WHEN speaker <> '{TARGET}' THEN speaker END) / 2.0::DOUBLE) AS diversity_score, round(avg(score), 9) AS avg_conf
FROM multi GROUP BY file_id, seg_idx // 4""",
    "config_sweep": f"""{CHAIN}, cfg(cfg, mw, mc, mq) AS (VALUES ('code', 7, 0.5, 0.6), ('readme', 5, 0.5, 0.55), ('tuned', 7, 0.5, 0.57), ('strict', 12, 0.7, 0.65))
SELECT cfg, count(*) AS pairs, count_if((output_len >= mw OR (output_len >= 1 AND round(coalesce(avg_score, 0), 9) >= 0.85)) AND (avg_score IS NULL OR round(avg_score, 9) >= mc) AND round(quality_score, 9) >= mq)::BIGINT AS kept FROM scored, cfg GROUP BY cfg""",
    "overlap_summary": f"""{CHAIN}, {DIAR}, f AS (SELECT w.file_id, w.gpos, coalesce(sum(CASE WHEN d.ds IS NOT NULL THEN least(w.e, d.de) - greatest(w.s, d.ds) END) / any_value(w.e - w.s), 0) > 0.8 AS o
FROM (SELECT c.* FROM wc c JOIN kept k USING (file_id, seg_idx) WHERE c.speaker = '{TARGET}') w LEFT JOIN diar d ON d.file_id = w.file_id AND d.speaker <> '{TARGET}' AND w.s < d.de AND d.ds < w.e GROUP BY w.file_id, w.gpos)
SELECT (SELECT count(*) FROM merged) AS meta_pairs, (SELECT count(*) FROM scored WHERE ({REASON}) IS NULL) AS clean_pairs, count(*) AS total_words, count_if(o)::BIGINT AS overlapped_words,
       round(coalesce(count_if(o)::DOUBLE / nullif(count(*), 0), 0), 9) AS overlap_rate, round(coalesce(1 - (SELECT count(*) FROM scored WHERE ({REASON}) IS NULL)::DOUBLE / nullif((SELECT count(*) FROM merged), 0), 0), 9) AS clean_drop_rate FROM f""",
    "final_report": f"""{CHAIN}, fd AS (SELECT file_id, max(e) AS duration FROM words GROUP BY file_id),
p AS (SELECT file_id, count(*) AS n_pairs, sum(tend - tstart) AS t, avg(avg_score) AS a, count_if(trim(input) = '') AS z FROM merged GROUP BY file_id)
SELECT file_id, round(duration, 9) AS duration, coalesce(n_pairs, 0) AS n_pairs, round(coalesce(t, 0), 9) AS target_seconds, round(a, 9) AS avg_conf, coalesce(z, 0)::BIGINT AS empty_inputs,
       round(coalesce(t * 100 / duration, 0), 9) AS target_share, round(coalesce(z::DOUBLE * 100 / n_pairs, 0), 9) AS empty_share FROM fd LEFT JOIN p USING (file_id)""",
    "placeholders": f"WITH {WORDS}, {pairs()}, f AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY seg_idx) = 1 AND input_len = 0 AS fu FROM pairs) SELECT file_id, seg_idx, CASE WHEN trim(input) = '' THEN CASE WHEN fu THEN '[NO PROMPT]' ELSE '[CONTEXT CONTINUES]' END ELSE input END AS input, input_len FROM f",
    "speaker_centroid": f"WITH {VECTORS} SELECT label::BIGINT AS label, i - 1 AS d, round(y, 9) AS x FROM cen",
    "identify_target": f"WITH {VECTORS}, r AS (SELECT label, sum(c.y * r.y) / (sqrt(sum(c.y * c.y)) * sqrt(sum(r.y * r.y))) AS sim FROM cen c JOIN ref r USING (i) GROUP BY label) SELECT label::BIGINT AS label, round(sim, 9) AS similarity, row_number() OVER (ORDER BY sim DESC, label) AS rank FROM r",
    "cosine_topk": f"WITH {VECTORS} SELECT v.vec_id, round(list_dot_product(v.x, z.x) / (v.n * z.n), 9) AS similarity FROM v, v z WHERE z.vec_id = 0 ORDER BY list_dot_product(v.x, z.x) / (v.n * z.n) DESC, v.vec_id LIMIT 10",
    "energy_vad": """WITH f AS (SELECT user_id AS file_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, value AS energy FROM events),
st AS (SELECT file_id, avg(energy) + 0.3 * stddev_pop(energy) AS lim FROM f GROUP BY file_id),
x AS (SELECT f.*, idx - row_number() OVER (PARTITION BY file_id ORDER BY idx) AS run FROM f JOIN st USING (file_id) WHERE energy > lim)
SELECT file_id, round(min(idx) * 0.03::DOUBLE, 9) AS start, round((max(idx) + 1) * 0.03::DOUBLE, 9) AS "end" FROM x GROUP BY file_id, run""",
    "legacy_score_pair": f"""WITH {WORDS}, {pairs()}, h AS (SELECT p.file_id, p.seg_idx, avg(w.score) AS c FROM pairs p JOIN words w ON w.file_id = p.file_id AND w.speaker = '{TARGET}' AND contains(p.output, w.text) GROUP BY ALL)
SELECT file_id, seg_idx, round(coalesce(c, 0), 9) AS confidence, round(CASE WHEN c IS NULL THEN 0 ELSE least(coalesce(input_len::DOUBLE / nullif(output_len, 0), 0), 4) END, 9) AS ratio,
       CASE WHEN c IS NOT NULL AND regexp_matches(trim(output), '[.?!]$') THEN 1.0 ELSE 0.0 END::DOUBLE AS complete,
       round(0.5 * coalesce(c, 0) + 0.3 * CASE WHEN c IS NULL THEN 0 ELSE least(coalesce(input_len::DOUBLE / nullif(output_len, 0), 0), 4) END + 0.2 * CASE WHEN c IS NOT NULL AND regexp_matches(trim(output), '[.?!]$') THEN 1 ELSE 0 END, 9) AS score
FROM pairs LEFT JOIN h USING (file_id, seg_idx)""",
    "legacy_build_pairs": f"""WITH {WORDS}, a AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_id ORDER BY gpos) THEN 0 ELSE 1 END AS c FROM words),
b AS (SELECT *, sum(c) OVER (PARTITION BY file_id ORDER BY gpos) AS run FROM a),
r AS (SELECT file_id, run, any_value(speaker) = '{TARGET}' AS mine, arg_min(s, gpos) AS s, arg_max(e, gpos) AS e FROM b GROUP BY file_id, run),
r2 AS (SELECT *, CASE WHEN lag(mine) OVER o AND (NOT mine OR s - lag(e) OVER o > 1.5) THEN 1 ELSE 0 END AS fl FROM r WINDOW o AS (PARTITION BY file_id ORDER BY run)),
r3 AS (SELECT *, sum(fl) OVER (PARTITION BY file_id ORDER BY run)::BIGINT AS pair FROM r2),
t AS (SELECT b.file_id, r3.pair, coalesce(string_agg(b.text, ' ' ORDER BY b.gpos) FILTER (WHERE NOT r3.mine AND lower(b.text) NOT IN ('the', 'of', 'and')), '') AS i0,
      coalesce(string_agg(b.text, ' ' ORDER BY b.gpos) FILTER (WHERE r3.mine), '') AS output, min(b.s) FILTER (WHERE r3.mine) AS t0, max(b.e) FILTER (WHERE r3.mine) AS t1 FROM b JOIN r3 USING (file_id, run) GROUP BY b.file_id, r3.pair),
u AS (SELECT *, {last_words('i0', 50)} AS input FROM t WHERE output <> '')
SELECT file_id, pair, input, {n_words('input')} AS input_len, output, {n_words('output')} AS output_len, round(t0, 9) AS tstart, round(t1, 9) AS tend FROM u""",
}
