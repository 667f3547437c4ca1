"""SQL for the queries, in DuckDB's dialect, written from the definitions and not from the Spark plans.

RE2's \\b knows ASCII only: accented letters become `_` first, which keeps lengths and word boundaries.
"""

from __future__ import annotations

from .tables import CUE_WORDS, DENYLIST, LEXICON, LOUD, PAUSE_MS, RULES, SOURCES, WORD_MS

_PLAIN = "regexp_replace(coalesce(text, ''), '[À-ÖØ-öø-ɏ]', '_', 'g')"
_TOKENS = rf"regexp_extract_all({_PLAIN}, '\b[a-zA-Z'']+\b')"
_LOWER = rf"list_filter({_TOKENS}, lambda t: t = lower(t) AND regexp_matches(t, '[a-z]'))"
_SPACE = r"[\s\x1c-\x1f\x{85}\p{Z}]+"
_SQUEEZE = lambda x: f"trim(regexp_replace({x}, '{_SPACE}', ' ', 'g'))"
_STRIP = lambda x: f"regexp_replace({x}, '^{_SPACE}|{_SPACE}$', '', 'g')"
_TAGS = lambda x: f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
_CLEAN = lambda x: f"regexp_replace({_SQUEEZE(f"translate({x}, ':[]', '')")}, '\\s+([,.;!?])', '\\1', 'g')"
_BAD = lambda x: f"(length({x}) - length(translate({x}, '[]{{}}|<>', '')))"

_VOCAB = rf"""
vw AS (SELECT unnest({_LOWER}) AS word FROM conversations),
vocab AS (SELECT word, count(*) >= 10 AS in_high FROM vw GROUP BY word)"""
_RARE = rf"""
dw AS (SELECT doc_id, unnest(list_distinct({_LOWER})) AS word FROM documents),
flagged AS (SELECT dw.doc_id, dw.word, vocab.word IS NULL AS oov FROM dw LEFT JOIN vocab ON dw.word = vocab.word WHERE vocab.word IS NULL OR NOT in_high),
rare AS (SELECT doc_id, count(*) FILTER (NOT oov) AS n_low, count(*) FILTER (oov) AS n_oov, string_agg(word, ',' ORDER BY word) AS words FROM flagged GROUP BY doc_id)"""

_lexicon = ", ".join(f"({i}, '{d}', '{w}')" for i, (d, ws) in enumerate(LEXICON.items()) for w in ws)
_DOMAINS = rf"""
lex(ord, domain, word) AS (VALUES {_lexicon}),
tw AS (SELECT doc_id, unnest(list_distinct(list_transform({_TOKENS}, lambda t: lower(t)))) AS word FROM documents),
ds AS (SELECT doc_id, ord, domain, count(*) AS score FROM tw JOIN lex USING (word) GROUP BY ALL),
dr AS (SELECT doc_id, domain, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ord) - 1 AS place FROM ds)"""

_ABBR = r"\b([A-Z][A-Z0-9]+|[0-9]+[A-Z][A-Z0-9]*|[a-z]+[A-Z][a-zA-Z0-9]*)\b"
_rules = ", ".join("(" + ", ".join(f"'{v}'" for v in (s, r[0], r[1], r[2], r[3], r[4])) + ")" for r in RULES for s in dict.fromkeys([r[0], *filter(None, r[5].split(","))]))
_HITS = rf"""
fenced AS (SELECT doc_id, coalesce(text, '') AS text, string_split(regexp_replace({_PLAIN}, '{_ABBR}', chr(57344) || '\1' || chr(57345), 'g'), chr(57344)) AS parts FROM documents),
pieces AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM fenced),
placed AS (SELECT *, sum(length(part) - CASE WHEN i = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pos FROM pieces),
cand AS (
  SELECT doc_id, i, split_part(part, chr(57345), 1) AS surface, pos::INT AS span_start, (pos + length(split_part(part, chr(57345), 1)))::INT AS span_end FROM placed WHERE i > 1),
norm AS (
  SELECT *, CASE WHEN length(surface) > 2 AND surface LIKE '%s' AND regexp_full_match(left(surface, -1), '{_ABBR[2:-2]}') THEN left(surface, -1) ELSE surface END AS normalized FROM cand),
rules(variant, abbr, reading, pron, tier, rule_id) AS (VALUES {_rules}),
hits AS (
  SELECT n.*, coalesce(s.abbr, m.abbr) AS abbr, coalesce(s.reading, m.reading) AS reading, coalesce(s.pron, m.pron) AS pron,
         coalesce(s.tier, m.tier) AS tier, coalesce(s.rule_id, m.rule_id) AS rule_id
  FROM norm n LEFT JOIN rules s ON n.surface = s.variant LEFT JOIN rules m ON n.normalized = m.variant WHERE coalesce(s.abbr, m.abbr) IS NOT NULL),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_hits,
         row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN tier = 'high_conf' THEN 0 ELSE 1 END, CASE WHEN pron <> 'spell_out' THEN 0 ELSE 1 END, abbr, span_start) AS r FROM hits),
prim AS (SELECT * FROM ranked WHERE r = 1)"""
_few = "n_hits <= 3"
_EXPANDED = rf"""{_HITS},
runs AS (
  SELECT h.doc_id, h.span_start, h.reading, f.text, h.span_end,
         lead(h.span_start, 1, length(f.text)::INT) OVER (PARTITION BY h.doc_id ORDER BY h.span_start) AS nxt,
         row_number() OVER (PARTITION BY h.doc_id ORDER BY h.span_start) AS k
  FROM ranked h JOIN fenced f USING (doc_id) WHERE {_few}),
glued AS (
  SELECT doc_id, string_agg(CASE WHEN k = 1 THEN substr(text, 1, span_start) ELSE '' END || reading || substr(text, span_end + 1, nxt - span_end), '' ORDER BY k) AS x FROM runs GROUP BY doc_id),
expanded AS (SELECT doc_id, {_SQUEEZE(_TAGS('x'))} AS text_expanded FROM glued)"""
_MANIFEST = rf"""{_EXPANDED},
man AS (
  SELECT p.doc_id AS uid, coalesce(d.source, '') AS video_id, coalesce(d.text, '') AS text, e.text_expanded, p.n_hits, p.abbr AS primary_abbr
  FROM prim p JOIN documents d USING (doc_id) JOIN expanded e USING (doc_id) WHERE {_few}),
best AS (
  SELECT *, {_CLEAN('text')} AS clean FROM man QUALIFY row_number() OVER (PARTITION BY primary_abbr ORDER BY
    (({_CLEAN('text')}) <> text OR ({_CLEAN('text_expanded')}) <> text_expanded), n_hits <> 1, {_BAD('text')} + {_BAD('text_expanded')},
    abs(len(list_filter(regexp_split_to_array({_CLEAN('text')}, '{_SPACE}'), lambda w: w <> '')) - 12), length({_CLEAN('text')}), uid) = 1),
pack AS (
  SELECT row_number() OVER (ORDER BY b.primary_abbr, b.uid) AS id, b.*, h.surface, h.span_start, h.rule_id
  FROM best b JOIN (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY doc_id, abbr ORDER BY span_start) = 1) h ON h.doc_id = b.uid AND h.abbr = b.primary_abbr),
items AS (
  SELECT *, 'audio/' || lpad(id::VARCHAR, 5, '0') || '_' || primary_abbr || '_' || coalesce(nullif(trim(regexp_replace(video_id, '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), ''), 'item') || '.wav' AS audio_file FROM pack)"""
_deny = ", ".join(f"'{x}'" for x in DENYLIST)

_CUES = rf"""
turns AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM conversations),
timed AS (
  SELECT *, coalesce(sum(len(words) * {WORD_MS} + CASE WHEN turn % 3 = 2 THEN {3 * PAUSE_MS} ELSE {PAUSE_MS} END)
            OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ms FROM turns),
cut AS (SELECT *, unnest(range(0, (len(words) - 1) // {CUE_WORDS} + 1)) AS k FROM timed WHERE len(words) > 0),
cues AS (
  SELECT conv_id::VARCHAR AS video_id, (turn * 100000 + k)::BIGINT AS cue_idx, ((ms + k * {CUE_WORDS * WORD_MS})::DOUBLE / 1000.0) AS start,
         ((ms + k * {CUE_WORDS * WORD_MS} + len(words[k * {CUE_WORDS} + 1:k * {CUE_WORDS} + {CUE_WORDS}]) * {WORD_MS} - 20)::DOUBLE / 1000.0) AS "end",
         array_to_string(words[k * {CUE_WORDS} + 1:k * {CUE_WORDS} + {CUE_WORDS}], ' ') AS text FROM cut)"""
_SEGMENTS = rf"""{_CUES},
ord AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY cue_idx) AS i FROM cues),
walk AS (
  SELECT video_id, i, start AS s, "end" AS e, text AS t, 0 AS seg, NULL::DOUBLE AS fs, NULL::DOUBLE AS fe, NULL::VARCHAR AS ft, true AS open FROM ord WHERE i = 1
  UNION ALL
  SELECT o.video_id, o.i,
    CASE WHEN w.open AND NOT (o.start - w.e > 1.2) THEN w.s ELSE o.start END,
    CASE WHEN w.open AND NOT (o.start - w.e > 1.2) THEN greatest(w.e, o."end") ELSE o."end" END,
    CASE WHEN w.open AND NOT (o.start - w.e > 1.2) THEN w.t || ' ' || o.text ELSE o.text END,
    w.seg + CASE WHEN NOT w.open OR o.start - w.e > 1.2 THEN 1 ELSE 0 END,
    NULL, NULL, NULL,
    NOT (w.open AND NOT (o.start - w.e > 1.2) AND (greatest(w.e, o."end") - w.s >= 30.0 OR regexp_matches(o.text, '[.!?。！？]$')))
  FROM walk w JOIN ord o ON o.video_id = w.video_id AND o.i = w.i + 1),
seg AS (SELECT video_id, seg AS seg_ord, arg_max(s, i) AS start, arg_max(e, i) AS "end", {_SQUEEZE(_TAGS('arg_max(t, i)'))} AS text FROM walk GROUP BY video_id, seg),
kept AS (SELECT * FROM seg WHERE "end" - start BETWEEN 5.0 AND 30.0 AND text <> '')"""

_loud = ", ".join(f"'{x}'" for x in LOUD)
_LOUD_SEGMENTS = _SEGMENTS.replace("lambda w: w <> '') AS words FROM", f"lambda w: w <> '').list_transform(lambda w: CASE WHEN w IN ({_loud}) THEN upper(w) ELSE w END) AS words FROM")
_LOUD_HITS = f"""{_LOUD_SEGMENTS},
segdocs AS (SELECT video_id::BIGINT * 1000000 + seg_ord AS doc_id, * FROM kept),
{_HITS.strip().replace("FROM documents)", "FROM segdocs)")}"""
_source_domain = "CASE video_id::BIGINT % 5 " + " ".join(f"WHEN {i} THEN '{s[0]}'" for i, s in enumerate(SOURCES)) + " END"
_PRON = "CASE WHEN regexp_matches(surface, '[0-9]') THEN 'mixed_alnum' WHEN regexp_matches(surface, '[a-z]') THEN 'camel_case' ELSE 'spell_out' END"
_FREE = f"""
free AS (SELECT *, {_PRON} AS pron FROM norm),
first AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_hits, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN pron <> 'spell_out' THEN 0 ELSE 1 END, normalized, span_start) AS r FROM free)"""
_tried = "ORDER BY nc, start, seg_ord"
_BY_SOURCE = "video_id::BIGINT % 5, video_id::BIGINT"

_ITEMS = "items AS (SELECT doc_id AS item_id, coalesce(source, '') AS video_id, coalesce(lang, '') AS domain, doc_id * 10.0 AS start, doc_id * 10.0 + 5.0 AS \"end\", coalesce(text, '') AS text FROM documents)"
_clip = "video_id || '_' || lpad(trunc(start * 1000)::BIGINT::VARCHAR, 9, '0') || '_' || lpad(trunc(\"end\" * 1000)::BIGINT::VARCHAR, 9, '0') || '.wav'"
_failed = r"CASE WHEN event_type = 'error' THEN '[WARN] Video info failed: read timed out ' || coalesce(props, '') WHEN event_type = 'click' THEN 'Expand FAILED' ELSE '[INFO] source=' || event_type END"

ORACLES = {
    "rare_words": f"WITH {_VOCAB}, {_RARE} SELECT doc_id, n_low::INT AS n_low, n_oov::INT AS n_oov, md5(words) AS words_md5 FROM rare",
    "rare_gate": f"""WITH {_VOCAB}, {_RARE}, {_DOMAINS}
SELECT d.lang, r.domain, count(*) AS n_docs, sum(x.n_low + x.n_oov)::BIGINT AS n_rare
FROM documents d JOIN rare x USING (doc_id) JOIN dr r ON r.doc_id = d.doc_id AND r.place = 0 WHERE x.n_low + x.n_oov BETWEEN 1 AND 60 GROUP BY d.lang, r.domain""",
    "tok_counts": f"SELECT lang, sum(len({_TOKENS}))::BIGINT AS n_tokens, sum(len({_LOWER}))::BIGINT AS n_lower FROM documents GROUP BY lang",
    "vocab_min_freq": f"SELECT word, (count(*) >= 10)::INT AS in_high FROM (SELECT unnest({_LOWER}) AS word FROM documents) GROUP BY word HAVING count(*) >= 5",
    "oov_words": f"WITH {_VOCAB}, dw AS (SELECT unnest(list_distinct({_LOWER})) AS word FROM documents) SELECT word, count(*) AS n_docs FROM dw WHERE word NOT IN (SELECT word FROM vocab) GROUP BY word",
    "domain_scores": f"WITH {_DOMAINS} SELECT doc_id, place::INT AS place, domain, score::INT AS score FROM dr",
    "domain_primary": f"WITH {_DOMAINS} SELECT d.doc_id, coalesce(r.domain, 'unknown') AS domain FROM documents d LEFT JOIN dr r ON r.doc_id = d.doc_id AND r.place = 0",
    "entities": rf"""WITH e AS (
  SELECT doc_id, unnest(x) AS entity, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, regexp_extract_all({_PLAIN}, '\b(?:[A-Z]{{2,}}[A-Z0-9-]*|[A-Z][a-z]+(?:{_SPACE}[A-Z][a-z]+){{1,3}})\b') AS x FROM documents)),
f AS (SELECT * FROM e WHERE length(entity) >= 2 AND lower(entity) NOT IN ('i', 'we', 'the') QUALIFY row_number() OVER (PARTITION BY doc_id, lower(entity) ORDER BY i) = 1)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS place, entity FROM f""",
    "abbr_candidates": f"WITH {_HITS} SELECT doc_id, surface, span_start, span_end, normalized FROM norm",
    "pron_type_infer": f"""WITH {_HITS}
SELECT normalized AS abbr, CASE WHEN regexp_matches(surface, '[0-9]') THEN 'mixed_alnum' WHEN regexp_matches(surface, '[a-z]') THEN 'camel_case' ELSE 'spell_out' END AS pron_type, count(*) AS n FROM norm GROUP BY 1, 2""",
    "abbr_rule_match": f"WITH {_HITS} SELECT doc_id, surface, abbr, rule_id, span_start, span_end FROM hits",
    "primary_hit": f"WITH {_HITS} SELECT doc_id, n_hits::INT AS n_hits, abbr AS primary_abbr, pron AS primary_pron_type, tier AS primary_confidence_tier FROM prim",
    "expand_readings": f"WITH {_EXPANDED} SELECT doc_id, length(text_expanded)::INT AS n_chars, md5(text_expanded) AS text_md5 FROM expanded",
    "caption_normalize": f"""WITH u AS (SELECT page_id, replace(replace(replace(replace({_TAGS('html')}, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS x FROM pages)
SELECT page_id, length({_SQUEEZE('x')})::INT AS n_chars, md5({_SQUEEZE('x')}) AS text_md5 FROM u""",
    "clean_text": f"""SELECT doc_id, length({_CLEAN('text')})::INT AS n_chars, {_BAD('text')}::INT AS n_bad,
  len(list_filter(regexp_split_to_array({_CLEAN('text')}, '{_SPACE}'), lambda w: w <> ''))::INT AS n_words, md5({_CLEAN('text')}) AS text_md5 FROM documents""",
    "cue_segments": f"WITH RECURSIVE {_SEGMENTS} SELECT video_id, (seg_ord)::INT AS seg_ord, round(start, 3) AS start, round(\"end\", 3) AS \"end\", text FROM kept",
    "segment_stats": f"""WITH RECURSIVE {_SEGMENTS} SELECT video_id, count(*) AS n_segments, round(sum("end" - start), 3) AS seconds,
  sum(len(list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda w: w <> '')))::BIGINT AS n_words FROM kept GROUP BY video_id""",
    "clip_names": f"WITH {_CUES} SELECT video_id, cue_idx, {_clip} AS clip, coalesce(nullif(trim(regexp_replace(text, '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), ''), 'item') AS safe FROM cues",
    "dedup_text": f"WITH {_ITEMS} SELECT min(item_id) AS item_id, md5(lower({_STRIP('text')})) AS text_md5 FROM items GROUP BY lower({_STRIP('text')})",
    "dedup_segment": f"WITH {_ITEMS}, k AS (SELECT item_id, printf('%s:%.3f:%.3f', video_id, start, \"end\") AS dedup_key FROM items) SELECT min(item_id) AS item_id, dedup_key FROM k GROUP BY dedup_key",
    "cap_per_video": f"WITH {_ITEMS} SELECT item_id, video_id FROM items QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY item_id) <= 5",
    "cap_per_domain": f"WITH {_ITEMS} SELECT item_id, domain FROM items QUALIFY row_number() OVER (PARTITION BY domain ORDER BY item_id) <= 25",
    "top_target": f"WITH {_ITEMS}, v AS (SELECT item_id FROM items QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY item_id) <= 30) SELECT row_number() OVER (ORDER BY item_id) AS uid, item_id FROM v ORDER BY item_id LIMIT 100",
    "greedy_select": f"""WITH RECURSIVE {_MANIFEST},
it AS (SELECT uid, video_id, lower({_STRIP("text")}) AS k, (SELECT list(DISTINCT abbr) FROM ranked r WHERE r.doc_id = man.uid) AS abbrs, row_number() OVER (ORDER BY uid) AS i FROM man),
st AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS ids, []::VARCHAR[] AS vids, []::VARCHAR[] AS keys, []::VARCHAR[] AS abbrs
  UNION ALL
  SELECT it.i, CASE WHEN ok THEN list_append(ids, uid) ELSE ids END, CASE WHEN ok THEN list_append(vids, video_id) ELSE vids END,
         CASE WHEN ok THEN list_append(keys, k) ELSE keys END, CASE WHEN ok THEN list_concat(st_abbrs, it_abbrs) ELSE st_abbrs END
  FROM (SELECT it.*, st.ids, st.vids, st.keys, st.abbrs AS st_abbrs, it.abbrs AS it_abbrs,
          len(st.ids) < 40 AND len(list_filter(st.vids, lambda v: v = it.video_id)) < 4 AND NOT list_contains(st.keys, it.k)
          AND len(list_filter(it.abbrs, lambda a: len(list_filter(st.abbrs, lambda b: b = a)) >= 9)) = 0 AS ok
        FROM st JOIN it ON it.i = st.i + 1) it),
fin AS (SELECT ids FROM st ORDER BY i DESC LIMIT 1)
SELECT unnest(ids) AS item_id, generate_subscripts(ids, 1) AS uid FROM fin""",
    "greedy_quota": f"""WITH RECURSIVE {_MANIFEST},
q AS (SELECT greatest(1, 24 // count(DISTINCT pron)) AS qp, list(DISTINCT pron) AS all_prons, greatest(1, 24 // count(DISTINCT tier)) AS qt, list(DISTINCT tier) AS all_tiers FROM rules),
own AS (SELECT doc_id, list(DISTINCT abbr) AS it_abbrs, list(DISTINCT pron) AS it_prons, list(DISTINCT tier) AS it_tiers FROM ranked GROUP BY doc_id),
it AS (
  SELECT man.uid, video_id, lower({_STRIP("text")}) AS k, it_abbrs, it_prons, it_tiers, prim.pron, prim.tier, q.*, row_number() OVER (ORDER BY man.n_hits, man.uid) AS i
  FROM man JOIN own ON own.doc_id = man.uid JOIN prim ON prim.doc_id = man.uid CROSS JOIN q),
st AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS ids, []::VARCHAR[] AS vids, []::VARCHAR[] AS keys, []::VARCHAR[] AS abbrs, []::VARCHAR[] AS prons, []::VARCHAR[] AS tiers
  UNION ALL
  SELECT i, CASE WHEN ok THEN list_append(ids, uid) ELSE ids END, CASE WHEN ok THEN list_append(vids, video_id) ELSE vids END,
         CASE WHEN ok THEN list_append(keys, k) ELSE keys END, CASE WHEN ok THEN list_concat(abbrs, it_abbrs) ELSE abbrs END,
         CASE WHEN ok THEN list_concat(prons, it_prons) ELSE prons END, CASE WHEN ok THEN list_concat(tiers, it_tiers) ELSE tiers END
  FROM (SELECT it.*, st.ids, st.vids, st.keys, st.abbrs, st.prons, st.tiers,
          len(st.ids) < 24 AND len(list_filter(st.vids, lambda v: v = it.video_id)) < 10 AND NOT list_contains(st.keys, it.k)
          AND len(list_filter(it_abbrs, lambda a: len(list_filter(st.abbrs, lambda b: b = a)) >= 9)) = 0
          AND (len(list_filter(st.prons, lambda v: v = it.pron)) < qp OR len(list_filter(all_prons, lambda a: len(list_filter(st.prons, lambda b: b = a)) < qp)) = 0)
          AND (len(list_filter(st.tiers, lambda v: v = it.tier)) < qt OR len(list_filter(all_tiers, lambda a: len(list_filter(st.tiers, lambda b: b = a)) < qt)) = 0) AS ok
        FROM st JOIN it ON it.i = st.i + 1) it),
fin AS (SELECT ids FROM st ORDER BY i DESC LIMIT 1)
SELECT unnest(ids) AS item_id, generate_subscripts(ids, 1) AS uid FROM fin""",
    "quota_plan": f"""WITH rules(variant, abbr, reading, pron, tier, rule_id) AS (VALUES {_rules})
SELECT 'pron_type' AS kind, pron AS name, (2000 // (SELECT count(DISTINCT pron) FROM rules))::INT AS quota FROM rules GROUP BY pron
UNION ALL SELECT 'confidence_tier', tier, (2000 // (SELECT count(DISTINCT tier) FROM rules))::INT FROM rules GROUP BY tier""",
    "best_per_abbr": f"WITH {_MANIFEST} SELECT primary_abbr, uid, video_id FROM best",
    "package_metadata": f"WITH {_MANIFEST} SELECT id::INT AS id, primary_abbr AS abbr, surface, audio_file, uid AS original_uid, md5(clean) AS text_md5, span_start, rule_id FROM items",
    "denylist_refine": f"""WITH {_MANIFEST}, k AS (SELECT *, row_number() OVER (ORDER BY id) AS n FROM items WHERE primary_abbr NOT IN ({_deny}))
SELECT n::INT AS id, primary_abbr AS abbr, 'audio/' || lpad(n::VARCHAR, 5, '0') || '_' || split_part(audio_file, '/', 2) AS audio_file FROM k""",
    "refine_report": f"""WITH {_MANIFEST} SELECT count(*) AS input_items, count(*) FILTER (primary_abbr NOT IN ({_deny})) AS kept_items, count(*) FILTER (primary_abbr IN ({_deny})) AS removed_items,
  count(DISTINCT primary_abbr) FILTER (primary_abbr IN ({_deny})) AS removed_unique_abbr, coalesce(string_agg(primary_abbr, ',' ORDER BY primary_abbr) FILTER (primary_abbr IN ({_deny})), '') AS removed_examples FROM items""",
    "selection_report": f"""WITH {_MANIFEST}, g AS (SELECT primary_abbr, bool_or(({_CLEAN('text')}) <> text) AS dirty FROM man GROUP BY primary_abbr)
SELECT (SELECT count(*) FROM man) AS input_records, (SELECT count(*) FROM g) AS selected_records, (SELECT count(*) FROM g) AS unique_abbr, (SELECT count(*) FROM g) AS groups,
  0::BIGINT AS skipped_missing_primary, 0::BIGINT AS skipped_missing_audio, (SELECT count(*) FROM g WHERE dirty) AS with_forbidden_available, (SELECT count(*) FROM best WHERE clean = text) AS without_forbidden_selected""",
    "audit_explode": f"""WITH {_HITS} SELECT r.doc_id AS uid, coalesce(d.source, '') AS video_id, surface, abbr, reading AS canonical_reading, pron AS pron_type, tier AS confidence_tier, rule_id
FROM ranked r JOIN documents d USING (doc_id) WHERE {_few}""",
    "abbr_counter": f"WITH {_HITS} SELECT abbr, count(DISTINCT doc_id) AS n FROM ranked WHERE {_few} GROUP BY abbr",
    "manifest_stats": f"WITH {_MANIFEST} SELECT 2000::BIGINT AS target_count, count(*) AS final_count, count(DISTINCT video_id) AS videos, max(uid) AS max_uid, round(count(*) * 5.0, 3)::DOUBLE AS seconds FROM man",
    "resume_anti": f"SELECT doc_id FROM documents WHERE lower({_STRIP("coalesce(text, '')")}) NOT IN (SELECT lower({_STRIP('text')}) FROM benchmark WHERE text IS NOT NULL)",
    "failure_classify": f"""WITH l AS (SELECT floor(epoch_us(ts)::DOUBLE / 3600000000)::BIGINT AS tick, {_failed} AS line FROM events),
c AS (SELECT tick, count(*) FILTER (line ILIKE '%video info failed%') AS video_info_failed, count(*) FILTER (line ILIKE '%expand failed%') AS expand_failed,
  count(*) FILTER (line ILIKE '%connection reset by peer%') AS connection_reset, count(*) FILTER (line ILIKE '%read timed out%' OR line ILIKE '%timeout after%') AS read_timeout,
  count(*) FILTER (line ILIKE '%video info failed%' OR line ILIKE '%expand failed%' OR line ILIKE '%connection reset by peer%' OR line ILIKE '%read timed out%' OR line ILIKE '%timeout after%') AS failure_lines FROM l GROUP BY tick)
SELECT *, CASE WHEN failure_lines < 10 THEN '网络波动可接受' WHEN failure_lines <= 30 THEN '失败偏高' ELSE '失败异常' END AS failure_status FROM c""",
    "speed_classify": """WITH t AS (SELECT floor(epoch_us(ts)::DOUBLE / 600000000)::BIGINT AS tick, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY tick) = 1 THEN 'baseline' WHEN n >= 20 THEN '正常' WHEN n >= 5 THEN '偏慢' ELSE '异常' END AS speed FROM t),
r AS (SELECT *, sum(CASE WHEN speed = '异常' THEN 0 ELSE 1 END) OVER (ORDER BY tick) AS run FROM s)
SELECT tick, n, speed, (sum(CASE WHEN speed = '异常' THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY tick))::BIGINT AS streak FROM r""",
    "subtitle_cues": f"""WITH {_CUES}, n AS (SELECT video_id, start, "end", {_SQUEEZE(_TAGS('text'))} AS text FROM cues)
SELECT video_id, count(*) AS n_cues, round(sum(start), 3) AS starts, round(sum("end"), 3) AS ends, sum(length(text))::BIGINT AS n_chars FROM n WHERE text <> '' GROUP BY video_id""",
    "mine_rare_words": rf"""WITH RECURSIVE {_SEGMENTS},
vw AS (SELECT unnest({_LOWER}) AS word FROM documents),
vocab AS (SELECT word, count(*) >= 50 AS in_high FROM vw GROUP BY word HAVING count(*) >= 2),
sw AS (SELECT video_id, seg_ord, unnest(list_distinct({_LOWER})) AS word FROM kept),
fl AS (SELECT video_id, seg_ord, count(*) FILTER (vocab.word IS NOT NULL) AS n_low, count(*) FILTER (vocab.word IS NULL) AS n_oov
       FROM sw LEFT JOIN vocab ON sw.word = vocab.word WHERE vocab.word IS NULL OR NOT in_high GROUP BY ALL),
ok AS (SELECT * FROM kept JOIN fl USING (video_id, seg_ord) WHERE n_low + n_oov BETWEEN 1 AND 12 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seg_ord) <= 4)
SELECT row_number() OVER (ORDER BY {_BY_SOURCE}, seg_ord) AS uid, video_id, round(start, 3) AS start, round("end", 3) AS "end", n_low::INT AS n_low, n_oov::INT AS n_oov,
  {_source_domain} AS source_domain, md5(text) AS text_md5, {_clip} AS clip FROM ok""",
    "mine_abbreviations": f"""WITH RECURSIVE {_LOUD_HITS},
n AS (SELECT doc_id, count(*) AS nc FROM norm GROUP BY doc_id),
ok AS (SELECT s.*, n.nc, p.n_hits, p.abbr, p.pron, p.tier FROM prim p JOIN n USING (doc_id) JOIN segdocs s USING (doc_id) WHERE p.n_hits <= 3 QUALIFY row_number() OVER (PARTITION BY video_id {_tried}) <= 5)
SELECT row_number() OVER (ORDER BY {_BY_SOURCE}, nc, start, seg_ord) AS uid, video_id, round(start, 3) AS start, n_hits::INT AS n_hits, abbr AS primary_abbr, pron AS primary_pron_type, tier AS primary_confidence_tier, md5(text) AS text_md5 FROM ok""",
    "mine_candidates": f"""WITH RECURSIVE {_LOUD_HITS}, {_FREE},
ok AS (SELECT s.*, f.n_hits AS nc, f.normalized, f.pron FROM first f JOIN segdocs s USING (doc_id) WHERE r = 1 AND f.n_hits <= 3 QUALIFY row_number() OVER (PARTITION BY video_id {_tried}) <= 5)
SELECT row_number() OVER (ORDER BY {_BY_SOURCE}, nc, start, seg_ord) AS uid, video_id, round(start, 3) AS start, nc::INT AS n_hits, normalized AS primary_abbr, pron AS primary_pron_type,
  'candidate_only' AS primary_confidence_tier, 'candidate_only' AS match_mode, md5(text) AS text_md5 FROM ok""",
    "candidate_primary": f"WITH {_HITS}, {_FREE} SELECT doc_id, n_hits::INT AS n_hits, normalized AS primary_abbr, pron AS primary_pron_type, 'candidate_only' AS match_mode FROM first WHERE r = 1",
    "source_counter": f"WITH {_MANIFEST} SELECT coalesce(d.lang, '') AS source_domain, count(*) AS n FROM man m JOIN documents d ON d.doc_id = m.uid GROUP BY 1",
    "review_sheet": f"WITH {_MANIFEST} SELECT doc_id AS uid, abbr, surface, reading AS canonical_reading, pron AS pron_type, tier AS confidence_tier FROM ranked WHERE {_few}",
    "open_videos": f"WITH {_MANIFEST}, c AS (SELECT video_id, count(*) AS n FROM man GROUP BY video_id) SELECT doc_id, coalesce(source, '') AS video_id FROM documents LEFT JOIN c ON c.video_id = coalesce(source, '') WHERE coalesce(n, 0) < 50",
}
