"""SQL for the queries, written from the rules and not from the Spark code."""

from __future__ import annotations

from ..functions import text as T
from ..operators.align import STRATEGIES
from ..sources.tables import WORDS_SQL


def half_even(a: str, b: str, k: int) -> str:
    q, r = f"(({a}) * {k} // ({b}))", f"(({a}) * {k} - (({a}) * {k} // ({b})) * ({b}))"
    return f"(({q} + CASE WHEN 2 * {r} > ({b}) OR (2 * {r} = ({b}) AND {q} % 2 = 1) THEN 1 ELSE 0 END) / {k}.0)"


def words(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([WORDS_SQL, *more]) + "\n" + select


def long(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


MEAN = half_even(long("sum(dur)"), long("count(dur)"), 10)


def stats(keys: str, names: tuple[str, str], least: int) -> str:
    return f"""SELECT {keys}, CASE WHEN count(dur) >= {least} THEN {MEAN} END AS {names[0]}, CASE WHEN count(dur) >= {least} THEN median(dur) END AS {names[1]}, count(dur) AS n FROM words GROUP BY {keys}"""


KEYED = f"keyed AS (SELECT *, translate(script, '{T.KEY_STRIP}', '') AS word_key FROM words)"
_OTHERS = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW"


def loo(partition: str) -> str:
    return f"median(dur) OVER (PARTITION BY {partition} {_OTHERS})"


LOO_WORD = f"loo_word AS (SELECT *, count(dur) OVER (PARTITION BY reciter_id, word_key) - 1 AS word_others, CASE WHEN dur IS NOT NULL AND count(dur) OVER (PARTITION BY reciter_id, word_key) - 1 >= 3 THEN {loo('reciter_id, word_key')} END AS word_base FROM keyed)"
LOO_BOTH = LOO_WORD + f""",
loo_both AS (SELECT *, count(dur) OVER (PARTITION BY reciter_id, surah, ayah) - 1 AS verse_others,
  CASE WHEN dur IS NOT NULL AND count(dur) OVER (PARTITION BY reciter_id, surah, ayah) - 1 >= 2 THEN {loo('reciter_id, surah, ayah')} END AS verse_base FROM loo_word)"""
BASED = """chapters AS (SELECT reciter_id, surah, count(dur) AS chapter_n, median(dur) AS chapter_median FROM words GROUP BY ALL HAVING count(dur) >= 8),
reciters AS (SELECT reciter_id, count(dur) AS reciter_n, median(dur) AS reciter_median FROM words GROUP BY ALL HAVING count(dur) >= 8),
based AS (SELECT l.*, CASE WHEN dur IS NULL THEN NULL WHEN word_base IS NOT NULL THEN 'word' WHEN verse_base IS NOT NULL THEN 'verse' WHEN chapter_median IS NOT NULL THEN 'surah' WHEN reciter_median IS NOT NULL THEN 'reciter' END AS baseline_source,
  CASE WHEN dur IS NOT NULL THEN coalesce(word_base, verse_base, chapter_median, reciter_median) END AS baseline_ms, chapter_n, reciter_n
  FROM loo_both l LEFT JOIN chapters USING (reciter_id, surah) LEFT JOIN reciters USING (reciter_id)),
sourced AS (SELECT *, CASE baseline_source WHEN 'word' THEN word_others WHEN 'verse' THEN verse_others WHEN 'surah' THEN chapter_n WHEN 'reciter' THEN reciter_n END AS baseline_n FROM based)"""

M = "".join(f"\\x{{{a:04X}}}" if a == b else f"\\x{{{a:04X}}}-\\x{{{b:04X}}}" for a, b in [(0x610, 0x61A), (0x64B, 0x65F), (0x670, 0x670), (0x6D6, 0x6DC), (0x6DF, 0x6E8), (0x6EA, 0x6ED)])
CLUSTERS = rf"""
texts AS (SELECT DISTINCT script AS t FROM words),
split_ AS (SELECT t, regexp_extract_all(t, '[^{M}][{M}]*|[{M}]+') AS cs FROM texts),
raw_ AS (SELECT t, unnest(cs) AS c, generate_subscripts(cs, 1) - 1 AS i FROM split_),
clusters AS (SELECT t, i, c, substr(c, 1, 1) AS base, substr(c, 2) AS marks,
  CASE WHEN regexp_matches(c, '^[{M}]') THEN 'other' WHEN substr(c, 1, 1) = '{T.TATWEEL}' THEN 'tatweel' WHEN regexp_matches(c, '^[\x{{0600}}-\x{{06FF}}]') THEN 'base' ELSE 'other' END AS kind,
  CASE WHEN regexp_matches(c, '^[{M}]') OR substr(c, 1, 1) = chr(1569) THEN 'nonjoining' WHEN substr(c, 1, 1) = '{T.TATWEEL}' THEN 'dual'
       WHEN contains('{T.RIGHT_JOINING}', substr(c, 1, 1)) THEN 'right' WHEN regexp_matches(c, '^[\x{{0620}}-\x{{06FF}}]') THEN 'dual' ELSE 'nonjoining' END AS joining FROM raw_)"""


def has(where: str, *marks: str) -> str:
    return "(" + " OR ".join(f"contains({where}, '{m}')" for m in marks) + ")"


_VOWEL = r"regexp_matches(marks, '[\x{064B}-\x{0650}]')"
_REST = f"{has('marks', T.SUKUN, T.SMALL_SUKUN)} AND NOT {has('marks', T.SHADDA)}"
_BEFORE = {k: has("before", v) for k, v in (("a", T.FATHA), ("u", T.DAMMA), ("i", T.KASRA))}
_RULES = [
    (f"base = '{T.ALEF_MADDA}'", "alif_madd", "alef_madda"),
    (has("marks", T.DAGGER_ALEF), "alif_madd", "dagger_alif"),
    (has("marks", T.MADDAH, T.SMALL_MADDA), "alif_madd", "maddah"),
    (has("marks", T.SMALL_WAW), "waw_madd", "sila_waw"),
    (has("marks", T.SMALL_YEH), "ya_madd", "sila_yeh"),
    (f"base = '{T.ALEF}' AND {_BEFORE['a']}", "alif_madd", "fatha_alif"),
    (f"base = '{T.ALEF_MAKSURA}' AND {_BEFORE['a']}", "alif_madd", "fatha_alef_maksura"),
    (f"base = '{T.YEH}' AND {_BEFORE['i']} AND {has('marks', T.SHADDA)}", "ya_madd", "kasra_before_shadda_ya"),
    (f"base = '{T.YEH}' AND {_BEFORE['i']} AND NOT {has('marks', T.SHADDA)} AND NOT {_VOWEL}", "ya_madd", "kasra_ya"),
    (f"base = '{T.YEH}' AND NOT {_BEFORE['i']} AND {_BEFORE['a']} AND {_REST}", "ya_lin", "madd_lin"),
    (f"base = '{T.WAW}' AND {_BEFORE['u']} AND {has('marks', T.SHADDA)}", "waw_madd", "damma_before_shadda_waw"),
    (f"base = '{T.WAW}' AND {_BEFORE['u']} AND NOT {has('marks', T.SHADDA)} AND NOT {_VOWEL}", "waw_madd", "damma_waw"),
    (f"base = '{T.WAW}' AND NOT {_BEFORE['u']} AND {_BEFORE['a']} AND {_REST}", "waw_lin", "madd_lin"),
]
_FIRED = " UNION ALL ".join(f"SELECT t, i, {n} AS rule, '{kind}' AS type, '{reason}' AS reason FROM around WHERE kind = 'base' AND {condition}" for n, (condition, kind, reason) in enumerate(_RULES))
CANDIDATES = f"""around AS (SELECT *, coalesce(lag(marks) OVER (PARTITION BY t ORDER BY i), '') AS before FROM clusters),
fired AS ({_FIRED}),
candidates AS (SELECT t, i, type, arg_min(reason, rule) AS reason FROM fired GROUP BY t, i, type)"""
PAIRS = """pairs AS (SELECT t, i, joining AS ja, jb FROM (SELECT *, lead(kind) OVER o AS kb, lead(joining) OVER o AS jb FROM clusters WINDOW o AS (PARTITION BY t ORDER BY i))
  WHERE kind IN ('base', 'tatweel') AND joining = 'dual' AND kb IN ('base', 'tatweel') AND jb IN ('dual', 'right'))"""
STRETCH = PAIRS + """,
stretch AS (SELECT t, i, CASE WHEN EXISTS (SELECT 1 FROM candidates c WHERE c.t = pairs.t AND c.i IN (pairs.i, pairs.i + 1)) THEN 1 WHEN ja = 'dual' AND jb = 'dual' THEN 2 ELSE 3 END AS priority FROM pairs)"""

RATIO = f"CASE WHEN baseline_ms > 0 THEN {half_even(long('2 * dur'), long('2 * baseline_ms'), 1000)} END"
LEVEL = "CASE WHEN ratio IS NULL OR NOT drawn THEN NULL WHEN ratio < 1.4 THEN 'normal' WHEN ratio < 1.8 THEN 'slightlyExtended' WHEN ratio < 2.5 THEN 'extended' ELSE 'highlyExtended' END"
CONFIDENCE = """CASE WHEN drawn AND ratio IS NOT NULL AND baseline_source IS NOT NULL THEN round_even((0.4::DOUBLE * least(1::DOUBLE, greatest(0::DOUBLE, (score::DOUBLE + 8) / 8))
  + 0.35::DOUBLE * (CASE baseline_source WHEN 'word' THEN 1.0 WHEN 'verse' THEN 0.7 WHEN 'surah' THEN 0.5 WHEN 'reciter' THEN 0.35 ELSE 0.3 END)::DOUBLE + 0.25::DOUBLE * least(1::DOUBLE, baseline_n / 8::DOUBLE)) * 1000, 0) / 1000 END"""
_DRAWN = "marked AS (SELECT t, count(*) AS n_candidates FROM candidates GROUP BY t), places AS (SELECT t, count(*) AS n_stretch FROM stretch GROUP BY t)"


def analysed(source: str, base: str) -> str:
    chapters = ", h.chapter_mean, h.chapter_median" if base.endswith(BASED) else ""
    more = f"LEFT JOIN ({stats('reciter_id, surah', ('chapter_mean', 'chapter_median'), 8)}) h USING (reciter_id, surah)" if chapters else ""
    return words(
        f"""SELECT reciter_id, surah, ayah, idx, dur, n_candidates, n_stretch, baseline_ms, baseline_source, baseline_n, ratio, {LEVEL} AS level, {CONFIDENCE} AS confidence, true AS timing_enabled, v.verse_mean, v.verse_median{chapters}
FROM (SELECT s.*, {RATIO} AS ratio, coalesce(m.n_candidates, 0) AS n_candidates, coalesce(p.n_stretch, 0) AS n_stretch, m.n_candidates IS NOT NULL AS drawn FROM {source} s LEFT JOIN marked m ON m.t = s.script LEFT JOIN places p ON p.t = s.script) x LEFT JOIN ({stats('reciter_id, surah, ayah', ('verse_mean', 'verse_median'), 1)}) v USING (reciter_id, surah, ayah) {more}""",
        KEYED, base, CLUSTERS, CANDIDATES, STRETCH, _DRAWN,
    )


VERSE_ONLY = LOO_BOTH + ",\nsourced AS (SELECT * EXCLUDE (word_base), verse_base AS baseline_ms, CASE WHEN verse_base IS NOT NULL THEN 'verse' END AS baseline_source, CASE WHEN verse_base IS NOT NULL THEN verse_others END AS baseline_n FROM loo_both)"
LETTERS = r"greatest(1, length(regexp_replace(text, '[^\p{L}\x{0600}-\x{06FF}]', '', 'g')))"
NEED = f"least(900, greatest(120, 55 * {LETTERS}))"
PAUSE = r"regexp_matches(text, '[\x{06D6}-\x{06DC}]')"

QUALITY = f"""spans AS (SELECT *, end_ms - start_ms AS d, {NEED} AS need, lead(start_ms) OVER (PARTITION BY reciter_id, surah, ayah ORDER BY idx) - end_ms AS gap, {PAUSE} AS pause FROM words),
quality AS (SELECT reciter_id, surah, ayah, sum(greatest(0, d)) / max(duration_ms)::DOUBLE * 40.0 - count(*) FILTER (d < 80) * 8.0 - count(*) FILTER (d < 0.45 * need) * 3.0
  - count(*) FILTER (gap > 2500 OR (gap > 1500 AND NOT pause)) * 4.0 + greatest(-8.0, avg(score::DOUBLE)) * 0.5 AS quality FROM spans GROUP BY ALL)"""

_EXPECTED = "CASE WHEN ayah % 8 = 1 AND idx % 5 = 0 THEN upper(text) ELSE text END"
_WORD_RULES = [
    ("idx <> pos", "'index_order at ' || (pos - 1) || ': got ' || idx"),
    (f"text <> {_EXPECTED}", "'text_mismatch at ' || idx"),
    ("start_ms < 0 OR end_ms < 0", "'negative_ts at ' || idx"),
    ("start_ms >= end_ms", "'start_ge_end at ' || idx"),
    ("end_ms > duration_ms + 50", "'end_past_duration at ' || idx || ': ' || end_ms || '>' || duration_ms"),
    ("start_ms < before - 30", "'overlap at ' || idx"),
    ("d < soft AND d < 40", "'collapsed at ' || idx || ': ' || d || 'ms'"),
    ("d > 15000", "'too_long at ' || idx || ': ' || d || 'ms'"),
    ("before >= 0 AND start_ms - before > 1600 AND NOT paused", "'large_gap before ' || idx || ': ' || (start_ms - before) || 'ms'"),
    ("before >= 0 AND start_ms - before > 2800 AND paused", "'huge_gap before ' || idx || ': ' || (start_ms - before) || 'ms'"),
]
_VERSE_RULES = [
    ("first_ > edge AND duration_ms - last_ > edge", "'late_start'"),
    ("last_ < duration_ms - edge", "'early_end'"),
    ("tiny / n::DOUBLE > 0.08", "'too_many_short:' || tiny || '/' || n"),
    ("coverage < 0.48", "'low_coverage:' || format('{:.3f}', coverage)"),
    ("mean < -20", "'low_mean_score:' || format('{:.4f}', mean)"),
]
VALIDATION = f"""faulty_ AS (SELECT reciter_id, surah, ayah, idx AS pos, CASE WHEN ayah % 23 = 4 AND idx % 40 = 0 THEN idx + 1 ELSE idx END AS idx, CASE WHEN ayah % 3 = 0 AND idx % 50 = 49 THEN text || chr(1750) ELSE text END AS text,
  start_ms + moved AS start_ms, end_ms + moved AS end_ms, score, CASE WHEN ayah % 31 = 7 THEN 3 * duration_ms ELSE duration_ms END AS duration_ms
  FROM (SELECT *, CASE WHEN ayah % 29 = 2 AND idx = 1 THEN -5000 WHEN ayah % 31 = 7 THEN duration_ms ELSE 0 END AS moved FROM words WHERE ayah % 37 <> 5 AND ayah % 41 <> 3)),
around_ AS (SELECT *, coalesce(lag(end_ms) OVER o, -1) AS before, end_ms - start_ms AS d, least(80, greatest(60, 40 * {LETTERS})) AS soft, coalesce(lag({PAUSE}) OVER o, false) AS paused
  FROM faulty_ WINDOW o AS (PARTITION BY reciter_id, surah, ayah ORDER BY pos)),
whole_ AS (SELECT reciter_id, surah, ayah, max(duration_ms) AS duration_ms, count(*) AS n, arg_min(start_ms, pos) AS first_, arg_max(end_ms, pos) AS last_, count(*) FILTER (d < soft) AS tiny,
  sum(greatest(0, d)) / greatest(arg_max(end_ms, pos) - arg_min(start_ms, pos), 1)::DOUBLE AS coverage, avg(score::DOUBLE) AS mean, greatest(3000, CAST(floor(0.25 * max(duration_ms)) AS INT)) AS edge FROM around_ GROUP BY ALL),
said AS ({' UNION ALL '.join(f'SELECT reciter_id, surah, ayah, 1 AS part, pos AS idx, {k} AS rule, {say} AS error FROM around_ WHERE {condition}' for k, (condition, say) in enumerate(_WORD_RULES))}
  UNION ALL {' UNION ALL '.join(f'SELECT reciter_id, surah, ayah, 2, 0, {k}, {say} FROM whole_ WHERE {condition}' for k, (condition, say) in enumerate(_VERSE_RULES))}
  UNION ALL SELECT reciter_id, surah, ayah, 0, 0, 0, 'word_count expected=' || (n + 1) || ' got=' || n FROM whole_ WHERE ayah % 12 = 5
  UNION ALL SELECT reciter_id, surah, ayah, 0, 0, 0, 'empty_words' FROM docs_ WHERE (len(ts) = 0 OR ayah % 37 = 5) AND ayah % 41 <> 3
  UNION ALL SELECT reciter_id, surah, ayah, 0, 0, 0, 'missing_field:duration_ms' FROM docs_ WHERE ayah % 41 = 3),
errors AS (SELECT d.reciter_id, d.surah, d.ayah, coalesce(list(error ORDER BY part, idx, rule) FILTER (error IS NOT NULL), []) AS errors FROM docs_ d LEFT JOIN said s ON s.ayah = d.ayah AND s.surah = d.surah AND s.reciter_id = d.reciter_id GROUP BY ALL)"""

_PATH = """paths AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'r/' || (doc_id % 114 + 1) || '/' || (doc_id % 7 + 1) || '.json' WHEN 1 THEN 'r/x/' || lpad(CAST(doc_id % 114 + 1 AS VARCHAR), 3, '0') || lpad(CAST(doc_id % 7 + 1 AS VARCHAR), 3, '0') || '.json'
  WHEN 2 THEN 'r/x/' || (doc_id % 114 + 1) || '_' || (doc_id % 7 + 1) || '.json' WHEN 3 THEN 'r/002/002_' || (doc_id % 7 + 1) || '.json' WHEN 4 THEN 'r/x/_meta.json' ELSE 'r/x/name' || doc_id || '.json' END AS path, lang FROM documents),
parsed AS (SELECT *, CASE WHEN regexp_matches(path, '/[0-9]+/[0-9]+\\.json$') THEN regexp_extract(path, '/([0-9]+)/[0-9]+\\.json$', 1) WHEN regexp_matches(path, '/[0-9]{6}\\.json$') THEN regexp_extract(path, '/([0-9]{3})[0-9]{3}\\.json$', 1) WHEN regexp_matches(path, '/[0-9]+_[0-9]+\\.json$') THEN regexp_extract(path, '/([0-9]+)_[0-9]+\\.json$', 1) END::INT AS surah,
  CASE WHEN regexp_matches(path, '/[0-9]+/[0-9]+\\.json$') THEN regexp_extract(path, '/[0-9]+/([0-9]+)\\.json$', 1) WHEN regexp_matches(path, '/[0-9]{6}\\.json$') THEN regexp_extract(path, '/[0-9]{3}([0-9]{3})\\.json$', 1) WHEN regexp_matches(path, '/[0-9]+_[0-9]+\\.json$') THEN regexp_extract(path, '/[0-9]+_([0-9]+)\\.json$', 1) END::INT AS ayah FROM paths)"""
_JSON = """'{"ayah":' || doc_id || ',"n":' || n_chars || '}'"""
_PACKS = """packs AS (SELECT lang, source, count(*) AS n_documents, CAST(sum(strlen(j) + 1) AS BIGINT) AS bytes, sha256(string_agg(j || chr(10), '' ORDER BY doc_id, j)) AS checksum, 'lang=' || lang || '/source=' || source AS file
  FROM (SELECT *, to_json({'ayah': doc_id, 'text': text})::VARCHAR AS j FROM documents) GROUP BY ALL)"""
_OUTPUTS = "outputs AS (SELECT reciter_id, ayah, CASE WHEN ayah % 6 = 0 THEN 'missing' WHEN ayah % 10 = 3 THEN 'broken' WHEN len(errors) = 0 THEN 'ok' ELSE 'invalid' END AS status FROM errors)"
_RESULTS = f"""results AS (SELECT e.reciter_id, e.ayah, e.ayah % 4 AS shard, e.errors, CASE WHEN l.doc_id IS NOT NULL THEN 'skipped' WHEN len(e.errors) = 0 THEN 'passed' ELSE 'failed' END AS status
  FROM errors e LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l ON l.doc_id = e.ayah)"""
_SUMMARY = "summary AS (SELECT reciter_id, shard, count(*) AS attempted, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'failed') AS failed FROM results GROUP BY ALL)"
_MERGED = "merged AS (SELECT reciter_id, CAST(sum(attempted) AS BIGINT) AS attempted, CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(passed) AS BIGINT) AS passed, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(passed + failed) AS BIGINT) AS processed, sum(failed) / sum(attempted)::DOUBLE AS fail_rate FROM summary GROUP BY ALL)"
_COUNTS = "counts AS (SELECT CAST(substr(source, 4) AS INT) + 1 AS chapter, count(*) AS n_verses FROM documents GROUP BY ALL), work AS (SELECT chapter, verse, row_number() OVER (ORDER BY chapter, verse) - 1 AS position FROM (SELECT chapter, unnest(generate_series(1, n_verses)) AS verse FROM counts))"
_SPECS = "specs AS (SELECT doc_id % 100 AS a, doc_id % 100 + 2 AS b, doc_id % 150 AS c FROM documents)"
_CANDIDATES = "cands AS (SELECT lang AS reciter_id, source AS surah, doc_id AS ayah, r.rank, r.strategy, CASE WHEN (doc_id + r.rank) % 3 <> 0 AND doc_id % 11 <> 5 THEN ((doc_id * 7 + r.rank * 1013) % 4000) / 100.0 END AS quality FROM documents, (VALUES {}) r(rank, strategy))".format(", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(STRATEGIES)))

def let(value: str, body: str) -> str:
    """body with y for a value that is made once."""
    return f"list_transform([{value}], lambda y: {body})[1]"


_HALF = "CAST(floor(({}) / 2.0) AS BIGINT)"


def _repair(energy: bool) -> str:
    """The four passes as reductions over the words of a verse; curve(k) is the energy of the frames before k."""
    curve = lambda k: f"(({k}) // 101 * 5050 + part[({k}) % 101 + 1])"
    plain = let(f"{{'lo': greatest(y.a, {_HALF.format('y.a + y.b')} - {_HALF.format('y.want')}), 'a': y.a, 'b': y.b, 'want': y.want}}", let("{'hi': least(y.b, y.lo + y.want), 'a': y.a, 'want': y.want}", "{'s': greatest(y.a, y.hi - y.want), 'e': y.hi}"))
    # The gap, the frames it covers, the window with the most energy, the first on ties.
    gap = "{'a': greatest(0, y.a), 'b': greatest(greatest(0, y.a) + 1, y.b), 'want': least(y.want, greatest(greatest(0, y.a) + 1, y.b) - greatest(0, y.a))}"
    spot = "{'a': y.a, 'b': y.b, 'want': y.want, 'f': greatest(0, least(y.a // 20, frames - 1)), 'g': greatest(greatest(0, least(y.a // 20, frames - 1)) + 1, least(y.b // 20, frames)), 'w': greatest(1, y.want // 20)}"
    best = f"{{'a': y.a, 'b': y.b, 'want': y.want, 'raw': 20 * list_max(list_transform(range(y.f, y.g - y.w + 1), lambda i: {{'x': {curve('i + y.w')} - {curve('i')}, 'k': -i}})).k * -1}}"
    most = let(best, let("{'a': y.a, 'b': y.b, 's': CASE WHEN y.raw + y.want > y.b THEN y.b - y.want ELSE y.raw END, 'e': least(y.b, y.raw + y.want)}", "{'s': greatest(y.a, y.s), 'e': least(y.b, greatest(greatest(y.a, y.s) + 1, y.e))}"))
    loud = let(gap, f"CASE WHEN y.want < 40 THEN {{'s': y.a, 'e': greatest(y.a + 1, {_HALF.format('y.a + y.b')})}} ELSE {let(spot, f"CASE WHEN y.g - y.f <= y.w THEN {{'s': y.a, 'e': y.a + y.want}} ELSE {most} END")} END")
    wish = "{'a': y.a, 'b': y.b, 'want': least(y.need, y.b - y.a)}"
    room = "{'own': x.e - x.s, 'l': x.s - acc.le, 'r': x.nxt - x.e, 'left': acc.le, 's': x.s, 'e': x.e, 'nxt': x.nxt, 'need': x.need}"
    span = "{'own': y.own, 's': y.s, 'e': y.e, 'need': y.need, 'a': CASE WHEN y.l + y.r + y.own < y.need OR y.r < y.l THEN y.left ELSE y.s END, 'b': CASE WHEN y.l + y.r + y.own < y.need OR y.r >= y.l THEN y.nxt ELSE y.e END}"
    moved = let(room, let(span, f"CASE WHEN (y.own >= 100 AND y.own >= 0.5 * y.need) OR y.b - y.a < 40 THEN {{'s': y.s, 'e': y.e}} ELSE {let(let(wish, loud if energy else plain), "{'s': y.s, 'e': greatest(y.s + 1, y.e)}")} END"))
    give = "{'s': y.s, 'e': y.e, 'l': y.l, 'lack': y.need - y.own, 'r': least(y.r, y.need - y.own - least(y.l, (y.need - y.own) // 2))}"
    grown = let(room, f"CASE WHEN y.own >= y.need THEN {{'s': y.s, 'e': y.e}} ELSE {let(give, "{'s': y.s - least(y.l, y.lack - y.r), 'e': y.e + y.r}")} END")
    push = lambda body: let(body, "{'o': list_append(acc.o, y), 'le': y.e}")
    begin = "{'o': []::STRUCT(s BIGINT, e BIGINT)[], 'le': 0::BIGINT}"
    ordered = let("{'e': greatest(x.e, acc.cs + 1), 'ns': x.nxt}", f"CASE WHEN y.e > y.ns THEN {{'e': greatest({_HALF.format('y.e + y.ns')}, acc.cs + 1), 'ns': {_HALF.format('y.e + y.ns')}}} ELSE {{'e': y.e, 'ns': y.ns}} END")
    nexts = lambda xs, last: f"list_transform({xs}, lambda w, i: {{'s': w.s, 'e': w.e, 'need': ws[i].need, 'nxt': CASE WHEN i < n THEN {xs}[i + 1].s ELSE {last} END}})"
    return words(
        "SELECT reciter_id, surah, ayah, CAST(i AS INT) AS idx, CAST(p.s AS INT) AS start_ms, CAST(p.e AS INT) AS end_ms FROM (SELECT reciter_id, surah, ayah, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM four)",
        f"""verse_ AS (SELECT reciter_id, surah, ayah, max(duration_ms)::BIGINT AS d, count(*) AS n, list({{'s': start_ms::BIGINT, 'e': end_ms::BIGINT, 'need': {NEED}::BIGINT, 'pause': {PAUSE}}} ORDER BY idx) AS ws,
  greatest(max(duration_ms) // 20, 1) + 1 AS frames, list_transform(range(0, 101), lambda k: coalesce(list_sum(list_transform(range(0, k), lambda j: (j * 37 + ayah) % 101)), 0))::BIGINT[] AS part FROM words GROUP BY reciter_id, surah, ayah)""",
        f"one AS (SELECT *, list_reduce({nexts('ws', 'd')}, lambda acc, x: {push(moved)}, {begin}).o AS ps FROM verse_)",
        f"two AS (SELECT * EXCLUDE (ps), list_reduce({nexts('ps', 'd')}, lambda acc, x: {push(grown)}, {begin}).o AS ps FROM one)",
        """gaps AS (SELECT *, list_transform(ps, lambda w, i: {'g': ps[i + 1].s - w.e, 'p': ws[i].pause}) AS gs FROM two),
three AS (SELECT * EXCLUDE (ps), list_transform(ps, lambda w, i: {'s': CASE WHEN i > 1 AND gs[i - 1].g > 250 AND NOT gs[i - 1].p THEN ps[i - 1].e + gs[i - 1].g // 2 WHEN i > 1 AND gs[i - 1].g > 1200 THEN w.s - ((gs[i - 1].g - 900) - (gs[i - 1].g - 900) // 2) WHEN i = 1 THEN greatest(0, w.s) ELSE w.s END,
  'e': CASE WHEN i < n AND gs[i].g > 250 AND NOT gs[i].p THEN w.e + gs[i].g // 2 WHEN i < n AND gs[i].g > 1200 THEN w.e + (gs[i].g - 900) // 2 ELSE w.e END}) AS ps FROM gaps)""",
        f"""put AS (SELECT * EXCLUDE (ps), list_reduce(list_slice({nexts('ps', '0')}, 1, n - 1), lambda acc, x: {let(ordered, "{'o': list_append(acc.o, {'s': acc.cs, 'e': y.e}), 'cs': y.ns}")}, {{'o': []::STRUCT(s BIGINT, e BIGINT)[], 'cs': ps[1].s}}) AS acc, ps[n].e AS le FROM three),
four AS (SELECT reciter_id, surah, ayah, list_append(acc.o, {{'s': acc.cs, 'e': {let("greatest(acc.cs + 1, least(d, le))", "CASE WHEN d - y > 0 AND d - y < 800 THEN d ELSE y END")}}}) AS ps FROM put)""",
    )


ORACLES: dict[str, str] = {
    "word_duration": words("SELECT reciter_id, surah, ayah, idx, dur FROM words"),
    "verse_stats": words(stats("reciter_id, surah, ayah", ("verse_mean", "verse_median"), 1)),
    "chapter_stats": words(stats("reciter_id, surah", ("chapter_mean", "chapter_median"), 8)),
    "reciter_median": words("SELECT reciter_id, CASE WHEN count(dur) >= 8 THEN median(dur) END AS reciter_median, count(dur) AS n FROM words GROUP BY reciter_id"),
    # Groups are large here: of each, the values at the ranks that may be in the middle of the others, instead of a median for each row.
    "loo_median": words("""SELECT w.reciter_id, w.surah, w.ayah, w.idx, ((CASE WHEN w.n // 2 >= w.rn THEN g.b ELSE g.a END) + (CASE WHEN (w.n + 1) // 2 >= w.rn THEN g.d ELSE g.c END)) / 2.0 AS loo, w.n - 1 AS loo_others
  FROM ranked w JOIN middles g USING (reciter_id, letters)
UNION ALL SELECT reciter_id, surah, ayah, idx, NULL, NULL FROM words WHERE dur IS NULL""",
        "ranked AS (SELECT reciter_id, surah, ayah, idx, dur, length(text) AS letters, row_number() OVER (PARTITION BY reciter_id, length(text) ORDER BY dur, ayah, idx) AS rn, count(*) OVER (PARTITION BY reciter_id, length(text)) AS n FROM words WHERE dur IS NOT NULL)",
        "middles AS (SELECT reciter_id, letters, max(dur) FILTER (rn = n // 2) AS a, max(dur) FILTER (rn = n // 2 + 1) AS b, max(dur) FILTER (rn = (n + 1) // 2) AS c, max(dur) FILTER (rn = (n + 1) // 2 + 1) AS d FROM ranked GROUP BY ALL)"),
    "word_baseline": words("SELECT reciter_id, surah, ayah, idx, word_base, CASE WHEN dur IS NOT NULL THEN word_others END AS word_base_others FROM loo_word", KEYED, LOO_WORD),
    "verse_baseline": words("SELECT reciter_id, surah, ayah, idx, verse_base, CASE WHEN dur IS NOT NULL THEN verse_others END AS verse_base_others FROM loo_both", KEYED, LOO_BOTH),
    "resolve_baseline": words("SELECT reciter_id, surah, ayah, idx, baseline_ms, baseline_source, baseline_n FROM sourced", KEYED, LOO_BOTH, BASED),
    "duration_ratio": words(f"SELECT reciter_id, surah, ayah, idx, {RATIO} AS ratio FROM sourced", KEYED, VERSE_ONLY),
    "attach_analysis": analysed("sourced", VERSE_ONLY),
    "enrich": analysed("sourced", LOO_BOTH + ",\n" + BASED),
    "extension_level": words(f"SELECT reciter_id, surah, ayah, idx, ratio, {LEVEL} AS level FROM (SELECT *, idx % 3 = 0 AS drawn, {RATIO} AS ratio FROM sourced)", KEYED, VERSE_ONLY),
    "extension_confidence": words(f"SELECT reciter_id, surah, ayah, idx, {CONFIDENCE} AS confidence FROM (SELECT * EXCLUDE (score, baseline_source, baseline_n), idx % 3 = 0 AS drawn, {RATIO} AS ratio, CASE WHEN idx % 7 <> 3 THEN score END AS score, ['word', 'verse', 'surah', 'reciter', 'other'][idx % 5 + 1] AS baseline_source, verse_others % 10 AS baseline_n FROM sourced)".replace("CASE WHEN drawn AND ratio IS NOT NULL", "CASE WHEN drawn AND ratio IS NOT NULL AND score IS NOT NULL"), KEYED, VERSE_ONLY),
    "timing_config": words(f"SELECT reciter_id, surah, ayah, idx, ratio, CASE WHEN NOT drawn THEN NULL WHEN ratio < 1.1 THEN 'normal' WHEN ratio < 1.5 THEN 'slightlyExtended' WHEN ratio < 2.5 THEN 'extended' WHEN ratio >= 2.5 THEN 'highlyExtended' END AS level FROM (SELECT *, idx % 3 = 0 AS drawn, CASE WHEN verse_others >= 5 THEN {RATIO} END AS ratio FROM sourced)", KEYED, VERSE_ONLY),
    "strategy_catalog": "WITH c AS (SELECT * FROM (VALUES ('fast', 4, 28.0::DOUBLE), ('balanced', 5, 32.0), ('max', 5, NULL)) m(mode, n, threshold), (VALUES {}) s(rank, strategy) WHERE rank <= n) SELECT doc_id, c.mode, c.rank, c.strategy, c.threshold FROM documents d JOIN c ON c.mode = ['fast', 'balanced', 'max'][d.doc_id % 3 + 1]".format(", ".join(f"({i + 1}, '{x}')" for i, x in enumerate(STRATEGIES))),
    "best_window_gap": """WITH samples AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, event_id * 37 % 101 AS x FROM events),
curve AS (SELECT user_id, i AS k, sum(x) OVER (PARTITION BY user_id ORDER BY i) - x AS before FROM samples UNION ALL SELECT user_id, count(*), sum(x) FROM samples GROUP BY user_id),
gap AS (SELECT user_id, n, lo, hi, least(want, hi - lo) AS want FROM (SELECT user_id, n, greatest(0, l) AS lo, greatest(greatest(0, l) + 1, h) AS hi, want FROM (SELECT user_id, count(*) AS n, user_id * 7 % 90 - 20 AS l, user_id * 7 % 90 - 20 + user_id * 13 % 1200 AS h, 20 + user_id * 29 % 400 AS want FROM events GROUP BY user_id))),
spot AS (SELECT *, greatest(0, least(lo // 20, n - 1)) AS f, greatest(greatest(0, least(lo // 20, n - 1)) + 1, least(hi // 20, n)) AS g, greatest(1, want // 20) AS w FROM gap),
best AS (SELECT s.user_id, 20 * arg_max(a.k, (b.before - a.before, -a.k)) AS raw FROM spot s JOIN curve a ON a.user_id = s.user_id AND a.k BETWEEN s.f AND s.g - s.w JOIN curve b ON b.user_id = s.user_id AND b.k = a.k + s.w WHERE s.want >= 40 AND s.g - s.f > s.w GROUP BY s.user_id),
put AS (SELECT s.*, CASE WHEN raw + want > hi THEN hi - want ELSE raw END AS p FROM spot s LEFT JOIN best b USING (user_id))
SELECT user_id, CAST(CASE WHEN p IS NULL THEN lo ELSE greatest(lo, p) END AS INT) AS start_ms, CAST(CASE WHEN want < 40 THEN greatest(lo + 1, (lo + hi) // 2) WHEN p IS NULL THEN lo + want ELSE least(hi, greatest(greatest(lo, p) + 1, p + want)) END AS INT) AS end_ms FROM put""",
    "chapter_timeline": "SELECT lang AS reciter_id, source AS surah, doc_id AS ayah, CAST(sum(n_chars) OVER w - n_chars AS BIGINT) AS start_ms, CAST(sum(n_chars) OVER w AS BIGINT) AS end_ms FROM documents WINDOW w AS (PARTITION BY lang, source ORDER BY doc_id)",
    "tokenize_words": f"SELECT doc_id, idx, word FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS idx FROM (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, '|', '{T.HIZB}'), '[ \\t\\n\\r\\f\\x0B]+'), lambda w: w <> '' AND NOT contains(w, '{T.HIZB}')) AS ws FROM documents))",
    "count_words": f"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(translate(text, '|', '{T.HIZB}'), '[ \\t\\n\\r\\f\\x0B]+'), lambda w: w <> '' AND NOT contains(w, '{T.HIZB}'))) AS INT) AS n_words FROM documents",
    "normalize_text": words(r"SELECT t AS text, CASE WHEN n = '' THEN chr(1575) ELSE n END AS normalized FROM (SELECT t, trim(translate(regexp_replace(regexp_replace(nfc_normalize(t), '\p{Cf}', '', 'g'), '[\x{06D6}-\x{06ED}\x{064B}-\x{065F}\x{0670}\x{0640}]', '', 'g'), '" + T.LETTER_FORMS[0] + "', '" + T.LETTER_FORMS[1] + "')) AS n FROM (SELECT DISTINCT script AS t FROM words))"),
    "join_normalized": words(r"SELECT reciter_id, surah, ayah, md5(string_agg(CASE WHEN plain = '' THEN chr(1575) ELSE plain END, ' ' ORDER BY idx)) AS joined FROM (SELECT *, trim(translate(regexp_replace(nfc_normalize(script), '[\x{06D6}-\x{06ED}\x{064B}-\x{065F}\x{0670}\x{0640}]', '', 'g'), '" + T.LETTER_FORMS[0] + "', '" + T.LETTER_FORMS[1] + "')) AS plain FROM words) GROUP BY ALL"),
    "letter_count": words(f"SELECT DISTINCT text, CAST({LETTERS} AS INT) AS letters FROM (SELECT script AS text FROM words UNION SELECT text FROM words)"),
    "target_min_ms": words(f"SELECT DISTINCT text, CAST({NEED} AS INT) AS need_ms FROM (SELECT script AS text FROM words UNION SELECT text FROM words)"),
    "has_waqf": words(f"SELECT DISTINCT text, {PAUSE} AS waqf FROM (SELECT script AS text FROM words)"),
    "baseline_key": words("SELECT DISTINCT script AS text, word_key FROM keyed", KEYED),
    "clusterize": words("SELECT t AS text, i AS cluster, kind, base, c, marks, joining FROM clusters", CLUSTERS),
    "joining_type": words("SELECT base, joining, count(*) AS n FROM clusters GROUP BY ALL", CLUSTERS),
    "madd_candidates": words("SELECT t AS text, i AS cluster, type, reason FROM candidates", CLUSTERS, CANDIDATES),
    "safe_boundaries": words("SELECT t AS text, i AS boundary FROM pairs", CLUSTERS, PAIRS),
    "stretch_positions": words("SELECT t AS text, i AS after_cluster, priority, 4 AS most, row_number() OVER (PARTITION BY t ORDER BY priority, i) AS place FROM stretch", CLUSTERS, CANDIDATES, STRETCH),
    "insert_tatweel": words(f"SELECT t AS text, CASE WHEN len(cs) > 2 THEN array_to_string(cs[1:2], '') || repeat('{T.TATWEEL}', 3) || array_to_string(cs[3:], '') END AS stretched FROM split_", CLUSTERS),
    "clip_duration": "SELECT event_id, CAST(round_even(value * 1000 // 1 / 16000.0 * 1000, 0) AS INT) AS duration_ms FROM events",
    "raw_to_ms": words(
        """SELECT reciter_id, surah, ayah, idx, s AS start_ms, CASE WHEN e > nxt THEN greatest(m, s + 1) ELSE e END AS end_ms FROM (SELECT *, (e + nxt) // 2 AS m, CASE WHEN prv > r THEN (prv + r) // 2 ELSE r END AS s FROM
 (SELECT *, lead(r) OVER o AS nxt, lag(e) OVER o AS prv FROM (SELECT *, CASE WHEN duration_ms > 0 THEN least(greatest(r + 1, end_ms), duration_ms) ELSE greatest(r + 1, end_ms) END AS e FROM (SELECT *, greatest(0, start_ms) AS r FROM words WHERE ayah % 12 <> 5))
  WINDOW o AS (PARTITION BY reciter_id, surah, ayah ORDER BY idx)))"""),
    "refine_timings": _repair(False),
    "refine_timings_energy": _repair(True),
    "timing_quality": words("SELECT reciter_id, surah, ayah, round(quality, 6) AS quality FROM quality UNION ALL SELECT reciter_id, surah, ayah, -1e9 FROM docs_ WHERE len(ts) = 0", QUALITY),
    "rms_frames": "SELECT user_id, frame, round(CASE WHEN n = 8 THEN sqrt(m + 1e-12) ELSE 0.0 END, 6) AS rms FROM (SELECT user_id, CAST(i // 8 AS BIGINT) AS frame, count(*) AS n, avg(value::DOUBLE * value::DOUBLE) AS m FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events) GROUP BY ALL) WHERE n = 8 OR frame = 0",
    "best_window": "SELECT user_id, arg_max(frame, (energy, -frame)) AS frame, max(energy) AS energy FROM (SELECT user_id, frame, sum(rms) OVER w AS energy, count(*) OVER w AS n FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, CAST(event_id * 37 % 101 AS DOUBLE) AS rms FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) WHERE n = 5 GROUP BY user_id",
    "select_strategy": f"""WITH {_CANDIDATES},
stop AS (SELECT *, min(CASE WHEN quality >= 32 THEN rank END) OVER (PARTITION BY ayah) AS e FROM cands), seen AS (SELECT * FROM stop WHERE e IS NULL OR rank <= e)
SELECT reciter_id, surah, ayah, arg_max(strategy, (quality, -rank)) FILTER (quality IS NOT NULL) AS strategy, max(quality)::DOUBLE AS quality, CAST(max(rank) AS BIGINT) AS tried, max(e) IS NOT NULL AS early_exit,
  CASE WHEN max(quality) IS NULL THEN 'all_strategies_failed:' || string_agg('bad ' || strategy, ';' ORDER BY rank) END AS failure FROM seen GROUP BY reciter_id, surah, ayah""",
    "validate": words("SELECT reciter_id, surah, ayah, len(errors) = 0 AS ok, CAST(len(errors) AS INT) AS n_errors, array_to_string(errors, ';') AS errors FROM errors", VALIDATION),
    "validation_rules": words("SELECT regexp_extract(e, '^[a-z_]+', 0) AS rule, count(*) AS n FROM (SELECT unnest(errors) AS e FROM errors) GROUP BY ALL", VALIDATION),
    "explode_words": words("SELECT reciter_id, ayah, idx, text, start_ms, end_ms, score::DOUBLE AS score FROM words"),
    "read_alignments": words("SELECT reciter_id, ayah, count(*) AS n_words, min(start_ms) AS first_ms, max(end_ms) AS last_ms FROM words WHERE ayah % 50 NOT IN (7, 8) GROUP BY ALL"),
    "write_alignments": words("SELECT reciter_id, surah, count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_words FROM (SELECT reciter_id, surah, len(ts) AS n FROM docs_) GROUP BY ALL"),
    "parse_alignment_path": f"WITH {_PATH} SELECT doc_id, path, surah, ayah FROM parsed",
    "publish_tree": f"WITH {_PATH} SELECT lang AS reciter_id, surah, ayah, max(path) AS path FROM parsed WHERE surah IS NOT NULL GROUP BY ALL",
    "load_texts": "SELECT CAST(doc_id % 114 + 1 AS INT) AS surah, CAST(doc_id // 114 + 1 AS INT) AS ayah, lang || '-' || n_chars AS text FROM documents",
    "catalog": "SELECT lang AS reciter_id, count(*) AS n_documents FROM documents GROUP BY ALL",
    "build_packs": f"WITH {_PACKS} SELECT * FROM packs",
    "merge_manifest": f"WITH {_PACKS} SELECT lang, source, file, checksum, bytes FROM packs UNION ALL SELECT lang, source || '-new', NULL, 'old-' || source, NULL FROM packs",
    "verify_checksums": f"""WITH {_PACKS}, f AS (SELECT file, n_documents % 5 AS k FROM packs)
SELECT file, CASE k WHEN 1 THEN 'unlisted' WHEN 2 THEN 'unlisted' WHEN 3 THEN 'mismatch' ELSE 'ok' END AS status FROM f UNION ALL SELECT file || '-gone', 'missing' FROM f WHERE k = 1""",
    "reciter_dim": "SELECT doc_id, r.folder, r.bitrate_kbps FROM documents d JOIN (VALUES ('en', 'English_128', 128), ('de', 'German_64', 64), ('fr', 'French_64', 64), ('es', 'Spanish_128', 128)) r(lang, folder, bitrate_kbps) ON r.lang = d.lang",
    "unknown_reciters": "SELECT DISTINCT lang AS reciter_id FROM documents WHERE lang NOT IN ('en', 'de', 'fr')",
    "chapter_ranges": f"WITH {_SPECS} SELECT DISTINCT CAST(x AS INT) AS chapter FROM (SELECT unnest(generate_series(a, b)) AS x FROM specs UNION SELECT c FROM specs) WHERE x BETWEEN 1 AND 114",
    "work_list": f"WITH {_COUNTS} SELECT chapter, CAST(verse AS INT) AS verse, position FROM work",
    "shard_slice": f"WITH {_COUNTS} SELECT chapter, CAST(verse AS INT) AS verse, position FROM work WHERE position % 7 = 3",
    "select_items": f"WITH {_COUNTS} SELECT chapter, CAST(verse AS INT) AS verse FROM work WHERE (chapter, verse) IN (SELECT (doc_id % 20 + 1, doc_id % 9 + 1) FROM documents) ORDER BY position LIMIT 100",
    "audio_names": "SELECT doc_id, printf('%03d%03d', doc_id % 114 + 1, doc_id % 286 + 1) AS stem, printf('%03d%03d.mp3', doc_id % 114 + 1, doc_id % 286 + 1) AS audio_file, 'https://audio.example/' || lang || '/' || printf('%03d%03d.mp3', doc_id % 114 + 1, doc_id % 286 + 1) AS url, (doc_id % 114 + 1) || '/' || (doc_id % 286 + 1) || '.json' AS document FROM documents",
    "resume_pending": words("SELECT reciter_id, ayah, status FROM outputs WHERE status <> 'ok'", VALIDATION, _OUTPUTS),
    "resume_forced": words("SELECT reciter_id, ayah, status FROM outputs", VALIDATION, _OUTPUTS),
    "backfill_analysis": words(f"SELECT reciter_id, surah, ayah, idx, ayah % 3 = 0 AS was_flagged, true AS analysed, CASE WHEN ayah % 3 <> 0 THEN {RATIO} END AS ratio FROM sourced", KEYED, VERSE_ONLY),
    "placeholder_timings": words("SELECT reciter_id, surah, ayah, CAST(d AS INT) AS duration_ms, CAST(idx AS INT) AS idx, text, CAST(floor((idx - 1) * (d / n::DOUBLE)) AS INT) AS start_ms, greatest(CASE WHEN idx = n THEN d ELSE CAST(floor(idx * (d / n::DOUBLE)) AS INT) END, CAST(floor((idx - 1) * (d / n::DOUBLE)) AS INT) + 1) AS end_ms FROM (SELECT *, greatest(1500, 450 * n) AS d FROM words)"),
    "shard_summary": words("SELECT * FROM summary", VALIDATION, _RESULTS, _SUMMARY),
    "failure_rows": words("SELECT ayah, array_to_string(errors, ';') AS reason FROM results WHERE status = 'failed'", VALIDATION, _RESULTS),
    "failures_csv": words("SELECT reciter_id AS surah, CAST(ayah AS VARCHAR) AS ayah, md5(array_to_string(errors, ';')) AS reason FROM results WHERE status = 'failed'", VALIDATION, _RESULTS),
    "merge_reports": words("SELECT * FROM merged", VALIDATION, _RESULTS, _SUMMARY, _MERGED),
    "failure_gate": words("SELECT *, attempted > 0 AND fail_rate > 0.05 AS over_gate FROM merged", VALIDATION, _RESULTS, _SUMMARY, _MERGED),
}
ORACLES["enrich_words"] = ORACLES["enrich"]
