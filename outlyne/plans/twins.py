"""DuckDB text of the data flow on the test tables, for comparison."""

from __future__ import annotations

from ..model import BLEND, BLEND_TAGS, BURST_PHRASES, GENUINE, NOT_GENUINE, NOTHING, TEMPLATES, TRANSIENT
from .demo import CFG, EVENT_CFG, LEXICON, NAMES, SYNONYMS


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def case(dim: str, table: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {dim} " + " ".join(f"WHEN {q(d)} THEN {v}" for d, v in table.items()) + f" ELSE {other} END"


def draw(seed: str, salt: str, key: str | None = None) -> str:
    return f"('0x' || substr(md5(concat_ws('|', ({seed})::VARCHAR, '{salt}'" + (f", ({key})::VARCHAR" if key else "") + ")), 1, 8))::BIGINT"


def pick(options, n: str) -> str:
    return "([" + ", ".join(map(q, options)) + f"])[(({n}) % {len(options)} + 1)::INT]"


def one_decimal(x: str) -> str:
    return f"CAST(CAST(round(round({x}, 6), 1) AS DECIMAL(20,1)) AS VARCHAR)"


def spread(mad: str, sd: str) -> str:
    return f"(CASE WHEN 1.4826 * {mad} >= 0.5 * {sd} THEN 1.4826 * {mad} ELSE {sd} END)"


def stats(source: str, *keys: str, name: str = "stats") -> str:
    """CTEs that end in one of that name: statistics of source(keys, dim, value)."""
    by = ", ".join(["dim", *keys])
    on = " AND ".join(f"v.{k} = f.{k}" for k in ["dim", *keys])
    s = spread("mad", "sd")
    return f"""{name}_v AS (SELECT * FROM {source} WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)),
{name}_f AS (SELECT {by}, avg(value) AS m, stddev_pop(value) AS sd, quantile_cont(value, 0.5) AS md, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90, count(*) AS n FROM {name}_v GROUP BY {by}),
{name}_a AS (SELECT {", ".join("f." + k for k in ["dim", *keys])}, quantile_cont(abs(v.value - f.md), 0.5) AS mad FROM {name}_v v JOIN {name}_f f ON {on} GROUP BY {", ".join("f." + k for k in ["dim", *keys])}),
{name} AS (SELECT {by}, round(m, 4) AS mean, round(md, 4) AS median, round(sd, 4) AS std, round(mad, 4) AS mad,
  round(CASE WHEN {s} >= 1e-6 THEN {s} WHEN sd > 1e-6 THEN sd ELSE 1.0 END, 4) AS spread, round(p10, 4) AS p10, round(p90, 4) AS p90, n FROM {name}_f JOIN {name}_a USING ({by}))"""


_CELLS = [
    ("trait", "QTY", 0, "q"), ("trait", "PRICE", 1, "round(p, 6)"), ("trait", "DISC", 2, "round(d, 9)"), ("trait", "TAX", 3, "round(t, 9)"), ("trait", "AGEV", 4, "s_nationkey * 0.24::DOUBLE"),
    ("trait", "GEND", 5, "(k % 25) * 0.24::DOUBLE"), ("trait", "REGS", 6, "((k * 7) % 25) * 0.24::DOUBLE"), ("trait", "TEMP", 7, "ln"), ("emotion", "RETURN", 0, "r"), ("emotion", "ACCEPT", 1, "a"), ("emotion", "OPEN", 2, "o"),
    ("quality", "genuineness", 0, "(s_acctbal + 1000.0::DOUBLE) / 1833.0::DOUBLE"), ("quality", "blend", 1, "round(t * 125, 7)"),
]

SCORES = """base AS (SELECT l_suppkey AS k, any_value(s_nationkey) AS s_nationkey, any_value(s_acctbal) AS s_acctbal, avg(l_quantity) AS q, avg(l_extendedprice) AS p, avg(l_discount) AS d, avg(l_tax) AS t, avg(l_linenumber) AS ln,
  avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS r, avg(CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a, avg(CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS o
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey),
scores AS (""" + " UNION ALL ".join(f"SELECT k AS entity_id, '{g}' AS grp, '{d}' AS dim, {i} AS dim_ix, ({e})::DOUBLE AS value FROM base" for g, d, i, e in _CELLS) + ")"
EXPERTS = "experts AS (SELECT s_suppkey AS entity_id, CASE WHEN s_suppkey % 10 <> 0 THEN ((s_suppkey % 9) - 4) / 4.0 END AS expert FROM supplier)"
_USED = "CASE WHEN b.spread > 1e-6 THEN b.spread WHEN " + spread("b.mad", "b.std") + " > 1e-6 THEN " + spread("b.mad", "b.std") + " ELSE 1.0 END"
_NAME = case("b.dim", {d: q(n) for d, n in NAMES.items()}, "b.dim")
_SYN = case("b.dim", {d: "[" + ", ".join(map(q, w)) + "]" for d, w in SYNONYMS.items()}, "CAST([] AS VARCHAR[])")
Z = f"{SCORES},\n{stats('scores', 'grp')},\nz AS (SELECT s.*, b.median, {_NAME} AS name, {_SYN} AS synonyms, (s.value - b.median) / (({_USED}) + 1e-6) AS z FROM scores s JOIN stats b ON s.grp = b.grp AND s.dim = b.dim)"
TIER = "CASE WHEN abs(z) >= 2.0 THEN 'Extremely' WHEN abs(z) >= 1.5 THEN 'Very' WHEN abs(z) >= 1.0 THEN 'Notably' ELSE 'Somewhat' END"
CAPPED = "CASE WHEN abs(z) >= 2.0 AND gate <> 'capped' THEN 'Extremely' WHEN abs(z) >= 1.5 AND gate <> 'capped' THEN 'Very' WHEN abs(z) >= 1.0 THEN 'Notably' ELSE 'Somewhat' END"
SHORT = {"Extremely": "'very'", "Very": "'very'", "Notably": "''", "Somewhat": "'slightly'"}
_BAND = {d: "CASE " + " ".join(f"WHEN value < {b} THEN {q(w)}" for b, w in v) + " END" for d, v in LEXICON.bands.items()}
_BTAG = {d: "CASE " + " ".join(f"WHEN value < {b} THEN {q(w)}" for (b, _), w in zip(LEXICON.bands[d], v)) + " END" for d, v in LEXICON.band_tags.items()}
BANDED = "dim IN (" + ", ".join(map(q, sorted(LEXICON.bands))) + ")"


def _at(i: int) -> str:
    return case("dim", {d: q(v[i]) for d, v in LEXICON.dims.items()})


WORD, TAG = f"CASE WHEN z >= 0 THEN {_at(0)} ELSE {_at(1)} END", f"CASE WHEN z >= 0 THEN {_at(2)} ELSE {_at(3)} END"
DIM_WORDS = f"""CASE WHEN z >= 0 THEN 'above' ELSE 'below' END AS direction,
  CASE WHEN {BANDED} THEN 'Absolute' WHEN abs(z) < 0.5 THEN 'About-average' ELSE {TIER} END AS intensity,
  CASE WHEN {BANDED} THEN {case('dim', _BAND)} WHEN abs(z) < 0.5 THEN coalesce({case('dim', {d: q(v) for d, v in LEXICON.neutral.items()})}, 'average in ' || lower(dim)) ELSE lower({TIER}) || ' ' || {WORD} END AS phrase,
  CASE WHEN {BANDED} THEN {case('dim', _BTAG)} WHEN abs(z) < 0.5 THEN NULL ELSE trim({case(TIER, SHORT)} || ' ' || {TAG}) END AS tag"""
GATE = "CASE WHEN value >= median THEN 'open' WHEN z > -1.0 THEN 'capped' ELSE 'dropped' END"
GENUINE_PHRASE = f"CASE WHEN z >= 0.5 THEN {q(GENUINE[0][1])} WHEN z >= 0 THEN {q(GENUINE[1][1])} WHEN z > -1.0 THEN {q(GENUINE[2][1])} ELSE {q(NOT_GENUINE)} END"
GENUINE_TAG = "CASE WHEN z >= 0 THEN 'genuine' WHEN z > -1.0 THEN 'semi-genuine' ELSE 'performed' END"
ALWAYS = CFG.always_on


def selection(k: int, always=ALWAYS, gated: bool = False) -> str:
    """CTE sel: chosen dims with rk, always_on, pos."""
    known = "dim IN (" + ", ".join(map(q, sorted({*LEXICON.dims, *LEXICON.bands}))) + ")"
    src = "z" if not gated else "(SELECT z.* FROM z LEFT JOIN experts e USING (entity_id) WHERE NOT coalesce(e.expert IS NOT NULL AND abs(e.expert) < 0.5 AND z.dim = 'GEND', false))"
    flag = "dim IN (" + ", ".join(map(q, always)) + ")" if always else "false"
    place = case("dim", {d: str(i + 1) for i, d in enumerate(always)}, "0") if always else "0"
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY abs(z) DESC, dim_ix) AS rk, {flag} AS always_on FROM {src} WHERE grp = 'trait' AND {known}),
sel AS (SELECT *, CASE WHEN rk <= {k} THEN rk ELSE {k} + {place} END AS pos FROM ranked WHERE rk <= {k} OR always_on)"""


def emotions(k: int, seed: str = "0") -> str:
    """CTE emo: described emotions."""
    syn = draw(seed, "synonym", "dim")
    word = f"CASE WHEN len(synonyms) > 0 THEN synonyms[({syn} % greatest(len(synonyms), 1) + 1)::INT] ELSE lower(dim) END"
    return f"""gates AS (SELECT entity_id, {GATE} AS gate FROM z WHERE grp = 'quality' AND dim = 'genuineness'),
emo_r AS (SELECT z.*, coalesce(gate, 'open') AS gate, row_number() OVER (PARTITION BY entity_id ORDER BY abs(z) DESC, dim_ix) AS pos FROM z LEFT JOIN gates USING (entity_id) WHERE grp = 'emotion' AND coalesce(gate, 'open') <> 'dropped'),
emo_w AS (SELECT *, {word} AS synonym, {CAPPED} AS intensity FROM emo_r WHERE pos <= {k} AND abs(z) >= 0.5),
emo AS (SELECT *, CASE WHEN z >= 0 THEN 'above' ELSE 'below' END AS direction, CASE WHEN z >= 0 THEN lower(intensity) || ' carrying ' || synonym ELSE 'notably free of ' || synonym END AS phrase,
  CASE WHEN z >= 0 THEN trim({case('intensity', SHORT)} || ' ' || synonym) ELSE 'no ' || synonym END AS tag FROM emo_w)"""


QUALITY = f"""qual AS (SELECT *, CASE dim WHEN 'genuineness' THEN 1 ELSE 2 END AS pos, CASE dim WHEN 'genuineness' THEN {GENUINE_PHRASE} ELSE CASE WHEN z >= 0.5 THEN {q(BLEND[0])} WHEN z <= -0.5 THEN {q(BLEND[1])} END END AS phrase,
  CASE dim WHEN 'genuineness' THEN {GENUINE_TAG} ELSE CASE WHEN z >= 0.5 THEN {q(BLEND_TAGS[0])} WHEN z <= -0.5 THEN {q(BLEND_TAGS[1])} END END AS tag
  FROM z WHERE grp = 'quality' AND (dim = 'genuineness' OR abs(z) >= 0.5))"""


def _shuffled(cte: str, salt: str, seed: str, movable: str) -> str:
    return f"""{cte}_s AS (SELECT entity_id, pos AS slot, row_number() OVER (PARTITION BY entity_id ORDER BY pos) AS i FROM {cte} WHERE {movable}),
{cte}_d AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY {draw(seed, salt, 'dim')}, dim) AS i FROM {cte} WHERE {movable}),
{cte}_x AS (SELECT {cte}_d.* EXCLUDE (pos, i), slot AS pos FROM {cte}_d JOIN {cte}_s USING (entity_id, i) UNION ALL BY NAME SELECT * FROM {cte} WHERE NOT ({movable}))"""


def detail(k: int = 5, ke: int = 3, always=ALWAYS, gated: bool = False, seed: str = "0", shuffle: bool = False) -> str:
    """CTEs that end in detail."""
    cols = "entity_id, {ix} AS part_ix, '{part}' AS part, pos::INT AS pos, dim, name, round(value, 3) AS value, round(z, 2) AS z, {d} AS direction, {i} AS intensity, {a} AS always_on, phrase, tag"
    s, e = ("words_x", "emo_x") if shuffle else ("words", "emo")
    parts = [Z, *([EXPERTS] if gated else []), selection(k, always, gated), f"words AS (SELECT *, {DIM_WORDS} FROM sel)", emotions(ke, seed), QUALITY]
    if shuffle:
        parts += [_shuffled("words", "dims", seed, "NOT always_on"), _shuffled("emo", "emotions", seed, "true")]
    parts.append(f"""detail AS (SELECT {cols.format(ix=1, part='dims', d='direction', i='intensity', a='always_on')} FROM {s} UNION ALL SELECT {cols.format(ix=2, part='emotions', d='direction', i='intensity', a='false')} FROM {e}
UNION ALL SELECT {cols.format(ix=3, part='quality', d='NULL', i='NULL', a='false')} FROM qual)""")
    return "WITH " + ",\n".join(parts)


def _agg(col: str, sep: str, keep: str, order: str = "part_ix, pos") -> str:
    return f"string_agg({col}, {q(sep)} ORDER BY {order}) FILTER (WHERE {keep} AND {col} IS NOT NULL)"


_IDENT, _TIMBRE, _EMO, _Q = "part = 'dims' AND always_on", "part = 'dims' AND NOT always_on", "part = 'emotions'", "part = 'quality'"
GROUPS = "g AS (SELECT entity_id, " + ", ".join([
    f"{_agg('phrase', '; ', 'true')} AS all_semi", f"{_agg('phrase', ', ', 'true')} AS all_comma",
    f"{_agg('phrase', ', ', _IDENT)} AS ident", f"{_agg('phrase', '; ', _TIMBRE)} AS timbre", f"{_agg('phrase', ', ', _TIMBRE)} AS timbre_c", f"{_agg('phrase', ', ', _EMO)} AS emo",
    f"{_agg('phrase', '; ', _Q)} AS q", f"{_agg('phrase', ', ', _Q)} AS q_c", f"{_agg('phrase', '; ', 'part = ' + q('dims'), 'always_on, pos')} AS body", f"{_agg('phrase', '; ', 'part <> ' + q('dims'))} AS conveys",
    *(f"max(phrase) FILTER (WHERE {_IDENT} AND dim = '{d}') AS {d.lower()}" for d in ("AGEV", "GEND", "REGS", "TEMP")), f"{_agg('tag', ', ', 'true')} AS tags",
    "string_agg(CASE WHEN n = 1 THEN phrase ELSE ([', with ', ' and ', ', carrying ', ', '])[((n - 2) % 4 + 1)::INT] || phrase END, '' ORDER BY n) AS linked",
]) + " FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY part_ix, pos) AS n FROM detail) GROUP BY entity_id)"


def _cap(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || substr({x}, 2)"


_LEAD = "nullif(concat_ws(' ', agev, gend), '')"
_TAIL = "nullif(concat_ws(', ', regs, temp), '')"
TEXTS = {
    "default": "'A voice that is ' || all_semi || '.'",
    "identity_first": f"concat_ws(' ', {_cap('ident')} || '.', 'It sounds ' || timbre || '.', 'Emotionally, it is ' || emo || '.', {_cap('q')} || '.')",
    "emotion_first": f"concat_ws(' ', coalesce('Emotionally ' || emo || '.', 'Emotionally even and unmarked.'), 'The voice itself is ' || body || '.', {_cap('q')} || '.')",
    "telegraphic": f"{_cap('all_comma')} || '.'",
    "two_sentence": "concat_ws(' ', 'How it sounds: ' || body || '.', coalesce('What it conveys: ' || conveys || '.', 'What it conveys: little overt emotion.'))",
    "sounds_like": f"concat_ws(' ', coalesce('Sounds like a ' || {_LEAD} || ' voice', 'Sounds like a voice') || coalesce(', ' || {_TAIL}, '') || '.', 'It is ' || timbre || '.', 'Emotionally, ' || emo || '.', {_cap('q')} || '.')",
    "bulleted": "concat_ws(' · ', 'Identity: ' || ident, 'Timbre: ' || timbre, 'Emotion: ' || emo, 'Delivery: ' || q) || '.'",
    "varied_connectors": "'A voice that is ' || linked || '.'",
    "quality_led": f"concat_ws(' ', coalesce({_cap('q')} || '.', 'Natural, unforced in delivery.'), 'The voice is ' || body || '.', 'Emotionally, ' || emo || '.')",
    "minimal_identity": f"concat_ws(' ', coalesce('A ' || {_LEAD} || ' voice', 'A voice') || coalesce(' ' || emo, '') || '.', 'Also ' || nullif(concat_ws(', ', {_TAIL}, timbre_c, q_c), '') || '.')",
    "tags": "coalesce(tags, 'unremarkable')",
}


def render(template: str, prefix: str | None = None) -> str:
    return f"{prefix or detail()},\n{GROUPS}\nSELECT entity_id, {q(template)} AS template, CASE WHEN all_semi IS NULL THEN {q(NOTHING)} ELSE {TEXTS[template]} END AS text FROM g"


def any_template(name: str) -> str:
    return "CASE " + name + " " + " ".join(f"WHEN {q(t)} THEN {x}" for t, x in TEXTS.items()) + " END"


# ---- time series ----
HOURS = "round(date_diff('microsecond', TIMESTAMP '2024-01-01', ts) / 3.6e9, 2)"
WORDS = f"words AS (SELECT user_id AS clip, (row_number() OVER (PARTITION BY user_id ORDER BY {HOURS}, event_id) - 1)::INT AS ix, event_type || event_id AS w, {HOURS} AS start, round({HOURS} + floor(value) * 0.1, 2) AS \"end\" FROM events WHERE event_type IN ('view', 'click'))"
BURSTS = f"bursts AS (SELECT user_id AS clip, event_id AS b_ix, {HOURS} AS start, round({HOURS} + floor(value) * 0.2, 2) AS \"end\", 'E' || (event_id % 7) AS label FROM events WHERE event_type = 'error')"
SENTENCES = """sent AS (SELECT clip, ix // 5 AS ix, string_agg(w, ' ' ORDER BY ix) || '.' AS text, CASE WHEN (clip + ix // 5) % 7 <> 0 THEN min(start) END AS start, CASE WHEN (clip + ix // 5) % 7 <> 0 THEN max("end") END AS "end" FROM words GROUP BY clip, ix // 5)"""
FRAMES = "frames AS (SELECT user_id AS clip, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS frame_ix, value AS p, event_type FROM events)"
ISLANDS = f"""hot AS (SELECT *, frame_ix - row_number() OVER (PARTITION BY clip ORDER BY frame_ix) AS run FROM frames WHERE p >= {EVENT_CFG.locator_threshold}),
spans AS (SELECT clip, min(frame_ix)::DOUBLE AS start, (max(frame_ix) + 1)::DOUBLE AS "end", count(*) AS n_frames, max(p) AS peak FROM hot GROUP BY clip, run HAVING count(*) >= {EVENT_CFG.min_frames})"""
_SL = EVENT_CFG.slack
PLACED = f"""near AS (SELECT b.clip, b.b_ix, s.ix AS s_ix, (s.start - {_SL} <= (b.start + b."end") / 2 AND (b.start + b."end") / 2 <= s."end" + {_SL}) AS inside,
  least(abs((b.start + b."end") / 2 - s.start), abs((b.start + b."end") / 2 - s."end")) AS away FROM bursts b JOIN sent s ON s.clip = b.clip AND s.start IS NOT NULL AND s."end" IS NOT NULL),
best AS (SELECT clip, b_ix, s_ix FROM (SELECT *, row_number() OVER (PARTITION BY clip, b_ix ORDER BY inside DESC, CASE WHEN inside THEN s_ix ELSE away END, s_ix) AS o FROM near) WHERE o = 1),
placed AS (SELECT b.*, coalesce(best.s_ix, 0) AS s_ix FROM bursts b LEFT JOIN best USING (clip, b_ix))"""
CONTAINED = """inner_w AS (SELECT w.*, s.ix AS s_ix FROM words w JOIN sent s ON s.clip = w.clip AND s.start - 1e-6 <= w.start AND w.start <= s."end" + 1e-6)"""


def slots(words: str, bursts: str, keys: str, name: str = "slots") -> str:
    on = " AND ".join(f"w.{k} = b.{k}" for k in keys.split(", "))
    non = " AND ".join(f"n.{k} = b.{k}" for k in keys.split(", "))
    return f"""{name}_w AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ix) - 1 AS wi FROM {words}),
{name}_n AS (SELECT {keys}, count(*) AS n FROM {words} GROUP BY {keys}),
{name} AS (SELECT b.*, max(coalesce(raw, n.n, 0)) OVER (PARTITION BY {", ".join("b." + k for k in keys.split(", "))} ORDER BY b.start, b.b_ix) AS slot, row_number() OVER (PARTITION BY {", ".join("b." + k for k in keys.split(", "))} ORDER BY b.start, b.b_ix) AS bo
  FROM (SELECT b.*, (SELECT min(w.wi) FROM {name}_w w WHERE {on} AND w.start >= (b.start + b."end") / 2) AS raw FROM {bursts} b) b LEFT JOIN {name}_n n ON {non})"""


def inline(keys: str, name: str = "slots") -> str:
    """CTE text: needs the CTEs of slots()."""
    ks = keys.split(", ")
    same = " AND ".join(f"t.{k} = p.{k}" for k in ks)
    return f"""gaps AS (SELECT *, start - lag(coalesce("end", start)) OVER (PARTITION BY {keys} ORDER BY wi) AS gap FROM {name}_w),
tok AS (SELECT {keys}, slot, 0 AS kind, bo AS o, '(' || label || ')' AS tok FROM {name} UNION ALL SELECT {keys}, wi, 2, 0, w FROM {name}_w
  UNION ALL SELECT {keys}, wi, 1, 0, '[pause ' || {one_decimal('gap')} || 's]' FROM gaps p WHERE gap >= {EVENT_CFG.pause} AND NOT EXISTS (SELECT 1 FROM {name} t WHERE {same} AND t.slot = p.wi)),
inl AS (SELECT {keys}, string_agg(tok, ' ' ORDER BY slot, kind, o) AS text FROM tok GROUP BY {keys})"""


SCRIPT = f"""{WORDS},\n{SENTENCES},\n{BURSTS},\n{PLACED},\n{CONTAINED},
own AS (SELECT clip, s_ix, string_agg('(' || label || ')', ' ' ORDER BY start, b_ix) AS labels, list(label ORDER BY start, b_ix) AS bursts FROM placed GROUP BY clip, s_ix),
both_w AS (SELECT i.* FROM inner_w i WHERE EXISTS (SELECT 1 FROM own o WHERE o.clip = i.clip AND o.s_ix = i.s_ix)),
both_b AS (SELECT p.* FROM placed p WHERE EXISTS (SELECT 1 FROM inner_w i WHERE i.clip = p.clip AND i.s_ix = p.s_ix)),
{slots('both_w', 'both_b', 'clip, s_ix')},\n{inline('clip, s_ix')},
sgap AS (SELECT *, start - last_value("end" IGNORE NULLS) OVER (PARTITION BY clip ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM sent),
lines AS (SELECT s.clip, s.ix, CASE WHEN s.gap >= {EVENT_CFG.pause} THEN '[pause ' || {one_decimal('s.gap')} || 's] ' ELSE '' END || CASE WHEN o.labels IS NULL THEN s.text ELSE coalesce(i.text, rtrim(s.text, '.') || ' ' || o.labels) END AS text, coalesce(array_to_string(o.bursts, ','), '') AS bursts
  FROM sgap s LEFT JOIN own o ON o.clip = s.clip AND o.s_ix = s.ix LEFT JOIN inl i ON i.clip = s.clip AND i.s_ix = s.ix
  UNION ALL SELECT o.clip, o.s_ix, o.labels, array_to_string(o.bursts, ',') FROM own o WHERE NOT EXISTS (SELECT 1 FROM sent s WHERE s.clip = o.clip))"""
TEMPLATE_LIST = TEMPLATES
PHRASES = BURST_PHRASES
TRANSIENT_LIST = ", ".join(map(q, TRANSIENT))
