"""Queries of the model names and of the linkage, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import linkage, models
from lotwise.views import table

# Makes of the parts, the models that are known of them, and texts that mean one of them more or less.
_MAKE = "CASE p_brand WHEN 'Brand#1' THEN 'Bmw' WHEN 'Brand#2' THEN 'Mercedes' WHEN 'Brand#3' THEN 'MINI' WHEN 'Brand#4' THEN 'Mazda' ELSE p_brand END"


def _sql(expression: str, text: str) -> str:
    """The same expression in either dialect; ``text`` is the name of its text type."""
    return expression.replace("TEXT", text)


_MODEL = """CASE p_brand
    WHEN 'Brand#1' THEN CASE p_partkey % 3 WHEN 0 THEN concat('Serie ', CAST(p_size % 8 + 1 AS TEXT)) WHEN 1 THEN concat('X', CAST(p_size % 7 + 1 AS TEXT)) ELSE concat('Serie ', CAST(p_size % 8 + 1 AS TEXT), ' ', p_name) END
    WHEN 'Brand#2' THEN CASE p_partkey % 4 WHEN 0 THEN concat('Clase ', substr('ABCES', CAST(p_size % 5 + 1 AS INT), 1)) WHEN 1 THEN 'GLC' WHEN 2 THEN 'GLC Coupe' ELSE concat('Clase ', substr('ABCES', CAST(p_size % 5 + 1 AS INT), 1), ' Coupe') END
    WHEN 'Brand#3' THEN CASE p_partkey % 4 WHEN 0 THEN 'Countryman' WHEN 1 THEN 'Mini Electric' WHEN 2 THEN concat('Clubman ', p_name) ELSE 'Cooper' END
    WHEN 'Brand#4' THEN CASE p_partkey % 3 WHEN 0 THEN concat('CX-', CAST(p_size % 10 AS TEXT)) WHEN 1 THEN substr('2356', CAST(p_size % 4 + 1 AS INT), 1) ELSE p_name END
    ELSE CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name, ' ', CAST(p_size % 10 AS TEXT)) ELSE concat(p_type, ' ', p_name) END END"""
_TEXT = """CASE p_brand
    WHEN 'Brand#1' THEN CASE p_partkey % 5 WHEN 0 THEN concat(CAST(p_size % 8 + 1 AS TEXT), '20d xDrive ', p_name) WHEN 1 THEN concat(p_name, ' X ', CAST(p_size % 9 AS TEXT)) WHEN 2 THEN concat('iX ', p_name) WHEN 3 THEN concat('serie ', CAST(p_size % 9 AS TEXT), ' ', p_name) ELSE p_name END
    WHEN 'Brand#2' THEN CASE p_partkey % 5 WHEN 0 THEN concat(substr('ABCES', CAST(p_size % 5 + 1 AS INT), 1), ' ', CAST(p_size + 150 AS TEXT), ' Coupe') WHEN 1 THEN concat('GLC ', p_name) WHEN 2 THEN concat('GLC 300 coupe ', p_name) WHEN 3 THEN concat('clase ', substr('ABCES', CAST(p_size % 5 + 1 AS INT), 1), ' ', p_name) ELSE p_name END
    WHEN 'Brand#3' THEN CASE p_partkey % 5 WHEN 0 THEN concat('Countyman ', p_name) WHEN 1 THEN concat('cooper SE ', p_name) WHEN 2 THEN concat('clubman ', p_name, ' sport') WHEN 3 THEN concat('mini cooper ', CAST(p_size AS TEXT)) ELSE p_name END
    WHEN 'Brand#4' THEN CASE p_partkey % 4 WHEN 0 THEN concat('cx ', CAST(p_size % 12 AS TEXT), ' ', p_name) WHEN 1 THEN concat('Mazda', CAST(p_size % 7 AS TEXT), ' diesel') WHEN 2 THEN concat('mazda ', p_name) ELSE concat(p_name, ' mx-5') END
    ELSE CASE p_partkey % 6 WHEN 0 THEN concat(p_type, ' ', p_name, ' ', CAST(p_size AS TEXT), 'kW') WHEN 1 THEN p_name WHEN 2 THEN concat(substr(p_name, 1, 4), ' ', CAST(p_size AS TEXT)) WHEN 3 THEN concat(p_name, 's hybrid') WHEN 4 THEN concat(substr(p_name, 3, 20), ' ', p_type) ELSE concat('zz ', CAST(p_size AS TEXT)) END END"""

_FUSION_SQL = rf"""
    WITH raw AS (SELECT p_partkey, replace(upper({_MAKE}), 'MERCEDES', 'MERCEDES BENZ') AS b, upper({_sql(_MODEL, 'VARCHAR')}) AS cand, upper({_sql(_TEXT, 'VARCHAR')}) AS u FROM part),
    noise AS (SELECT ['4X4','AWD','FWD','RWD','XDRIVE','QUATTRO','4MATIC','AUTOMATIC','AUTO','BVA','EAT','MANUAL','HYBRID','PHEV','ELECTRIC','DIESEL','GASOLINA','PETROL','SPORT','AMG','GTI','ST','RS','GRAND','GRAN','BUSINESS','LIFE','LOUNGE','CHIC','TOURER','ACTIVE','XLINE','URBAN','CROSSBACK','CROSS','STEPWAY','COUPE'] AS words,
        ['EDITION','BUSINESS','PACK','LINE','SPORT','SPORTS','AUTOMATIC','CV','CVS','CVV','HP','PS','DIESEL','BENZINA','GASOLINA','PETROL','HYBRID','ELECTRIC','LANG'] AS point_words),
    m AS (SELECT DISTINCT b, cand, regexp_replace(cand, '[-]', ' ', 'g') AS points FROM raw),
    m2 AS (SELECT *, list_filter(string_split_regex(regexp_replace(cand, '[^A-Z0-9_ ]', ' ', 'g'), ' +'), lambda x: x <> '') AS ct, string_split(points, ' ') AS pc FROM m),
    w AS (SELECT DISTINCT b, u, regexp_replace(u, '[-]', ' ', 'g') AS p, list_filter(string_split_regex(regexp_replace(u, '[^A-Z0-9_ ]', ' ', 'g'), ' +'), lambda x: x <> '') AS tw FROM raw),
    w2 AS (SELECT b, u, p, list_filter(tw, lambda x: NOT (list_contains(words, x) AND NOT (b = 'MERCEDES BENZ' AND x = 'COUPE') AND NOT (b = 'MINI' AND x = 'ELECTRIC')) AND NOT (b = 'MERCEDES BENZ' AND x IN ('CLASE', 'CLASSE', 'CLASS'))) AS f, tw, point_words FROM w, noise),
    t AS (SELECT b, u, p, CASE WHEN len(f) > 0 THEN f ELSE tw END AS tt, array_to_string(CASE WHEN len(f) > 0 THEN f ELSE tw END, ' ') AS t, point_words, string_split(p, ' ') AS pt FROM w2),
    -- the scorer by points
    v AS (SELECT t.b, t.u, m2.cand, m2.points,
            CASE WHEN p = points THEN 100 ELSE 0 END + CASE WHEN contains(p, points) THEN 60 ELSE 0 END
            + CASE WHEN len(list_filter(pc, lambda c: NOT list_contains(pt, c) OR list_contains(point_words, c) OR (t.b = 'BMW' AND c IN ('XDRIVE','STEPTRONIC','AUT','DCT','TOURING','GRAN','COUPE','MHEV')) OR (t.b = 'MERCEDES BENZ' AND c IN ('4MATIC','KOMBI','TOURER','AMG')))) = 0 THEN 40 ELSE 0 END
            + least(length(points), 40) // 2 + CASE WHEN regexp_matches(points, '[0-9]') AND regexp_matches(p, '[0-9]') THEN 15 ELSE 0 END
            - CASE WHEN len(list_filter(pc, lambda c: list_contains(point_words, c) OR (t.b = 'BMW' AND c IN ('XDRIVE','STEPTRONIC','AUT','DCT','TOURING','GRAN','COUPE','MHEV')) OR (t.b = 'MERCEDES BENZ' AND c IN ('4MATIC','KOMBI','TOURER','AMG')))) > 0 THEN 10 ELSE 0 END AS score
        FROM t JOIN m2 USING (b)),
    v2 AS (SELECT b, u, arg_min(cand, (-score, points, cand)) AS cand FROM v WHERE score >= 50 GROUP BY b, u),
    r AS (SELECT t.b, t.u, m.cand FROM t JOIN m ON t.b = m.b AND (
            (t.b = 'MERCEDES BENZ' AND m.points = 'CLASE ' || regexp_extract(t.p, '\b([ABCESG])\s?\d{{2,3}}\b', 1) AND regexp_matches(t.p, '\b([ABCESG])\s?\d{{2,3}}\b'))
            OR (t.b = 'BMW' AND m.points = 'SERIE ' || regexp_extract(t.p, '\b([1-8])\d{{2}}[A-Z]?\b', 1) AND regexp_matches(t.p, '\b([1-8])\d{{2}}[A-Z]?\b')))),
    picks AS (SELECT t.b, t.u, coalesce(min(r.cand), min(v2.cand)) AS pick FROM t LEFT JOIN v2 ON t.b = v2.b AND t.u = v2.u LEFT JOIN r ON t.b = r.b AND t.u = r.u GROUP BY t.b, t.u),
    -- rules
    h AS (SELECT t.*, pick,
            CASE t.b WHEN 'BMW' THEN [CASE WHEN regexp_matches(t, '\bIX\s*[1-7]\b') THEN 'IX' || regexp_extract(t, '\bIX\s*([1-7])\b', 1) END, CASE WHEN regexp_matches(t, '\bIX\b') THEN 'IX' END, CASE WHEN regexp_matches(t, '\bX\s*[1-7]\b') THEN 'X' || regexp_extract(t, '\bX\s*([1-7])\b', 1) END]
                WHEN 'MAZDA' THEN [CASE WHEN regexp_matches(t, '\bMAZDA\s*2\b') THEN '2' END, CASE WHEN regexp_matches(t, '\bMAZDA\s*5\b') AND NOT regexp_matches(t, '\b(CX|MX)\s*-?\s*5\b') THEN '5' END, CASE WHEN regexp_matches(t, '\bMAZDA\s*3\b') THEN '3' END, CASE WHEN regexp_matches(t, '\bMAZDA\s*6\b') THEN '6' END]
                WHEN 'MERCEDES BENZ' THEN [CASE WHEN regexp_matches(t, '^[ABCES] ?\d{{2,3}}') AND contains(t, 'COUPE') THEN 'CLASE ' || t[1] || ' COUPE' END, CASE WHEN regexp_matches(t, '^[ABCES] ?\d{{2,3}}') THEN 'CLASE ' || t[1] END]
                ELSE CAST([] AS VARCHAR[]) END AS hards,
            CASE t.b WHEN 'BMW' THEN [CASE WHEN regexp_matches(t, '\bIX\s*[1-7]\b') THEN 'IX' || regexp_extract(t, '\bIX\s*([1-7])\b', 1) END, CASE WHEN regexp_matches(t, '\bIX\b') THEN 'IX' END, CASE WHEN regexp_matches(t, '\bX\s*[1-7]\b') THEN 'X' || regexp_extract(t, '\bX\s*([1-7])\b', 1) END]
                WHEN 'MAZDA' THEN [CASE WHEN regexp_matches(t, '\bMAZDA\s*2\b') THEN '2' END, CASE WHEN regexp_matches(t, '\bMAZDA\s*5\b') AND NOT regexp_matches(t, '\b(CX|MX)\s*-?\s*5\b') THEN '5' END, CASE WHEN regexp_matches(t, '\bMAZDA\s*3\b') THEN '3' END, CASE WHEN regexp_matches(t, '\bMAZDA\s*6\b') THEN '6' END]
                WHEN 'MERCEDES BENZ' THEN [CASE WHEN regexp_matches(t, '\bGLC\b.*\bCOUPE\b') THEN 'GLC COUPE' END, CASE WHEN regexp_matches(t, '\bGLC\b') THEN 'GLC' END]
                ELSE CAST([] AS VARCHAR[]) END AS guards,
            CASE WHEN t.b = 'BMW' AND regexp_matches(t, '\b([1-8])\d{{2}}[A-Z]?\b') THEN 'SERIE ' || regexp_extract(t, '\b([1-8])\d{{2}}[A-Z]?\b', 1)
                WHEN t.b = 'MERCEDES BENZ' AND tt[1] IN ('A', 'B', 'C', 'E', 'S') THEN 'CLASE ' || tt[1] WHEN t.b = 'MERCEDES BENZ' AND tt[1] = 'GLC' THEN 'GLC'
                WHEN t.b = 'MAZDA' AND regexp_matches(t, '\bCX\s*-?\s*\d{{1,2}}\b') THEN 'CX-' || regexp_extract(t, '\bCX\s*-?\s*(\d{{1,2}})\b', 1) WHEN t.b = 'MAZDA' AND regexp_matches(t, '\bMX\s*-?\s*\d{{1,2}}\b') THEN 'MX-' || regexp_extract(t, '\bMX\s*-?\s*(\d{{1,2}})\b', 1)
                WHEN t.b = 'MAZDA' AND regexp_matches(t, '\bMAZDA\s*[2356]\b') THEN regexp_extract(t, '\bMAZDA\s*([2356])\b', 1) END AS family,
            CASE WHEN t.b = 'MERCEDES BENZ' AND contains(t, 'COUPE') THEN 'COUPE' WHEN t.b = 'MINI' AND regexp_matches(t, '\bCOUNTR?YMAN\b') THEN 'COUNTRYMAN' WHEN t.b = 'MINI' AND regexp_matches(t, '\bCLUBMAN\b') THEN 'CLUBMAN'
                WHEN t.b = 'MINI' AND regexp_matches(t, '\b(ELECTRIC|SE|COOPER\s*SE|E[-\s]?MINI)\b') THEN 'MINI ELECTRIC' END AS pool
        FROM t JOIN picks USING (b, u)),
    -- every model of the make
    a AS (SELECT h.*, m2.cand, m2.ct, list_filter(ct, lambda x: x NOT IN ('MERCEDES', 'BENZ', 'CLASE', 'CLASSE', 'CLASS')) AS said FROM h JOIN m2 USING (b)),
    p1 AS (SELECT *, min(nullif(coalesce(list_position(hards, cand), 0), 0)) OVER (PARTITION BY b, u) AS hard_at,
            len(said) > 0 AND CASE WHEN b = 'MERCEDES BENZ' THEN len(list_filter(said, lambda c: NOT CASE WHEN regexp_full_match(c, '[A-Z]+') THEN list_contains(tt, c) ELSE len(list_filter(tt, lambda x: starts_with(x, c) OR starts_with(c, x))) > 0 END)) = 0
                ELSE len(list_filter(said, lambda c: NOT list_contains(tt, c))) = 0 END AS present FROM a),
    p2 AS (SELECT *, b <> 'MERCEDES BENZ' OR present AS open0, coalesce(contains(cand, pool), false) AS narrow FROM p1),
    p3 AS (SELECT *, bool_or(open0 AND narrow) OVER (PARTITION BY b, u) AS narrowed FROM p2),
    p4 AS (SELECT * FROM p3 WHERE CASE WHEN hard_at IS NOT NULL THEN hards[hard_at] = cand ELSE open0 AND (narrow OR NOT narrowed) END),
    p5 AS (SELECT *, guards[min(nullif(coalesce(list_position(guards, cand), 0), 0)) OVER (PARTITION BY b, u)] AS guard,
            list_filter(tt, lambda w: w NOT IN ('BMW', 'MERCEDES', 'BENZ', 'MINI', 'MAZDA') AND NOT list_contains(string_split(b, ' '), w))[1] AS ti, list_filter(ct, lambda w: w NOT IN ('BMW', 'MERCEDES', 'BENZ', 'MINI', 'MAZDA') AND NOT list_contains(string_split(b, ' '), w))[1] AS tc FROM p4),
    p6 AS (SELECT *, list_filter(list_transform(said, lambda c: list_position(list_transform(tt, lambda x: starts_with(x, c) OR starts_with(c, x)), true)), lambda p: p > 0) AS places FROM p5),
    f AS (SELECT b, u, cand, hard_at,
            len(list_filter(ct, lambda c: len(list_filter(tt, lambda x: starts_with(x, c) OR starts_with(c, x))) > 0)) / CAST(len(ct) AS DOUBLE) AS recall,
            CASE WHEN starts_with(ti, tc) OR starts_with(tc, ti) THEN 1.0 ELSE 0.0 END AS pref, 1.0 / (1.0 + 0.15 * length(cand)) AS len_, CASE WHEN len(list_filter(ct, lambda c: NOT list_contains(tt, c))) = 0 THEN 1.0 ELSE 0.0 END AS subset,
            CASE WHEN regexp_matches(array_to_string(ct, ''), '[0-9]') AND regexp_matches(array_to_string(tt, ''), '[0-9]') THEN 1.0 ELSE 0.0 END AS digits,
            CASE WHEN guard IS NULL THEN 0.0 WHEN guard = cand THEN 1.0 ELSE -0.2 END AS guard, CASE WHEN pick = cand THEN 1.0 ELSE 0.0 END AS v2flag, CASE WHEN contains(cand, family) THEN 1.0 ELSE 0.0 END AS fam,
            len(list_intersect(list_distinct(tt), list_distinct(ct))) / CAST(len(list_distinct(list_concat(tt, ct))) AS DOUBLE) AS lex, CASE WHEN ti = tc THEN 1.0 ELSE 0.0 END AS first_token,
            CASE WHEN len(places) > 0 THEN list_sum(list_transform(places, lambda p: coalesce([1.0, 0.85, 0.7, 0.55, 0.4, 0.3][p], 0.2))) / len(places) ELSE 0.0 END AS pref_pos, CASE WHEN present THEN 1.0 ELSE 0.0 END AS present,
            CASE WHEN NOT contains(t, 'COUPE') THEN 0.0 WHEN contains(cand, 'COUPE') THEN 1.0 ELSE -1.0 END AS coupe FROM p6),
    s AS (SELECT *, round(CAST(CASE b WHEN 'BMW' THEN 0.4 ELSE 0.45 END * recall + 0.2 * pref + 0.05 * len_ + CASE b WHEN 'BMW' THEN 0.15 ELSE 0.10 END * subset + CASE b WHEN 'BMW' THEN 0.08 ELSE 0.05 END * digits
            + CASE b WHEN 'MERCEDES BENZ' THEN 0.18 WHEN 'MINI' THEN 0.12 ELSE 0.10 END * guard + CASE b WHEN 'BMW' THEN 0.22 ELSE 0.15 END * v2flag + CASE b WHEN 'MERCEDES BENZ' THEN 0.12 WHEN 'MAZDA' THEN 0.14 ELSE 0.10 END * fam
            + 0.10 * lex + CASE b WHEN 'MERCEDES BENZ' THEN 0.25 ELSE 0.20 END * first_token + 0.15 * pref_pos + 0.25 * present + CASE b WHEN 'MERCEDES BENZ' THEN 0.35 ELSE 0.0 END * coupe AS DOUBLE), 9) AS score FROM f),
    o AS (SELECT b, u, cand, hard_at, score, row_number() OVER (PARTITION BY b, u ORDER BY score DESC, cand) AS i FROM s),
    e AS (SELECT b, u, max(cand) FILTER (i = 1) AS model, max(cand) FILTER (i = 2) AS second, CASE WHEN max(hard_at) IS NOT NULL THEN 1.0 ELSE greatest(0.0, max(score) FILTER (i = 1) - coalesce(max(score) FILTER (i = 2), 0.0)) END AS confidence FROM o GROUP BY b, u),
    fam AS (SELECT x.b, x.cand, arg_min(y.cand, (length(y.cand), y.cand)) AS family FROM m2 x JOIN m2 y ON x.b = y.b AND starts_with(array_to_string(x.ct, ' ') || ' ', array_to_string(y.ct, ' ') || ' ') GROUP BY x.b, x.cand)
    SELECT p_partkey, raw.b AS make, e.model AS model, e.second, round(coalesce(CAST(e.confidence AS DOUBLE), 0.0), 6) AS confidence, fam.family
    FROM raw LEFT JOIN e ON raw.b = e.b AND raw.u = e.u LEFT JOIN fam ON fam.b = e.b AND fam.cand = e.model
"""


def model_names(spark, sf_dir):
    """Texts of the parts and the known models they mean, over the whole table."""
    p = table(spark, sf_dir, "part")
    make = F.expr(_MAKE)
    whitelist = p.select(make.alias("MARCA"), F.expr(_sql(_MODEL, "STRING")).alias("MODELO")).distinct()
    rows = p.select("p_partkey", make.alias("make"), F.expr(_sql(_TEXT, "STRING")).alias("text"))
    return models.fused(rows, "p_partkey", "make", "text", whitelist)


# --- linkage --------------------------------------------------------------------------------------------------------

_LOT_MODEL = "CASE (l_partkey + y) % 4 WHEN 0 THEN p_type WHEN 1 THEN concat(p_type, 's') WHEN 2 THEN concat(p_type, ' plus') ELSE 'other' END"
_LOT_TEXT = "CASE WHEN l_partkey % 5 = 0 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) ELSE p_name END"
_PRICE_TEXT = "CASE WHEN p_partkey % 4 = 0 THEN concat(p_name, ' plus') ELSE p_name END"
_FUEL = "CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END"

# Every lot against every price of its make; ratios from the table of common subsequences, letter by letter.
_AUDIT_SQL = f"""
    WITH RECURSIVE price AS (
        SELECT CAST(p_partkey AS VARCHAR) AS price_id, p_brand AS make, p_type AS model, p_size % 7 + 1992 AS year, {_FUEL} AS fuel, CAST(p_size % 20 * 10 AS DOUBLE) AS power, {_PRICE_TEXT} AS text, p_retailprice AS price FROM part
    ), keys AS (SELECT DISTINCT l_partkey, l_returnflag, year(l_shipdate) AS y FROM lineitem),
    lot AS (
        SELECT concat_ws('-', l_partkey, l_returnflag, y) AS lot_id, p_brand AS make, {_LOT_MODEL} AS model, y AS year, l_returnflag AS fuel, CAST(p_size % 23 * 10 AS DOUBLE) AS power, {_LOT_TEXT} AS text
        FROM keys JOIN part ON l_partkey = p_partkey
    ), named AS (SELECT DISTINCT l.make, l.model, p.model AS other FROM (SELECT DISTINCT make, model FROM lot) l JOIN (SELECT DISTINCT make, model FROM price) p USING (make)),
    -- pairs of labels and of texts with a word in common
    labels AS (SELECT DISTINCT model AS a, other AS b, false AS whole FROM named UNION SELECT DISTINCT l.text, p.text, true FROM (SELECT DISTINCT make, text FROM lot) l JOIN (SELECT DISTINCT make, text FROM price) p USING (make) WHERE len(list_intersect(string_split(l.text, ' '), string_split(p.text, ' '))) > 0),
    sets AS (SELECT *, list_sort(list_distinct(string_split(a, ' '))) AS x, list_sort(list_distinct(string_split(b, ' '))) AS y FROM labels),
    cut AS (SELECT *, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') AS shared, list_filter(x, lambda w: NOT list_contains(y, w)) AS dx, list_filter(y, lambda w: NOT list_contains(x, w)) AS dy FROM sets),
    sides AS (SELECT *, trim(concat(shared, ' ', array_to_string(dx, ' '))) AS u, trim(concat(shared, ' ', array_to_string(dy, ' '))) AS v, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS brief, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS wide FROM cut),
    asked AS (
        SELECT a, b, whole, u AS s, v AS t FROM sides UNION SELECT a, b, whole, shared, u FROM sides WHERE shared <> '' UNION SELECT a, b, whole, shared, v FROM sides WHERE shared <> ''
        UNION SELECT a, b, whole, brief, substr(wide, CAST(greatest(i, 0) + 1 AS INTEGER), CAST(length(brief) + least(i, 0) AS INTEGER)) FROM (SELECT *, unnest(range(1 - length(brief), length(wide))) AS i FROM sides WHERE whole)
    ), pair AS (SELECT DISTINCT s, t FROM asked),
    common AS (
        SELECT s, t, 0 AS i, list_transform(range(length(t)), lambda j: 0) AS line FROM pair
        UNION ALL
        SELECT s, t, i + 1, list_transform(range(1, length(t) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(line[k], CASE WHEN k = 1 THEN 0 ELSE line[k - 1] END + CASE WHEN s[i + 1] = t[k] THEN 1 ELSE 0 END))))
        FROM common WHERE i < length(s)
    ), ratio AS (SELECT s, t, 200.0 * list_max(line) / (length(s) + length(t)) AS r FROM common WHERE i = length(s)),
    alike AS (SELECT a, b, whole, max(r) AS score FROM asked JOIN ratio USING (s, t) GROUP BY a, b, whole),
    -- stages
    ca AS (SELECT 'EXACT' AS stage, l.lot_id, l.year AS ly, l.fuel AS lf, l.power AS lp, l.text AS lt, p.* FROM lot l JOIN price p ON l.make = p.make AND l.model = p.model),
    near AS (SELECT n.make, n.model, p.price_id, row_number() OVER (PARTITION BY n.make, n.model ORDER BY score DESC, p.price_id) AS i FROM named n JOIN alike ON NOT whole AND a = n.model AND b = n.other AND score >= 90 JOIN price p ON p.make = n.make AND p.model = n.other),
    ea AS (SELECT *, max(CAST(ly = year AS INTEGER)) OVER (PARTITION BY lot_id) AS ok FROM ca), fa AS (SELECT * EXCLUDE ok, max(CAST(lf = fuel AS INTEGER)) OVER (PARTITION BY lot_id) AS ok FROM ea WHERE ok = 0 OR ly = year),
    ga AS (SELECT * EXCLUDE ok, max(CAST(lp = power AS INTEGER)) OVER (PARTITION BY lot_id) AS ok FROM fa WHERE ok = 0 OR lf = fuel), ha AS (SELECT *, len(list_intersect(string_split(lt, ' '), string_split(text, ' '))) AS o FROM ga WHERE ok = 0 OR lp = power),
    done AS (SELECT DISTINCT lot_id FROM ha WHERE o > 0),
    rest AS (SELECT * FROM lot WHERE lot_id NOT IN (SELECT lot_id FROM done)),
    cb AS (
        SELECT 'BRAND' AS stage, l.lot_id, l.year AS ly, l.fuel AS lf, l.power AS lp, l.text AS lt, p.* FROM rest l JOIN price p ON l.make = p.make
        WHERE CASE WHEN (l.make, l.model) IN (SELECT (make, model) FROM near) THEN (l.make, l.model, p.price_id) IN (SELECT (make, model, price_id) FROM near WHERE i <= 3) ELSE true END
    ), eb AS (SELECT *, max(CAST(ly = year AS INTEGER)) OVER (PARTITION BY lot_id) AS ok FROM cb), fb AS (SELECT * EXCLUDE ok, max(CAST(lf = fuel AS INTEGER)) OVER (PARTITION BY lot_id) AS ok FROM eb WHERE ok = 0 OR ly = year),
    gb AS (SELECT * EXCLUDE ok, max(CAST(lp = power AS INTEGER)) OVER (PARTITION BY lot_id) AS ok FROM fb WHERE ok = 0 OR lf = fuel), hb AS (SELECT *, len(list_intersect(string_split(lt, ' '), string_split(text, ' '))) AS o FROM gb WHERE ok = 0 OR lp = power),
    h AS (SELECT * FROM ha WHERE o > 0 UNION ALL SELECT * FROM hb WHERE o > 0),
    r AS (SELECT h.*, CAST(contains(lt, text) OR contains(text, lt) AS INTEGER) AS hit, round(score, 4) AS fuzzy FROM h JOIN alike ON whole AND a = lt AND b = text),
    q AS (SELECT *, row_number() OVER (PARTITION BY lot_id ORDER BY o DESC, hit DESC, fuzzy DESC, price_id) AS n FROM r),
    z AS (SELECT *, row_number() OVER (PARTITION BY lot_id ORDER BY CASE WHEN ok = 0 AND n <= 3 THEN 0 ELSE 1 END, CASE WHEN ok = 0 AND n <= 3 THEN abs(power - lp) END, n) AS rank FROM q)
    SELECT lot_id, CAST(rank AS INTEGER) AS cand_rank, price_id, price, stage, CAST(o AS INTEGER) AS token_overlap, array_to_string(list_sort(list_intersect(string_split(lt, ' '), string_split(text, ' '))), ' ') AS terms, hit AS substring_hit, fuzzy,
        CASE WHEN rank = 1 THEN 'selected' ELSE 'candidate' END AS decision
    FROM z WHERE rank <= 5
    UNION ALL SELECT lot_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'unmatched' FROM lot WHERE lot_id NOT IN (SELECT lot_id FROM z)
"""


def linkage_audit(spark, sf_dir):
    """The best candidates of each lot over all line items: strict keys, likest models, whole makes."""
    p = table(spark, sf_dir, "part")
    prices = p.select(
        F.col("p_partkey").cast("string").alias("price_id"), F.col("p_brand").alias("make"), F.col("p_type").alias("model"), F.expr("p_size % 7 + 1992").alias("year"), F.expr(_FUEL).alias("fuel"), F.expr("CAST(p_size % 20 * 10 AS DOUBLE)").alias("power"),
        F.expr(_PRICE_TEXT).alias("text"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.col("p_retailprice").alias("price"),
    )
    keys = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", F.year("l_shipdate").alias("y")).distinct()
    lots = keys.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_partkey", "l_returnflag", "y").alias("lot_id"), F.col("p_brand").alias("make"), F.expr(_LOT_MODEL).alias("model"), F.col("y").alias("year"), F.col("l_returnflag").alias("fuel"), F.expr("CAST(p_size % 23 * 10 AS DOUBLE)").alias("power"), F.expr(_LOT_TEXT).alias("text")
    )
    return linkage.match(lots, prices)[1]


QUERIES = {f.__name__: f for f in (model_names, linkage_audit)}
ORACLE_SQL = {"model_names": _FUSION_SQL, "linkage_audit": _AUDIT_SQL}
