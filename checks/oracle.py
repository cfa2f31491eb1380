"""DuckDB SQL with the results each registered query must give."""

from __future__ import annotations

from checks.queries import BOX, ELL

# Fixed values, written out here so that a wrong table in the package does not pass: keys by priority, with categories.
KEYS = [
    ("aerialway", "c"), ("aeroway", "c"), ("bridge", "c"), ("tunnel", "c"), ("junction", "r"), ("highway", "r"),
    ("railway", "c"), ("shop", "c"), ("mountain_pass", "c"), ("waterway", "c"), ("boundary", "c"), ("place", "c"),
    ("emergency", "c"), ("craft", "c"), ("office", "c"), ("building", "c"), ("amenity", "c"), ("leisure", "c"),
    ("tourism", "c"), ("man_made", "c"), ("military", "c"), ("natural", "n"), ("landuse", "n"), ("historic", "c"),
    ("club", "c", "club_hangout"),
]
# Key, value, category, subcategory (1 stands for the key, 2 for the value).
OVERRIDES = [
    ("place", "city", "c", "2"), ("place", "country", "c", "2"), ("place", "islet", "n", "island"), ("place", "island",
    "n", "2"), ("place", "archipelago", "n", "2"), ("place", "peninsula", "n", "2"), ("place", "field", "n", "2"),
    ("place", "sea", "n", "2"), ("place", "woodland", "n", "2"), ("waterway", "stream", "n", "1"), ("waterway", "river",
    "n", "1"), ("waterway", "riverbank", "n", "1"), ("waterway", "waterfall", "n", "2"), ("waterway", "drystream", "n",
    "1"), ("waterway", "wadi", "n", "1"), ("waterway", "soakhole", "n", "2"), ("waterway", "brook", "n", "1"),
    ("waterway", "lake", "n", "2"), ("waterway", "spring", "n", "2"), ("waterway", "coastline", "n", "2"), ("waterway",
    "creek", "n", "1"), ("amenity", "place_of_worship", "c", "2"), ("boundary", "national_park", "n", "2"),
]
# What administrative levels are.
ADMIN_SUBCATS = {
    1: "continent", 2: "country", 3: "state", 4: "state", 5: "state district", 6: "county", 7: "county", 8: "city", 9:
    "city district",
}
WEB_ROOT = "https://www.openstreetmap.org/"
# Fixed values of the fixture.
_TYPE_VALUES = [
    "city", "island", "river", "waterfall", "administrative", "national_park", "place_of_worship", "yes", "residential",
    "hotel", "islet", "tram_stop",
]
# Fixed values of the fixture.
_NAME_VALUES = [
    "São Tomé", "Sao Tome", "Ôbo", "Obo", "Östermalm", "Main Street", "High_Street", "", "100% Gulch",
]


def _quoted(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _values(rows: list[tuple], columns: str) -> str:
    lines = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _quoted(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {lines}) AS t({columns}))"


_KEYS = _values([(n, k[0], k[1], k[2] if len(k) == 3 else k[0]) for n, k in enumerate(KEYS)], "prio, key, supercat, subcat")
_OVERRIDES = _values([(k, v, s, {"1": k, "2": v}.get(c, c)) for k, v, s, c in OVERRIDES], "key, value, supercat, subcat")
_TYPES = _values(list(enumerate(_TYPE_VALUES)), "i, v")
_NAMES = _values(list(enumerate(_NAME_VALUES)), "i, v")

_PLACES = f"""
keys AS {_KEYS}, overrides AS {_OVERRIDES},
raw AS (
  SELECT CAST(o_orderkey AS BIGINT) AS o, CAST(o_custkey AS BIGINT) AS c FROM orders),
places AS (
  SELECT o AS place_id,
    CASE o%3 WHEN 0 THEN 'N' WHEN 1 THEN 'W' ELSE 'R' END AS osm_type,
    c*10+o%2+1 AS osm_id,
    CASE WHEN o%4=0 THEN NULL ELSE CAST((o*7919)%1000 AS DOUBLE)/1e3 END AS importance,
    CASE WHEN o%11=0 THEN NULL ELSE CAST((o*13)%31 AS SMALLINT) END AS rank_search,
    k.key AS class, ty.v AS type,
    CASE WHEN o%6=0 THEN NULL ELSE CAST(o%16 AS SMALLINT) END AS admin_level,
    CASE WHEN nm.v='' THEN '' ELSE nm.v||' '||CAST(CAST((c%40-c%10)/10 AS INT) AS VARCHAR) END AS name,
    CASE WHEN o%5=0 THEN 'Q'||CAST(c%700 AS VARCHAR) END AS wikidata,
    CASE WHEN o%7=0 THEN 'en:'||replace(nm.v,' ','_')||'_'||CAST(CAST((c%40-c%10)/10 AS INT) AS VARCHAR)
         WHEN o%7=1 THEN 'en:Other' END AS wikipedia,
    CASE o%3 WHEN 0 THEN 'POINT' WHEN 1 THEN 'LINESTRING' ELSE 'POLYGON' END AS gtype,
    CAST(6000000+((c-c%2)%100)*10000+(o%10)*400 AS DOUBLE)/1e6 AS minx,
    CAST(((c-c%2)%37)*10000 AS DOUBLE)/1e6 AS miny,
    CAST(6000000+((c-c%2)%100)*10000+(o%10)*400+(CASE o%3 WHEN 0 THEN 0 WHEN 1 THEN 500 ELSE 600 END) AS DOUBLE)/1e6 AS maxx,
    CAST(((c-c%2)%37)*10000+(CASE o%3 WHEN 2 THEN 600 ELSE 0 END) AS DOUBLE)/1e6 AS maxy
  FROM raw LEFT JOIN keys k ON k.prio = o%25 LEFT JOIN {_TYPES} ty ON ty.i = (o*7)%12
  LEFT JOIN {_NAMES} nm ON nm.i = c%10)"""

_RANK = "((30 - coalesce(rank_search, 30)) / CAST(30 AS DOUBLE))"
_FULL = f"(CAST(0.85 AS DOUBLE) * coalesce(importance, CAST(0 AS DOUBLE)) + CAST(0.15 AS DOUBLE) * {_RANK})"
_REST = f"(CAST(0.85 AS DOUBLE) * CAST(0 AS DOUBLE) + CAST(0.15 AS DOUBLE) * {_RANK})"
_FULL_RANK_ONLY = f"(CASE WHEN importance IS NULL THEN {_RANK} ELSE CAST(0.85 AS DOUBLE) * importance + CAST(0.15 AS DOUBLE) * {_RANK} END)"
_BROWSE = "coalesce(importance, CAST(0.75 AS DOUBLE) - CAST(rank_search AS DOUBLE)/CAST(40 AS DOUBLE))"


def _folded(column: str) -> str:
    return f"replace(lower(strip_accents({column})), '_', ' ')"


_PAGE_TEST = f"CASE WHEN {_folded('wikipedia')} LIKE '%'||{_folded('name')}||'%' THEN wikipedia END"
_WEB_KIND = "CASE osm_type WHEN 'N' THEN 'node' WHEN 'W' THEN 'way' ELSE 'relation' END"
_WEB = f"'{WEB_ROOT}'||{_WEB_KIND}||'/'||osm_id"


def _prepared(full: str = _FULL, rest: str = _REST) -> str:
    return f"""{_PLACES},
tested AS (SELECT *, {_PAGE_TEST} AS page FROM places WHERE name IS NOT NULL AND name <> ''),
prepared AS (
  SELECT place_id, osm_type||osm_id AS id, name, class, type, admin_level, wikidata, page AS wikipedia,
    {full} AS imp_order, CASE WHEN page IS NOT NULL THEN {full} ELSE {rest} END AS imp_value,
    CASE WHEN gtype='POINT' THEN 1 ELSE 0 END AS is_node, k.prio AS prio, gtype, minx, miny, maxx, maxy
  FROM tested LEFT JOIN keys k ON k.key = class),
grouped AS (
  SELECT *, 0 AS kind, id AS key FROM prepared
  UNION ALL SELECT *, 1, coalesce(wikidata, CAST(place_id AS VARCHAR)) FROM prepared
  UNION ALL SELECT *, 2, coalesce(wikipedia, CAST(place_id AS VARCHAR)) FROM prepared),
placed AS (SELECT *, row_number() OVER (PARTITION BY kind, key ORDER BY imp_order DESC, place_id) AS pos FROM grouped),
won AS (SELECT place_id FROM placed WHERE pos = 1 GROUP BY place_id HAVING count(*) = 3),
members AS (
  SELECT w.place_id AS survivor, m.* FROM placed w JOIN won USING (place_id)
  JOIN placed m ON m.kind = w.kind AND m.key = w.key)"""


def _merged(**scores) -> str:
    return f"""{_prepared(**scores)},
tag AS (SELECT * FROM (
  SELECT survivor, prio, class, type, admin_level,
    row_number() OVER (PARTITION BY survivor ORDER BY prio, kind, imp_order DESC, place_id) AS n FROM members) WHERE n = 1),
shape AS (SELECT * FROM (
  SELECT survivor, gtype, minx, miny, maxx, maxy,
    row_number() OVER (PARTITION BY survivor ORDER BY is_node, imp_order DESC, kind, place_id) AS n FROM members) WHERE n = 1),
named AS (SELECT * FROM (
  SELECT m.survivor, m.id, row_number() OVER (PARTITION BY m.survivor ORDER BY m.kind, m.imp_order DESC, m.place_id) AS n
  FROM members m JOIN shape s ON s.survivor = m.survivor AND s.gtype = m.gtype AND s.minx = m.minx AND s.miny = m.miny
    AND s.maxx = m.maxx AND s.maxy = m.maxy) WHERE n = 1),
merged AS (
  SELECT p.place_id, p.name, p.imp_value AS importance, t.prio, t.class, t.type, t.admin_level, d.id,
    s.gtype, s.minx, s.miny, s.maxx, s.maxy
  FROM prepared p JOIN tag t ON t.survivor = p.place_id JOIN shape s ON s.survivor = p.place_id
  JOIN named d ON d.survivor = p.place_id)"""


def _components(rows: str, eps: float) -> str:
    """Components of boxes of one folded name within eps in EPSG:3857: (place_id, nk, cid)."""
    def my(lat: str) -> str:
        return f"ln(tan(pi()/4 + radians({lat})/2))*6378137"

    return f"""
boxes AS (
  SELECT place_id, strip_accents(name) AS nk, radians(minx)*6378137 AS x0, radians(maxx)*6378137 AS x1,
    {my('miny')} AS y0, {my('maxy')} AS y1 FROM {rows}),
edges AS (
  SELECT a.place_id AS u, b.place_id AS v FROM boxes a JOIN boxes b ON a.nk = b.nk AND a.place_id <> b.place_id
  WHERE pow(greatest(0, a.x0-b.x1, b.x0-a.x1), 2) + pow(greatest(0, a.y0-b.y1, b.y0-a.y1), 2) <= {eps * eps}),
reach(a, b) AS (
  SELECT place_id, place_id FROM boxes UNION SELECT r.a, e.v FROM reach r JOIN edges e ON e.u = r.b),
clusters AS (SELECT place_id, nk, min(b) AS cid FROM reach JOIN boxes ON place_id = a GROUP BY place_id, nk)"""


_ADMIN = "CASE {level} " + " ".join(f"WHEN {n} THEN '{s}'" for n, s in ADMIN_SUBCATS.items()) + " ELSE 'border' END"


def _categories(rows: str, columns: str) -> str:
    is_admin = "r.class = 'boundary' AND r.type = 'administrative'"
    return f"""
categorised AS (
  SELECT {columns}, CASE WHEN {is_admin} THEN 'c' ELSE coalesce(o.supercat, k.supercat) END AS supercat,
    CASE WHEN {is_admin} THEN {_ADMIN.format(level='r.admin_level')} ELSE replace(coalesce(o.subcat, k.subcat), '_', ' ') END AS subcat
  FROM {rows} r LEFT JOIN overrides o ON o.key = r.class AND o.value = r.type LEFT JOIN keys k ON k.key = r.class)"""


def _ways(lines: str) -> str:
    """Union of horizontal lines (grp, minx, maxx): ways between neighbouring ends that some line covers."""
    return f"""
ends AS (SELECT grp, minx AS x FROM {lines} UNION SELECT grp, maxx FROM {lines}),
gaps AS (SELECT grp, x AS a, lead(x) OVER (PARTITION BY grp ORDER BY x) AS b FROM ends),
ways AS (SELECT g.grp, g.a, g.b FROM gaps g WHERE EXISTS (
  SELECT 1 FROM {lines} l WHERE l.grp = g.grp AND l.minx <= g.a AND l.maxx >= g.b)),
united AS (
  SELECT grp, CASE WHEN count(*) = 1 THEN 'LINESTRING' ELSE 'MULTILINESTRING' END AS gtype, count(*) AS parts,
    sum(b - a) AS length FROM ways GROUP BY grp)"""


_TAGS = """entries AS (SELECT *, row_number() OVER (PARTITION BY survivor ORDER BY kind, imp_order DESC, place_id) AS entry FROM members),
tags AS (SELECT o.popindex, row_number() OVER (PARTITION BY c.cid ORDER BY c.nth, e.entry) AS pos, e.class, e.type, e.admin_level
  FROM clustered c JOIN entries e ON e.survivor = c.place_id JOIN objects o ON o.cid = c.cid)"""


def _elems(pairing: str = "", **scores) -> str:
    return f"""{_merged(**scores)}, {_components('merged', 100.0)},
clustered AS (SELECT m.*, c.cid, row_number() OVER (PARTITION BY c.cid ORDER BY m.importance DESC, m.id, m.place_id) AS nth
  FROM merged m JOIN clusters c USING (place_id)),
first AS (SELECT cid, place_id, name, importance FROM clustered WHERE nth = 1),
lists AS (SELECT cid, count(*) AS n, list(id ORDER BY nth) AS ids, count(*) FILTER (gtype = 'LINESTRING') AS n_lines FROM clustered GROUP BY cid),
best AS (SELECT * FROM (SELECT cid, class, type, admin_level, row_number() OVER (PARTITION BY cid ORDER BY prio, nth) AS k
  FROM clustered) WHERE k = 1),
picked AS (SELECT * FROM (SELECT cid, gtype, minx, miny, maxx, maxy, row_number() OVER (
    PARTITION BY cid ORDER BY CASE WHEN gtype = 'POINT' THEN 1 ELSE 0 END, {pairing}importance, id, place_id) AS k
  FROM clustered) WHERE k = 1),
roads AS (SELECT cid AS grp, minx, maxx, miny FROM clustered WHERE gtype = 'LINESTRING'), {_ways('roads')},
extents AS (SELECT grp, min(minx) AS minx, max(maxx) AS maxx FROM roads GROUP BY grp),
objects AS (
  SELECT f.cid, f.name, f.importance, b.class, b.type, b.admin_level, l.n, l.ids,
    CASE WHEN p.gtype = 'LINESTRING' AND l.n_lines > 1 THEN u.gtype ELSE p.gtype END AS gtype,
    CASE WHEN p.gtype = 'POLYGON' THEN (p.maxx-p.minx)*(p.maxy-p.miny) ELSE 0 END AS area,
    CASE WHEN p.gtype = 'LINESTRING' AND l.n_lines > 1 THEN e.minx ELSE p.minx END AS minx, p.miny,
    CASE WHEN p.gtype = 'LINESTRING' AND l.n_lines > 1 THEN e.maxx ELSE p.maxx END AS maxx, p.maxy,
    row_number() OVER (ORDER BY f.importance DESC, l.ids, f.place_id) AS popindex
  FROM first f JOIN lists l USING (cid) JOIN best b USING (cid) JOIN picked p USING (cid)
  LEFT JOIN united u ON u.grp = f.cid LEFT JOIN extents e ON e.grp = f.cid),
{_categories('objects', "r.popindex, r.name, r.gtype, r.area, array_to_string(r.ids, ',') AS osm_ids, r.minx, r.miny, r.maxx, r.maxy")},
elems AS (SELECT * FROM categorised)"""


def _overlap(x0: float, y0: float, x1: float, y1: float) -> tuple[str, str]:
    """Does the place's box touch a rectangle, and the area shared when it is a polygon."""
    touches = f"(minx <= {x1} AND maxx >= {x0} AND miny <= {y1} AND maxy >= {y0})"
    shared = (
        f"(CASE WHEN gtype = 'POLYGON' THEN greatest(0, least(maxx, {x1}) - greatest(minx, {x0}))"
        f" * greatest(0, least(maxy, {y1}) - greatest(miny, {y0})) ELSE CAST(0 AS DOUBLE) END)"
    )
    return touches, shared


def _inside(touches: str, shared: str) -> str:
    return f"({touches} AND (gtype <> 'POLYGON' OR {shared} / nullif((maxx-minx)*(maxy-miny), 0) >= 0.5))"


_BOX = _overlap(BOX.minx, BOX.miny, BOX.maxx, BOX.maxy)
# the L as two rectangles side by side
_ELL_PARTS = [_overlap(6.20025, 0.05005, 6.40015, 0.25035), _overlap(6.40015, 0.05005, 6.60045, 0.15035)]
_ELL = (f"({_ELL_PARTS[0][0]} OR {_ELL_PARTS[1][0]})", f"({_ELL_PARTS[0][1]} + {_ELL_PARTS[1][1]})")
assert (ELL.minx, ELL.maxy) == (6.20025, 0.25035)


def _against(parts: tuple[str, str]) -> str:
    touches, shared = parts
    return f"""WITH {_PLACES} SELECT place_id, {touches} AS touches, round({shared}, 12) AS overlap,
  {_inside(touches, shared)} AS inside FROM places"""


def _overlap(x0: float, x1: float, y0: float, y1: float) -> str:
    return f"""greatest(CAST(0 AS DOUBLE), least(maxx, CAST({x1!r} AS DOUBLE)) - greatest(minx, CAST({x0!r} AS DOUBLE)))
  * greatest(CAST(0 AS DOUBLE), least(maxy, CAST({y1!r} AS DOUBLE)) - greatest(miny, CAST({y0!r} AS DOUBLE)))"""


_TEETH = [6.20025 + 0.0166 * i for i in range(25)]
# back of the comb, its teeth, less its hole
_COMB = " + ".join(
    [_overlap(_TEETH[0], _TEETH[24], 0.05005, 0.15015), *[_overlap(_TEETH[i], _TEETH[i + 1], 0.15015, 0.25035) for i in range(1, 24, 2)]]
) + f" - {_overlap(_TEETH[3], _TEETH[20], 0.08005, 0.12005)}"


def _report(rows: str, keys: str, order: str, lists: dict[str, str], where: str = "TRUE") -> str:
    texts = ", ".join(f"string_agg(coalesce(CAST({v} AS VARCHAR), '-'), ', ' ORDER BY pos) AS {k}" for k, v in lists.items())
    return f"""SELECT {keys}, page, CAST(count(*) AS INT) AS entries, {texts} FROM (
  SELECT *, CAST((pos - 1) // 1000 AS BIGINT) AS page FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pos, count(*) OVER (PARTITION BY {keys}) AS n
    FROM {rows} WHERE {where}) WHERE n > 1) GROUP BY {keys}, page"""


_NUM = "regexp_replace(CAST({} AS VARCHAR), '\\.0$', '')"


def _xy(x: str, y: str) -> str:
    return f"{_NUM.format(x)}||' '||{_NUM.format(y)}"


_EWKT = f"""'SRID=4326;'||gtype||CASE gtype
  WHEN 'POINT' THEN '('||{_xy('minx', 'miny')}||')'
  WHEN 'LINESTRING' THEN '('||{_xy('minx', 'miny')}||','||{_xy('maxx', 'miny')}||')'
  ELSE '(('||{_xy('minx', 'miny')}||','||{_xy('maxx', 'miny')}||','||{_xy('maxx', 'maxy')}||','||{_xy('minx', 'maxy')}||','||{_xy('minx', 'miny')}||'))' END"""


def _pos(x: str, y: str) -> str:
    return f"'['||{_NUM.format(x)}||','||{_NUM.format(y)}||']'"


_GEOJSON = f"""CASE gtype
  WHEN 'POINT' THEN '{{"type":"Point","coordinates":'||{_pos('minx', 'miny')}||'}}'
  WHEN 'LINESTRING' THEN '{{"type":"LineString","coordinates":['||{_pos('minx', 'miny')}||','||{_pos('maxx', 'miny')}||']}}'
  ELSE '{{"type":"Polygon","coordinates":[['||{_pos('minx', 'miny')}||','||{_pos('maxx', 'miny')}||','||{_pos('maxx', 'maxy')}||','||{_pos('minx', 'maxy')}||','||{_pos('minx', 'miny')}||']]}}' END"""

_M_PER_DEG = """(SELECT place_id, miny, pow(pow(6378.137*cos(radians(miny*100)), 2) + pow(6356.7523*sin(radians(miny*100)), 2), 1.5) AS w FROM places)"""

# ---- tags ----

_TAGGED = """
raw AS (SELECT CAST(o_orderkey AS BIGINT) AS o, CAST(o_custkey AS BIGINT) AS c FROM orders),
tagged AS (
  SELECT o, 1 AS n, 'source' AS k, 'survey' AS v FROM raw WHERE o%4=0
  UNION ALL SELECT o, 2, 'name', 'Place '||c FROM raw WHERE o%3<>0
  UNION ALL SELECT o, 3, 'name:sv', 'Plats' FROM raw WHERE o%9=1
  UNION ALL SELECT o, 4, 'ref', CAST(o AS VARCHAR) FROM raw WHERE o%5=0
  UNION ALL SELECT o, 5, 'brand:wikidata', 'Q1' FROM raw WHERE o%8=0
  UNION ALL SELECT o, 6, 'addr:housename', 'The House' FROM raw WHERE o%31=0
  UNION ALL SELECT o, 7, 'highway', ['footway','residential','crossing','no'][o%4+1] FROM raw WHERE o%7=0
  UNION ALL SELECT o, 8, 'footway', 'sidewalk' FROM raw WHERE o%2=0
  UNION ALL SELECT o, 9, 'natural', ['tree','coastline','yes'][o%3+1] FROM raw WHERE o%11=0
  UNION ALL SELECT o, 10, 'landuse', ['cemetry','forest'][o%2+1] FROM raw WHERE o%6=0
  UNION ALL SELECT o, 11, 'junction', 'roundabout' FROM raw WHERE o%10=0
  UNION ALL SELECT o, 12, 'boundary', ['administrative','postal'][o%2+1] FROM raw WHERE o%13=0
  UNION ALL SELECT o, 13, 'place', ['city','island','hamlet'][o%3+1] FROM raw WHERE o%12<3
  UNION ALL SELECT o, 14, 'amenity', ['cafe','no'][c%2+1] FROM raw WHERE o%17=0
  UNION ALL SELECT o, 15, 'admin_level', ['4','0','x','8a','99'][o%5+1] FROM raw WHERE o%3=0
  UNION ALL SELECT o, 16, 'addr:postcode', '7'||(c%1000) FROM raw WHERE o%5=1
  UNION ALL SELECT o, 17, 'postal_code', '00000' FROM raw WHERE o%10=1
  UNION ALL SELECT o, 18, 'addr:country', ['se','swe'][o%2+1] FROM raw WHERE o%4=1
  UNION ALL SELECT o, 19, 'addr:interpolation', 'even' FROM raw WHERE o%37=0
  UNION ALL SELECT o, 20, 'addr:housenumber', CAST(c%90 AS VARCHAR) FROM raw WHERE o%6=5
  UNION ALL SELECT o, 21, 'is_in:state', 'Here' FROM raw WHERE o%19=0
  UNION ALL SELECT o, 22, 'wheelchair', 'yes' FROM raw WHERE o%14=0
  UNION ALL SELECT o, 23, 'building', 'yes' FROM raw WHERE o%5=2),
flags AS (
  SELECT raw.o, coalesce(bool_or(k IN ('name','name:sv')), FALSE) AS named,
    coalesce(bool_or(k IN ('name','name:sv','ref','addr:housename')), FALSE) AS has_names,
    coalesce(bool_or(k IN ('addr:housename','addr:housenumber')), FALSE) AS house,
    coalesce(bool_or(k='addr:interpolation'), FALSE) AS interpolated,
    coalesce(bool_or(k='boundary' AND v='administrative'), FALSE) AS admin,
    coalesce(bool_or(k='footway'), FALSE) AS sidewalk,
    coalesce(bool_or(k='building'), FALSE) AS building,
    coalesce(bool_or(k IN ('addr:postcode','postal_code')), FALSE) AS postcode,
    max(v) FILTER (k='place') AS place, max(v) FILTER (k='junction') AS junction,
    max(v) FILTER (k='landuse' AND v<>'cemetry') AS landuse,
    max(v) FILTER (k='admin_level') AS lvl
  FROM raw LEFT JOIN tagged USING (o) GROUP BY raw.o),
own AS (
  SELECT t.o, t.k, t.v FROM tagged t JOIN flags f USING (o) WHERE
    (k='highway' AND v NOT IN ('crossing','no') AND NOT (v='footway' AND f.sidewalk))
    OR (k='natural' AND v='tree' AND (f.named OR {keep_natural})) OR (k='landuse' AND v='cemetry') OR k='boundary'
    OR (k='amenity' AND v<>'no')
  UNION ALL SELECT o, 'place', 'houses' FROM flags WHERE interpolated
  UNION ALL SELECT o, 'place', place FROM flags WHERE place IS NOT NULL AND NOT (interpolated OR (admin AND place<>'island'))),
empties AS (SELECT f.* FROM flags f LEFT JOIN own USING (o) WHERE own.o IS NULL),
fallback AS (
  SELECT o, CASE WHEN junction IS NOT NULL THEN 'junction' ELSE 'landuse' END AS k, coalesce(junction, landuse) AS v
  FROM empties WHERE named AND coalesce(junction, landuse) IS NOT NULL),
last AS (
  SELECT o, CASE WHEN building AND (has_names OR house OR postcode) THEN 'building' ELSE 'place' END AS k,
    CASE WHEN building AND (has_names OR house OR postcode) THEN 'yes' WHEN house THEN 'house' ELSE 'postcode' END AS v
  FROM empties e WHERE (building AND (has_names OR house OR postcode) OR house OR postcode)
    AND NOT EXISTS (SELECT 1 FROM fallback f WHERE f.o = e.o)),
found AS (SELECT * FROM own UNION ALL SELECT * FROM fallback UNION ALL SELECT * FROM last),
levels AS (SELECT o, CASE WHEN TRY_CAST(nullif(regexp_extract(lvl, '^\\s*([+-]?\\d+)', 1), '') AS INT) BETWEEN 1 AND 15
  THEN CAST(regexp_extract(lvl, '^\\s*([+-]?\\d+)', 1) AS INT) ELSE 15 END AS admin_level FROM flags)"""


def _joined(rows: str) -> str:
    return f"(SELECT o, string_agg(k||'='||v, ',' ORDER BY k||'='||v) AS s FROM {rows} GROUP BY o)"


_CLASSIFY = f"""WITH {_TAGGED.replace('{keep_natural}', 'TRUE')},
extra AS (
  SELECT o, k, v FROM tagged WHERE k IN ('brand:wikidata','wheelchair')
  UNION ALL SELECT o, 'place', place FROM flags WHERE place IS NOT NULL AND (interpolated OR (admin AND place<>'island'))),
parts AS (
  SELECT o, n, CASE WHEN k IN ('addr:postcode','postal_code') THEN 'postcode' WHEN k='addr:country' THEN 'country'
    WHEN k='is_in:state' THEN 'state' ELSE replace(k,'addr:','') END AS k, v FROM tagged
  WHERE k IN ('addr:postcode','postal_code','addr:interpolation','addr:housenumber','is_in:state') OR (k='addr:country' AND length(v)=2)),
address AS (SELECT o, k, arg_min(v, n) AS v FROM parts GROUP BY o, k)
SELECT f.o AS osm_id, coalesce(p.s,'') AS places, coalesce(m.s,'') AS names, coalesce(e.s,'') AS extratags,
  coalesce(a.s,'') AS address, l.admin_level
FROM flags f JOIN levels l USING (o) LEFT JOIN {_joined('found')} p USING (o)
LEFT JOIN {_joined("(SELECT * FROM tagged WHERE k IN ('name','name:sv','ref','addr:housename'))")} m USING (o)
LEFT JOIN {_joined('extra')} e USING (o) LEFT JOIN {_joined('address')} a USING (o)"""

_LABEL = "(CASE WHEN place_id%9=0 THEN 'Something Else' ELSE array_to_string(list_transform(string_split(type,'_'), lambda w: upper(w[1])||w[2:]), ' ') END)"

ORACLE_SQL = {
    "to_importance": f"""WITH {_PLACES} SELECT place_id, {_FULL} AS zero, {_FULL_RANK_ONLY} AS rank_only, {_REST} AS no_page,
  coalesce({_BROWSE}, CAST(0 AS DOUBLE)) AS browse, {_BROWSE} AS browse_unfilled FROM places""",
    "test_wikipedia": f"WITH {_PLACES} SELECT place_id, name, strip_accents(name) AS folded, {_PAGE_TEST} AS wikipedia FROM places",
    "web_links": f"""WITH {_PLACES} SELECT place_id, osm_type||osm_id AS id, {_WEB} AS web, {_WEB} AS id_web,
  {_WEB}||', {WEB_ROOT}node/'||place_id AS webs FROM places""",
    "array_functions": """WITH raw AS (SELECT CAST(o_orderkey AS BIGINT) AS o FROM orders),
pairs AS (SELECT o, i, (o+i*7)%23 AS v, CAST((o+i*i)%5 AS VARCHAR) AS id FROM raw, range(1, 10) r(i)),
firsts AS (SELECT o, id, min(i) AS i FROM pairs GROUP BY o, id)
SELECT raw.o AS k,
  (SELECT string_agg(CAST(p.v AS VARCHAR), ',' ORDER BY p.i) FROM firsts f JOIN pairs p ON p.o=f.o AND p.i=f.i WHERE f.o=raw.o) AS unique_values,
  concat_ws(',', CASE WHEN o%2=0 THEN CAST(o%16 AS VARCHAR) END, CASE WHEN o%3=0 THEN CAST(o%7 AS VARCHAR) END, CAST(o%5 AS VARCHAR)) AS without_nulls,
  concat_ws(',', CASE WHEN o%2=0 THEN o%16 ELSE -1 END, CASE WHEN o%3=0 THEN o%7 ELSE -1 END, o%5) AS filled,
  (SELECT p.v FROM firsts f JOIN pairs p ON p.o=f.o AND p.i=f.i WHERE f.o=raw.o AND f.id='3') AS at_three,
  17 AS bytes FROM raw""",
    "unnest_pairs": """SELECT k, unnest([k%3, k%5, k%7]) AS x, unnest([k+1, k+2, k+3]) AS y FROM (SELECT CAST(o_orderkey AS BIGINT) AS k FROM orders)""",
    "meters_to_degrees": f"""WITH {_PLACES} SELECT place_id,
  round(100.0 / ((pow(6378.137*6356.7523, 2) / w) * 1000 * (2*pi()/360)), 9) AS degrees FROM {_M_PER_DEG}""",
    "geometry_measures": f"""WITH {_PLACES} SELECT place_id, gtype, minx, miny, maxx, maxy,
  CASE gtype WHEN 'POINT' THEN 1 WHEN 'LINESTRING' THEN 2 ELSE 5 END AS points, 1 AS parts, minx AS x0, miny AS y0,
  round(CASE gtype WHEN 'POLYGON' THEN (maxx-minx)*(maxy-miny) ELSE 0 END, 12) AS area,
  round(CASE gtype WHEN 'POLYGON' THEN 2*(maxx-minx)+2*(maxy-miny) ELSE maxx-minx END, 12) AS length,
  round(radians(minx)*6378137, 3) AS mx, round(ln(tan(pi()/4 + radians(miny)/2))*6378137, 3) + 0.0 AS my FROM places""",
    "area_of_box": _against(_BOX),
    "area_of_ell": _against(_ELL),
    "area_of_comb": f"""WITH {_PLACES} SELECT place_id, round(CASE gtype WHEN 'POLYGON' THEN {_COMB} ELSE 0 END, 12) AS overlap FROM places""",
    "probe_area": f"""WITH {_PLACES} SELECT place_id, left(name, 30) AS name, gtype, {_BOX[0]} AS touches, round({_BOX[1]}, 12) AS overlap,
  CASE WHEN NOT {_BOX[0]} THEN 'GEOMETRYCOLLECTION' ELSE gtype END AS overlap_type,
  round(CASE gtype WHEN 'POLYGON' THEN (maxx-minx)*(maxy-miny) ELSE 0 END, 12) AS area FROM places""",
    "overlap_parts": f"""WITH boxes AS (
  SELECT o_orderkey AS o, 6.1500037::DOUBLE + (o_orderkey % 1000)::DOUBLE / 2000 AS x, 0.0010011::DOUBLE + (o_orderkey % 13)::DOUBLE / 100 AS w FROM orders),
teeth AS (SELECT 6.20025::DOUBLE + 0.0166::DOUBLE * i AS t0, 6.20025::DOUBLE + 0.0166::DOUBLE * (i + 1) AS t1 FROM range(1, 24, 2) r(i)),
pieces AS (
  SELECT o, greatest(t0, x) AS lo, least(t1, x + w) AS hi, greatest(t0, x, x + w * 0.25) AS hl, least(t1, x + w, x + w * 0.75) AS hh
  FROM boxes JOIN teeth ON t0 < x + w AND t1 > x),
sums AS (
  SELECT o, sum(CASE WHEN hh > hl AND hl = lo AND hh = hi THEN 2 ELSE 1 END) AS parts, sum(CASE WHEN hl > lo AND hh < hi AND hh > hl THEN 1 ELSE 0 END) AS holes,
    sum((hi - lo) * 0.08::DOUBLE - greatest(hh - hl, 0) * 0.02::DOUBLE) AS area, count(*) AS n, sum(hi - lo) AS length FROM pieces GROUP BY o)
SELECT CAST(o AS BIGINT) AS o, CASE WHEN parts IS NULL THEN 'GEOMETRYCOLLECTION' WHEN parts = 1 THEN 'POLYGON' ELSE 'MULTIPOLYGON' END AS kind,
  CAST(parts AS INT) AS parts, CAST(parts + holes AS INT) AS rings, round(coalesce(area, 0), 12) AS area,
  CASE WHEN n IS NULL THEN 'GEOMETRYCOLLECTION' WHEN n = 1 THEN 'LINESTRING' ELSE 'MULTILINESTRING' END AS line_kind, CAST(n AS INT) AS line_parts,
  round(length, 12) AS line_length
FROM boxes LEFT JOIN sums USING (o)""",
    "valid_geometries": "SELECT CAST(o_orderkey AS BIGINT) AS place_id, o_orderkey%8 IN (0, 2, 5, 7) AS valid FROM orders",
    "text_formats": f"""WITH {_PLACES} SELECT place_id, {_EWKT} AS ewkt, {_GEOJSON} AS geojson, TRUE AS same,
  CASE WHEN wikidata IS NOT NULL THEN name END AS name, CASE WHEN name IS NOT NULL THEN wikidata END AS wikidata,
  CASE WHEN name IS NOT NULL AND wikidata IS NOT NULL THEN 3 END AS keys FROM places""",
    "binary_geometries": """WITH kinds AS (SELECT CAST(o_orderkey AS BIGINT) AS o, o_orderkey % 7 AS k, pow((o_orderkey % 8 + 8) / 4.0::DOUBLE, 2) - 0.03125::DOUBLE AS framed FROM orders)
SELECT o, ['POINT', 'LINESTRING', 'POLYGON', 'MULTIPOINT', 'MULTILINESTRING', 'MULTIPOLYGON', NULL][k + 1] AS gtype,
  CAST([1, 1, 1, 2, 2, 2, NULL][k + 1] AS INT) AS parts, CAST([1, 3, 9, 2, 5, 13, NULL][k + 1] AS INT) AS points,
  CASE WHEN k = 2 THEN framed WHEN k = 5 THEN framed + 0.28125::DOUBLE WHEN k < 6 THEN 0 END AS area,
  CASE WHEN k IN (2, 5) THEN 0 WHEN k < 6 THEN (o % 16) / 4.0::DOUBLE END AS x,
  CASE WHEN k = 6 AND o % 2 = 0 THEN 'not a whole geometry' WHEN k = 6 THEN 'not hexadecimal' END AS error FROM kinds""",
    "category_of_places": f"WITH {_PLACES}, {_categories('places', 'r.place_id, r.class, r.type, r.admin_level')} SELECT * FROM categorised",
    "pick_tag": f"""WITH {_PLACES}, tags AS (
  SELECT o, m, CASE m WHEN 0 THEN o%25 WHEN 1 THEN (o*7+3)%25 WHEN 2 THEN (o*3+11)%25 ELSE o%25 END AS p FROM raw, range(0, 4) r(m)),
best AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY p, m) AS n FROM tags)
SELECT o AS k, CAST(p AS INT) AS prio, k.key AS class, ty.v AS type, CAST((o+m)%16 AS INT) AS admin_level
FROM best JOIN keys k ON k.prio=p JOIN {_TYPES} ty ON ty.i=(o+m)%12 WHERE n=1""",
    "category_lines": f"""WITH {_PLACES}
SELECT 'override' AS form, CAST(NULL AS INT) AS prio, class AS key, type AS value, 'c' AS supercat,
  CASE place_id%3 WHEN 0 THEN class WHEN 1 THEN type ELSE 'other' END AS subcat FROM places WHERE place_id > 0
UNION ALL SELECT 'key', CAST(place_id-1 AS INT), class, NULL, 'n', CASE WHEN place_id%2=0 THEN type ELSE class END FROM places WHERE place_id > 0""",
    "label_lines": f"""WITH {_PLACES}, lines AS (SELECT class, type, {_LABEL} AS label FROM places)
SELECT class, type, label, count(*) AS n, count(*) FILTER (NOT starts_with(lower(label), lower(string_split(type,'_')[1]))) AS odd
FROM lines GROUP BY class, type, label""",
    "interesting_keys": f"WITH {_PLACES} SELECT class AS key FROM places UNION SELECT 'building' ORDER BY key",
    "prepare": f"""WITH {_prepared()} SELECT place_id, id, name, class, type, admin_level, wikidata, wikipedia, imp_order, imp_value, is_node, prio FROM prepared""",
    "group_positions": f"""WITH {_PLACES} SELECT place_id, name,
  row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY {_BROWSE} NULLS LAST, place_id) AS object_index,
  row_number() OVER (PARTITION BY coalesce(wikipedia, CAST(place_id AS VARCHAR)) ORDER BY {_BROWSE} NULLS LAST, place_id) AS wikipedia_index,
  row_number() OVER (PARTITION BY coalesce(wikidata, CAST(place_id AS VARCHAR)) ORDER BY {_BROWSE} NULLS LAST, place_id) AS wikidata_index
FROM places""",
    "merge_positions": f"WITH {_prepared()} SELECT kind, key, place_id, pos FROM placed",
    "merged_members": f"""WITH {_prepared()} SELECT survivor, kind, place_id, class, type, admin_level, id, imp_order AS importance, is_node,
  row_number() OVER (PARTITION BY survivor ORDER BY kind, imp_order DESC, place_id) AS pos FROM members""",
    "merge_same_entity": f"WITH {_merged()} SELECT * FROM merged",
    "cluster_nearby": f"WITH RECURSIVE {_merged()}, {_components('merged', 100.0)} SELECT * FROM clusters",
    "cluster_all_places": f"WITH RECURSIVE {_prepared()}, {_components('prepared', 20.0)} SELECT place_id, cid FROM clusters",
    "dedupe_nearby": f"WITH RECURSIVE {_elems()} SELECT cid, name, importance, class, type, admin_level, n, array_to_string(ids, ',') AS ids FROM objects",
    "cluster_members": f"WITH RECURSIVE {_elems()} SELECT cid, importance, id, place_id, nth AS pos FROM clustered",
    "merge_linestrings": f"""WITH {_PLACES}, roads AS (SELECT CAST(floor(osm_id/20) AS BIGINT) AS grp, minx, maxx FROM places WHERE gtype='LINESTRING'),
{_ways('roads')} SELECT grp, gtype, CAST(parts AS INT) AS parts, round(length, 9) AS length FROM united""",
    "slanted_roads": """WITH roads AS (SELECT CAST(o_custkey // 2 AS BIGINT) AS grp, o_orderkey % 96 + 1 AS k, o_orderkey % 3 + 1 AS f, o_orderkey % 5 = 0 AS across FROM orders),
cuts AS (SELECT grp, count(DISTINCT k) AS k, 2 * count(DISTINCT k) FILTER (across) AS a FROM roads GROUP BY grp),
spurs AS (SELECT grp, count(*) AS n, sum(sqrt(0.002 * 0.002 + 0.004 * 0.004 * f * f)) AS length FROM (SELECT DISTINCT grp, k, f FROM roads) GROUP BY grp)
SELECT grp, CAST(0 AS BIGINT) AS page, 'MULTILINESTRING' AS gtype, CAST(1 + k + n + a AS INT) AS parts,
  round(sqrt(0.6 * 0.6 + 0.3 * 0.3) + length + a * sqrt(0.001 * 0.001 + 0.002 * 0.002), 9) AS length
FROM cuts JOIN spurs USING (grp)""",
    "replace_lines": f"""WITH {_PLACES}, roads AS (SELECT CAST(floor(osm_id/20) AS BIGINT) AS grp, minx, maxx FROM places WHERE gtype='LINESTRING'),
{_ways('roads')} SELECT CAST(floor(p.osm_id/20) AS BIGINT) AS grp, place_id AS line, coalesce(importance, CAST(0 AS DOUBLE)) AS importance,
  row_number() OVER (PARTITION BY floor(p.osm_id/20) ORDER BY coalesce(importance, CAST(0 AS DOUBLE)), place_id) AS pos,
  CASE WHEN p.gtype='LINESTRING' THEN u.gtype ELSE p.gtype END AS gtype,
  CAST(CASE WHEN p.gtype='LINESTRING' THEN u.parts ELSE 1 END AS INT) AS parts
FROM places p LEFT JOIN united u ON u.grp = CAST(floor(p.osm_id/20) AS BIGINT)""",
    "pick_geometry": f"""WITH {_PLACES}, shapes AS (
  SELECT place_id, s, s - place_id%4 AS n, (place_id*(s - place_id%4 + 3))%5 AS score, CASE WHEN s=3 THEN minx+1 ELSE minx END AS x,
    ['POINT','LINESTRING','POLYGON','POINT'][s+1] AS gtype
  FROM places, range(0, 4) r(s) WHERE s >= place_id%4 AND s < place_id%4 + place_id%3 + 1),
best AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY gtype='POINT', score DESC, n) AS k FROM shapes)
SELECT place_id, gtype, x FROM best WHERE k = 1""",
    "place_details": f"""WITH {_PLACES} SELECT left(name, 20) AS name, place_id, osm_type, osm_id, importance, rank_search, class, type, admin_level,
  wikidata, wikipedia, minx, miny, maxx, maxy FROM places WHERE name = 'São Tomé 1'""",
    "build_elems": f"""WITH RECURSIVE {_elems()} SELECT popindex, CAST(0 AS BIGINT) AS page, name, supercat, subcat, gtype, round(area, 12) AS area, osm_ids, minx, miny, maxx, maxy FROM elems""",
    "build_elems_other_modes": f"""WITH RECURSIVE {_elems(pairing='-', full=_FULL_RANK_ONLY, rest=_RANK)} SELECT popindex, name, supercat, subcat, gtype, osm_ids FROM elems""",
    "cluster_lists": f"""WITH RECURSIVE {_elems()}, {_TAGS} SELECT popindex, pos, class, type, admin_level FROM tags""",
    "object_lists": f"""WITH RECURSIVE {_elems()}, {_TAGS} SELECT popindex, (pos-1)//1000 AS page, string_agg(class, ',' ORDER BY pos) AS classes,
  string_agg(type, ',' ORDER BY pos) AS types, string_agg(CAST(coalesce(admin_level, -1) AS VARCHAR), ',' ORDER BY pos) AS admin_levels
FROM tags GROUP BY popindex, page""",
    "area_matches": f"""WITH RECURSIVE {_elems()} SELECT popindex, popindex||'. '||name||'. '||supercat||'. '||subcat||'. '||osm_ids AS line FROM elems WHERE {_inside(*_BOX)}""",
    "query_area": f"""WITH RECURSIVE {_elems()} SELECT popindex, name, supercat, subcat, osm_ids FROM elems WHERE popindex > 5 AND {_inside(*_BOX)} ORDER BY popindex LIMIT 10""",
    "prepared_in_area": f"""WITH {_prepared()}, inside AS (SELECT * FROM prepared WHERE {_inside(*_BOX)}),
{_categories('inside', 'r.place_id, r.id, r.name, r.imp_order, r.class, r.type, r.admin_level')} SELECT * FROM categorised ORDER BY imp_order DESC, place_id""",
    "same_object_report": f"WITH {_PLACES} " + _report("places", "osm_type, osm_id", "place_id", {"names": "name", "scores": _BROWSE}),
    "same_wikipedia_report": f"WITH {_PLACES} " + _report("places", "wikipedia", "place_id", {"names": "name", "webs": _WEB}, "wikipedia <> ''"),
    "same_wikidata_report": f"WITH {_PLACES} " + _report("places", "wikidata", "place_id", {"names": "name", "importances": "importance", "webs": _WEB}, "wikidata <> ''"),
    "same_name_report": f"WITH RECURSIVE {_elems()} " + _report("elems", "name", "popindex", {"popindexs": "popindex", "supercats": "supercat", "subcats": "subcat", "osm_idss": "osm_ids"}),
    "repeated_objects": f"WITH {_PLACES} SELECT osm_type, osm_id, count(*) AS n FROM places GROUP BY ALL HAVING count(*) > 1",
    "ranks_by_name": f"""WITH RECURSIVE {_elems()} SELECT left(name, 30) AS name, popindex, row_number() OVER w AS nth, min(popindex) OVER (PARTITION BY name) AS best,
  popindex = min(popindex) OVER (PARTITION BY name) AS is_best FROM elems WINDOW w AS (PARTITION BY name ORDER BY popindex)""",
    "first_of_object": f"""WITH {_PLACES}, ordered AS (SELECT *, row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY importance NULLS LAST, place_id) AS n FROM places)
SELECT left(name, 30) AS name, place_id, rank_search, {_WEB} AS web, {_BROWSE} AS score FROM ordered WHERE n = 1 AND name <> ''""",
    "classes_so_far": f"""WITH {_PLACES}, ordered AS (SELECT *, row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY {_BROWSE} NULLS LAST, place_id) AS n,
  string_agg(class, '_:_') OVER (PARTITION BY osm_type, osm_id ORDER BY place_id) AS classes,
  string_agg(type, '_:_') OVER (PARTITION BY osm_type, osm_id ORDER BY place_id) AS types FROM places)
SELECT osm_type, osm_id, name, CAST(0 AS BIGINT) AS page, classes, types FROM ordered WHERE n = 1 AND name <> ''""",
    "running_lists": f"""WITH {_PLACES} SELECT osm_type, osm_id, place_id, name, admin_level, gtype, {_BROWSE} AS score,
  row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY {_BROWSE} NULLS LAST, place_id) AS by_score,
  row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY place_id) AS pos, CAST(0 AS BIGINT) AS page,
  string_agg(class, '_:_') OVER o AS classes_so_far, string_agg(type, '_:_') OVER o AS types_so_far,
  coalesce(string_agg(name, '_:_') OVER w, '') AS all_names, string_agg(class, '_:_') OVER w AS all_classes, string_agg(type, '_:_') OVER w AS all_types
FROM places WINDOW o AS (PARTITION BY osm_type, osm_id ORDER BY place_id),
  w AS (PARTITION BY osm_type, osm_id ORDER BY place_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "object_entries": f"""WITH {_PLACES} SELECT osm_type, osm_id, place_id, name, class, type, admin_level,
  row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY place_id) AS pos FROM places""",
    "names_summary": f"""WITH {_PLACES} SELECT name, count(*) AS n, count(*) FILTER (WHERE wikipedia IS NOT NULL) AS with_page,
  max(importance) FILTER (WHERE wikipedia IS NOT NULL) AS best, 'DOUBLE' AS kind FROM places GROUP BY name""",
    "reference_systems": """SELECT CAST(p_partkey AS BIGINT) AS srid, 'UNIT["metre",1]' AS srtext FROM part WHERE p_partkey % 3 <> 0""",
    "stored_elems": f"""WITH RECURSIVE {_elems()} SELECT popindex, CAST(0 AS BIGINT) AS page, name, supercat, subcat, gtype, osm_ids FROM elems""",
    "simplify_to_points": """WITH peaks AS (SELECT o_orderkey AS o, ((o_orderkey * (k + 3)) % 11 + 1) / 10.0::DOUBLE AS h FROM orders, range(5) r(k)),
higher AS (SELECT o, h, (SELECT count(*) FROM peaks q WHERE q.o = p.o AND q.h > p.h) AS above FROM peaks p),
least AS (SELECT o, CASE WHEN count(*) <= 3 THEN 0 ELSE min(h) FILTER (above <= 3) END AS t FROM higher GROUP BY o)
SELECT CAST(o AS BIGINT) AS o, CAST(sum(CASE WHEN h > t THEN 3 ELSE 2 END) AS INT) AS points,
  round(sum(CASE WHEN h > t THEN 2 * sqrt(1 + h * h) ELSE 2 END), 9) AS length FROM peaks JOIN least USING (o) GROUP BY o""",
    "simplify_peaks": "SELECT CAST(o_orderkey AS BIGINT) AS place_id, CAST(CASE WHEN o_orderkey%7 > 3.5 THEN 3 ELSE 2 END AS INT) AS points FROM orders",
    "rejected_wikipedia": f"""WITH {_PLACES} SELECT place_id, name, wikipedia, importance FROM places
WHERE wikipedia IS NOT NULL AND ({_PAGE_TEST}) IS NULL AND importance IS NOT NULL""",
    "widest_rows": f"""WITH {_PLACES} SELECT place_id AS label, CAST(strlen(CAST(to_json({{'place_id': place_id, 'osm_type': osm_type,
  'osm_id': osm_id, 'importance': importance, 'rank_search': rank_search, 'class': class, 'type': type, 'admin_level': admin_level,
  'name': CASE WHEN name IS NOT NULL THEN {{'name': name}} END, 'extratags': CASE WHEN wikidata IS NOT NULL THEN {{'wikidata': wikidata}} END,
  'wikipedia': wikipedia, 'geometry': {{'gtype': gtype, 'parts': [[CASE gtype WHEN 'POINT' THEN [{{'x': minx, 'y': miny}}]
    WHEN 'LINESTRING' THEN [{{'x': minx, 'y': miny}}, {{'x': maxx, 'y': miny}}]
    ELSE [{{'x': minx, 'y': miny}}, {{'x': maxx, 'y': miny}}, {{'x': maxx, 'y': maxy}}, {{'x': minx, 'y': maxy}}, {{'x': minx, 'y': miny}}] END]]}},
  'minx': minx, 'miny': miny, 'maxx': maxx, 'maxy': maxy}}) AS VARCHAR)) AS INT) AS bytes FROM places
ORDER BY bytes DESC, label LIMIT 10""",
    "count_larger_than": f"WITH {_PLACES} SELECT count(*) AS n FROM places WHERE gtype <> 'POINT'",
    "most_points": f"WITH {_PLACES} SELECT min(place_id) AS place_id, 2 AS points FROM places WHERE gtype = 'LINESTRING'",
    "top_name": f"""WITH {_PLACES} SELECT name, count(*) AS n, coalesce(max(importance), CAST(0.75 AS DOUBLE) - min(rank_search)/CAST(40 AS DOUBLE)) AS best
FROM places GROUP BY name ORDER BY best DESC NULLS FIRST, name NULLS FIRST LIMIT 1""",
    "browse": f"""WITH {_PLACES} SELECT coalesce({_BROWSE}, CAST(0 AS DOUBLE)) AS importance, osm_type||osm_id AS osm_id, left(name, 30) AS name, class, type,
  gtype AS geom, wikidata, wikipedia, {_WEB} AS web, place_id FROM places""",
    "names_matching": f"WITH {_PLACES} SELECT place_id, name FROM places WHERE regexp_matches(name, 'st.*m')",
    "classify_tags": _CLASSIFY,
    "place_rows": f"""WITH {_TAGGED.replace('{keep_natural}', 'FALSE')} SELECT CASE o%3 WHEN 0 THEN 'N' WHEN 1 THEN 'W' ELSE 'R' END AS osm_type,
  o AS osm_id, k AS class, v AS type, admin_level FROM found JOIN levels USING (o)""",
}
