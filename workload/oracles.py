"""The same results in plain SQL over the given tables, written independently of the operators.

Zones are rasterised by counting crossings per pixel, rasters are upsampled by making every
output pixel, and statistics are taken over those pixels without weights.
"""

from __future__ import annotations

from workload.queries import (
    AS_OF,
    CHUNK_SIZE,
    DEGREE_COVERAGE,
    FINE,
    PLANS_AS_OF,
    QUARTILES,
    SOME_CODES,
    TOLERANCE,
)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def listed(codes: tuple[str, ...]) -> str:
    return ", ".join(f"'{c}'" for c in codes)


# Scene

P = """p AS (SELECT CAST(count(*) AS BIGINT) AS n, count(*) / 5.0 AS strip,
  CAST(ceil(sqrt(count(*) / 25.0)) AS BIGINT) AS across FROM supplier)"""
P_TILE = "p AS (SELECT CAST(8 AS BIGINT) AS n, 8 / 5.0 AS strip, CAST(1 AS BIGINT) AS across)"

SHAPES = """shapes(shape, i, dx, dy) AS (VALUES
  ('country', 1, 0.02, 0.05), ('country', 2, 0.98, 0.05), ('country', 3, 0.98, 4.95),
  ('country', 4, 0.02, 4.95),
  ('pentagon', 1, 0.03, 0.03), ('pentagon', 2, 0.97, 0.03), ('pentagon', 3, 0.97, 0.41),
  ('pentagon', 4, 0.52, 0.96), ('pentagon', 5, 0.03, 0.41),
  ('hole', 1, 0.31, 0.11), ('hole', 2, 0.31, 0.33), ('hole', 3, 0.63, 0.33),
  ('hole', 4, 0.63, 0.11),
  ('speck', 1, 0.6, 0.6), ('speck', 2, 0.9, 0.6), ('speck', 3, 0.9, 0.9), ('speck', 4, 0.6, 0.9),
  ('kite', 1, 0.05, 0.07), ('kite', 2, 0.93, 0.11), ('kite', 3, 0.88, 0.95),
  ('kite', 4, 0.09, 0.83))"""

ZONES = """zones AS (
  SELECT 'R' || chr(CAST(65 + r_regionkey AS INTEGER)) || 'X' AS iso3, 0 AS adm_level,
    0 AS zone_idx, 'R' || r_regionkey AS pcode, r_name AS name, 'country' AS shape,
    r_regionkey * strip AS ox, 0.0 AS oy, strip AS scale FROM region, p
  UNION ALL
  SELECT 'R' || chr(CAST(65 + n_regionkey AS INTEGER)) || 'X', 1, CAST(n_nationkey // 5 AS INTEGER),
    'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), n_name,
    CASE WHEN n_nationkey = 24 THEN 'speck' ELSE 'pentagon' END, n_regionkey * strip,
    (n_nationkey // 5) * strip - CASE WHEN n_nationkey // 5 = 3 THEN 0.5 * strip ELSE 0.0 END,
    CASE WHEN n_nationkey = 24 THEN 1.0 ELSE strip END FROM nation, p
  UNION ALL
  SELECT 'R' || chr(CAST(65 + s_suppkey % 5 AS INTEGER)) || 'X', 2,
    CAST(s_suppkey // 5 AS INTEGER), 'S' || s_suppkey, s_name, 'kite',
    (s_suppkey % 5) * strip + ((s_suppkey // 5) % across) * (strip / across),
    ((s_suppkey // 5) // across) * (strip / across), strip / across FROM supplier, p)"""

GRID_UNITS = "1.0 AS k, 0.0 AS shift"
DEGREES = "160.0 / n AS k, -80.0 AS shift"


def vertices(units: str = GRID_UNITS) -> str:
    return f"""units AS (SELECT {units} FROM p),
vertices AS (
  SELECT iso3, adm_level, zone_idx, 0 AS ring_no, i, (ox + dx * scale) * k + shift AS x,
    (oy + dy * scale) * k + shift AS y FROM zones JOIN shapes USING (shape), units
  UNION ALL
  SELECT iso3, adm_level, zone_idx, 1, i, (ox + dx * scale) * k + shift,
    (oy + dy * scale) * k + shift FROM zones, shapes, units
  WHERE zones.pcode = 'N00' AND shapes.shape = 'hole'),
edges AS (
  SELECT iso3, adm_level, zone_idx, x AS x1, y AS y1,
    coalesce(lead(x) OVER ring, first_value(x) OVER ring) AS x2,
    coalesce(lead(y) OVER ring, first_value(y) OVER ring) AS y2
  FROM vertices
  WINDOW ring AS (PARTITION BY iso3, adm_level, zone_idx, ring_no ORDER BY i))"""


def country_windows(x0: str = "0.0", y0: str = "n", res: str = "1.0", size: str = "n") -> str:
    """Rows and columns whose centre is within a country's bounds, found by looking at each."""
    return f"""lines AS (SELECT unnest(range(CAST({size} AS BIGINT))) AS i FROM p),
bounds AS (SELECT iso3, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy
  FROM vertices WHERE adm_level = 0 GROUP BY iso3),
win AS (
  SELECT * FROM
    (SELECT iso3, min(i) AS r_lo, max(i) AS r_hi FROM bounds, lines, p
     WHERE {y0} - (i + 0.5) * {res} BETWEEN miny AND maxy GROUP BY iso3)
  JOIN
    (SELECT iso3, min(i) AS c_lo, max(i) AS c_hi FROM bounds, lines, p
     WHERE {x0} + (i + 0.5) * {res} BETWEEN minx AND maxx GROUP BY iso3) USING (iso3))"""


def pixels(factor: str, x0: str = "0.0", y0: str = "n", res: str = "1.0") -> str:
    """All output pixels of all windows, with the zone that owns each, per level."""
    return f"""fine AS (SELECT *, r_hi - r_lo + 1 AS h, c_hi - c_lo + 1 AS w,
    CAST(floor((r_hi - r_lo + 1) * {factor}) AS BIGINT) AS new_h,
    CAST(floor((c_hi - c_lo + 1) * {factor}) AS BIGINT) AS new_w FROM win),
frows AS (SELECT iso3, unnest(range(new_h)) AS fr FROM fine),
fcols AS (SELECT iso3, unnest(range(new_w)) AS fc FROM fine),
px AS (
  SELECT iso3, fr, fc, c_lo + ((2 * fc + 1) * w) // (2 * new_w) AS col,
    r_lo + ((2 * fr + 1) * h) // (2 * new_h) AS row,
    {x0} + c_lo * {res} + (fc + 0.5) * (w * {res} / new_w) AS x,
    {y0} - r_lo * {res} - (fr + 0.5) * (h * {res} / new_h) AS y
  FROM fine JOIN frows USING (iso3) JOIN fcols USING (iso3), p),
hits AS (
  SELECT px.iso3, adm_level, fr, fc, row, col, zone_idx
  FROM px JOIN edges ON px.iso3 = edges.iso3 AND (y1 > y) <> (y2 > y)
  WHERE x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x
  GROUP BY ALL HAVING count(*) % 2 = 1),
owned AS (SELECT iso3, adm_level, fr, fc, row, col, max(zone_idx) AS zone_idx
  FROM hits GROUP BY ALL)"""


SCENE = [P, SHAPES, ZONES, vertices(), country_windows()]
FACTOR = f"(1.0 / {FINE})"
PLAIN = [*SCENE, pixels("1.0")]
UPSAMPLED = [*SCENE, pixels(FACTOR)]

COUNTRIES = """countries AS (SELECT 'R' || chr(CAST(65 + r_regionkey AS INTEGER)) || 'X' AS iso3,
  CASE WHEN r_regionkey % 2 = 1 THEN 2 ELSE 1 END AS max_adm_level FROM region)"""

# Cells

_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
OBS = f"""cells AS (SELECT {_MONTH} AS valid_date, l_suppkey AS row, l_partkey // 20 AS col,
  max(l_quantity) AS value FROM lineitem GROUP BY ALL)"""
NAN = """cells AS (SELECT valid_date, row, col,
  CASE WHEN (row + col) % 7 <> 0 THEN value END AS value FROM all_cells)"""
NAN_CELLS = [OBS.replace("cells AS", "all_cells AS", 1), NAN]
FORECAST = f"""cells AS (SELECT {_MONTH} AS valid_date, l_linenumber - 1 AS leadtime,
  l_suppkey AS row, l_partkey // 20 AS col, max(l_quantity) AS value FROM lineitem GROUP BY ALL)"""
PATCHY = """cells AS (SELECT valid_date, leadtime, row, col, value FROM all_cells, p
  WHERE (col // (n // 5) + month(valid_date) + leadtime) % 5 <> 0)"""
PATCHY_CELLS = [FORECAST.replace("cells AS", "all_cells AS", 1), PATCHY]
BAND = """cells AS (SELECT CAST(ts AS DATE) AS valid_date,
  CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS band_no,
  event_id % n AS row, user_id % n AS col, max(value) AS value FROM events, p GROUP BY ALL)"""

# Statistics

AGG = """round(avg(value), 6) AS mean, median(value) AS median, min(value) AS min,
  max(value) AS max, CAST(count(value) AS BIGINT) AS count, coalesce(sum(value), 0.0) AS sum,
  round(stddev_pop(value), 6) AS std"""
Z = "iso3, adm_level, zone_idx"
FILLED_STATS = """a.mean, a.median, a.min, a.max, coalesce(a.count, 0) AS count,
  coalesce(a.sum, 0.0) AS sum, a.std"""


def agg(keys: str, select: str = AGG, level: str = "TRUE") -> str:
    return f"""agg AS (SELECT {keys}, {Z}, {select}
  FROM cells JOIN owned USING (row, col) WHERE value IS NOT NULL AND {level} GROUP BY ALL)"""


def dense(keys: list[str], due: str, level: str, zones: str = "zones", extra: str = "") -> str:
    on = " AND ".join(f"a.{k} = d.{k}" for k in keys)
    return f"""SELECT {", ".join("d." + k for k in keys)}, z.iso3, z.adm_level, z.zone_idx,
  z.pcode, {FILLED_STATS}{extra}
FROM {due} d JOIN {zones} z ON z.iso3 = d.iso3
LEFT JOIN agg a ON {on} AND a.iso3 = z.iso3 AND a.adm_level = z.adm_level
  AND a.zone_idx = z.zone_idx
WHERE {level}"""


DUE_ALL = """due AS (SELECT valid_date, iso3 FROM (SELECT DISTINCT valid_date FROM cells), win)"""


def due_filled(keys: str) -> str:
    return f"""due AS (SELECT DISTINCT iso3, {keys} FROM cells JOIN win
  ON row BETWEEN r_lo AND r_hi AND col BETWEEN c_lo AND c_hi WHERE value IS NOT NULL)"""


OBSERVED = [*PLAIN, OBS, agg("valid_date", level="adm_level = 1"), DUE_ALL]
OBSERVED_SQL = with_(*OBSERVED) + dense(["valid_date"], "due", "z.adm_level = 1")
ISSUED = ",\n  CAST(d.valid_date - to_months(CAST(d.leadtime AS INTEGER)) AS DATE) AS issued_date"
VD_LT = ["valid_date", "leadtime"]

# Tiles and files

TILE_DAY = "CAST(DATE '2020-01-01' + CAST(vec_id AS INTEGER) AS DATE)"
TILES = f"""tiles AS (SELECT vec_id, 'tiles/t_' || strftime({TILE_DAY}, '%Y-%m-%d') || '.tif' AS path,
  {TILE_DAY} AS day, CASE WHEN vec_id % 10 <> 9 THEN 1 END AS dated,
  CASE WHEN vec_id % 8 <> 7 THEN label % 7 END AS leadtime, embedding FROM embeddings)"""
FILES = """files AS (SELECT
  CASE WHEN o_orderkey % 3 = 0 THEN 'monthly/' ELSE 'daily/' END || 'processed/p_' ||
  CASE WHEN o_orderkey % 50 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'latest' END ||
  '_lt' || (o_orderkey % 7) || '.tif' AS path FROM orders),
catalog AS (SELECT path, CAST(found AS DATE) AS file_date FROM
  (SELECT path, regexp_extract(path, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS found FROM files)
  WHERE found <> '')"""

# Country metadata


def code(k: str) -> str:
    def letter(step: int) -> str:
        return f"chr(CAST(65 + ({k}) // {step} % 26 AS INTEGER))"

    return f"({letter(676)} || {letter(26)} || {letter(1)})"


BOUNDARIES = f"""boundaries AS (SELECT {code('s_suppkey // 2')} AS iso_3,
  s_nationkey % 4 AS src_lvl, CAST(DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE)
  AS src_update, 'shp/' || s_name AS o_shp, s_suppkey AS listed FROM supplier),
firsts AS (SELECT * FROM boundaries
  QUALIFY row_number() OVER (PARTITION BY iso_3 ORDER BY listed) = 1),
codes AS (SELECT count(*) // 2 AS n_codes FROM supplier)"""
PLANS = f"""plans AS (SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Humanitarian response plan'
    WHEN '2-HIGH' THEN 'Flash appeal; humanitarian RESPONSE plan (2)'
    WHEN '3-MEDIUM' THEN NULL ELSE 'Regional refugee plan' END AS categories,
  CAST(o_orderdate AS DATE) AS "endDate",
  {code('o_custkey % n_codes')} || ' | ' || {code('o_orderkey % n_codes')} || '|' AS locations
  FROM orders, codes),
active AS (SELECT * FROM plans WHERE categories ILIKE '%humanitarian response plan%'
  AND "endDate" >= DATE '{PLANS_AS_OF}')"""
FLAGS = """planned AS (SELECT DISTINCT trim(u) AS iso3 FROM
  (SELECT unnest(string_split(locations, '|')) AS u FROM active) WHERE trim(u) <> ''),
flags AS (SELECT iso_3 AS iso3, src_lvl, iso_3 IN (SELECT iso3 FROM planned) AS has_active_hrp
  FROM firsts),
levels AS (SELECT *, least(CASE WHEN has_active_hrp THEN 2 ELSE 1 END, src_lvl) AS max_adm_level
  FROM flags)"""
PCODES = f"""pcodes AS (SELECT {code('c_custkey % (n_codes + 3)')} AS iso3,
  c_nationkey % 5 AS adm_level, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS pcode
  FROM customer, codes),
counts AS (SELECT iso3, adm_level, count(pcode) AS n_pcodes FROM pcodes
  WHERE adm_level <= 2 GROUP BY ALL),
wide AS (SELECT iso3, CAST(1 AS BIGINT) AS adm0_pcode_count,
  CAST(sum(n_pcodes) FILTER (adm_level = 1) AS BIGINT) AS adm1_pcode_count,
  CAST(sum(n_pcodes) FILTER (adm_level = 2) AS BIGINT) AS adm2_pcode_count
  FROM counts GROUP BY iso3)"""
TOTALS = """totals AS (SELECT iso3, max_adm_level, adm0_pcode_count, adm1_pcode_count,
  CASE WHEN max_adm_level = 2 THEN adm2_pcode_count END AS adm2_pcode_count,
  adm0_pcode_count + coalesce(adm1_pcode_count, 0) +
    CASE WHEN max_adm_level = 2 THEN coalesce(adm2_pcode_count, 0) ELSE 0 END AS total_pcodes
  FROM levels JOIN wide USING (iso3))"""
COUNTRY = [BOUNDARIES, PLANS, FLAGS, PCODES, TOTALS]

# Runs

DAYS = """days AS (SELECT CAST(o_orderdate AS DATE) AS valid_date FROM orders),
span AS (SELECT min(valid_date) AS first, max(valid_date) AS last FROM days),
daily AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS valid_date
  FROM span),
monthly AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', first) AS DATE), last,
  INTERVAL 1 MONTH)) AS DATE) AS valid_date FROM span),
missing AS (SELECT valid_date FROM daily EXCEPT SELECT valid_date FROM days),
run AS (SELECT valid_date FROM monthly, span WHERE valid_date >= first + 14
  UNION SELECT valid_date FROM missing)"""

# Quality

_LEAD = "(l_linenumber - 1)"


def _spoilt(n: int, bad: str, good: str) -> str:
    return f"CASE WHEN kind = {n} THEN {bad} ELSE {good} END"


STATS_ROWS = f"""raw AS (SELECT *, {_MONTH} AS month,
  CASE WHEN l_partkey % 997 = 0 THEN l_suppkey % 12 ELSE -1 END AS kind FROM lineitem),
stats AS (SELECT
  {_spoilt(6, "'1AA'", code('l_suppkey'))} AS iso3,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pcode, month AS valid_date,
  CAST({_spoilt(7, "month + INTERVAL 9 MONTH",
    f"month - to_months({_LEAD} + CASE WHEN kind = 9 THEN 1 ELSE 0 END)")} AS DATE) AS issued_date,
  {_spoilt(8, "9", _LEAD)} AS leadtime, {_spoilt(5, "5", "l_linenumber % 3")} AS adm_level,
  l_quantity + {_spoilt(1, "11", "5")} AS mean, l_quantity + {_spoilt(2, "-1", "4")} AS median,
  {_spoilt(11, "NULL", "l_quantity")} AS min, l_quantity + {_spoilt(0, "-1", "10")} AS max,
  {_spoilt(4, "-1", "7")} AS count, {_spoilt(3, "-1.0", "1.5")} AS std FROM raw)"""
_COMMON_RULES = """CASE WHEN min > max THEN 'min_max' END,
  CASE WHEN mean < min OR mean > max THEN 'mean_between' END,
  CASE WHEN median < min OR median > max THEN 'median_between' END,
  CASE WHEN std < 0 THEN 'std_nonneg' END, CASE WHEN count < 0 THEN 'count_nonneg' END,
  CASE WHEN adm_level NOT IN (0, 1, 2, 3, 4) THEN 'adm_level' END,
  CASE WHEN NOT regexp_full_match(iso3, '[A-Z][A-Z][A-Z]') THEN 'iso3' END"""
_FORECAST_RULES = """CASE WHEN issued_date > valid_date THEN 'issued_le_valid' END,
  CASE WHEN leadtime < 0 OR leadtime > 6 THEN 'leadtime_range' END,
  CASE WHEN leadtime <> (year(valid_date) - year(issued_date)) * 12 + month(valid_date)
    - month(issued_date) THEN 'leadtime_months' END"""
CHECKED = f"""checked AS (SELECT *, concat_ws(',', {_COMMON_RULES}, {_FORECAST_RULES})
  AS violations FROM stats)"""
CHUNKED = f"""chunks AS (SELECT valid_date, CAST((row_number() OVER (ORDER BY valid_date) - 1)
  // {CHUNK_SIZE} AS INTEGER) AS chunk_id FROM (SELECT DISTINCT valid_date FROM checked)),
units AS (SELECT * FROM checked JOIN chunks USING (valid_date)),
failed AS (SELECT iso3, chunk_id, adm_level, string_split(violations, ',')[1] AS rule FROM units
  WHERE violations <> '' QUALIFY row_number() OVER (PARTITION BY iso3, chunk_id
    ORDER BY adm_level, valid_date, pcode) = 1)"""
QUALITY = [STATS_ROWS, CHECKED, CHUNKED]
KEYED = """keyed AS (SELECT 'P' || l_orderkey AS pcode,
  CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS leadtime, l_quantity AS mean,
  l_returnflag AS flag, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem)"""
_LAST = """QUALIFY row_number() OVER (PARTITION BY pcode, leadtime
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"""
_AT = f"'{AS_OF} 00:00:00'"

# Equal-area projection: the auxiliary angle by twelve Newton steps, written out.


def _newton(steps: int = 12) -> str:
    parts = ["""a0 AS (SELECT *, radians(y) AS t, pi() * sin(radians(y)) AS target FROM vertices)"""]
    for s in range(steps):
        parts.append(
            f"a{s + 1} AS (SELECT * REPLACE (t - (t + sin(t) - target) / (1 + cos(t)) AS t) FROM a{s})"
        )
    return ",\n".join(parts)


AREA = f"""{_newton()},
flat AS (SELECT iso3, adm_level, zone_idx, ring_no, i,
  6378137.0 * 2 * sqrt(2) / pi() * radians(x) * cos(t / 2) AS x,
  6378137.0 * sqrt(2) * sin(t / 2) AS y FROM a12),
flat_edges AS (SELECT {Z}, x AS x1, y AS y1,
    coalesce(lead(x) OVER ring, first_value(x) OVER ring) AS x2,
    coalesce(lead(y) OVER ring, first_value(y) OVER ring) AS y2
  FROM flat WINDOW ring AS (PARTITION BY {Z}, ring_no ORDER BY i)),
areas AS (SELECT {Z}, round(abs(sum(x1 * y2 - x2 * y1)) / 2 / 1e6, 3) AS area
  FROM flat_edges GROUP BY ALL)"""


def _degree_pixels(name: str, per_cell: int, factor: str, countries: str) -> str:
    """Raw and output pixels per zone of one grid in degrees, as CTE ``name``."""
    res = f"(160.0 / n / {per_cell})"
    body = ",\n".join(
        [
            country_windows("-80.0", "80.0", res, f"n * {per_cell}"),
            pixels(factor, "-80.0", "80.0", res),
        ]
    )
    for cte in ("lines", "bounds", "win", "fine", "frows", "fcols", "px", "hits", "owned"):
        for before, after in ((" ", " "), (" ", ","), (" ", "\n"), ("\n", " "), (" ", ")"), ("", "."), ("", " AS")):
            body = body.replace(f"{before}{cte}{after}", f"{before}{cte}_{name}{after}")
    return f"""{body},
{name} AS (SELECT z.iso3, z.adm_level, z.zone_idx,
  CAST(count(DISTINCT CASE WHEN o.row IS NOT NULL THEN (o.row, o.col) END) AS INTEGER) AS raw, CAST(count(o.row) AS INTEGER) AS fine_n,
  round(count(o.row) / (f.new_w / f.w * (f.new_w / f.w)), 6) AS frac
  FROM zones z JOIN fine_{name} f ON f.iso3 = z.iso3
  LEFT JOIN owned_{name} o ON o.iso3 = z.iso3 AND o.adm_level = z.adm_level
    AND o.zone_idx = z.zone_idx
  WHERE {countries} GROUP BY z.iso3, z.adm_level, z.zone_idx, f.new_w, f.w)"""


DEGREE_SCENE = [P, SHAPES, ZONES, vertices(DEGREES)]
COARSE = _degree_pixels("coarse", 1, FACTOR, "TRUE")
FINE_GRID = _degree_pixels("dense", 2, "1.0", f"z.iso3 IN ({listed(DEGREE_COVERAGE)})")

# Upsampling the whole raster before clipping.
LATE = """whole AS (SELECT n, CAST(floor(n * FACTOR) AS BIGINT) AS m FROM p),
late_lines AS (SELECT unnest(range(m)) AS i FROM whole),
late_win AS (
  SELECT * FROM
    (SELECT iso3, i AS fr FROM bounds, late_lines, whole
     WHERE n - (i + 0.5) * (n * 1.0 / m) BETWEEN miny AND maxy)
  JOIN (SELECT iso3, i AS fc FROM bounds, late_lines, whole
     WHERE (i + 0.5) * (n * 1.0 / m) BETWEEN minx AND maxx) USING (iso3)),
late_px AS (SELECT iso3, fr, fc, ((2 * fr + 1) * n) // (2 * m) AS row,
  ((2 * fc + 1) * n) // (2 * m) AS col, (fc + 0.5) * (n * 1.0 / m) AS x,
  n - (fr + 0.5) * (n * 1.0 / m) AS y FROM late_win, whole),
late_hits AS (
  SELECT late_px.iso3, adm_level, fr, fc, row, col, zone_idx
  FROM late_px JOIN edges ON late_px.iso3 = edges.iso3 AND (y1 > y) <> (y2 > y)
  WHERE adm_level = 1 AND x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x
  GROUP BY ALL HAVING count(*) % 2 = 1),
late_owned AS (SELECT iso3, adm_level, fr, fc, row, col, max(zone_idx) AS zone_idx
  FROM late_hits GROUP BY ALL)""".replace("FACTOR", FACTOR)


def _late_agg(name: str, source: str, select: str) -> str:
    return f"""{name} AS (SELECT valid_date, {Z}, {select} FROM cells
  JOIN {source} USING (row, col) WHERE adm_level = 1 GROUP BY ALL)"""


_MC = "round(avg(value), 6) AS mean, CAST(count(value) AS BIGINT) AS count"
_FOUR = "avg(value) AS mean, median(value) AS median, min(value) AS min, max(value) AS max"


def _compare() -> str:
    plain = pixels("1.0")
    for cte in ("fine", "frows", "fcols", "px", "hits", "owned"):
        for after in (" ", ",", "\n", ".", ")"):
            for before in (" ", "\n", "(", "") if after == "." else (" ", "\n", "("):
                plain = plain.replace(f"{before}{cte}{after}", f"{before}{cte}_1{after}")
        if plain.startswith(f"{cte} "):
            plain = plain.replace(f"{cte} ", f"{cte}_1 ", 1)
    diffs = {
        f"{s}_diff_db_{o}": f"round(abs(({o}.{s} - db.{s}) / (({o}.{s} + db.{s}) / 2) * 100), 4)"
        for o in ("up", "late")
        for s in ("mean", "median", "min", "max")
    }
    values = [
        f"round({t}.mean, 6) AS mean_{t}, {t}.median AS median_{t}, {t}.min AS min_{t}, {t}.max AS max_{t}"
        for t in ("db", "up", "late")
    ]
    return (
        with_(
            *UPSAMPLED,
            plain,
            LATE,
            OBS,
            _late_agg("db", "owned_1", _FOUR),
            _late_agg("up", "owned", _FOUR),
            _late_agg("late", "late_owned", _FOUR),
            f"""joined AS (SELECT valid_date, {Z}, {", ".join(values)},
  {", ".join(f"{e} AS {c}" for c, e in diffs.items())}
  FROM db JOIN up USING (valid_date, {Z}) JOIN late USING (valid_date, {Z}))""",
        )
        + f"""SELECT *, greatest({", ".join(diffs)}) AS max_difference FROM joined
WHERE greatest({", ".join(diffs)}) > 5"""
    )


# A pixel is touched if a boundary meets its square: boxes overlap, and the pixel's corners are
# not all on one side of the edge.
TOUCHED = """squares AS (SELECT *, x - 0.5 AS xa, x + 0.5 AS xb, y - 0.5 AS ya, y + 0.5 AS yb FROM px),
touching AS (
  SELECT s.iso3, adm_level, s.row, s.col, zone_idx FROM squares s JOIN edges e ON s.iso3 = e.iso3
    AND least(x1, x2) <= xb AND greatest(x1, x2) >= xa
    AND least(y1, y2) <= yb AND greatest(y1, y2) >= ya
  WHERE least((x2 - x1) * (ya - y1) - (y2 - y1) * (xa - x1),
      (x2 - x1) * (ya - y1) - (y2 - y1) * (xb - x1),
      (x2 - x1) * (yb - y1) - (y2 - y1) * (xa - x1),
      (x2 - x1) * (yb - y1) - (y2 - y1) * (xb - x1)) <= 0
    AND greatest((x2 - x1) * (ya - y1) - (y2 - y1) * (xa - x1),
      (x2 - x1) * (ya - y1) - (y2 - y1) * (xb - x1),
      (x2 - x1) * (yb - y1) - (y2 - y1) * (xa - x1),
      (x2 - x1) * (yb - y1) - (y2 - y1) * (xb - x1)) >= 0)"""

# Farthest-vertex splitting of closed lines; every step splits all open segments at once.
SIMPLIFY = f"""WITH RECURSIVE border AS (SELECT c_nationkey AS nation, c_custkey AS pos,
  (1.0 + c_acctbal / 50000) * cos(c_custkey * (2 * pi() / n)) AS x,
  (1.0 + c_acctbal / 50000) * sin(c_custkey * (2 * pi() / n)) AS y
  FROM customer, (SELECT count(*) AS n FROM customer)),
anchor AS (SELECT nation, min(pos) AS lo, max(pos) + 1 AS hi, arg_min(x, pos) AS ux,
  arg_min(y, pos) AS uy FROM border GROUP BY nation),
part(nation, pos, x, y, lo, hi, ux, uy, vx, vy, kept) AS (
  SELECT b.nation, pos, x, y, lo, hi, ux, uy, ux, uy, pos = lo FROM border b
    JOIN anchor a ON a.nation = b.nation
  UNION ALL
  SELECT nation, pos, x, y, CASE WHEN pos < sp THEN lo ELSE sp END,
    CASE WHEN pos < sp THEN sp ELSE hi END, CASE WHEN pos < sp THEN ux ELSE sx END,
    CASE WHEN pos < sp THEN uy ELSE sy END, CASE WHEN pos < sp THEN sx ELSE vx END,
    CASE WHEN pos < sp THEN sy ELSE vy END, pos = sp
  FROM (SELECT *, max(d) OVER w AS reach, arg_max(pos, d) OVER w AS sp,
      arg_max(x, d) OVER w AS sx, arg_max(y, d) OVER w AS sy
    FROM (SELECT *, sqrt((x - ux - t * (vx - ux)) ** 2 + (y - uy - t * (vy - uy)) ** 2) AS d
      FROM (SELECT *, CASE WHEN ux = vx AND uy = vy THEN 0.0 ELSE
          greatest(0.0, least(1.0, ((x - ux) * (vx - ux) + (y - uy) * (vy - uy)) /
            ((vx - ux) ** 2 + (vy - uy) ** 2))) END AS t FROM part WHERE NOT kept))
    WINDOW w AS (PARTITION BY nation, lo))
  WHERE reach > {TOLERANCE})
SELECT nation, pos, round(x, 6) AS x, round(y, 6) AS y FROM part WHERE kept"""

INT = "CAST({0} AS INTEGER) AS {0}".format
ROWCOL = f"{INT('row')}, {INT('col')}"

def _tile_stats(where: str) -> str:
    """Statistics of the small tiles, as they are stored."""
    return (
        with_(
            P_TILE,
            SHAPES,
            ZONES,
            vertices(),
            country_windows(),
            pixels("1.0"),
            f"""cells AS (SELECT {TILE_DAY} AS valid_date, (i - 1) // 8 AS row, (i - 1) % 8 AS col,
  CAST(embedding[i] AS DOUBLE) AS value
  FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings WHERE {where}))""",
            agg("valid_date", AGG.replace("round(avg(value), 6)", "avg(value)").replace(
                "round(stddev_pop(value), 6)", "stddev_pop(value)"
            ), "adm_level < 2"),
            DUE_ALL,
        )
        + "SELECT iso3, pcode, valid_date, adm_level, "
        + ", ".join(
            f"CAST(CAST({s} AS FLOAT) AS DOUBLE) AS {s}"
            for s in ("mean", "median", "min", "max", "sum", "std")
        )
        + ", CAST(count AS INTEGER) AS count, 'embeddings' AS dataset FROM ("
        + dense(["valid_date"], "due", "z.adm_level < 2")
        + ")"
    )


# Exact coverage: for each cell of a zone's box and each edge in its row, the area between the edge
# and the cell's right side, as an integral in closed form.

_PART = "CASE WHEN {t} <= 0 THEN 0.0 WHEN {t} >= 1 THEN {t} - 0.5 ELSE {t} * {t} / 2 END"
SHARES = f"""ring_edges AS (SELECT {Z}, ring_no, x AS x1, y AS y1,
    coalesce(lead(x) OVER ring, first_value(x) OVER ring) AS x2,
    coalesce(lead(y) OVER ring, first_value(y) OVER ring) AS y2
  FROM vertices WINDOW ring AS (PARTITION BY {Z}, ring_no ORDER BY i)),
turns AS (SELECT {Z}, ring_no, sign(sum(x1 * y2 - x2 * y1)) * CASE ring_no WHEN 0 THEN 1 ELSE -1 END AS s
  FROM ring_edges GROUP BY {Z}, ring_no),
boxes AS (SELECT {Z}, greatest(floor(min(x1)), 0)::BIGINT AS c0, least(ceil(max(x1)), any_value(n))::BIGINT AS c1,
    greatest(any_value(n) - ceil(max(y1)), 0)::BIGINT AS r0, least(any_value(n) - floor(min(y1)), any_value(n))::BIGINT AS r1
  FROM ring_edges, p GROUP BY {Z}),
rowed AS (SELECT {Z}, c0, c1, unnest(range(r0, r1)) AS row FROM boxes),
cut AS (SELECT r.*, s, x1, y1, x2, y2, greatest(least(y1, n - row), n - row - 1) AS ya,
    greatest(least(y2, n - row), n - row - 1) AS yb
  FROM rowed r JOIN ring_edges e USING ({Z}) JOIN turns USING ({Z}, ring_no), p
  WHERE least(y1, y2) < n - row AND greatest(y1, y2) > n - row - 1),
ends AS (SELECT *, ya - yb AS climb, x1 + (ya - y1) * (x2 - x1) / (y2 - y1) AS xa,
    x1 + (yb - y1) * (x2 - x1) / (y2 - y1) AS xb FROM cut WHERE ya <> yb),
celled AS (SELECT *, unnest(range(c0, c1)) AS col FROM ends),
parts AS (SELECT {Z}, row, col, s * climb * CASE WHEN abs(xb - xa) < 1e-12 THEN greatest(0.0, least(1.0, col + 1 - xa))
    ELSE ({_PART.format(t="(col + 1 - xa)")} - {_PART.format(t="(col + 1 - xb)")}) / (xb - xa) END AS w FROM celled),
shares AS (SELECT {Z}, row, col, sum(w) AS w FROM parts GROUP BY {Z}, row, col HAVING sum(w) > 1e-9)"""


def _exact(level: str = "adm_level = 1") -> str:
    def quantile(share: float) -> str:
        return f"""(min(value) FILTER (upto >= total * {share} * (1 - 1e-9)) +
    coalesce(min(value) FILTER (upto > total * {share} * (1 + 1e-9)), max(value))) / 2"""

    more = "".join(f", {quantile(q)} AS q{round(100 * q):02d}" for q in QUARTILES)
    return f"""met AS (SELECT valid_date, {Z}, value, w FROM cells JOIN shares USING (row, col)
  WHERE value IS NOT NULL AND {level}),
ranked AS (SELECT *, sum(w) OVER (g ORDER BY value RANGE UNBOUNDED PRECEDING) AS upto, sum(w) OVER g AS total,
    sum(value * w) OVER g / sum(w) OVER g AS m FROM met WINDOW g AS (PARTITION BY valid_date, {Z})),
exact AS (SELECT valid_date, {Z}, sum(value * w) / sum(w) AS mean, {quantile(0.5)} AS median, min(value) AS min,
    max(value) AS max, sum(value * w) AS sum, sqrt(sum(w * (value - m) * (value - m)) / sum(w)) AS std,
    sum(w) AS count{more} FROM ranked GROUP BY valid_date, {Z})"""


def _compare_exact() -> str:
    diffs = {
        f"{s}_diff_db_ee": f"round(abs((ee.{s} - db.{s}) / ((ee.{s} + db.{s}) / 2) * 100), 4)" for s in ("mean", "median", "min", "max")
    }
    values = ", ".join(
        f"round({t}.mean, 6) AS mean_{t}, {t}.median AS median_{t}, {t}.min AS min_{t}, {t}.max AS max_{t}" for t in ("db", "ee")
    )
    db = agg("valid_date", "avg(value) AS mean, median(value) AS median, min(value) AS min, max(value) AS max").replace("agg AS", "db AS", 1)
    joined = f"""joined AS (SELECT valid_date, {Z}, {values}, {", ".join(f"{e} AS {c}" for c, e in diffs.items())}
  FROM db JOIN exact ee USING (valid_date, {Z}))"""
    return with_(*PLAIN, OBS, db, SHARES, _exact(), joined) + f"""SELECT *, greatest({", ".join(diffs)}) AS max_difference
FROM joined WHERE greatest({", ".join(diffs)}) > 5"""


ORACLES: dict[str, str] = {
    "tile_to_cells": with_(TILES)
    + f"""SELECT vec_id, CAST((i - 1) // 8 AS INTEGER) AS row, CAST((i - 1) % 8 AS INTEGER) AS col,
  CAST(embedding[i] AS DOUBLE) AS value, (i - 1) % 8 + 0.5 AS x, 8 - ((i - 1) // 8 + 0.5) AS y
FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM tiles)""".replace(
        "(i - 1) % 8 + 0.5 AS x", "CAST((i - 1) % 8 + 0.5 AS DOUBLE) AS x"
    ).replace("8 - ((i - 1) // 8 + 0.5) AS y", "CAST(8 - ((i - 1) // 8 + 0.5) AS DOUBLE) AS y"),
    "valid_date_daily": with_(TILES)
    + """SELECT path, CASE WHEN dated = 1 THEN day END AS valid_date,
  CASE WHEN dated = 1 THEN '' ELSE 'date_valid' END AS missing FROM tiles""",
    "valid_date_monthly": with_(TILES)
    + "SELECT path, CAST(date_trunc('month', day) AS DATE) AS valid_date, '' AS missing FROM tiles",
    "valid_date_forecast": with_(TILES)
    + """SELECT path, CASE WHEN leadtime IS NOT NULL THEN CAST(date_trunc('month', day) AS DATE) END
  AS valid_date, leadtime, CASE WHEN leadtime IS NULL THEN 'leadtime' ELSE '' END AS missing
FROM tiles""",
    "date_from_name": with_(FILES) + "SELECT path, file_date FROM catalog",
    "files_for_dates": with_(FILES)
    + """SELECT path, file_date FROM catalog WHERE path LIKE 'daily/%' AND file_date IN
  (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "selection_counts": with_(FILES)
    + """SELECT count(*) AS n_files, count(DISTINCT file_date) AS n_dates_found, n_dates,
  count(DISTINCT file_date) = n_dates AS complete
FROM catalog, (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates FROM orders)
WHERE path LIKE 'monthly/%' GROUP BY n_dates""",
    "latest_date": with_(FILES)
    + "SELECT max(file_date) AS latest FROM catalog WHERE path LIKE 'daily/processed/%'",
    "stack_union": with_(
        P,
        OBS,
        FORECAST.replace("cells AS", "fc AS", 1),
        BAND.replace("cells AS", "bc AS", 1),
    )
    + f"""SELECT valid_date, {ROWCOL}, value, CAST(NULL AS INTEGER) AS leadtime,
  CAST(NULL AS INTEGER) AS band FROM cells
UNION ALL SELECT valid_date, {ROWCOL}, value, leadtime, NULL FROM fc
UNION ALL SELECT valid_date, {ROWCOL}, value, NULL, band_no FROM bc""",
    "grid_template": """SELECT 'd' || vec_id % 7 AS dataset, CAST(min(vec_id) AS DOUBLE) AS x0,
  CAST(8 AS DOUBLE) AS y0, CAST(1 AS DOUBLE) AS res,
  CAST(max(vec_id) - min(vec_id) + 8 AS INTEGER) AS width, 8 AS height, TRUE AS even
FROM embeddings GROUP BY vec_id % 7""",
    "iso3_filter": with_(BOUNDARIES)
    + f"SELECT * RENAME (iso_3 AS iso3) FROM boundaries WHERE iso_3 IN ({listed(SOME_CODES)})",
    "dedupe_first": with_(BOUNDARIES) + "SELECT * FROM firsts",
    "stats_slice": with_(*OBSERVED)
    + dense(
        ["valid_date"],
        "due",
        "z.adm_level = 1 AND z.iso3 = 'RBX' AND d.valid_date = DATE '1998-05-01'",
    ),
    "bbox_clip": with_(*SCENE, OBS)
    + f"""SELECT iso3, valid_date, {ROWCOL}, value FROM cells, bounds, p
WHERE col + 0.5 BETWEEN minx AND maxx AND n - (row + 0.5) BETWEEN miny AND maxy""",
    "zone_bounds": with_(P, SHAPES, ZONES, vertices())
    + """SELECT iso3, adm_level, round(min(x), 6) AS minx, round(min(y), 6) AS miny,
  round(max(x), 6) AS maxx, round(max(y), 6) AS maxy FROM vertices GROUP BY ALL""",
    "allnan_skip": with_(*SCENE, *PATCHY_CELLS, due_filled("valid_date, leadtime"))
    + "SELECT * FROM due",
    "coverage_filter": with_(BOUNDARIES)
    + f"""SELECT 'BUILDING' AS dataset, iso_3 AS iso3, src_lvl FROM firsts WHERE iso_3 IN
  (SELECT {code('c_custkey')} FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 'UNLISTED', iso_3, src_lvl FROM firsts""",
    "level_filter": with_(P, ZONES, COUNTRIES)
    + f"""SELECT {Z}, pcode FROM zones JOIN countries USING (iso3)
WHERE adm_level <= max_adm_level""",
    "active_filter": with_(BOUNDARIES, PLANS) + "SELECT * FROM active",
    "band_label": with_(P, BAND)
    + f"""SELECT valid_date, CASE band_no WHEN 1 THEN 'SFED' ELSE 'MFED' END AS band, {ROWCOL}, value
FROM cells""",
    "issued_date": with_(FORECAST)
    + f"""SELECT valid_date, leadtime, {ROWCOL}, value,
  CAST(valid_date - to_months(CAST(leadtime AS INTEGER)) AS DATE) AS issued_date FROM cells""",
    "max_adm_level": with_(BOUNDARIES, PLANS, FLAGS) + "SELECT * FROM levels",
    "split_codes": with_(BOUNDARIES, PLANS)
    + """SELECT DISTINCT trim(u) AS iso3 FROM
  (SELECT unnest(string_split(locations, '|')) AS u FROM plans) WHERE trim(u) <> ''""",
    "membership_flags": with_(BOUNDARIES, PLANS, FLAGS) + "SELECT * FROM flags",
    "rasterize": with_(*PLAIN) + f"SELECT {Z}, {ROWCOL} FROM owned",
    "rasterize_touched": with_(*PLAIN, TOUCHED)
    + f"""SELECT iso3, adm_level, max(zone_idx) AS zone_idx, {ROWCOL} FROM
  (SELECT iso3, adm_level, row, col, zone_idx FROM hits
   UNION SELECT iso3, adm_level, row, col, zone_idx FROM touching)
GROUP BY iso3, adm_level, row, col""",
    "zone_weights": with_(*UPSAMPLED)
    + f"SELECT {Z}, {ROWCOL}, count(*) AS w FROM owned GROUP BY {Z}, row, col",
    "point_in_zone": with_(P, SHAPES, ZONES, vertices())
    + f"""SELECT c_custkey, {Z} FROM
  (SELECT c_custkey, c_custkey * 37 % (10 * n) / 10.0 + 0.013 AS x,
    c_custkey * 91 % (10 * n) / 10.0 + 0.017 AS y FROM customer, p)
  JOIN edges ON (y1 > y) <> (y2 > y)
WHERE x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x
GROUP BY ALL HAVING count(*) % 2 = 1""",
    "upsample_nearest": with_(
        P,
        OBS,
        f"whole AS (SELECT n, CAST(floor(n * {FACTOR}) AS BIGINT) AS m FROM p)",
        "fine AS (SELECT unnest(range(m)) AS i, n, m FROM whole)",
        "back AS (SELECT i, CAST(floor((i + 0.5) * n / m) AS BIGINT) AS src FROM fine)",
    )
    + """SELECT valid_date, CAST(a.i AS INTEGER) AS row, CAST(b.i AS INTEGER) AS col, value
FROM cells JOIN back a ON a.src = cells.row JOIN back b ON b.src = cells.col""",
    "prep_clip_first": with_(*UPSAMPLED, OBS)
    + """SELECT iso3, valid_date, CAST(fr AS INTEGER) AS row, CAST(fc AS INTEGER) AS col, value
FROM cells JOIN px USING (row, col)""",
    "prep_order_diff": with_(
        *UPSAMPLED,
        LATE,
        OBS,
        _late_agg("a", "owned", _MC),
        _late_agg("b", "late_owned", _MC),
    )
    + f"""SELECT valid_date, {Z}, a.mean AS mean_clip_first, a.count AS count_clip_first,
  b.mean AS mean_upsample_first, b.count AS count_upsample_first
FROM a FULL JOIN b USING (valid_date, {Z})""",
    "simplify_rings": SIMPLIFY,
    "dissolve_pixels": with_(*PLAIN)
    + f"SELECT DISTINCT iso3, adm_level, {ROWCOL} FROM hits WHERE adm_level = 2",
    "zone_area_km2": with_(*DEGREE_SCENE, AREA) + f"SELECT {Z}, area FROM areas",
    "shoelace_area": with_(P, SHAPES, ZONES, vertices())
    + f"""SELECT {Z}, round(abs(sum(x1 * y2 - x2 * y1)) / 2, 6) AS area FROM edges GROUP BY ALL""",
    "cell_zone_join": with_(*PLAIN, OBS)
    + f"SELECT valid_date, {ROWCOL}, value, {Z} FROM cells JOIN owned USING (row, col)",
    "zonal_stats": OBSERVED_SQL,
    "zonal_stats_leadtime": with_(
        *PLAIN,
        *PATCHY_CELLS,
        agg("valid_date, leadtime", level="adm_level = 1"),
        due_filled("valid_date, leadtime"),
    )
    + dense(VD_LT, "due", "z.adm_level = 1", extra=ISSUED),
    "zonal_stats_band": with_(
        *PLAIN,
        BAND.replace("cells AS", "band_cells AS", 1),
        """cells AS (SELECT * EXCLUDE (band_no), CASE band_no WHEN 1 THEN 'SFED' ELSE 'MFED' END
  AS band FROM band_cells)""",
        agg(
            "valid_date, band",
            AGG.replace("median(value)", "round(median(value), 6)").replace(
                "coalesce(sum(value), 0.0)", "round(coalesce(sum(value), 0.0), 6)"
            ),
            "adm_level = 1",
        ),
        due_filled("valid_date, band"),
    )
    + dense(["valid_date", "band"], "due", "z.adm_level = 1"),
    "zonal_stats_levels": with_(
        *UPSAMPLED,
        COUNTRIES,
        FORECAST,
        agg("valid_date, leadtime"),
        due_filled("valid_date, leadtime"),
        "used AS (SELECT * FROM zones JOIN countries USING (iso3) WHERE adm_level <= max_adm_level)",
    )
    + dense(VD_LT, "due", "TRUE", "used", ISSUED),
    "zonal_stats_large_zones": with_(
        *UPSAMPLED,
        OBS,
        agg("valid_date", AGG + ",\n  count(DISTINCT value) AS unique", "adm_level = 0"),
    )
    + "SELECT * FROM agg",
    "stat_subset": with_(
        *PLAIN,
        OBS,
        agg(
            "valid_date",
            "round(avg(value), 6) AS mean, max(value) AS max, CAST(count(value) AS BIGINT) AS count",
        ),
    )
    + "SELECT * FROM agg",
    "unique_stat": with_(
        *UPSAMPLED,
        *NAN_CELLS,
        agg(
            "valid_date",
            "CAST(count(value) AS BIGINT) AS count, count(DISTINCT value) AS unique",
        ),
    )
    + "SELECT * FROM agg",
    "densify_zones": with_(*PLAIN, *NAN_CELLS, agg("valid_date", level="adm_level = 2"), DUE_ALL)
    + dense(["valid_date"], "due", "z.adm_level = 2"),
    "pixel_metadata": with_(*DEGREE_SCENE, COARSE)
    + f"""SELECT {Z}, raw AS n_intersect_raw_pixels, frac AS frac_raw_pixels,
  fine_n AS n_upsampled_pixels FROM coarse""",
    "polygon_meta": with_(*DEGREE_SCENE, COUNTRIES, AREA, COARSE, FINE_GRID)
    + f"""SELECT pcode, iso3, adm_level, name, 'EN' AS name_language, area, TRUE AS standard,
  c.raw AS coarse_n_intersect_raw_pixels, c.frac AS coarse_frac_raw_pixels,
  c.fine_n AS coarse_n_upsampled_pixels, d.raw AS fine_n_intersect_raw_pixels,
  d.frac AS fine_frac_raw_pixels, d.fine_n AS fine_n_upsampled_pixels
FROM zones JOIN countries USING (iso3) JOIN areas USING ({Z}) LEFT JOIN coarse c USING ({Z})
LEFT JOIN dense d USING ({Z}) WHERE adm_level <= max_adm_level""",
    "pcode_counts": with_(BOUNDARIES, PCODES) + "SELECT * FROM counts",
    "pcode_pivot": with_(BOUNDARIES, PCODES) + "SELECT * FROM wide",
    "iso3_counts": with_(*COUNTRY)
    + """SELECT iso3, max_adm_level, adm0_pcode_count, adm1_pcode_count, adm2_pcode_count
FROM levels JOIN wide USING (iso3)""",
    "total_pcodes": with_(*COUNTRY) + "SELECT * FROM totals",
    "iso3_meta": with_(*COUNTRY)
    + f"""SELECT iso3, src_update, o_shp, has_active_hrp, max_adm_level,
  CAST(NULL AS DATE) AS stats_last_updated, iso3 IN ({listed(SOME_CODES)}) AS floodscan,
  adm0_pcode_count, adm1_pcode_count, adm2_pcode_count, total_pcodes
FROM totals JOIN levels USING (iso3, max_adm_level) JOIN firsts ON iso_3 = iso3""",
    "admin_lookup": """WITH r AS (SELECT *, 'R' || chr(CAST(65 + r_regionkey AS INTEGER)) || 'X' AS i
  FROM region), n AS (SELECT * FROM nation JOIN r ON n_regionkey = r_regionkey)
SELECT i AS ISO3, 'R' || r_regionkey AS ADM0_PCODE, r_name AS ADM0_NAME, NULL AS ADM1_PCODE,
  NULL AS ADM1_NAME, NULL AS ADM2_PCODE, NULL AS ADM2_NAME, 'EN' AS NAME_LANGUAGE, 0 AS ADM_LEVEL
FROM r UNION ALL SELECT i, 'R' || r_regionkey, r_name, 'N' || n_nationkey, n_name, NULL, NULL,
  'FR', 1 FROM n
UNION ALL SELECT i, 'R' || r_regionkey, r_name, 'N' || n_nationkey, n_name, 'S' || s_suppkey,
  s_name, 'ES', 2 FROM supplier JOIN n ON s_nationkey = n_nationkey""",
    "date_spine": with_(DAYS)
    + """SELECT 'D' AS frequency, valid_date FROM daily
UNION ALL SELECT 'M', valid_date FROM monthly""",
    "missing_dates": with_(DAYS) + "SELECT valid_date FROM missing",
    "missing_issue_dates": with_(DAYS)
    + """SELECT CAST(unnest(range(date_trunc('month', low), high + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS DATE)
  AS valid_date FROM (SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem)
EXCEPT SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders""",
    "run_dates": with_(DAYS) + "SELECT valid_date FROM run",
    "date_chunks": with_(DAYS)
    + """SELECT valid_date, CAST((row_number() OVER (ORDER BY valid_date) - 1) // 100 AS INTEGER)
  AS chunk_id FROM (SELECT DISTINCT valid_date FROM days)""",
    "run_summary": with_(DAYS)
    + """SELECT 'orders' AS dataset, 'backfill' AS mode, (count(*) + 99) // 100 AS n_chunks,
  count(*) AS n_dates, min(valid_date) AS first_date, max(valid_date) AS last_date,
  (SELECT count(*) FROM missing) AS n_missing, 'RAX,RBX' AS iso3_filter FROM run""",
    "update_latest": OBSERVED_SQL,
    "backfill": OBSERVED_SQL,
    "validate_rows": with_(*QUALITY)
    + "SELECT pcode, valid_date, leadtime, adm_level, violations FROM checked",
    "validate_observations": with_(STATS_ROWS)
    + f"""SELECT pcode, valid_date, concat_ws(',', {_COMMON_RULES},
  CASE WHEN valid_date > DATE '{AS_OF}' THEN 'not_future' END) AS violations FROM stats""",
    "violation_summary": with_(*QUALITY)
    + """SELECT adm_level, rule, count(*) AS n_rows FROM
  (SELECT adm_level, unnest(string_split(violations, ',')) AS rule FROM checked
   WHERE violations <> '') GROUP BY ALL""",
    "quarantine": with_(*QUALITY)
    + """SELECT iso3, chunk_id, pcode, valid_date, leadtime, mean, count FROM units
WHERE (iso3, chunk_id) NOT IN (SELECT (iso3, chunk_id) FROM failed)""",
    "qa_rows": with_(*QUALITY)
    + f"""SELECT {_AT} AS date, iso3, adm_level, 'seas5' AS dataset,
  'Validation error: ' || rule AS error, rule AS stack_trace FROM failed""",
    "duplicate_keys": with_(KEYED)
    + "SELECT pcode, leadtime, count(*) AS n_rows FROM keyed GROUP BY ALL HAVING count(*) > 1",
    "duplicate_rule": with_(
        KEYED,
        "counted AS (SELECT flag, count(*) OVER (PARTITION BY pcode, leadtime) AS c FROM keyed)",
    )
    + """SELECT flag, CASE WHEN c > 1 THEN 'duplicate_key' ELSE '' END AS violations,
  count(*) AS n_rows FROM counted GROUP BY ALL""",
    "empty_clip_qa": with_(
        P,
        SHAPES,
        ZONES,
        vertices(),
        "boxes AS (SELECT zone_idx, iso3, min(x) AS minx, min(y) AS miny, max(x) AS maxx, "
        "max(y) AS maxy FROM vertices WHERE adm_level = 2 GROUP BY ALL)",
        "lines AS (SELECT unnest(range(n)) AS i, n FROM p)",
    )
    + f"""SELECT {_AT} AS date, pcode AS iso3, CAST(NULL AS INTEGER) AS adm_level,
  'coarse' AS dataset, 'no_cells_in_bounds' AS error,
  'no_cells_in_bounds' AS stack_trace FROM zones z
WHERE adm_level = 2 AND NOT EXISTS (SELECT 1 FROM boxes b, lines l
  WHERE b.iso3 = z.iso3 AND b.zone_idx = z.zone_idx AND i < n // 2
    AND n / 2.0 - (i + 0.5) BETWEEN miny AND maxy)""",
    "upsert_stats": with_(
        KEYED,
        f"stored AS (SELECT * FROM keyed {_LAST})",
        f"arrived AS (SELECT * FROM keyed WHERE flag = 'R' {_LAST})",
    )
    + """SELECT pcode, leadtime, mean + 1000 AS mean, flag FROM arrived
UNION ALL SELECT s.pcode, s.leadtime, s.mean, s.flag FROM stored s WHERE NOT EXISTS
  (SELECT 1 FROM arrived a WHERE a.pcode = s.pcode AND a.leadtime IS NOT DISTINCT FROM s.leadtime)""",
    "compare_stats": _compare(),
    "stream_update": _tile_stats("TRUE"),
    "multi_tile_stats": _tile_stats("TRUE"),
    "archive_run": _tile_stats("vec_id % 10 NOT IN (3, 9)"),
    "backfill_run": _tile_stats("vec_id % 10 <> 9"),
    "qa_log": with_(TILES)
    + """SELECT CAST(NULL AS VARCHAR) AS iso3, CAST(NULL AS INTEGER) AS adm_level,
  'embeddings' AS dataset, 'missing_attribute: ' || path || ' lacks date_valid' AS error,
  'missing_attribute' AS stack_trace FROM tiles WHERE vec_id % 10 = 9
UNION ALL SELECT NULL, NULL, 'embeddings', 'conflicting_tiles: ' || CAST(day AS DATE), 'conflicting_tiles'
FROM tiles WHERE vec_id % 10 = 3""",
    "run_report": """SELECT 'embeddings' AS dataset, 'full' AS mode, CAST(0 AS BIGINT) AS n_missing,
  count(*) + count(*) FILTER (vec_id % 10 = 3) AS n_files, CAST(0 AS BIGINT) AS n_undated,
  CAST(0 AS BIGINT) AS n_failed, count(*) FILTER (vec_id % 10 = 3) AS n_conflicts FROM embeddings""",
    "conflicting_tiles": f"""SELECT {TILE_DAY} AS day,
  CAST(CASE WHEN vec_id % 10 = 3 THEN 5 ELSE 4 END AS BIGINT) AS n_tiles
FROM embeddings WHERE vec_id % 10 IN (3, 4)""",
    "simplify_zones": f"""WITH found AS ({SIMPLIFY})
SELECT CAST(nation AS INTEGER) AS zone_idx, 0 AS ring_no,
  CAST(row_number() OVER (PARTITION BY nation ORDER BY pos) - 1 AS INTEGER) AS nth, x, y FROM found
UNION ALL SELECT nation, 1, nth, x, y FROM (SELECT DISTINCT CAST(c_nationkey AS INTEGER) AS nation
  FROM customer), (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, 1.0, 0.001), (2, 2.0, 0.0)) v(nth, x, y)""",
    "zonal_stats_mixed_zones": with_(*PLAIN, OBS, agg("valid_date")) + "SELECT * FROM agg",
    "level_filter_zones": with_(P, SHAPES, ZONES, COUNTRIES)
    + """SELECT z.iso3, z.adm_level, z.zone_idx, z.pcode FROM zones z JOIN countries c USING (iso3)
WHERE z.adm_level <= c.max_adm_level""",
    "stored_zones": with_(P, SHAPES, ZONES) + "SELECT iso3, adm_level, zone_idx, pcode FROM zones",
}

ORACLES |= {
    "point_cover": ORACLES["point_in_zone"],
    "coverage_weights": with_(P, SHAPES, ZONES, vertices(), SHARES)
    + f"SELECT {Z}, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, round(w, 6) AS w FROM shares WHERE round(w, 6) > 0",
    "zonal_stats_exact": with_(P, SHAPES, ZONES, vertices(), SHARES, OBS, _exact())
    + "SELECT * REPLACE (round(mean, 6) AS mean, round(sum, 6) AS sum, round(std, 6) AS std, round(count, 6) AS count) FROM exact",
    "compare_exact": _compare_exact(),
    "zonal_stats_runs": with_(
        *PLAIN,
        OBS,
        agg(
            "valid_date",
            """round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max, round(sum(value), 6) AS sum,
  round(stddev_pop(value), 6) AS std, CAST(count(value) AS BIGINT) AS count""",
        ),
    )
    + "SELECT * FROM agg",
}

_SPLIT = SIMPLIFY[SIMPLIFY.index("part(nation") : SIMPLIFY.index("SELECT nation, pos, round(x, 6)")]
ORACLES |= {
    # The same division of segments, on open lines from their first to their last vertex.
    "simplify_shared": """WITH RECURSIVE raw AS (SELECT c_nationkey AS nation, c_custkey / n::DOUBLE AS x,
  c_acctbal / 50000 + 10 * c_nationkey AS y FROM customer, (SELECT count(*) AS n FROM customer)),
line AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY x, y) AS pos,
  count(*) OVER (PARTITION BY nation) AS n FROM raw QUALIFY n > 1),
anchor AS (SELECT nation, min(pos) AS lo, max(pos) AS hi, arg_min(x, pos) AS ux, arg_min(y, pos) AS uy,
  arg_max(x, pos) AS wx, arg_max(y, pos) AS wy FROM line GROUP BY nation),
border AS (SELECT l.nation, pos, x, y FROM line l JOIN anchor a ON a.nation = l.nation AND pos > lo AND pos < hi),
"""
    + _SPLIT.replace("ux, uy, ux, uy, pos = lo FROM border", "ux, uy, wx, wy, FALSE FROM border")
    + """, found AS (SELECT nation, x, y FROM part WHERE kept UNION ALL SELECT nation, ux, uy FROM anchor
  UNION ALL SELECT nation, wx, wy FROM anchor)
SELECT CAST(2 * nation + up AS INTEGER) AS zone_idx, round(x, 6) AS x, round(y, 6) AS y FROM found, (VALUES (0), (1)) u(up)
UNION ALL SELECT CAST(2 * nation + up AS INTEGER), round(x, 6), round(10.0 * nation + CASE up WHEN 0 THEN -2.0 ELSE 2.0 END, 6)
FROM (SELECT nation, ux AS x FROM anchor UNION ALL SELECT nation, wx FROM anchor), (VALUES (0), (1)) u(up)""",
    "missing_intervals": """WITH stored AS (SELECT DISTINCT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey),
bounds AS (SELECT min(day) AS a, max(day) AS b FROM stored),
lacking AS (SELECT n_nationkey AS nation, CAST(d AS DATE) AS day
  FROM nation, bounds, unnest(generate_series(a, b, INTERVAL 1 DAY)) g(d)
  WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.nation = n_nationkey AND s.day = CAST(d AS DATE))),
grouped AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY nation ORDER BY day) AS INTEGER) AS island FROM lacking)
SELECT 'N' || nation AS iso3, 0 AS adm_level, min(day) AS first_date, max(day) AS last_date, count(*) AS n_dates
FROM grouped GROUP BY nation, island""",
    "tagged_csv": "SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier",
    "iso3_stored": ORACLES["iso3_meta"],
    "polygons_stored": ORACLES["polygon_meta"],
    "lookup_stored": ORACLES["admin_lookup"],
}
