"""The same questions as plain SQL for DuckDB, written independently of the operators: cross joins, no grid, no thinning."""

from epigrid.constants import APOTHEM, HALF_SIDE, HEAT_RAMP, NORMALS, SIDES, UNIT_AREA, VERTICES
from epigrid.functions.geohash import ALPHABET
from epigrid.functions.projection import (
    ALPHA, ECCENTRICITY, FALSE_EASTING, FALSE_NORTHING, RECTIFYING, SCALE,
)
from epigrid.plans.catalogue import CITY_POINT, CLUSTER_POINTS, HOME_ZONE, ONE_CASE, ONE_REGION
from epigrid.sources.binding import AREA_SECOND, AREA_SHAPE, AREA_SHAPES, AREA_TWICE


def _place(axis: str, cluster: str, jitter: str) -> str:
    base, a, b = {"lon": (98020000, 331777, 7919), "lat": (13020000, 517413, 6101)}[axis]
    whole = f"{base} + ({cluster} * {a}) % 4960000 + ({jitter} * {b}) % 40001 - 20000"
    return f"CAST({whole} AS DOUBLE) / CAST(1000000 AS DOUBLE) AS {axis}"


_BASE = f"""
cases AS (
  SELECT event_id AS case_id, CAST((event_id * 7 + user_id * 31) % 80 AS INTEGER) AS patient_age,
    DATE '2024-06-01' + CAST((event_id * 7 + user_id * 13) % 122 AS INTEGER) AS infection_date,
    CASE event_type WHEN 'error' THEN 'DSS' WHEN 'purchase' THEN 'DHF' ELSE 'DF' END AS severity,
    {_place("lon", "user_id", "event_id")}, {_place("lat", "user_id", "event_id")}
  FROM events),
schools AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS district,
    {_place("lon", "c_custkey", "c_custkey")}, {_place("lat", "c_custkey", "c_custkey")} FROM customer),
hospitals AS (
  SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS province,
    {_place("lon", "s_suppkey", "s_suppkey")}, {_place("lat", "s_suppkey", "s_suppkey")} FROM supplier),
boxes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS region_code, n_name AS region_name,
    CAST(98 + n_nationkey % 5 AS DOUBLE) AS x0, CAST(13 + n_nationkey // 5 AS DOUBLE) AS y0 FROM nation),
regions AS (
  SELECT *, x0 + CAST(1.1 AS DOUBLE) AS x1, y0 + CAST(1.1 AS DOUBLE) AS y1 FROM boxes),
located AS (
  SELECT c.*, r.region_name FROM cases c JOIN regions r
    ON c.lon BETWEEN r.x0 AND r.x1 AND c.lat BETWEEN r.y0 AND r.y1),
tiers(risk_tier, radius_meters) AS (VALUES ('RED', 500), ('ORANGE', 1000), ('YELLOW', 2000))"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_BASE.strip(), *ctes]) + "\n" + body


def _d(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def _deg(metres: int) -> str:
    return f"(CAST({metres} AS DOUBLE) / CAST(111000 AS DOUBLE))"


def _round(value: str, digits: int = 0) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    whole = f"floor(({value}) * {scale} + CAST(0.5 AS DOUBLE))"
    return f"CAST({whole} AS BIGINT)" if digits == 0 else f"{whole} / {scale}"


def _dist(a: str, b: str) -> str:
    return f"sqrt(({a}.lon - {b}.lon) * ({a}.lon - {b}.lon) + ({a}.lat - {b}.lat) * ({a}.lat - {b}.lat))"


def _text(value: str) -> str:
    units = f"CAST(floor(({value}) * CAST(1000000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"
    return f"(({units} // 1000000000)::VARCHAR || '.' || lpad(({units} % 1000000000)::VARCHAR, 9, '0'))"


_METRES = "CAST(111000 AS DOUBLE)"
_SQKM = "CAST(11988 AS DOUBLE)"


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


_SEVERE = "severity IN ('DHF', 'DSS')"


def _pairs(table: str, metres: int) -> str:
    """Facility-case pairs by brute force."""
    return f"""pairs AS (
  SELECT f.*, c.case_id, c.severity, {_dist("f", "c")} AS d FROM {table} f JOIN cases c ON {_dist("f", "c")} <= {_deg(metres)})"""


def _hash(points: str = "cases", name: str = "hashed") -> str:
    """Points with the 7-character geohash, one character after the other from the bits of the two cell numbers."""
    letters = []
    for j in range(7):
        terms = []
        for i in range(5):
            bit = 5 * j + i
            value = f"((ix >> {17 - bit // 2}) & 1)" if bit % 2 == 0 else f"((iy >> {16 - bit // 2}) & 1)"
            terms.append(f"{value} * {16 >> i}")
        letters.append(f"substr('{ALPHABET}', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return f"""{name} AS (
  SELECT *, {' || '.join(letters)} AS h7 FROM (
    SELECT *, CAST(floor((lon + 180.0::DOUBLE) / 360.0::DOUBLE * 262144::DOUBLE) AS BIGINT) AS ix,
      CAST(floor((lat + 90.0::DOUBLE) / 180.0::DOUBLE * 131072::DOUBLE) AS BIGINT) AS iy FROM {points}))"""


def _rect(precision: int) -> tuple[str, str, str, str]:
    """Rectangle of a cell from one of its points' cell numbers `ix`, `iy` at precision 7."""
    lon_bits, lat_bits = {6: (15, 15), 7: (18, 17)}[precision]
    x, y = f"(any_value(ix) >> {18 - lon_bits})", f"(any_value(iy) >> {17 - lat_bits})"

    def lon(i):
        return f"(CAST({i} AS DOUBLE) / {float(1 << lon_bits)}::DOUBLE * 360::DOUBLE - 180::DOUBLE)"

    def lat(i):
        return f"(CAST({i} AS DOUBLE) / {float(1 << lat_bits)}::DOUBLE * 180::DOUBLE - 90::DOUBLE)"

    return lon(x), lat(y), lon(f"({x} + 1)"), lat(f"({y} + 1)")


def _rect_wkt(precision: int) -> str:
    x0, y0, x1, y1 = _rect(precision)
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return "'POLYGON((' || " + " || ', ' || ".join(f"{_text(x)} || ' ' || {_text(y)}" for x, y in corners) + " || '))'"


def _buffer_wkt(radius: str) -> str:
    corners = [*VERTICES, VERTICES[0]]
    points = " || ', ' || ".join(
        f"{_text(f'lon + {radius} * {_d(c)}')} || ' ' || {_text(f'lat + {radius} * {_d(s)}')}" for c, s in corners
    )
    return f"'POLYGON((' || {points} || '))'"


_RHO, _HALF, _TOUCH = _d(APOTHEM), _d(HALF_SIDE), "CAST(1e-9 AS DOUBLE)"
_PI = "CAST(3.141592653589793 AS DOUBLE)"


def _outline(tiers: str = "tiers") -> list[str]:
    """Free pieces of all buffer edges, from all pairs of overlapping buffers.

    The chord of the other buffer is interpolated between the two vertices around its height.
    """
    normals = ", ".join(f"({k}, {_d(x)}, {_d(y)})" for k, (x, y) in enumerate(NORMALS))
    step = f"({_PI} / {SIDES})"
    height = f"greatest(-{_RHO}, least({_RHO}, {_RHO} - up))"
    return [
        f"""centres AS (
  SELECT row_number() OVER () AS id, *, CAST(radius_meters AS DOUBLE) / {_METRES} AS r FROM (
    SELECT DISTINCT region_name, risk_tier, radius_meters, lon, lat FROM located, {tiers}))""",
        f"normals(k, nx, ny) AS (VALUES {normals})",
        """near AS (
  SELECT a.*, b.id AS other, (b.lon - a.lon) / a.r AS dx, (b.lat - a.lat) / a.r AS dy
  FROM centres a JOIN centres b ON a.region_name = b.region_name AND a.radius_meters = b.radius_meters
    AND b.lon BETWEEN a.lon - 2.01 * a.r AND a.lon + 2.01 * a.r AND b.lat BETWEEN a.lat - 2.01 * a.r AND a.lat + 2.01 * a.r)""",
        f"""moved AS (
  SELECT *, nx * dx + ny * dy AS up, nx * dy - ny * dx AS along FROM near, normals
  WHERE nx * dx + ny * dy BETWEEN -{_TOUCH} AND 2 * {_RHO} + {_TOUCH})""",
        f"""raised AS (
  SELECT *, {height} AS h, CAST(greatest(0, least({SIDES // 2 - 2}, floor((acos({height}) / {step} - 1) / 2))) AS INTEGER) AS j
  FROM moved)""",
        f"""chords AS (
  SELECT *, cos((2 * j + 1) * {step}) AS h1, cos((2 * j + 3) * {step}) AS h2,
    sin((2 * j + 1) * {step}) AS w1, sin((2 * j + 3) * {step}) AS w2 FROM raised)""",
        """spans AS (
  SELECT *, along - (w1 + (w2 - w1) * (h1 - h) / (h1 - h2)) AS low, along + (w1 + (w2 - w1) * (h1 - h) / (h1 - h2)) AS high,
    (up > 1e-9 OR other < id) AS hides FROM chords)""",
        f"""free AS (
  SELECT region_name, risk_tier, radius_meters, r, id, lon, lat, k, nx, ny,
    max(CASE WHEN hides AND low <= -{_HALF} AND high > -{_HALF} THEN least(high, {_HALF}) ELSE -{_HALF} END) AS t0,
    min(CASE WHEN hides AND high >= {_HALF} AND low < {_HALF} THEN greatest(low, -{_HALF}) ELSE {_HALF} END) AS t1
  FROM spans GROUP BY ALL)""",
        """pieces AS (SELECT * FROM free WHERE t1 - t0 > 1e-9)""",
    ]


def _areas(tiers: str = "tiers") -> list[str]:
    return [
        *_outline(tiers),
        f"""merged AS (
  SELECT p.region_name, risk_tier, radius_meters,
    sum((nx * (lon - x0) + ny * (lat - y0) + r * {_RHO}) * (t1 - t0) * r) / 2 * {_SQKM} AS area
  FROM pieces p JOIN regions g ON p.region_name = g.region_name GROUP BY ALL)""",
        f"""zones AS (
  SELECT m.*, n.case_count, n.buffers * pow(CAST(radius_meters AS DOUBLE) / {_METRES}, 2) * {_d(UNIT_AREA)} * {_SQKM} AS naive
  FROM merged m JOIN (
    SELECT region_name, count(DISTINCT case_id) AS case_count, count(*) AS buffers FROM located GROUP BY region_name) n
  ON m.region_name = n.region_name)""",
    ]


def _slab_areas(tiers: str = "tiers") -> list[str]:
    """Merged areas by horizontal slabs: between two neighbouring heights of corners and crossings every buffer is a trapezoid, so
    the covered length half way up, times the height, is the area. Nothing of it is shared with the operator's own rule."""
    corners = ", ".join(f"({k}, {_d(x)}, {_d(y)})" for k, (x, y) in enumerate(VERTICES))
    quarter = SIDES // 4
    step = f"(2 * {_PI} / {SIDES})"
    return [
        f"""places AS (
  SELECT row_number() OVER () AS id, *, CAST(radius_meters AS DOUBLE) / {_METRES} AS r FROM (
    SELECT DISTINCT region_name, risk_tier, radius_meters, lon, lat FROM located, {tiers}))""",
        f"corners(k, cx, cy) AS (VALUES {corners})",
        f"""sides AS (
  SELECT id, lon + r * a.cx AS ax, lat + r * a.cy AS ay, lon + r * b.cx AS ex, lat + r * b.cy AS ey
  FROM places, corners a JOIN corners b ON b.k = (a.k + 1) % {SIDES})""",
        """pairs_near AS (
  SELECT a.id AS i, b.id AS j, a.region_name, a.radius_meters FROM places a JOIN places b
    ON a.region_name = b.region_name AND a.radius_meters = b.radius_meters AND a.id < b.id
    AND abs(a.lon - b.lon) <= 2 * a.r AND abs(a.lat - b.lat) <= 2 * a.r)""",
        """crossed AS (
  SELECT region_name, radius_meters, p.ay, p.ey, q.ay AS qy,
    (p.ex - p.ax) * (q.ey - q.ay) - (p.ey - p.ay) * (q.ex - q.ax) AS det,
    (q.ax - p.ax) * (q.ey - q.ay) - (q.ay - p.ay) * (q.ex - q.ax) AS along_p,
    (q.ax - p.ax) * (p.ey - p.ay) - (q.ay - p.ay) * (p.ex - p.ax) AS along_q
  FROM pairs_near n JOIN sides p ON p.id = n.i JOIN sides q ON q.id = n.j
  WHERE least(p.ay, p.ey) <= greatest(q.ay, q.ey) AND least(q.ay, q.ey) <= greatest(p.ay, p.ey)
    AND least(p.ax, p.ex) <= greatest(q.ax, q.ex) AND least(q.ax, q.ex) <= greatest(p.ax, p.ex))""",
        """heights AS (
  SELECT DISTINCT region_name, radius_meters, y FROM (
    SELECT region_name, radius_meters, ay AS y FROM sides JOIN places USING (id)
    UNION ALL
    SELECT region_name, radius_meters, ay + along_p / det * (ey - ay) FROM crossed
    WHERE abs(det) > 1e-18 AND along_p / det BETWEEN 0 AND 1 AND along_q / det BETWEEN 0 AND 1))""",
        """slabs AS (
  SELECT row_number() OVER () AS slab, * FROM (
    SELECT region_name, radius_meters, y AS low, lead(y) OVER (PARTITION BY region_name, radius_meters ORDER BY y) AS high
    FROM heights) WHERE high - low > 1e-15)""",
        f"""widths AS (
  SELECT slab, s.region_name, risk_tier, s.radius_meters, high - low AS tall, lon, r, abs((low + high) / 2 - lat) / r AS h
  FROM slabs s JOIN places p ON s.region_name = p.region_name AND s.radius_meters = p.radius_meters
    AND (low + high) / 2 BETWEEN lat - r AND lat + r)""",
        f"""angled AS (
  SELECT *, CAST(least({quarter - 1}, floor(asin(least(1, h)) / {step})) AS INTEGER) AS j FROM widths)""",
        f"""lengths AS (
  SELECT *, lon - r * w AS x0, lon + r * w AS x1 FROM (
    SELECT *, cos(j * {step}) + (cos((j + 1) * {step}) - cos(j * {step})) * (h - sin(j * {step}))
      / (sin((j + 1) * {step}) - sin(j * {step})) AS w FROM angled))""",
        """reaches AS (
  SELECT *, max(x1) OVER (PARTITION BY slab ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM lengths)""",
        f"""merged AS (
  SELECT region_name, risk_tier, radius_meters,
    sum(tall * greatest(0, x1 - greatest(x0, coalesce(before, x0)))) * {_SQKM} AS area
  FROM reaches GROUP BY ALL)""",
        f"""zones AS (
  SELECT m.*, n.case_count, n.buffers * pow(CAST(radius_meters AS DOUBLE) / {_METRES}, 2) * {_d(UNIT_AREA)} * {_SQKM} AS naive
  FROM merged m JOIN (
    SELECT region_name, count(DISTINCT case_id) AS case_count, count(*) AS buffers FROM located GROUP BY region_name) n
  ON m.region_name = n.region_name)""",
    ]


def _separated() -> str:
    """A buffer and a rectangle are apart if some axis separates them: all 32 edge normals and the two rectangle axes."""
    tests = ["x0 - lon > r", "lon - x1 > r", "y0 - lat > r", "lat - y1 > r"]
    for nx, ny in NORMALS:
        x, y = ("x0" if nx > 0 else "x1"), ("y0" if ny > 0 else "y1")
        tests.append(f"{_d(nx)} * ({x} - lon) + {_d(ny)} * ({y} - lat) > r * {_RHO}")
    return " OR ".join(tests)


def _load(table: str, metres: int, severe: str, by: str, nearest: bool = True) -> str:
    near = f", {_round(f'min(d) * {_METRES}')} AS nearest_case_meters" if nearest else ""
    return _with(
        f"SELECT {by}, count(*) AS case_count, {_count(severe)} AS severe_count{near} FROM pairs GROUP BY {by}",
        _pairs(table, metres),
    )


def _fogging() -> str:
    points = " ".join(f"WHEN d <= {_deg(m)} THEN {p}" for m, p in ((500, 3), (1000, 2), (2000, 1)))
    return f"""scores AS (
  SELECT name, district, count(*) AS case_count,
    CAST(sum((CASE {points} END) * (CASE WHEN {_SEVERE} THEN 2 ELSE 1 END)) AS BIGINT) AS risk_score,
    {_count(f"d <= {_deg(500)}")} AS red_cases
  FROM pairs GROUP BY name, district)"""


def _colour(value: str) -> str:
    """Heat colour of an intensity, channel by channel."""
    cases = []
    for (low, a), (high, b) in zip(HEAT_RAMP, HEAT_RAMP[1:]):
        t = f"(({value} - {_d(low)}) / {_d(high - low)})"
        parts = [
            f"printf('%02x', CAST(trunc({int(a[i:i+2], 16)}::DOUBLE * (1 - {t}) + {int(b[i:i+2], 16)}::DOUBLE * {t}) AS INTEGER))"
            for i in (1, 3, 5)
        ]
        cases.append(f"WHEN {value} <= {_d(high)} THEN '#' || {' || '.join(parts)}")
    return f"CASE {' '.join(cases)} ELSE '{HEAT_RAMP[-1][1]}' END"


def _ring_sql(x: str, y: str, width: int, height: int) -> str:
    corners = ((0, 0), (width, 0), (width, height), (0, height), (0, 0))
    pairs = (f"({x} + {i}) || '.000000000 ' || ({y} + {j}) || '.000000000'" for i, j in corners)
    return "'(' || " + " || ', ' || ".join(pairs) + " || ')'"


#: Areas and centroids by hand: a square of side 4 (16), less a hole of 1 x 2 (2), and a far square of side 1.
_MIXED = f"""SELECT region_code, m < 3 AS accepted,
  CASE m WHEN 0 THEN 16.0::DOUBLE WHEN 1 THEN 14.0::DOUBLE WHEN 2 THEN 15.0::DOUBLE END AS area,
  CASE m WHEN 0 THEN x + 2.0::DOUBLE WHEN 1 THEN {_round("x + (16 * 2 - 2 * 1.5)::DOUBLE / 14", 6)}
    WHEN 2 THEN {_round("x + (16 * 2 - 2 * 1.5 + 10.5)::DOUBLE / 15", 6)} END AS cx,
  CASE m WHEN 0 THEN y + 2.0::DOUBLE WHEN 1 THEN y + 2.0::DOUBLE WHEN 2 THEN {_round("y + (16 * 2 - 2 * 2 + 0.5)::DOUBLE / 15", 6)} END AS cy,
  CASE m WHEN 0 THEN 'POLYGON(' || {_ring_sql("x", "y", 4, 4)} || ')'
    WHEN 1 THEN 'POLYGON(' || {_ring_sql("x", "y", 4, 4)} || ', ' || {_ring_sql("(x + 1)", "(y + 1)", 1, 2)} || ')'
    WHEN 2 THEN 'MULTIPOLYGON((' || {_ring_sql("x", "y", 4, 4)} || ', ' || {_ring_sql("(x + 1)", "(y + 1)", 1, 2)} || '), ('
      || {_ring_sql("(x + 10)", "y", 1, 1)} || '))' END AS wkt
FROM (SELECT region_code, CAST(x0 AS INTEGER) AS x, CAST(y0 AS INTEGER) AS y, CAST(region_code AS INTEGER) % 4 AS m FROM regions)"""


def _areas_sql() -> list[str]:
    """The areas as numbered rows and their edges, and the cases in them by casting a ray over all edges; a case on an edge is in."""
    edges = ", ".join(
        f"({n}, {p}, {r}, {_d(ax)}, {_d(ay)}, {_d(bx)}, {_d(by)})"
        for n, shape in enumerate(AREA_SHAPES)
        for p, part in enumerate(shape)
        for r, ring in enumerate(part)
        for (ax, ay), (bx, by) in zip(ring, (*ring[1:], ring[0]))
    )
    key = "n_nationkey"
    return [
        f"offsets(shape, part, ring, ax, ay, ex, ey) AS (VALUES {edges})",
        f"""listed AS (
  SELECT n_nationkey, {AREA_SHAPE.format(key=key)} AS shape FROM nation
  UNION ALL SELECT n_nationkey, 2 FROM nation WHERE {AREA_SECOND.format(key=key)}
  UNION ALL SELECT n_nationkey, {AREA_SHAPE.format(key=key)} FROM nation WHERE {AREA_TWICE.format(key=key)})""",
        """area_rows AS (
  SELECT row_number() OVER () AS row, shape, 'AREA_' || (n_nationkey % 20) AS region_name,
    CAST(98 + n_nationkey % 5 AS DOUBLE) AS x, CAST(13 + n_nationkey // 5 AS DOUBLE) AS y FROM listed)""",
        """area_edges AS (
  SELECT row, region_name, part, ring, x + ax AS ax, y + ay AS ay, x + ex AS ex, y + ey AS ey FROM area_rows JOIN offsets USING (shape))""",
        """tested AS (
  SELECT c.case_id, e.row, e.region_name,
    bool_or((ex - ax) * (lat - ay) - (ey - ay) * (lon - ax) = 0 AND lon BETWEEN least(ax, ex) AND greatest(ax, ex)
      AND lat BETWEEN least(ay, ey) AND greatest(ay, ey)) AS touches,
    count(*) FILTER (WHERE (ay > lat) <> (ey > lat) AND lon < ax + (lat - ay) * (ex - ax) / nullif(ey - ay, 0)) AS crossings
  FROM cases c, area_edges e GROUP BY ALL)""",
        """in_areas AS (
  SELECT c.*, t.region_name FROM cases c JOIN tested t ON c.case_id = t.case_id WHERE t.touches OR t.crossings % 2 = 1)""",
    ]


def _utm_sql(source: str, name: str, zone: str | None = None) -> list[str]:
    """UTM metres of `lon` and `lat`: the conformal latitude by its tangent, the series as written."""
    own = "CAST(least(60, floor((lon + 180) / 6) + 1) AS INTEGER)" if zone is None else zone
    e, k = _d(ECCENTRICITY), _d(SCALE * RECTIFYING)
    along = " + ".join(f"{_d(a)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1))
    up = " + ".join(f"{_d(a)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(ALPHA, 1))
    south = f"CASE WHEN lat < 0 THEN {_d(FALSE_NORTHING)} ELSE 0 END" if zone is None else "0"
    return [
        f"""{name}_zoned AS (
  SELECT *, tan(radians(lat)) AS tau, {own} AS utm_zone FROM {source})""",
        f"""{name}_turned AS (
  SELECT *, radians(lon - (utm_zone * 6 - 183)) AS turn, sinh({e} * atanh({e} * tau / sqrt(1 + tau * tau))) AS sigma FROM {name}_zoned)""",
        f"""{name}_conformal AS (
  SELECT *, tau * sqrt(1 + sigma * sigma) - sigma * sqrt(1 + tau * tau) AS t FROM {name}_turned)""",
        f"""{name}_sphere AS (
  SELECT *, atan2(t, cos(turn)) AS xi, asinh(sin(turn) / sqrt(t * t + cos(turn) * cos(turn))) AS eta FROM {name}_conformal)""",
        f"""{name} AS (
  SELECT *, lat >= 0 AS utm_north, {_d(FALSE_EASTING)} + {k} * (eta + {along}) AS easting,
    {south} + {k} * (xi + {up}) AS northing FROM {name}_sphere)""",
    ]


_ROOT3 = "sqrt(CAST(3 AS DOUBLE))"


def _hexed(source: str, name: str, size: float = 0.01) -> list[str]:
    """Rows with the axial coordinates of their hexagon: that of the centres around whose is nearest."""
    s = _d(size)
    return [
        f"""{name}_near AS (
  SELECT p.*, q + i AS q, r + j AS r FROM (
    SELECT *, CAST(floor((lon * {_ROOT3} / 3 - lat / 3) / {s}) AS BIGINT) AS q, CAST(floor(lat * 2 / 3 / {s}) AS BIGINT) AS r FROM {source}) p,
    range(-1, 3) a(i), range(-1, 3) b(j))""".replace("SELECT p.*, q + i AS q, r + j AS r", "SELECT p.* EXCLUDE (q, r), q + i AS q, r + j AS r"),
        f"""{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY
    pow(lon - {_ROOT3} * {s} * (q + r / 2), 2) + pow(lat - 1.5 * {s} * r, 2)) AS turn FROM {name}_near) WHERE turn = 1)""",
    ]


def _hex_id(q: str = "q", r: str = "r") -> str:
    return f"printf('%08x%08x', {q} + 2147483648, {r} + 2147483648)"


def _hex_wkt(size: float, q: str = "any_value(q)", r: str = "any_value(r)") -> str:
    corners = ((1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2), (1, -1))
    points = " || ', ' || ".join(
        _text(f"CAST(2 * {q} + {r} + {a} AS DOUBLE) * ({_ROOT3} / 2 * {_d(size)})") + " || ' ' || " + _text(f"CAST(3 * {r} + {u} AS DOUBLE) * ({_d(size)} / 2)")
        for a, u in corners
    )
    return f"'POLYGON((' || {points} || '))'"


def oracle_sql() -> dict[str, str]:
    month = "CAST(date_trunc('month', infection_date) AS DATE)"
    age = _round("avg(patient_age)", 1)
    h6, h7 = "substr(h7, 1, 6)", "h7"
    changes = f"""monthly AS (
  SELECT {h6} AS cell_id, {month} AS report_month, count(*) AS case_count FROM hashed GROUP BY ALL),
changes AS (
  SELECT *, lag(case_count, 1, 0) OVER (PARTITION BY cell_id ORDER BY report_month) AS prev_month_cases FROM monthly)"""
    report = f"""report AS (
  SELECT {month} AS report_month, 6 AS grid_precision, {h6} AS cell_id, count(*) AS case_count,
    {_count("severity = 'DF'")} AS df_count, {_count("severity = 'DHF'")} AS dhf_count,
    {_count("severity = 'DSS'")} AS dss_count, {age} AS avg_age, {_rect_wkt(6)} AS wkt
  FROM hashed GROUP BY {month}, {h6})"""
    fine = f"""fine AS (
  SELECT {h7} AS cell_id, count(*) AS case_count, {_count(_SEVERE)} AS severe_count, {_rect_wkt(7)} AS cell_polygon_wkt
  FROM hashed GROUP BY {h7})"""
    x0, y0, x1, y1 = _rect(6)
    red = "(SELECT * FROM tiers WHERE risk_tier = 'RED')"
    nearest_points = " UNION ALL ".join(
        f"""(SELECT {n} AS point, id, name, {_round(f"d * {_METRES}")} AS distance_meters FROM (
  SELECT id, name, sqrt((lon - {_d(x)}) * (lon - {_d(x)}) + (lat - {_d(y)}) * (lat - {_d(y)})) AS d FROM hospitals)
  ORDER BY d, id LIMIT 3)"""
        for n, (x, y) in enumerate(CLUSTER_POINTS, 1)
    )
    city = "sqrt((lon - {0}) * (lon - {0}) + (lat - {1}) * (lat - {1}))".format(_d(CITY_POINT[0]), _d(CITY_POINT[1]))
    scored = {s: f"(severity = '{s}' AND d <= {_deg(m)})" for s, m in (("DSS", 500), ("DHF", 1000), ("DF", 2000))}
    radius = f"(CAST(radius_meters AS DOUBLE) / {_METRES})"
    tooltip = (
        "'region_name: ' || region_name || '<br>risk_tier: ' || risk_tier || '<br>radius_meters: ' || radius_meters"
        " || '<br>case_count: ' || case_count"
    )
    heat = f"""heat AS (
  SELECT {h6} AS cell_id, count(*) AS case_count, {_count(_SEVERE)} AS severe_count FROM hashed GROUP BY {h6}),
scaled AS (SELECT *, CAST(case_count AS DOUBLE) / (SELECT max(case_count) FROM heat) AS v FROM heat)"""

    def box(table: str) -> str:
        ends = ", ".join(
            f"{_round(f'{f}({c})', 5)} AS {f}_{c}" for f in ("min", "max") for c in ("lat", "lon")
        )
        return f"SELECT '{table}' AS layer, {ends} FROM {table}"

    return {
        "q01_row_counts": _with(
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                for t in ("cases", "hospitals", "regions", "schools")
            )
        ),
        "q02_cases_near_schools": _load("schools", 1000, "severity = 'DHF'", "name, district"),
        "q02_severe_cases_near_schools": _load("schools", 1000, _SEVERE, "name, district"),
        "q03_distance_to_city": _with(
            f"SELECT id, {_round(city, 4)} AS distance_degrees, {_round(f'{city} * {_METRES}')} AS approx_meters FROM schools"
        ),
        "q04_nearest_hospital": _with(
            f"""SELECT case_id, patient_age, severity, name AS nearest_hospital, {_round(f"d * {_METRES}")} AS distance_meters
FROM (SELECT c.case_id, c.patient_age, c.severity, h.name, {_dist("c", "h")} AS d,
  row_number() OVER (PARTITION BY c.case_id ORDER BY {_dist("c", "h")}, h.id) AS rn FROM cases c, hospitals h) WHERE rn = 1"""
        ),
        "q05_hospital_case_load": _load("hospitals", 5000, _SEVERE, "name, province", nearest=False),
        "q05_hospital_case_load_all": _with(
            f"""SELECT h.name, h.province, count(c.case_id) AS case_count FROM hospitals h
LEFT JOIN cases c ON {_dist("h", "c")} <= {_deg(5000)} GROUP BY h.name, h.province"""
        ),
        "q05_regional_case_load": _with(
            f"""SELECT id, name, {_count(f"d <= {_deg(25_000)}")} AS cases_25_km, {_count(f"d <= {_deg(50_000)}")} AS cases_50_km,
  count(*) AS cases_100_km, {_count(_SEVERE)} AS severe_cases, {_round(f"min(d) * {_METRES}")} AS nearest_case_meters
FROM pairs GROUP BY id, name""",
            _pairs("hospitals", 100_000),
        ),
        "q06_hospitals_nearest_points": _with(nearest_points),
        "q07_case_buffer": _with(f"SELECT case_id, severity, {_buffer_wkt(_deg(500))} AS buffer_500m_wkt FROM cases"),
        "q08_tier_buffers": _with(
            f"""SELECT case_id, severity, infection_date, risk_tier, radius_meters, {_buffer_wkt(radius)} AS zone_wkt
FROM cases, tiers"""
        ),
        "q09_school_case_tiers": _with(
            f"""SELECT name, district, case_id, severity, {_round(f"d * {_METRES}")} AS distance_meters,
  CASE WHEN d <= {_deg(500)} THEN 'RED (0-500m)' WHEN d <= {_deg(1000)} THEN 'ORANGE (500m-1km)'
       WHEN d <= {_deg(2000)} THEN 'YELLOW (1-2km)' END AS risk_tier FROM pairs""",
            _pairs("schools", 2000),
        ),
        "q10_school_threat": _load("schools", 2000, _SEVERE, "name, district"),
        "q11_school_cumulative_tiers": _with(
            f"""SELECT name, count(*) AS threatening_cases, {_count(f"d <= {_deg(500)}")} AS red_cases,
  {_count(f"d <= {_deg(1000)}")} AS orange_cases, {_count(f"d <= {_deg(2000)}")} AS yellow_cases,
  {_round(f"min(d) * {_METRES}")} AS nearest_case_m FROM pairs GROUP BY name""",
            _pairs("schools", 2000),
        ),
        "q12_merged_outline": _with(
            f"""SELECT region_name, k, {_round("lon", 6)} AS lon, {_round("lat", 6)} AS lat,
  {_round(f"lon + r * ({_RHO} * nx - t0 * ny)", 6)} AS from_x, {_round(f"lat + r * ({_RHO} * ny + t0 * nx)", 6)} AS from_y,
  {_round(f"lon + r * ({_RHO} * nx - t1 * ny)", 6)} AS to_x, {_round(f"lat + r * ({_RHO} * ny + t1 * nx)", 6)} AS to_y
FROM pieces""",
            *_outline(red),
        ),
        "q12_merged_rings": _with(
            f"""SELECT p.region_name, p.vertices, {_round("area", 3)} AS area_sq_km
FROM (SELECT region_name, count(*) AS vertices FROM pieces GROUP BY region_name) p
JOIN zones z ON p.region_name = z.region_name""",
            *_outline(red),
            *_slab_areas(red),
        ),
        "q13_merged_areas": _with(
            "SELECT region_name, max(case_count) AS total_cases, "
            + ", ".join(
                f"{_round(f'''max({_round('area', 3)}) FILTER (WHERE risk_tier = '{t}')''', 2)} AS {t.lower()}_zone_sq_km"
                for t in ("RED", "ORANGE", "YELLOW")
            )
            + " FROM zones GROUP BY region_name",
            *_areas(),
        ),
        "q14_overlap_savings": _with(
            f"""SELECT region_name, risk_tier, {_round("naive", 3)} AS naive_sq_km, {_round("area", 3)} AS merged_sq_km,
  {_round("(1 - area / nullif(naive, 0)) * 100", 1)} AS overlap_savings_pct FROM zones""",
            *_areas(),
        ),
        "q15_risk_zones": _with(
            f"SELECT region_name, risk_tier, radius_meters, case_count, {_round('area', 3)} AS area_sq_km FROM zones",
            *_areas(),
        ),
        "q16_severity_score": _with(
            f"""SELECT s.name, CAST(coalesce(sum(CASE WHEN {scored["DSS"]} THEN 3 WHEN {scored["DHF"]} THEN 2
    WHEN {scored["DF"]} THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_risk_score,
  {_count(scored["DSS"])} AS dss_cases, {_count(scored["DHF"])} AS dhf_cases, {_count(scored["DF"])} AS df_cases
FROM schools s LEFT JOIN pairs p ON s.id = p.id GROUP BY s.name""",
            _pairs("schools", 2000),
        ),
        "q17_fogging_score": _with(
            "SELECT name, district, case_count, risk_score FROM scores", _pairs("schools", 2000), _fogging()
        ),
        "q17_fogging_top": _with(
            "SELECT name, district, case_count, risk_score FROM scores ORDER BY risk_score DESC, case_count DESC, name LIMIT 3",
            _pairs("schools", 2000),
            _fogging(),
        ),
        "q17_fogging_summary": _with(
            f"""SELECT count(*) AS schools, {_round("CAST(sum(risk_score) AS DOUBLE) / count(*)", 2)} AS avg_risk_score,
  {_count("red_cases > 0")} AS schools_in_red FROM scores""",
            _pairs("schools", 2000),
            _fogging(),
        ),
        "q18_case_cells": _with(
            f"SELECT case_id, substr(h7, 1, 5) AS cell_5, {h6} AS cell_6, h7 AS cell_7 FROM hashed", _hash()
        ),
        "q19_cell_heatmap": _with(
            f"""SELECT {h6} AS cell_id, count(*) AS case_count, {_count(_SEVERE)} AS severe_count,
  min(infection_date) AS first_case_date, max(infection_date) AS last_case_date,
  date_diff('day', min(infection_date), max(infection_date)) AS outbreak_duration_days FROM hashed GROUP BY {h6}""",
            _hash(),
        ),
        "q20_cell_polygons": _with(
            f"""SELECT {h6} AS cell_id, count(*) AS case_count, {_count(_SEVERE)} AS severe_count,
  min(infection_date) AS first_case_date, max(infection_date) AS last_case_date, {_rect_wkt(6)} AS cell_polygon_wkt
FROM hashed GROUP BY {h6}""",
            _hash(),
        ),
        "q21_resolution_counts": _with(
            " UNION ALL ".join(
                f"SELECT '{label}' AS level, substr(h7, 1, {p}) AS cell_id, count(*) AS case_count FROM hashed GROUP BY 2"
                for p, label in (
                    (5, "Precision 5 (province)"), (6, "Precision 6 (city)"), (7, "Precision 7 (neighborhood)"),
                )
            ),
            _hash(),
        ),
        "q22_monthly_cells": _with(
            f"""SELECT {month} AS report_month, {h6} AS cell_id, count(*) AS case_count, {_count(_SEVERE)} AS severe_count,
  {_rect_wkt(6)} AS cell_polygon_wkt FROM hashed GROUP BY {month}, {h6}""",
            _hash(),
        ),
        "q23_cell_report": _with("SELECT * FROM report", _hash(), report),
        "q23_report_readback": _with(
            """SELECT report_month, cell_id, case_count, dhf_count + dss_count AS severe_count, avg_age FROM report
ORDER BY report_month, case_count DESC, cell_id LIMIT 30""",
            _hash(),
            report,
        ),
        "q24_cells_in_red_zones": _with(
            f"""SELECT report_month, cell_id, cell_cases, 'RED' AS risk_tier, z.region_name, {_round("area", 3)} AS risk_zone_area,
  {_round(f"100::DOUBLE * cell_cases / nullif({_round('area', 3)}, 0)", 2)} AS cases_per_sq_km
FROM monthly m JOIN touched t ON m.cell_id = t.cell JOIN zones z ON t.region_name = z.region_name""",
            *_slab_areas(red),
            _hash(),
            f"""cells AS (
  SELECT {h6} AS cell, {x0} AS x0, {y0} AS y0, {x1} AS x1, {y1} AS y1 FROM hashed GROUP BY {h6})""",
            f"""touched AS (
  SELECT DISTINCT region_name, cell FROM (SELECT lon, lat, region_name, {_deg(500)} AS r FROM located) l JOIN cells c
    ON l.lon BETWEEN c.x0 - 0.01 AND c.x1 + 0.01 AND l.lat BETWEEN c.y0 - 0.01 AND c.y1 + 0.01
  WHERE NOT ({_separated()}))""",
            f"""monthly AS (
  SELECT {month} AS report_month, {h6} AS cell_id, count(*) AS cell_cases FROM hashed GROUP BY ALL)""",
        ),
        "q25_region_resolutions": _with(
            " UNION ALL ".join(
                f"""SELECT region_name, {p} AS grid_precision, count(DISTINCT substr(h7, 1, {p})) AS cell_count,
  count(*) AS total_cases, {_round(f"count(*)::DOUBLE / count(DISTINCT substr(h7, 1, {p}))", 1)} AS avg_per_cell
FROM hashed GROUP BY region_name"""
                for p in (5, 6, 7)
            ),
            _hash("located"),
        ),
        "q26_region_heatmap": _with(
            f"""SELECT region_name, {h6} AS cell_id, count(*) AS case_count, {_rect_wkt(6)} AS wkt
FROM hashed GROUP BY region_name, {h6}""",
            _hash("located"),
        ),
        "q27_monthly_trend": _with(
            f"""SELECT {month} AS report_month, count(*) AS case_count, {_count(_SEVERE)} AS severe_cases,
  {age} AS avg_patient_age FROM cases GROUP BY {month}"""
        ),
        "q28_month_change": _with("SELECT *, case_count - prev_month_cases AS month_change FROM changes", _hash(), changes),
        "q28_sharpest_change": _with(
            """SELECT *, case_count - prev_month_cases AS month_change FROM changes
ORDER BY month_change DESC, cell_id, report_month LIMIT 5""",
            _hash(),
            changes,
        ),
        "q29_latest_month": _with(
            "SELECT report_month, wkt, case_count FROM report WHERE report_month = (SELECT max(report_month) FROM report)",
            _hash(),
            report,
        ),
        "q30_fine_heatmap": _with("SELECT * FROM fine", _hash(), fine),
        "q30_hottest_cell": _with("SELECT * FROM fine ORDER BY case_count DESC, cell_id LIMIT 1", _hash(), fine),
        "q31_severity_mix": _with(
            f"SELECT severity, count(*) AS case_count, {age} AS avg_age FROM cases GROUP BY severity"
        ),
        "q32_case_labels": _with("SELECT 'Case ' || case_id AS label, severity, patient_age, lat, lon FROM cases"),
        "q33_facility_points": _with(
            """SELECT name, province AS area, lat, lon, 'hospital' AS kind FROM hospitals
UNION ALL SELECT name, district, lat, lon, 'school' FROM schools"""
        ),
        "q34_point_features": _with(
            """SELECT name AS label, '<b>name:</b> ' || name || '<br><b>province:</b> ' || province AS popup, lon, lat
FROM hospitals"""
        ),
        "q34_zone_features": _with(
            f"""SELECT region_name, risk_tier,
  CASE risk_tier WHEN 'RED' THEN '#e74c3c' WHEN 'ORANGE' THEN '#e67e22' ELSE '#f1c40f' END AS colour,
  CAST(CASE risk_tier WHEN 'RED' THEN 0.45 WHEN 'ORANGE' THEN 0.3 ELSE 0.18 END AS DOUBLE) AS opacity,
  -radius_meters AS draw_order, {tooltip} AS tooltip
FROM (SELECT region_name, count(DISTINCT case_id) AS case_count FROM located GROUP BY region_name), tiers"""
        ),
        "q34_cell_features": _with(
            f"""SELECT cell_id, case_count, severe_count, {_round("v", 6)} AS intensity, {_colour("v")} AS colour,
  'cell_id: ' || cell_id || '<br>case_count: ' || case_count || '<br>severe_count: ' || severe_count AS tooltip FROM scaled""",
            _hash(),
            heat,
        ),
        "q34_layer_extents": _with(
            f"{box('cells')} UNION ALL {box('hospitals')} UNION ALL {box('schools')}",
            _hash(),
            f"cells AS (SELECT ({x0} + {x1}) / 2 AS lon, ({y0} + {y1}) / 2 AS lat FROM hashed GROUP BY {h6})",
        ),
        "wkt_points": _with(f"SELECT case_id, {_text('lon')} AS lon, {_text('lat')} AS lat FROM cases"),
        "wkt_polygons": _with(
            f"""SELECT region_code, {", ".join(f"{_round(c, 4)} AS {c}" for c in ("x0", "y0", "x1", "y1"))},
  {_round("(x1 - x0) * (y1 - y0)", 4)} AS area FROM regions"""
        ),
        "geojson_points": _with(
            f"""SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || {_text("lon")} || ',' || {_text("lat")}
  || ']}},"properties":{{"id":' || id || ',"name":"' || name || '"}}}}' AS value FROM schools"""
        ),
        "geojson_cells": _with(
            f"""SELECT '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[['
  || {" || ',' || ".join(f"'[' || {_text(x)} || ',' || {_text(y)} || ']'" for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)))}
  || ']]}},"properties":{{"cell_id":"' || {h6} || '","case_count":' || count(*) || '}}}}' AS value FROM hashed GROUP BY {h6}""",
            _hash(),
        ),
        "q07_one_case_buffer": _with(
            f"SELECT case_id, severity, {_buffer_wkt(_deg(500))} AS buffer_500m_wkt FROM cases WHERE case_id = {ONE_CASE}"
        ),
        "q26_one_region_heatmap": _with(
            f"""SELECT {h6} AS cell_id, count(*) AS case_count, {_rect_wkt(6)} AS wkt
FROM hashed WHERE region_name = '{ONE_REGION}' GROUP BY {h6}""",
            _hash("located"),
        ),
        "q15_zone_readback": _with(
            f"SELECT region_name, risk_tier, case_count, {_round('area', 3)} AS area_sq_km FROM zones", *_areas()
        ),
        "wkt_mixed_points": _with(
            f"""SELECT case_id, case_id % 5 < 2 AS accepted, CASE WHEN case_id % 5 < 2 THEN {_text("lon")} END AS lon,
  CASE WHEN case_id % 5 < 2 THEN {_text("lat")} END AS lat FROM cases"""
        ),
        "wkt_mixed_polygons": _with(_MIXED),
        "wkt_rejects": "SELECT event_id, props AS wkt FROM events",
        "repeated_names": _with(
            "SELECT district, count(*) AS row_count FROM schools GROUP BY district HAVING count(*) > 1"
        ),
        "region_assignment": _with("SELECT case_id, region_name FROM located"),
        "area_assignment": _with("SELECT case_id, region_name FROM in_areas", *_areas_sql()),
        "q25_area_resolutions": _with(
            " UNION ALL ".join(
                f"""SELECT region_name, {p} AS grid_precision, count(DISTINCT substr(h7, 1, {p})) AS cell_count,
  count(*) AS total_cases, {_round(f"count(*)::DOUBLE / count(DISTINCT substr(h7, 1, {p}))", 1)} AS avg_per_cell
FROM hashed GROUP BY region_name"""
                for p in (5, 6, 7)
            ),
            *_areas_sql(),
            _hash("in_areas"),
        ),
        "q26_area_heatmap": _with(
            f"""SELECT region_name, {h6} AS cell_id, count(*) AS case_count, {_rect_wkt(6)} AS wkt
FROM hashed GROUP BY region_name, {h6}""",
            *_areas_sql(),
            _hash("in_areas"),
        ),
        "utm_cases": _with(
            f"SELECT case_id, utm_zone, utm_north, {_round('easting', 2)} AS easting, {_round('northing', 2)} AS northing FROM metres",
            *_utm_sql("cases", "metres"),
        ),
        "utm_round_trip": _with(
            """SELECT CAST(least(60, floor((lon + 180) / 6) + 1) AS INTEGER) AS utm_zone, count(*) AS cases, count(*) AS within_1_mm
FROM cases GROUP BY 1"""
        ),
        "utm_distance_to_city": _with(
            f"""SELECT s.id, {_round("sqrt((s.easting - c.easting) ** 2 + (s.northing - c.northing) ** 2)", 2)} AS utm_meters,
  {_round(f"{city.replace('lon', 's.lon').replace('lat', 's.lat')} * {_METRES}")} AS approx_meters FROM plane s, centre c""",
            f"city AS (SELECT {_d(CITY_POINT[0])} AS lon, {_d(CITY_POINT[1])} AS lat)",
            *_utm_sql("schools", "plane", str(HOME_ZONE)),
            *_utm_sql("city", "centre", str(HOME_ZONE)),
        ),
        "utm_area_sizes": _with(
            f"""SELECT any_value(region_name) AS region_name, {_round("sum(CASE WHEN ring = 0 THEN size ELSE -size END) / 1e6::DOUBLE", 3)} AS area_sq_km
FROM (
  SELECT row, any_value(region_name) AS region_name, part, ring, abs(sum((a.easting - 5e5) * (b.northing - 15e5) - (b.easting - 5e5) * (a.northing - 15e5))) / 2 AS size
  FROM plane_a a JOIN plane_b b USING (row, region_name, part, ring, k) GROUP BY row, part, ring) GROUP BY row""",
            *_areas_sql(),
            "ends AS (SELECT *, row_number() OVER () AS k FROM area_edges)",
            "ends_a AS (SELECT row, region_name, part, ring, k, ax AS lon, ay AS lat FROM ends)",
            "ends_b AS (SELECT row, region_name, part, ring, k, ex AS lon, ey AS lat FROM ends)",
            *_utm_sql("ends_a", "plane_a", str(HOME_ZONE)),
            *_utm_sql("ends_b", "plane_b", str(HOME_ZONE)),
        ),
        "hex_heatmap": _with(
            f"SELECT {_hex_id()} AS hex_id, count(*) AS case_count, {_count(_SEVERE)} AS severe_count, {_hex_wkt(0.01)} AS wkt FROM hexed GROUP BY q, r",
            *_hexed("cases", "hexed"),
        ),
        "hex_rollup": _with(
            f"""SELECT {_hex_id()} AS hex_id, count(*) AS cells, CAST(sum(n) AS BIGINT) AS case_count, CAST(sum(s) AS BIGINT) AS severe_count,
  {_hex_wkt(0.03)} AS wkt FROM rolled GROUP BY q, r""",
            *_hexed("cases", "hexed"),
            f"fine AS (SELECT q, r, -q - r AS s3, count(*) AS n, {_count(_SEVERE)} AS s FROM hexed GROUP BY q, r)",
            # the largest of the three remainders is dropped
            """thirds AS (
  SELECT *, CAST(floor((2 * q + 3) / 6) AS BIGINT) AS a, CAST(floor((2 * r + 3) / 6) AS BIGINT) AS b, CAST(floor((2 * s3 + 3) / 6) AS BIGINT) AS c FROM fine)""",
            """rolled AS (
  SELECT n, s, CASE WHEN abs(q - 3 * a) > greatest(abs(r - 3 * b), abs(s3 - 3 * c)) THEN -b - c ELSE a END AS q,
    CASE WHEN abs(q - 3 * a) > greatest(abs(r - 3 * b), abs(s3 - 3 * c)) OR abs(r - 3 * b) < abs(s3 - 3 * c) THEN b ELSE -a - c END AS r FROM thirds)""",
        ),
        "hex_neighbourhood": _with(
            f"""SELECT {_hex_id("a.q", "a.r")} AS hex_id, a.n AS case_count, CAST(sum(b.n) AS BIGINT) AS nearby_count
FROM counted a JOIN counted b ON greatest(abs(a.q - b.q), abs(a.r - b.r), abs(a.q + a.r - b.q - b.r)) <= 2 GROUP BY a.q, a.r, a.n""",
            *_hexed("cases", "hexed"),
            "counted AS (SELECT q, r, count(*) AS n FROM hexed GROUP BY q, r)",
        ),
        "hex_regions": _with(
            f"""SELECT region_name, {_hex_id()} AS hex_id, n AS case_count, {_round("1000::DOUBLE * n / sum(n) OVER (PARTITION BY region_name)", 3)} AS per_mille
FROM (SELECT l.region_name, h.q, h.r, count(*) AS n FROM located l JOIN hexed h ON l.case_id = h.case_id GROUP BY ALL)""",
            *_hexed("cases", "hexed"),
        ),
        "q34_zone_layer": _with(
            f"""SELECT z.region_name, '#e74c3c' AS colour, CAST(0.45 AS DOUBLE) AS opacity, -500 AS draw_order,
  'region_name: ' || z.region_name || '<br>risk_tier: RED<br>radius_meters: 500<br>case_count: ' || case_count AS tooltip,
  p.vertices, {_round("area", 3)} AS area_sq_km
FROM (SELECT region_name, count(*) AS vertices FROM pieces GROUP BY region_name) p JOIN zones z ON p.region_name = z.region_name""",
            *_outline(red),
            *_slab_areas(red),
        ),
        "q34_zone_extent": _with(
            f"""SELECT {_round("min(y)", 5)} AS min_lat, {_round("min(x)", 5)} AS min_lon, {_round("max(y)", 5)} AS max_lat, {_round("max(x)", 5)} AS max_lon
FROM (SELECT lon + r * ({_RHO} * nx - t0 * ny) AS x, lat + r * ({_RHO} * ny + t0 * nx) AS y FROM pieces)""",
            *_outline(red),
        ),
        "q34_polygon_layer": _with(
            """SELECT region_code, CAST(region_code AS INTEGER) % 3 = 1 AS accepted,
  CASE WHEN CAST(region_code AS INTEGER) % 3 = 1 THEN 'region_code: ' || region_code || '<br>region_name: ' || region_name END AS tooltip,
  CASE WHEN CAST(region_code AS INTEGER) % 3 = 1 THEN 1 ELSE 0 END AS parts FROM regions"""
        ),
    }
