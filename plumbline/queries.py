"""The library's own queries over the fixture tables, each with the same question in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import at, load, oracle
from .functions import geo, shapes, text
from .functions.geo import haversine_sql as hav
from .operators import checkpoints, curate, dedup, gap, listings, merge, spatial
from .plans import features, grid, model, radius
from .sources import pages, tables
from .streaming import steps

CENTRE = (-25.2637, -57.5759)
LAT, LNG = (f"CAST({c} AS DOUBLE)" for c in CENTRE)
RADIUS = 100_000.0
QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def cents(c):
    return F.floor(c * 100 + 0.5) / 100


def cents_sql(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def near_sql(table: str, metres: float = RADIUS, more: str = "TRUE", alias: str = "") -> str:
    return f"SELECT * FROM {oracle(table)} WHERE {more} AND {hav('lat', 'lng', LAT, LNG)} <= {metres}"


# Around a point.


@query("radius_population", f"SELECT coalesce(sum(population), 0) AS population FROM ({near_sql('population')})")
def _(spark, d):
    return radius.population(load(spark, d, "population"), *CENTRE, RADIUS)


@query("radius_total", f"SELECT count(*) AS total FROM ({near_sql('business', more='is_active')})")
def _(spark, d):
    return radius.total(load(spark, d, "business"), *CENTRE, RADIUS)


@query("radius_by_category", f"SELECT coalesce(business_category, 'Sin clasificar') AS category, count(*) AS n FROM ({near_sql('business', more='is_active')}) GROUP BY 1")
def _(spark, d):
    return radius.by_category(load(spark, d, "business"), *CENTRE, RADIUS)


@query(
    "radius_top_types",
    f"SELECT business_type, business_category, count(*) AS n FROM ({near_sql('business', 30_000, 'is_active AND category_confidence >= CAST(0.5 AS DOUBLE)')}) GROUP BY 1, 2 ORDER BY n DESC, business_type NULLS LAST, business_category NULLS LAST LIMIT 10",
)
def _(spark, d):
    return radius.top_types(load(spark, d, "business"), *CENTRE, metres=30_000)


@query(
    "radius_ratio",
    f"SELECT total, population, CASE WHEN population > 0 THEN floor(total * 1000 / population * 100 + 0.5) / 100 ELSE 0 END AS per_1000 FROM (SELECT (SELECT count(*) FROM ({near_sql('business', more='is_active')})) AS total, (SELECT coalesce(sum(population), 0) FROM ({near_sql('population')})) AS population)",
)
def _(spark, d):
    return radius.ratio(load(spark, d, "business"), load(spark, d, "population"), *CENTRE, RADIUS)


@query(
    "radius_list_top20",
    f"SELECT id, name, {cents_sql('distance_m')} AS distance_m FROM (SELECT id, name, {hav('lat', 'lng', LAT, LNG)} AS distance_m FROM {oracle('business')} WHERE is_active) WHERE distance_m <= {RADIUS} ORDER BY 3, id LIMIT 20",
)
def _(spark, d):
    return radius.nearest_list(load(spark, d, "business"), *CENTRE, RADIUS, 20).withColumn("distance_m", cents(F.col("distance_m")))


# Listings.
_PINS = f"(SELECT lat, lng, count(*) AS n FROM {oracle('listing')} GROUP BY lat, lng HAVING count(*) >= 10)"
_CLEAN = f"(SELECT l.* FROM {oracle('listing')} l WHERE precio > 0 AND superficie_m2 >= 30 AND NOT EXISTS (SELECT 1 FROM {_PINS} p WHERE p.lat = l.lat AND p.lng = l.lng))"


@query("listing_office_pins", f"SELECT * FROM {_PINS}")
def _(spark, d):
    return listings.office_pins(load(spark, d, "listing"))


@query("listing_clean", f"SELECT id, fuente, operacion, precio, superficie_m2 FROM {_CLEAN}")
def _(spark, d):
    return listings.clean_listings(load(spark, d, "listing")).select("id", "fuente", "operacion", "precio", "superficie_m2")


_DOLLAR = f"(SELECT l.*, CASE WHEN precio <= 0 THEN NULL WHEN moneda = 'USD' THEN precio WHEN moneda = 'PYG' THEN precio / (SELECT max_by(pyg_por_usd, fecha) FROM {oracle('rate')}) END AS precio_usd FROM {oracle('listing')} l)"


@query("listing_dollarize", f"SELECT id, moneda, {cents_sql('precio_usd')} AS precio_usd FROM {_DOLLAR}")
def _(spark, d):
    return listings.dollarize(load(spark, d, "listing"), load(spark, d, "rate")).select("id", "moneda", cents(F.col("precio_usd")).alias("precio_usd"))


_PER_M2 = f"(SELECT *, precio / superficie_m2 AS m2 FROM {_CLEAN})"


@query("listing_trim", f"SELECT id, {cents_sql('m2')} AS precio_m2 FROM {_PER_M2}, (SELECT quantile_cont(m2, 0.01) AS lo, quantile_cont(m2, 0.99) AS hi FROM {_PER_M2}) WHERE m2 >= lo AND m2 <= hi")
def _(spark, d):
    rows = listings.clean_listings(load(spark, d, "listing")).withColumn("precio_m2", F.col("precio") / F.col("superficie_m2"))
    return listings.trim_outliers(rows, "precio_m2").select("id", cents(F.col("precio_m2")).alias("precio_m2"))


@query(
    "listing_summary",
    f"SELECT fuente, count(*) AS n, count(precio_usd) AS n_usd, count(*) FILTER (moneda = 'USD') AS n_in_usd, {cents_sql('min(precio_usd)')} AS low, {cents_sql('max(precio_usd)')} AS high, {cents_sql('median(precio_usd)')} AS middle FROM {_DOLLAR} GROUP BY fuente",
)
def _(spark, d):
    rows = listings.dollarize(load(spark, d, "listing"), load(spark, d, "rate"))
    p = F.col("precio_usd")
    return rows.groupBy("fuente").agg(F.count("*").alias("n"), F.count(p).alias("n_usd"), F.count_if(F.col("moneda") == "USD").alias("n_in_usd"), cents(F.min(p)).alias("low"), cents(F.max(p)).alias("high"), cents(F.percentile(p, F.lit(0.5))).alias("middle"))


def _bucket_sql(left: str, right: str, step: float) -> str:
    """Pairs of points in neighbouring buckets, for oracles."""
    s = f"CAST({step} AS DOUBLE)"
    return f"""(SELECT l.id, r.*, {hav('l.lat', 'l.lng', 'r.lat', 'r.lng')} AS m FROM (SELECT id, lat, lng, CAST(floor(lat / {s}) AS BIGINT) + dy AS bky, CAST(floor(lng / {s}) AS BIGINT) + dx AS bkx FROM {left}, (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx)) l
 JOIN (SELECT * EXCLUDE (id), CAST(floor(lat / {s}) AS BIGINT) AS bky, CAST(floor(lng / {s}) AS BIGINT) AS bkx FROM {right}) r USING (bky, bkx))"""


def _radii_sql(prefix: str, value: str, right: str) -> str:
    sums = ", ".join(f"sum({value}) FILTER (m <= {m}) AS {prefix}_{m}" for m in (500, 1000, 2000))
    return f"SELECT id, {', '.join(f'coalesce({prefix}_{m}, 0) AS {prefix}_{m}' for m in (500, 1000, 2000))} FROM {_CLEAN} LEFT JOIN (SELECT id, {sums} FROM {_bucket_sql(_CLEAN, right, 0.0225)} GROUP BY id) USING (id)"


@query("listing_pop_radii", _radii_sql("pob", "population", oracle("population")))
def _(spark, d):
    rows = listings.clean_listings(load(spark, d, "listing"))
    return features.population_radii(rows, load(spark, d, "population")).select("id", "pob_500", "pob_1000", "pob_2000")


@query("listing_biz_radii", _radii_sql("neg", "CAST(1 AS BIGINT)", f"(SELECT * FROM {oracle('business')} WHERE is_active)").replace("coalesce(neg_500, 0)", "CAST(coalesce(neg_500, 0) AS BIGINT)").replace("coalesce(neg_1000, 0)", "CAST(coalesce(neg_1000, 0) AS BIGINT)").replace("coalesce(neg_2000, 0)", "CAST(coalesce(neg_2000, 0) AS BIGINT)"))
def _(spark, d):
    rows = listings.clean_listings(load(spark, d, "listing"))
    return features.business_radii(rows, load(spark, d, "business")).select("id", "neg_500", "neg_1000", "neg_2000")


@query("listing_dist_center", f"SELECT id, {cents_sql(hav('lat', 'lng', LAT, LNG))} AS dist_centro_m FROM {_CLEAN}")
def _(spark, d):
    return listings.clean_listings(load(spark, d, "listing")).select("id", cents(geo.haversine_m("lat", "lng", *CENTRE)).alias("dist_centro_m"))


# Cells.
_CELL = "(CAST(floor((lat + 90) / CAST(0.003 AS DOUBLE)) AS BIGINT) * 1000000 + CAST(floor((lng + 180) / CAST(0.003 AS DOUBLE)) AS BIGINT))"
_REPS = f"(SELECT cell, min_by(lat, id) AS lat, min_by(lng, id) AS lng FROM (SELECT *, {_CELL} AS cell FROM {oracle('population')}) GROUP BY cell)"


@query("cell_representative", f"SELECT * FROM {_REPS}")
def _(spark, d):
    return features.cell_representatives(load(spark, d, "population"))


#: Kinds of place that stand for the layers in the query over points.
_POI_LAYERS = (("dist_hospital_m", "hospital"), ("dist_universidad_m", "university"), ("dist_agua_m", "police"), ("dist_via_principal_m", "bus_station"))
_NEAR = "min_by({m}, power(c.lat - p.lat, 2) + power(c.lng - p.lng, 2)) FILTER (amenity = '{kind}') AS {name}"


@query(
    "cell_features",
    f"""SELECT cell, {', '.join(f"{cents_sql(n)} AS {n}" for n, _ in _POI_LAYERS)}, coalesce(dist_via_principal_m < 120, false) AS frente_avenida, coalesce(dist_agua_m < 400, false) AS cerca_agua FROM
 (SELECT c.cell, {', '.join(_NEAR.format(m=hav('c.lat', 'c.lng', 'p.lat', 'p.lng'), kind=k, name=n) for n, k in _POI_LAYERS)} FROM {_REPS} c, {oracle('poi')} p GROUP BY c.cell)""",
)
def _(spark, d):
    poi = load(spark, d, "poi").select("id", "amenity", F.lit("Point").alias("type"), F.array(F.struct(F.col("lng").alias("x"), F.col("lat").alias("y"))).alias("path"))
    layers = {name: poi.where(F.col("amenity") == kind) for name, kind in _POI_LAYERS}
    got = features.cell_features(features.cell_representatives(load(spark, d, "population")), layers)
    return got.select("cell", *(cents(F.col(c)).alias(c) for c in layers), "frente_avenida", "cerca_agua")


@query("listing_cell_join", f"SELECT l.id, l.cell, r.cell IS NOT NULL AS known FROM (SELECT id, {_CELL} AS cell FROM {_CLEAN}) l LEFT JOIN {_REPS} r ON l.cell = r.cell")
def _(spark, d):
    cells = features.cell_representatives(load(spark, d, "population")).select("cell", F.lit(True).alias("known"))
    rows = listings.clean_listings(load(spark, d, "listing")).select("id", geo.cell_id("lat", "lng").alias("cell"))
    return rows.join(cells, "cell", "left").select("id", "cell", F.coalesce("known", F.lit(False)).alias("known"))


_KNN = f"(SELECT q.id AS id, p.id AS p, p.v AS v, {hav('q.lat', 'q.lng', 'p.lat', 'p.lng')} AS m FROM {oracle('poi')} q, (SELECT id, category_confidence AS v, lat, lng FROM {oracle('business')}) p)"


def _knn(spark, d, k):
    points = load(spark, d, "business").select(F.col("id").alias("p"), F.col("category_confidence").alias("v"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"))
    return spatial.knn_join(load(spark, d, "poi").select("id", "lat", "lng"), points, k, 10_000.0, "id", "p")


@query("knn_neighbors", f"SELECT id, p, {cents_sql('m')} AS distance_m, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, p) AS k FROM {_KNN}) WHERE k <= 5")
def _(spark, d):
    return _knn(spark, d, 5).select("id", "p", cents(F.col("distance_m")).alias("distance_m"), "rank")


@query("knn_target_mean", f"SELECT id, {cents_sql('avg(v)')} AS neighbour_target, {cents_sql('avg(m)')} AS neighbour_distance_m FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, p) AS k FROM {_KNN}) WHERE k <= 10 GROUP BY id")
def _(spark, d):
    got = model.neighbour_features(load(spark, d, "poi"), load(spark, d, "business"), "category_confidence", 10_000.0)
    return got.select("id", *(cents(F.col(c)).alias(c) for c in ("neighbour_target", "neighbour_distance_m")))


@query("spatial_block_folds", f"SELECT block, count(*) AS n FROM (SELECT concat(CAST(CAST(floor(lat / CAST(0.1 AS DOUBLE)) AS BIGINT) AS VARCHAR), '_', CAST(CAST(floor(lng / CAST(0.1 AS DOUBLE)) AS BIGINT) AS VARCHAR)) AS block FROM {_CLEAN}) GROUP BY block")
def _(spark, d):
    return listings.clean_listings(load(spark, d, "listing")).groupBy(geo.block_id("lat", "lng").alias("block")).agg(F.count("*").alias("n"))


@query(
    "nearest_with_fallback",
    f"""WITH c AS (SELECT b.id AS id, p.id AS p, p.name AS name, p.amenity AS kind, {hav('b.lat', 'b.lng', 'p.lat', 'p.lng')} AS m FROM {oracle('business')} b, {oracle('poi')} p),
 f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, p) AS k FROM c), g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, p) AS k FROM c WHERE name IS NOT NULL AND m <= 15000)
 SELECT f.id, coalesce(f.name, g.name, concat('Via sin nombre (', f.kind, ')')) AS name, {cents_sql('CASE WHEN f.name IS NOT NULL OR g.id IS NULL THEN f.m ELSE g.m END')} AS distance_m FROM f LEFT JOIN g ON f.id = g.id AND g.k = 1 WHERE f.k = 1""",
)
def _(spark, d):
    poi = load(spark, d, "poi").select(F.col("id").alias("shape"), "name", F.col("amenity").alias("kind"), F.lit("Point").alias("type"), F.array(F.struct(F.col("lng").alias("x"), F.col("lat").alias("y"))).alias("path"))
    return radius.nearest_named(load(spark, d, "business").select("id", "lat", "lng"), poi, "id", 15_000.0).select("id", "name", cents(F.col("distance_m")).alias("distance_m"))


# Polygons: one arrow-shaped ring for each region.
_ARROW = ((0.0, 0.0), (0.8, 0.0), (0.4, 0.3), (0.8, 0.8), (0.0, 0.8))
_X0, _Y0 = "(CAST(-58.4 AS DOUBLE) + r_regionkey * CAST(0.3 AS DOUBLE))", "(CAST(-26.4 AS DOUBLE) + r_regionkey * CAST(0.25 AS DOUBLE))"
_EDGES = "(" + " UNION ALL ".join(f"SELECT r_regionkey AS boundary, r_name AS name, {k} AS i, {_X0} + CAST({a} AS DOUBLE) AS x1, {_Y0} + CAST({b} AS DOUBLE) AS y1, {_X0} + CAST({e} AS DOUBLE) AS x2, {_Y0} + CAST({f} AS DOUBLE) AS y2 FROM region" for k, ((a, b), (e, f)) in enumerate(zip(_ARROW, _ARROW[1:] + _ARROW[:1]))) + ")"
_INSIDE = f"(SELECT id, boundary FROM {oracle('business')}, {_EDGES} GROUP BY id, boundary HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lng < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1)"


def _rings(spark, d) -> DataFrame:
    ring = ", ".join(f"named_struct('x', {_X0} + CAST({a} AS DOUBLE), 'y', {_Y0} + CAST({b} AS DOUBLE))" for a, b in _ARROW)
    return spark.sql(f"SELECT r_regionkey AS boundary, r_name AS name, CASE r_regionkey % 3 WHEN 0 THEN '8' WHEN 1 THEN '9' END AS admin_level, CASE WHEN r_regionkey % 3 = 2 THEN 'town' END AS place, array({ring}) AS ring FROM parquet.`{d}/region.parquet`")


@query("point_in_polygon", f"SELECT id, boundary FROM {_INSIDE}")
def _(spark, d):
    return spatial.point_in_polygon(load(spark, d, "business"), _rings(spark, d).select("boundary", "ring"), "id", "boundary")


#: The same rings with a hole each, and the first ring shifted as a second part.
_HOLE = ((0.1, 0.1), (0.3, 0.1), (0.3, 0.6), (0.1, 0.6))
_PARTS = ((_ARROW, 0.0), (_HOLE, 0.0), (_HOLE, 1.0))


def _part_edges(ring, shift) -> str:
    return " UNION ALL ".join(f"SELECT r_regionkey AS boundary, {_X0} + CAST({a + shift} AS DOUBLE) AS x1, {_Y0} + CAST({b} AS DOUBLE) AS y1, {_X0} + CAST({e + shift} AS DOUBLE) AS x2, {_Y0} + CAST({f} AS DOUBLE) AS y2 FROM region" for (a, b), (e, f) in zip(ring, ring[1:] + ring[:1]))


@query(
    "point_in_rings",
    f"SELECT id, boundary FROM {oracle('business')}, ({' UNION ALL '.join(_part_edges(*p) for p in _PARTS)}) GROUP BY id, boundary HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lng < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1",
)
def _(spark, d):
    """Multipolygons, written as GeoJSON texts and read from them."""
    ring = lambda points, shift: "array(" + ", ".join(f"named_struct('x', {_X0} + CAST({a + shift} AS DOUBLE), 'y', {_Y0} + CAST({b} AS DOUBLE))" for a, b in points) + ")"
    some = spark.sql(f"SELECT r_regionkey AS boundary, array({', '.join(ring(*p) for p in _PARTS)}) AS rings FROM parquet.`{d}/region.parquet`")
    texts = some.select("boundary", shapes.geojson_of_shape(F.lit("MultiPolygon"), F.col("rings")).alias("geom"))
    return spatial.point_in_polygon(load(spark, d, "business"), texts.select("boundary", shapes.shape_of_geojson(F.col("geom"))["rings"].alias("rings")), "id", "boundary")


@query("city_priority", f"SELECT id, name AS city FROM (SELECT id, r_name AS name, row_number() OVER (PARTITION BY id ORDER BY CASE r_regionkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END, r_name) AS k FROM {_INSIDE} JOIN region ON r_regionkey = boundary) WHERE k = 1")
def _(spark, d):
    return radius.city_of(load(spark, d, "business"), _rings(spark, d))


@query("polygon_area", f"SELECT boundary, floor(abs(sum(x1 * y2 - x2 * y1)) / 2 * 1000000 + 0.5) / 1000000 AS area FROM {_EDGES} GROUP BY boundary")
def _(spark, d):
    closed = F.concat("ring", F.slice("ring", 1, 1))
    return _rings(spark, d).select("boundary", (F.floor(spatial.ring_area(closed) * 1_000_000 + 0.5) / 1_000_000).alias("area"))


@query("ring_centroid", f"SELECT boundary, floor(avg(x1) * 1000000 + 0.5) / 1000000 AS x, floor(avg(y1) * 1000000 + 0.5) / 1000000 AS y FROM {_EDGES} GROUP BY boundary")
def _(spark, d):
    c = spatial.vertex_mean(F.col("ring"))
    return _rings(spark, d).select("boundary", *((F.floor(c[k] * 1_000_000 + 0.5) / 1_000_000).alias(k) for k in "xy"))


# Text.
_NORM = f"nullif(trim(regexp_replace(lower(translate({{x}}, '{text.MARKED}', '{text.PLAIN}')), '\\s+', ' ', 'g')), '')"


@query("text_norm", f"SELECT doc_id, md5({_NORM.format(x='text')}) AS norm_md5 FROM documents")
def _(spark, d):
    text.create_norm(spark, "plumbline_norm")
    return spark.sql(f"SELECT doc_id, md5(plumbline_norm(text)) AS norm_md5 FROM parquet.`{d}/documents.parquet`")


@query("text_norm_alnum", f"SELECT id, regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]', '', 'g') AS key FROM {oracle('part_name')}")
def _(spark, d):
    return load(spark, d, "part_name").select("id", text.norm_alnum(F.col("name")).alias("key"))


@query("name_clean", f"""SELECT id, regexp_replace(trim(regexp_replace(concat('  "', replace(name, ' ', '   '), '" '), '\\s+', ' ', 'g')), '^["'']|["'']$', '', 'g') AS name FROM {oracle('part_name')}""")
def _(spark, d):
    return load(spark, d, "part_name").select("id", text.clean_name(F.concat(F.lit('  "'), F.replace("name", F.lit(" "), F.lit("   ")), F.lit('" '))).alias("name"))


_CASES = " ".join(f"WHEN contains(low, '{k}') THEN '{v}'" for k, v in text.CATEGORY_PARTS)
_WORDS = "concat(CASE id % 5 WHEN 0 THEN ' Gran HOTEL ' WHEN 1 THEN 'Hardware Store ' WHEN 2 THEN '' ELSE '  ' END, coalesce(business_category, ''))"


@query("category_map", f"SELECT id, CASE WHEN low = '' THEN 'Sin categoria' {_CASES} ELSE low END AS category FROM (SELECT id, trim(lower({_WORDS})) AS low FROM {oracle('business')})")
def _(spark, d):
    return load(spark, d, "business").select("id", text.category_by_part(F.expr(_WORDS)).alias("category"))


_LINK = "concat('https://maps.example.com/place/p', CAST(id AS STRING), CASE WHEN id % 3 = 0 THEN concat('/@-25.', CAST(100000 + id AS STRING), ',-57.', CAST(200000 + id AS STRING), CASE WHEN id % 2 = 0 THEN ',17z' ELSE '?x#y' END) WHEN id % 3 = 1 THEN concat('/data=!3d-25.', CAST(100000 + id AS STRING), '!4d-57.', CAST(200000 + id AS STRING)) ELSE '' END)"


@query(
    "url_coords",
    f"""WITH u AS (SELECT id, {_LINK} AS u FROM {oracle('business')}), c AS (SELECT id, TRY_CAST(regexp_extract(u, '/@(-?[0-9]+\\.[0-9]+),(-?[0-9]+\\.[0-9]+),[0-9]+z', 1) AS DOUBLE) AS a, TRY_CAST(regexp_extract(u, '/@(-?[0-9]+\\.[0-9]+),(-?[0-9]+\\.[0-9]+),[0-9]+z', 2) AS DOUBLE) AS b,
 TRY_CAST(regexp_extract(u, '!3d(-?[0-9]+\\.[0-9]+)!4d(-?[0-9]+\\.[0-9]+)', 1) AS DOUBLE) AS e, TRY_CAST(regexp_extract(u, '!3d(-?[0-9]+\\.[0-9]+)!4d(-?[0-9]+\\.[0-9]+)', 2) AS DOUBLE) AS f FROM u) SELECT id, coalesce(a, e) AS lat, coalesce(b, f) AS lng FROM c""",
)
def _(spark, d):
    return load(spark, d, "business").select("id", text.coordinates(F.expr(_LINK)).alias("c")).select("id", "c.lat", "c.lng")


@query(
    "place_id",
    f"WITH u AS (SELECT id, {_LINK} AS u FROM {oracle('business')}), t AS (SELECT id, nullif(regexp_extract(u, 'data=(.+)$', 1), '') AS a, string_split(u, '/')[-1] AS b FROM u) SELECT id, coalesce(a, CASE WHEN b <> '' AND NOT contains(b, '=') AND NOT contains(b, '@') THEN b END) AS place_id FROM t",
)
def _(spark, d):
    return load(spark, d, "business").select("id", text.place_id(F.expr(_LINK)).alias("place_id"))


@query("page_links", """SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, h[i] AS href FROM (SELECT page_id, h, unnest(range(1, len(h) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS h FROM pages))""")
def _(spark, d):
    return pages.links(load(spark, d, "page"))


@query("page_titles", "SELECT page_id, nullif(trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages")
def _(spark, d):
    return pages.titles(load(spark, d, "page"))


_REPORT = """concat('x {"coordinates":"POINT(-57.', CAST(100000 + id AS STRING), ' -25.', CAST(200000 + id AS STRING), ')","type":"t', CAST(id % 3 AS STRING), '","cat":"c","name":"', name, '"} y')"""


@query("embedded_records", f"SELECT id, CAST(0 AS INTEGER) AS pos, CAST(concat('-57.', CAST(100000 + id AS VARCHAR)) AS DOUBLE) AS lng, CAST(concat('-25.', CAST(200000 + id AS VARCHAR)) AS DOUBLE) AS lat, concat('t', CAST(id % 3 AS VARCHAR)) AS type, 'c' AS cat, name FROM {oracle('business')}")
def _(spark, d):
    return pages.embedded_points(load(spark, d, "business").select("id", F.expr(_REPORT).alias("html")), "id")


# Curation.
_MAP = (("construccion", "trade", "construction"), ("building", "shop", "construction"), ("automobile", "shop", "vehicles"), ("furniture", "shop", "home"), ("widget", "trade", "metal"), ("gear", "trade", "metal"), ("small", "trade", "other"))
_RAW = """(SELECT c.id AS id, p.name AS name, CASE c.id % 7 WHEN 0 THEN NULL WHEN 1 THEN concat(p.name, ' 4.', CAST(c.id % 10 AS STRING), ' ', c.category) WHEN 2 THEN concat('x No hay OPINIONES ', c.category, ' cerrado temporalmente') WHEN 3 THEN concat(' ', c.category, ' Abierto 24 horas')
 WHEN 4 THEN concat('Abierto ', c.category) WHEN 5 THEN 'Construcción' ELSE c.category END AS category, CASE WHEN c.id % 8 < 4 THEN c.category ELSE 'otro' END AS search_category, c.is_active AS is_active FROM {b} c JOIN {p} p ON p.id = c.id)"""
_RAW_SQL = _RAW.format(b=oracle("business"), p=oracle("part_name"))
_PLAIN = "strip_accents(lower(trim(coalesce({x}, ''))))"
_KEY = f"nullif(regexp_replace({_PLAIN}, '{curate.STATUS}', ''), '')"
_TAIL = rf"CASE WHEN regexp_matches(category, '\d\.\d\s+(.*)$') THEN trim(regexp_extract(category, '\d\.\d\s+(.*)$', 1)) WHEN regexp_matches(category, '(?i)no hay opiniones\s+(.*)$') THEN trim(regexp_extract(category, '(?i)no hay opiniones\s+(.*)$', 1)) END"
_VALUES = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _MAP)
_NAMES = "|".join(sorted((k for k, _, _ in _MAP if len(k) >= 5), key=len, reverse=True))
_CURATED = f"""(WITH m(k, t, c) AS (VALUES {_VALUES}), r AS (SELECT *, {_TAIL} AS raw_category FROM {_RAW_SQL}), q AS (SELECT *, {_KEY.format(x='raw_category')} AS k1, {_KEY.format(x='category')} AS k2, {_KEY.format(x='search_category')} AS k3, regexp_extract_all({_PLAIN.format(x='name')}, '\\b({_NAMES})\\b', 1) AS f FROM r),
 w AS (SELECT id, arg_max(f[i], length(f[i]) * 1000 - i) AS k4 FROM (SELECT id, f, unnest(range(1, len(f) + 1)) AS i FROM q) GROUP BY id)
 SELECT q.id AS id, raw_category, coalesce(a.t, b.t, s.t, n.t) AS business_type, coalesce(a.c, b.c, s.c, n.c) AS business_category,
 CASE WHEN a.k IS NOT NULL THEN 'google_categoria' WHEN b.k IS NOT NULL THEN 'categoria_original' WHEN s.k IS NOT NULL THEN 'search_category' WHEN n.k IS NOT NULL THEN 'nombre' END AS category_source,
 CAST(CASE WHEN a.k IS NOT NULL THEN 0.90 WHEN b.k IS NOT NULL THEN 0.85 WHEN s.k IS NOT NULL THEN 0.60 WHEN n.k IS NOT NULL THEN 0.50 END AS DOUBLE) AS category_confidence
 FROM q LEFT JOIN w ON w.id = q.id LEFT JOIN m a ON a.k = k1 LEFT JOIN m b ON b.k = k2 LEFT JOIN m s ON s.k = k3 LEFT JOIN m n ON n.k = k4)"""


def _raw(spark, d) -> DataFrame:
    load(spark, d, "business").createOrReplaceTempView("plumbline_business")
    load(spark, d, "part_name").createOrReplaceTempView("plumbline_part")
    return spark.sql(f"SELECT * FROM {_RAW.format(b='plumbline_business', p='plumbline_part')}")


def _curated(spark, d) -> DataFrame:
    return curate.curate(_raw(spark, d), spark.createDataFrame(_MAP, "raw_norm string, type string, category string"))


@query("curate_cascade", f"SELECT * FROM {_CURATED}")
def _(spark, d):
    return _curated(spark, d).select("id", "raw_category", "business_type", "business_category", "category_source", "category_confidence")


@query("curate_distribution", f"SELECT category_source, count(*) AS n, floor(count(*) / (sum(count(*)) OVER ()) * 10000 + 0.5) / 10000 AS share FROM {_CURATED} GROUP BY category_source")
def _(spark, d):
    return curate.distribution(_curated(spark, d), "category_source").withColumn("share", F.floor(F.col("share") * 10_000 + 0.5) / 10_000)


@query("clean_rows", f"SELECT id FROM {_RAW_SQL} WHERE is_active AND category IS NOT NULL AND trim(category) <> '' AND category <> 'Sin categoria' AND search_category IS NOT NULL AND trim(search_category) <> ''")
def _(spark, d):
    return curate.clean_rows(_raw(spark, d)).select("id")


# Dedup and merge.
@query("dedup_exact_name", f"SELECT id, name FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY length(name) DESC, id) AS k FROM {oracle('part_name')}) WHERE k = 1")
def _(spark, d):
    return dedup.dedup_exact_name(load(spark, d, "part_name")).select("id", "name")


#: One row after another, with the list of seeds so far; a row joins the first one that is near.
_GREEDY = f"""(WITH RECURSIVE b AS (SELECT id, name, lat, lng, row_number() OVER (ORDER BY id) AS i FROM {oracle('business')}), g AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS seed, CAST([] AS STRUCT(id BIGINT, lat DOUBLE, lng DOUBLE)[]) AS seeds
 UNION ALL SELECT i, id, coalesce(hit, id), CASE WHEN hit IS NULL THEN list_append(seeds, {{'id': id, 'lat': lat, 'lng': lng}}) ELSE seeds END FROM
  (SELECT b.i AS i, CAST(b.id AS BIGINT) AS id, b.lat AS lat, b.lng AS lng, g.seeds AS seeds, list_filter(g.seeds, lambda s: {hav('s.lat', 's.lng', 'b.lat', 'b.lng')} < 12000)[1].id AS hit FROM g JOIN b ON b.i = g.i + 1))
 SELECT g.id AS id, g.seed AS seed, b.name AS name FROM g JOIN b ON b.id = g.id)"""


@query("dedup_proximity", f"SELECT id, name FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY length(name) DESC, id) AS k FROM {_GREEDY}) WHERE k = 1")
def _(spark, d):
    return dedup.dedup_proximity(load(spark, d, "business"), 12_000.0).select("id", "name")


_STORED = f"(SELECT id, name, lat, lng, CASE WHEN id % 3 = 0 THEN concat('p', CAST(id AS STRING)) END AS google_place_id, CASE WHEN id % 3 = 1 THEN concat('u', CAST(id AS STRING)) END AS source_url FROM {{b}} WHERE id % 2 = 0)"
_COMING = f"(SELECT id AS seq, upper(name) AS name, lat + CAST(0.0001 AS DOUBLE) * (id % 15) AS lat, lng, CASE WHEN id % 9 = 0 THEN concat('p', CAST(id AS STRING)) END AS google_place_id, CASE WHEN id % 7 = 1 THEN concat('u', CAST(id AS STRING)) END AS source_url FROM {{b}})"


@query(
    "merge_tiered",
    f"""WITH s AS {_STORED.format(b=oracle('business'))}, n AS {_COMING.format(b=oracle('business'))}, t AS (SELECT seq, s.id AS id, 1 AS tier FROM n JOIN s ON n.google_place_id = s.google_place_id UNION ALL SELECT seq, s.id, 2 FROM n JOIN s ON n.source_url = s.source_url
 UNION ALL SELECT seq, s.id, 3 FROM n JOIN s ON lower(n.name) = lower(s.name) AND {hav('n.lat', 'n.lng', 's.lat', 's.lng')} <= 100) SELECT seq, id, CAST(tier AS INTEGER) AS tier FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY tier, id) AS k FROM t) WHERE k = 1""",
)
def _(spark, d):
    load(spark, d, "business").createOrReplaceTempView("plumbline_business")
    return merge.match_tiers(spark.sql(f"SELECT * FROM {_STORED.format(b='plumbline_business')}"), spark.sql(f"SELECT * FROM {_COMING.format(b='plumbline_business')}"))


_STATE = f"(SELECT task, max_by(status, seq) AS status, max_by(results_count, seq) FILTER (status = 'completed') AS results_count, CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS retry_count FROM {oracle('task_event')} GROUP BY task)"


@query("task_state", f"SELECT * FROM {_STATE}")
def _(spark, d):
    return merge.task_state(load(spark, d, "task_event"))


@query("task_resume", f"SELECT task FROM {_STATE} WHERE status <> 'completed'")
def _(spark, d):
    events = load(spark, d, "task_event")
    return merge.tasks_to_resume(events.select("task").distinct(), events)


@query("repair_missing", f"SELECT id, coalesce(business_category, category) AS category FROM {oracle('business')}")
def _(spark, d):
    b = load(spark, d, "business")
    stored = b.select("id", F.col("id").cast("string").alias("source_url"), F.col("business_category").alias("category"))
    return merge.repair_categories(stored, b.select(F.col("id").cast("string").alias("source_url"), "category")).select("id", "category")


@query("portal_distinct_sources", f"SELECT count(DISTINCT fuente) AS fuentes, count(*) AS n FROM {oracle('listing')}")
def _(spark, d):
    return load(spark, d, "listing").agg(F.count_distinct("fuente").alias("fuentes"), F.count("*").alias("n"))


# Search grids.
_BOX = (-26.5, -24.0, -58.5, -56.0)


def _cells(spark) -> DataFrame:
    return grid.grid_cells(spark, *_BOX, 25.0)


_STEP = "(CAST(25 AS DOUBLE) / CAST(111.32 AS DOUBLE))"
_GRID = f"""(SELECT CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, y AS lat_min, least(y + {_STEP}, CAST(-24 AS DOUBLE)) AS lat_max, CAST(-58.5 AS DOUBLE) + col * dx AS lng_min, least(CAST(-58.5 AS DOUBLE) + (col + 1) * dx, CAST(-56 AS DOUBLE)) AS lng_max FROM
 (SELECT row, y, dx, unnest(range(CAST(ceil(CAST(2.5 AS DOUBLE) / dx - 1e-9) AS BIGINT))) AS col FROM (SELECT row, y, CAST(25 AS DOUBLE) / (CAST(111.32 AS DOUBLE) * cos(radians(y))) AS dx FROM (SELECT row, CAST(-26.5 AS DOUBLE) + row * {_STEP} AS y FROM (SELECT unnest(range(CAST(ceil(CAST(2.5 AS DOUBLE) / {_STEP} - 1e-9) AS BIGINT))) AS row)))))"""


#: The box around all businesses, in place of the fixed one.
_SPAN = f"(SELECT min(lat) AS s, max(lat) AS n, min(lng) AS w, max(lng) AS e FROM {oracle('business')})"


@query(
    "grid_cells",
    f"""WITH x AS MATERIALIZED {_SPAN}, r AS (SELECT *, s + row * {_STEP} AS y FROM (SELECT *, unnest(range(CAST(ceil((n - s) / {_STEP} - 1e-9) AS BIGINT))) AS row FROM x)), c AS (SELECT *, CAST(25 AS DOUBLE) / (CAST(111.32 AS DOUBLE) * cos(radians(y))) AS dx FROM r)
 SELECT CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, floor(y * 1000000 + 0.5) / 1000000 AS lat_min, floor(least(w + (col + 1) * dx, e) * 1000000 + 0.5) / 1000000 AS lng_max FROM (SELECT *, unnest(range(CAST(ceil((e - w) / dx - 1e-9) AS BIGINT))) AS col FROM c)""",
)
def _(spark, d):
    box = load(spark, d, "business").agg(F.min("lat"), F.max("lat"), F.min("lng"), F.max("lng")).first()
    return grid.grid_cells(spark, *box, 25.0).select("row", "col", *((F.floor(F.col(c) * 1_000_000 + 0.5) / 1_000_000).alias(c) for c in ("lat_min", "lng_max")))


@query(
    "grid_priority",
    f"SELECT row, col, floor(min({hav('(lat_min + lat_max) / 2', '(lng_min + lng_max) / 2', 'd.lat', 'd.lng')}) / 1000 * CASE WHEN min(CASE WHEN d.id < 5 THEN {hav('(lat_min + lat_max) / 2', '(lng_min + lng_max) / 2', 'd.lat', 'd.lng')} END) <= 25000 THEN CAST(0.1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END * 100 + 0.5) / 100 AS priority FROM {_GRID}, {oracle('district')} d GROUP BY row, col",
)
def _(spark, d):
    districts = load(spark, d, "district")
    return grid.priorities(_cells(spark), districts, districts.where("id < 5")).select("row", "col", "priority")


@query("task_shards", f"SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) % 7 AS INTEGER) AS shard, CAST(ntile(7) OVER (ORDER BY id) - 1 AS INTEGER) AS part FROM {oracle('poi')}")
def _(spark, d):
    rows = load(spark, d, "poi").select("id")
    dealt = tables.shards(rows, ["id"], 7)
    return tables.shards(dealt.withColumnRenamed("shard", "dealt"), ["id"], 7, contiguous=True).select("id", F.col("dealt").alias("shard"), F.col("shard").alias("part"))


# Coverage of a report.
_SHIFT = f"(SELECT id, name, category, lat + CASE id % 4 WHEN 0 THEN CAST(0.0001 AS DOUBLE) WHEN 1 THEN CAST(0.0005 AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) END AS lat, lng FROM (SELECT id, CASE WHEN id % 4 = 3 THEN concat(name, 'x') ELSE name END AS name, category, lat, lng FROM {{b}}))"
_FOUND = f"""(WITH r AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS n FROM {_SHIFT.format(b=oracle('business'))}), b AS (SELECT s.lat AS lat, s.lng AS lng, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS n FROM {oracle('business')} s JOIN (SELECT min(lat) AS a, max(lat) AS b, min(lng) AS c, max(lng) AS d FROM r) x ON s.lat BETWEEN a - 0.02 AND b + 0.02 AND s.lng BETWEEN c - 0.02 AND d + 0.02),
 c AS (SELECT r.id AS id, bool_or(m <= 25) AS near, bool_or(n <> '' AND k <> '' AND (left(n, 8) = left(k, 8) OR contains(k, n) OR contains(n, k))) AS alike FROM (SELECT r.id AS id, r.n AS n, b.n AS k, {hav('r.lat', 'r.lng', 'b.lat', 'b.lng')} AS m FROM r JOIN b ON abs(r.lat - b.lat) < 0.001 AND abs(r.lng - b.lng) < 0.001) r WHERE m <= 70 GROUP BY r.id)
 SELECT r.id AS id, r.category AS category, CASE WHEN c.near THEN 'near' WHEN c.alike THEN 'near_name' WHEN r.n IN (SELECT n FROM b WHERE length(n) >= 5) THEN 'name' ELSE 'missing' END AS found FROM r LEFT JOIN c ON c.id = r.id)"""


def _gap(spark, d) -> DataFrame:
    b = load(spark, d, "business")
    b.createOrReplaceTempView("plumbline_business")
    return gap.classify_gap(spark.sql(f"SELECT * FROM {_SHIFT.format(b='plumbline_business')}"), b)


@query("gap_classification", f"SELECT id, found FROM {_FOUND}")
def _(spark, d):
    return _gap(spark, d).select("id", "found")


@query("gap_by_type", f"SELECT category, found, count(*) AS n FROM {_FOUND} GROUP BY 1, 2")
def _(spark, d):
    return _gap(spark, d).groupBy("category", "found").agg(F.count("*").alias("n"))


@query(
    "regression_metrics",
    f"SELECT {cents_sql('avg(abs(e))')} AS mae, {cents_sql('median(abs(e))')} AS medae, {cents_sql('avg(abs(e) / nullif(abs(y), 0)) * 100')} AS mape, {cents_sql('sqrt(avg(e * e))')} AS rmse, floor((1 - sum(e * e) / (count(*) * var_pop(y))) * 1000000 + 0.5) / 1000000 AS r2 FROM (SELECT precio AS y, precio * (CAST(90 AS DOUBLE) + id % 21) / 100 - precio AS e FROM {_CLEAN})",
)
def _(spark, d):
    rows = listings.clean_listings(load(spark, d, "listing")).select(F.col("precio").alias("y"), (F.col("precio") * (F.lit(90.0) + F.col("id") % 21) / 100).alias("p"))
    got = model.regression_metrics(rows)
    return got.select(*(cents(F.col(c)).alias(c) for c in ("mae", "medae", "mape", "rmse")), (F.floor(F.col("r2") * 1_000_000 + 0.5) / 1_000_000).alias("r2"))


# Streams.
def _work(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{checkpoints.checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


@query("stream_dedup_equiv", ORACLES["dedup_exact_name"])
def _(spark, d):
    work = _work(spark, "dedup")
    schema = spark.read.parquet(f"{d}/part.parquet").schema
    stream = steps.parquet_stream(spark, d, "part.parquet", schema).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    steps.dedup_batches(stream, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    # Batches are deduplicated each; the last step does it across them.
    return dedup.dedup_exact_name(spark.read.parquet(f"{work}/out")).select("id", "name")


@query("stream_task_ledger", ORACLES["task_state"])
def _(spark, d):
    work = _work(spark, "ledger")
    from .fixtures import TABLES

    schema = spark.read.parquet(f"{d}/events.parquet").schema
    steps.parquet_stream(spark, d, "events.parquet", schema).createOrReplaceTempView("plumbline_events")
    stream = spark.sql(TABLES["task_event"].replace("{events}", "plumbline_events"))
    q = steps.ledger(stream, f"{work}/out", f"{work}/checkpoint")
    q.awaitTermination()
    return steps.ledger_state(spark, f"{work}/out")


@query("ext_tumbling_events", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    got = steps.windows(spark.read.parquet(f"{d}/events.parquet"), "1 day")
    return got.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query(
    "ext_session_events",
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events), n AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, count(DISTINCT k) AS sessions, count(*) AS n FROM n GROUP BY user_id",
)
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("t", F.col("ts").cast("timestamp"))
    sessions = e.groupBy("user_id", F.session_window("t", "30 minutes")).agg(F.count("*").alias("n"))
    return sessions.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))


@query(
    "ext_asof_fx",
    f"SELECT o_orderkey AS id, {cents_sql('o_totalprice / r.pyg_por_usd')} AS precio_usd FROM (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) + CAST(10000 + o_orderkey % 5 AS INTEGER) AS dia FROM orders) o ASOF LEFT JOIN {oracle('rate')} r ON o.dia >= r.fecha",
)
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("precio"), F.lit("PYG").alias("moneda"), F.date_add(F.to_date("o_orderdate"), (F.lit(10_000) + F.col("o_orderkey") % 5).cast("int")).alias("dia"))
    return listings.dollarize_as_of(o, load(spark, d, "rate"), "dia").select("id", cents(F.col("precio_usd")).alias("precio_usd"))


from . import map_queries  # noqa: E402, F401  adds its queries to those above, and those of table_queries
