"""Queries over features, folds, boundaries, task tables and stored tables; imported by ``map_queries``, whose layers it uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fixtures import load, oracle
from .functions import geo, text
from .functions.geo import haversine_sql as hav
from .map_queries import _CARD, _CARD_ROWS, _LAYERS, _MILLIONTH, _NEAR_LAYERS, _cards, _elements
from .operators import listings, merge
from .operators.order import numbered
from .plans import features, grid, model, radius
from .queries import _ARROW, _BOX, _CELL, _CLEAN, _CURATED, _DOLLAR, _GRID, _HOLE, _MAP, _RAW_SQL, CENTRE, LAT, LNG, _bucket_sql, _cells, _raw, cents, cents_sql, query
from .sources import cards, osm, tables

_D = "CAST({} AS DOUBLE)"


# Listings as the price model sees them.
_USE = "CASE id % 4 WHEN 0 THEN 'comercial' WHEN 1 THEN 'habitacional' WHEN 2 THEN 'otro' END"


def _priced(spark, d) -> DataFrame:
    return listings.dollarize(load(spark, d, "listing"), load(spark, d, "rate")).withColumn("uso", F.expr(_USE))


def _features(spark, d) -> DataFrame:
    rows = _priced(spark, d)
    reps = features.cell_representatives(load(spark, d, "population"))
    wanted = rows.select(geo.cell_id("lat", "lng").alias("cell")).distinct()
    by_cell = features.layer_features(reps.join(wanted, "cell", "left_semi"), osm.layers(*_elements(spark, d)))
    return model.model_features(features.listing_features(rows, load(spark, d, "population"), load(spark, d, "business"), by_cell, CENTRE))


_PRICED = f"(SELECT c.id, c.lat, c.lng, c.superficie_m2, {_USE.replace('id %', 'c.id %')} AS uso, {_CELL.replace('lat +', 'c.lat +').replace('lng +', 'c.lng +')} AS cell, floor(p.precio_usd / c.superficie_m2 * 100 + 0.5) / 100 AS usd_m2 FROM {_CLEAN} c JOIN {_DOLLAR} p ON p.id = c.id WHERE p.precio_usd > 0)"
_TRIMMED = f"(SELECT t.* FROM {_PRICED} t, (SELECT quantile_cont(usd_m2, 0.01) AS lo, quantile_cont(usd_m2, 0.99) AS hi FROM {_PRICED}) WHERE usd_m2 >= lo AND usd_m2 <= hi)"


def _near_sums(prefix: str, value: str, right: str) -> str:
    return f"(SELECT id, {', '.join(f'sum({value}) FILTER (m <= {m}) AS {prefix}_{n}' for m, n in ((500, '500m'), (1000, '1km'), (2000, '2km')))} FROM {_bucket_sql('base', right, 0.0225)} GROUP BY id)"


_COUNTS = [f"{p}_{n}" for p in ("pop", "biz") for n in ("500m", "1km", "2km")]


@query(
    "listing_features",
    f"""{_NEAR_LAYERS}, base AS MATERIALIZED (SELECT * FROM {_TRIMMED}), wide AS (SELECT cell, {', '.join(f"max(m) FILTER (layer = '{n}') AS {n}" for n in _LAYERS)} FROM mm GROUP BY cell)
 SELECT base.id, usd_m2, base.lat, base.lng, floor({hav('base.lat', 'base.lng', LAT, LNG)} / 10 + 0.5) / 100 AS dist_asuncion_km, {', '.join(f"{cents_sql(n)} AS {n}" for n in _LAYERS)},
 CASE WHEN wide.cell IS NOT NULL THEN CASE WHEN dist_via_principal_m < 120 THEN {_D.format(1)} ELSE 0 END END AS frente_avenida, CASE WHEN wide.cell IS NOT NULL THEN CASE WHEN dist_agua_m < 400 THEN {_D.format(1)} ELSE 0 END END AS cerca_agua,
 {', '.join(f"CAST(coalesce({c}, 0) AS {'DOUBLE' if c.startswith('pop') else 'BIGINT'}) AS {c}" for c in _COUNTS)}, {cents_sql('ln(1 + superficie_m2) * 100')} AS log_superficie, CASE uso WHEN 'comercial' THEN {_D.format(1)} WHEN 'habitacional' THEN {_D.format(0)} END AS uso_comercial
 FROM base LEFT JOIN wide ON wide.cell = base.cell LEFT JOIN {_near_sums('pop', 'population', oracle('population'))} p ON p.id = base.id LEFT JOIN {_near_sums('biz', 'CAST(1 AS BIGINT)', f"(SELECT * FROM {oracle('business')} WHERE is_active)")} b ON b.id = base.id""",
)
def _(spark, d):
    """All eighteen columns of model.FEATURES and the price."""
    got = _features(spark, d)
    shown = {**{c: cents(F.col(c)) for c in _LAYERS}, "log_superficie": cents(F.col("log_superficie") * 100)}
    return got.select("id", "usd_m2", *(shown.get(c, F.col(c)).alias(c) for c in model.FEATURES))


@query(
    "listing_neighbours",
    f"""WITH base AS MATERIALIZED (SELECT * FROM {_TRIMMED}), n AS (SELECT q.id AS id, unnest(min({{'m': {hav('q.lat', 'q.lng', 'p.lat', 'p.lng')}, 'p': p.id, 'y': ln(1 + p.usd_m2)}}, 10)) AS n FROM base q JOIN base p ON p.id <> q.id AND abs(p.lat - q.lat) < 0.5 AND abs(p.lng - q.lng) < 0.5 GROUP BY q.id)
 SELECT id, {cents_sql('avg(n.y) * 100')} AS vecinos_log_usd_m2, {cents_sql('avg(n.m) / 10')} AS vecinos_dist_km FROM n GROUP BY id""",
)
def _(spark, d):
    """The other two columns that the model adds, in hundredths: each listing's neighbours among all others."""
    rows = listings.clean_listings(_priced(spark, d)).where("precio_usd > 0").withColumn("usd_m2", F.floor(F.col("precio_usd") / F.col("superficie_m2") * 100 + 0.5) / 100)
    rows = listings.trim_outliers(rows, "usd_m2").select("id", "lat", "lng", "usd_m2")
    got = model.with_neighbours(rows, rows, "usd_m2", 5_000.0, skip_self=True)
    return got.select("id", *(cents(F.col(c) * 100).alias(c) for c in model.NEIGHBOUR_FEATURES))


@query(
    "spatial_folds",
    f"""WITH RECURSIVE s AS (SELECT block, count(*) AS n FROM (SELECT concat(CAST(CAST(floor(lat / {_D.format(0.1)}) AS BIGINT) AS VARCHAR), '_', CAST(CAST(floor(lng / {_D.format(0.1)}) AS BIGINT) AS VARCHAR)) AS block FROM {_CLEAN}) GROUP BY block),
 o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY n DESC, block) AS i FROM s), g AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS block, CAST(0 AS BIGINT) AS n, CAST(NULL AS INTEGER) AS fold, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS load
  UNION ALL SELECT o.i, o.block, o.n, CAST(list_position(g.load, list_min(g.load)) - 1 AS INTEGER), list_transform(g.load, lambda x, k: CASE WHEN k = list_position(g.load, list_min(g.load)) THEN x + o.n ELSE x END) FROM g JOIN o ON o.i = g.i + 1)
 SELECT block, n, fold FROM g WHERE i > 0""",
)
def _(spark, d):
    return model.balanced_folds(listings.clean_listings(load(spark, d, "listing")).withColumn("block", geo.block_id("lat", "lng")))


_MEAN = "avg(precio_usd) FILTER ({} = '{}')"


@query(
    "listing_price_summary",
    f"SELECT fuente, count(*) AS n, count(precio_usd) AS n_usd, {cents_sql('min(precio_usd)')} AS low, {cents_sql('avg(precio_usd)')} AS mean, {cents_sql('max(precio_usd)')} AS high, {cents_sql(_MEAN.format('moneda', 'USD'))} AS mean_in_usd, {cents_sql(_MEAN.format('operacion', 'venta'))} AS mean_of_sales FROM {_DOLLAR} GROUP BY fuente",
)
def _(spark, d):
    return listings.price_summary(_priced(spark, d)).select("fuente", "n", "n_usd", *(cents(F.col(c)).alias(c) for c in ("low", "mean", "high", "mean_in_usd", "mean_of_sales")))


# Boundaries: for each region a polygon with a hole, a smaller one of the same name in another spelling, and a point.
_X0, _Y0 = "(CAST(-58.4 AS DOUBLE) + r_regionkey * CAST(0.3 AS DOUBLE))", "(CAST(-26.4 AS DOUBLE) + r_regionkey * CAST(0.25 AS DOUBLE))"
_SPELLING = "translate(lower(r_name), 'aei', 'áéí')"


def _shoelace(ring) -> float:
    return abs(sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]))) / 2


@query(
    "largest_boundary",
    f"SELECT CAST(r_regionkey * 10 AS BIGINT) AS id, r_name AS name, '8' AS admin_level, 'Polygon' AS type, {_shoelace(_ARROW) - _shoelace(_HOLE):.6f}::DOUBLE AS area, floor({_X0} * 1000000 + 0.5) / 1000000 AS x0, floor(({_Y0} + 0.8) * 1000000 + 0.5) / 1000000 AS y1 FROM region",
)
def _(spark, d):
    ring = lambda points, s: "array(" + ", ".join(f"named_struct('x', {_X0} + CAST({a * s} AS DOUBLE), 'y', {_Y0} + CAST({b * s} AS DOUBLE))" for a, b in points) + ")"
    table = f"parquet.`{d}/region.parquet`"
    rows = spark.sql(
        f"""SELECT CAST(r_regionkey * 10 AS BIGINT) AS id, r_name AS name, '8' AS admin_level, 'Polygon' AS type, array({ring(_ARROW, 1)}, {ring(_HOLE, 1)}) AS rings FROM {table}
 UNION ALL SELECT CAST(r_regionkey * 10 + 1 AS BIGINT), {_SPELLING}, '9', 'Polygon', array({ring(_ARROW, 0.8)}) FROM {table} UNION ALL SELECT CAST(r_regionkey * 10 + 2 AS BIGINT), r_name, NULL, 'Point', array({ring(_ARROW[:1], 1)}) FROM {table}"""
    )
    kind = F.from_json("geojson", "type string")["type"]
    return radius.largest_named(rows).select("id", "name", "admin_level", kind.alias("type"), *(_MILLIONTH(F.col(c)).alias(n) for n, c in (("area", "area"), ("x0", "box.x0"), ("y1", "box.y1"))))


# Pages and reports.
@query(
    "extraction_report",
    f"""WITH r AS (SELECT page, count(*) AS u, count(*) FILTER (category <> '') AS c FROM {_CARD_ROWS} GROUP BY page), t AS (SELECT page, count(*) AS t FROM ({_CARD.format(b=oracle('business'))}) GROUP BY page), e AS (SELECT page, t, u, c FROM r JOIN t USING (page))
 SELECT page, false AS overall, t AS total_cards, u AS unique_results, c AS with_category, u - c AS without_category, floor(CAST(c AS DOUBLE) / u * 100 + 0.5) AS success_rate FROM e
 UNION ALL SELECT NULL, true, CAST(sum(t) AS BIGINT), CAST(sum(u) AS BIGINT), CAST(sum(c) AS BIGINT), CAST(sum(u) - sum(c) AS BIGINT), floor(CAST(sum(c) AS DOUBLE) / sum(u) * 100 + 0.5) FROM e""",
)
def _(spark, d):
    return cards.extraction_report(*_cards(spark, d), "page")


# Grids and tasks.
@query("point_cells", f"SELECT p.id AS id, g.row AS row, g.col AS col FROM {oracle('business')} p LEFT JOIN {_GRID} g ON p.lat >= g.lat_min AND p.lat < g.lat_max AND p.lng >= g.lng_min AND p.lng < g.lng_max")
def _(spark, d):
    cell = grid.cell_of_point(F.col("lat"), F.col("lng"), *_BOX, 25.0)
    return load(spark, d, "business").select("id", cell.alias("c")).select("id", "c.row", "c.col")


_KINDS = f"(SELECT DISTINCT business_category AS category FROM {oracle('business')} WHERE business_category IS NOT NULL)"


@query(
    "grid_tasks",
    f"""WITH k AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS pos FROM {_KINDS}), g AS (SELECT g.*, (SELECT min({hav('(lat_min + lat_max) / 2', '(lng_min + lng_max) / 2', 'd.lat', 'd.lng')}) FROM {oracle('district')} d) / 1000 AS km FROM {_GRID} g), p AS (SELECT *, floor(km * CASE WHEN km <= 25 THEN {_D.format(0.1)} ELSE 1 END * 100 + 0.5) / 100 AS priority FROM g)
 SELECT row, col, category, CAST(pos AS INTEGER) AS category_pos, priority, row_number() OVER (ORDER BY priority, lat_min, lng_min, pos) AS place, concat('https://www.google.com/maps/search/', category, '/@', printf('%.6f', (lat_min + lat_max) / 2), ',', printf('%.6f', (lng_min + lng_max) / 2), ',10z') AS url FROM p, k""",
)
def _(spark, d):
    """The search plan: each cell with each category that occurs, in order of priority, with its place in the order and the link to search by."""
    districts = load(spark, d, "district")
    names = [r.category for r in load(spark, d, "business").select(F.col("business_category").alias("category")).where("category is not null").distinct().orderBy("category").collect()]  # a handful of categories
    placed = numbered(grid.tasks(grid.priorities(_cells(spark), districts, districts), names), ["priority", "lat_min", "lng_min", "category_pos"], "place")
    middle = lambda a, b: (F.col(a) + F.col(b)) / 2
    zoom = geo.zoom_level(geo.box_area_km2("lat_min", "lat_max", "lng_min", "lng_max"))
    url = text.maps_url(middle("lat_min", "lat_max"), middle("lng_min", "lng_max"), F.least(zoom, F.lit(10)), F.col("category"))
    return placed.select("row", "col", "category", "category_pos", "priority", (F.col("place") + 1).alias("place"), url.alias("url"))


_KM, _KM_OF = _D.format(111.32), f"({_D.format(111.32)} * cos(radians(lat_min)))"


@query(
    "circle_grids",
    f"""WITH c AS (SELECT id, lat, lng, row, col, lat - 40 / {_KM} + row * (5 / {_KM}) AS lat_min FROM {oracle('district')}, (SELECT unnest(range(16)) AS row), (SELECT unnest(range(16)) AS col)),
 e AS (SELECT *, lat_min + 5 / {_KM} AS lat_max, lng - 40 / {_KM_OF} + col * (5 / {_KM_OF}) AS lng_min, lng - 40 / {_KM_OF} + (col + 1) * (5 / {_KM_OF}) AS lng_max FROM c)
 SELECT id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, floor(lat_max * 1000000 + 0.5) / 1000000 AS lat_max, floor(lng_min * 1000000 + 0.5) / 1000000 AS lng_min FROM e WHERE {hav('lat', 'lng', '(lat_min + lat_max) / 2', '(lng_min + lng_max) / 2')} <= 45000""",
)
def _(spark, d):
    got = grid.circle_grids(load(spark, d, "district"), 40.0, 5.0)
    return got.select("id", "row", "col", _MILLIONTH(F.col("lat_max")).alias("lat_max"), _MILLIONTH(F.col("lng_min")).alias("lng_min"))


@query("cell_keys", f"SELECT row, col, floor(lat_max * 1000000 + 0.5) / 1000000 AS lat_max, floor(lng_min * 1000000 + 0.5) / 1000000 AS lng_min, count(p.id) AS n FROM {_GRID} JOIN {oracle('business')} p ON p.lat >= lat_min AND p.lat < lat_max AND p.lng >= lng_min AND p.lng < lng_max GROUP BY ALL")
def _(spark, d):
    """Businesses counted by the name of their cell, and the cell read from its name again."""
    cell = grid.cell_of_point(F.col("lat"), F.col("lng"), *_BOX, 25.0)
    named = load(spark, d, "business").select(cell.alias("c")).select("c.*").withColumn("key", grid.cell_key())
    counted = named.groupBy("row", "col", "key").agg(F.count("*").alias("n")).withColumn("c", grid.cell_of_key(F.col("key")))
    return counted.select("row", "col", _MILLIONTH(F.col("c.lat_max")).alias("lat_max"), _MILLIONTH(F.col("c.lng_min")).alias("lng_min"), "n")


_TASKS = "SELECT concat('c', CAST(user_id % 40 AS STRING)) AS cell, concat('k', CAST(seq % 7 AS STRING)) AS category, status FROM {t}"


@query("finished_tasks", f"SELECT DISTINCT cell, category FROM ({_TASKS.format(t=oracle('task_event'))}) WHERE status = 'completed' ORDER BY cell, category LIMIT 100")
def _(spark, d):
    load(spark, d, "task_event").createOrReplaceTempView("plumbline_task")
    return grid.finished_tasks(spark.sql(_TASKS.format(t="plumbline_task")), 100)


@query("most_common_events", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def _(spark, d):
    return tables.most_common(spark.read.parquet(f"{d}/events.parquet"), "event_type", 3)


# Stored tables.
@query(
    "flush_clean",
    f"""WITH b AS (SELECT * FROM {_RAW_SQL} WHERE is_active AND category IS NOT NULL AND trim(category) <> '' AND category <> 'Sin categoria' AND search_category IS NOT NULL AND trim(search_category) <> ''),
 n AS (SELECT b.id AS seq, b.name AS name, c.business_category AS business_category, c.category_source AS category_source, concat('f', CAST(CAST(floor(b.id / 3) AS BIGINT) AS VARCHAR)) AS google_place_id FROM b JOIN {_CURATED} c ON c.id = b.id),
 s AS (SELECT CAST(id AS BIGINT) AS id, name, business_category, CAST(NULL AS VARCHAR) AS category_source, concat('f', CAST(id AS VARCHAR)) AS google_place_id FROM {oracle('business')} WHERE id % 9 = 0),
 f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY google_place_id ORDER BY seq) AS k FROM n) WHERE k = 1 AND google_place_id NOT IN (SELECT google_place_id FROM s))
 SELECT * FROM s UNION ALL SELECT (SELECT max(id) FROM s) + row_number() OVER (ORDER BY seq), name, business_category, category_source, google_place_id FROM f""",
)
def _(spark, d):
    mappings = spark.createDataFrame(_MAP, "raw_norm string, type string, category string")
    rows = _raw(spark, d).withColumns({"google_place_id": F.concat(F.lit("f"), F.floor(F.col("id") / 3).cast("string")), "source_url": F.lit(None).cast("string"), "lat": F.lit(0.0), "lng": F.lit(0.0)})
    none = F.lit(None).cast("string")
    stored = load(spark, d, "business").where("id % 9 = 0").select(F.col("id").cast("bigint").alias("id"), "name", "lat", "lng", "business_category", none.alias("category_source"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("google_place_id"), none.alias("source_url"))
    return merge.flush(rows, mappings, stored)[0].select("id", "name", "business_category", "category_source", "google_place_id")


_SEEN = "SELECT o_custkey AS k, {f}(o_orderdate) AS first_seen, {g}(o_orderdate) AS last_seen, max(o_totalprice) AS price, CAST(count(*) AS BIGINT) AS n FROM {o} WHERE o_orderkey % 2 = {r} GROUP BY o_custkey"


@query(
    "keyed_upsert",
    f"SELECT k, coalesce(s.first_seen, n.first_seen) AS first_seen, coalesce(n.last_seen, s.last_seen) AS last_seen, coalesce(n.price, s.price) AS price, coalesce(s.n, n.n) AS n FROM ({_SEEN.format(f='min', g='max', o='orders', r=0)}) s FULL JOIN ({_SEEN.format(f='min', g='max', o='orders', r=1)}) n USING (k)",
)
def _(spark, d):
    spark.read.parquet(f"{d}/orders.parquet").createOrReplaceTempView("plumbline_orders")
    stored, incoming = (spark.sql(_SEEN.format(f="min", g="max", o="plumbline_orders", r=r)) for r in (0, 1))
    return merge.keyed_upsert(stored, incoming, ["k"], "first_seen", "last_seen", untouched=("n",))


@query("raw_latest", "SELECT o_custkey AS k, max_by(o_totalprice, (o_orderdate, o_orderkey)) AS price, max(o_orderdate) AS seen FROM orders GROUP BY o_custkey")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("seen"), "o_orderkey")
    return merge.latest(rows, ["k"], ["seen", "o_orderkey"]).select("k", "price", "seen")


@query("only_new", f"SELECT id, name FROM {oracle('business')} n WHERE NOT EXISTS (SELECT 1 FROM {oracle('poi')} p WHERE p.id = n.id)")
def _(spark, d):
    return merge.only_new(load(spark, d, "poi"), load(spark, d, "business"), ["id"]).select("id", "name")


@query("business_records", f"SELECT name, lat, lng, category, CAST(NULL AS VARCHAR) AS search_category FROM {oracle('business')}")
def _(spark, d):
    return tables.records(load(spark, d, "business"))
