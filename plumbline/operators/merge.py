"""Upserts: tiered matching and its resolution within a batch, keyed versions, task states, repairs."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.geo import DEGREE_M, RADIUS_M
from .checkpoints import cut
from .components import connected
from .dedup import first_by
from .order import numbered
from .spatial import _buckets, radius_join

#: What an update keeps from the stored row, and what it takes only where the new row has none.
KEPT = ("id", "name", "lat", "lng", "raw_name", "created_at", "is_active")
FILLED = ("source_url", "google_place_id")


def _active(stored: DataFrame) -> Column:
    return F.coalesce(F.col("is_active").cast("boolean"), F.lit(False)) if "is_active" in stored.columns else F.lit(True)


def match_tiers(stored: DataFrame, incoming: DataFrame, seq: str = "seq", metres: float | None = 100.0) -> DataFrame:
    """(seq, id, tier) of incoming rows and the active stored rows they match: place id first, then source url, then equal lower-cased name within ``metres`` (by name alone if None).

    Within a tier the least stored id counts; the first two tiers hold however far apart the rows are. Incoming rows are matched with stored ones only; see ``resolve``.
    """
    s = stored.where(_active(stored))
    s = s.select(F.col("id").alias("s_id"), F.col("google_place_id").alias("s_place"), F.col("source_url").alias("s_url"), F.lower("name").alias("s_name"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"))
    n = incoming.select(F.col(seq).alias("seq"), "google_place_id", "source_url", F.lower("name").alias("name"), "lat", "lng")
    place = n.join(s, F.col("google_place_id") == F.col("s_place")).select("seq", "s_id", F.lit(1).alias("tier"))
    url = n.join(s, F.col("source_url") == F.col("s_url")).select("seq", "s_id", F.lit(2).alias("tier"))
    if metres is None:
        name = n.join(s, F.col("name") == F.col("s_name"))
    else:
        name = radius_join(n, s, metres).where(F.col("name") == F.col("s_name"))
    every = place.unionByName(url).unionByName(name.select("seq", "s_id", F.lit(3).alias("tier")))
    best = every.groupBy("seq").agg(F.min(F.struct("tier", "s_id")).alias("m"))
    return best.select("seq", F.col("m.s_id").alias("id"), F.col("m.tier").alias("tier"))


class _Group:
    """The rows of one connected group as they are taken in order; what is kept grows with the stored and created rows, not with the incoming ones."""

    def __init__(self, metres: float | None, ignore: bool = False):
        self.metres, self.ignore = metres, ignore
        self.place: dict = {}
        self.url: dict = {}
        self.names: dict = {}

    def add(self, row: dict) -> None:
        for owners, key in ((self.place, row["place"]), (self.url, row["url"])):
            if key is not None:
                owners[key] = row
        if row["active"]:
            self.names.setdefault(self._band(row, 0), []).append(row)

    def _band(self, row, step: int):
        band = None if self.metres is None or row["lat"] is None else math.floor(row["lat"] * DEGREE_M / (self.metres * 1.001)) + step
        return row["name"], band

    def _near(self, a, b) -> bool:
        if self.metres is None:
            return True
        if None in (a["lat"], a["lng"], b["lat"], b["lng"]):
            return False
        p, q = math.radians(a["lat"]), math.radians(b["lat"])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b["lng"] - a["lng"]) / 2) ** 2
        return 2 * RADIUS_M * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0.0))) <= self.metres

    def match(self, row):
        """(stored or created row, tier)."""
        for tier, (owners, key) in enumerate(((self.place, row["place"]), (self.url, row["url"])), 1):
            if key is not None and key in owners and owners[key]["active"]:
                return owners[key], tier
        if row["name"] is not None:
            steps = (0,) if self.metres is None else (-1, 0, 1)
            near = [x for k in steps for x in self.names.get(self._band(row, k), ()) if self._near(row, x)]
            if near:
                return min(near, key=lambda x: x["rank"]), 3
        return None, None

    def take(self, row):
        """(outcome, stored id, creating seq, tier) of an incoming row."""
        found, tier = (None, None) if self.ignore else self.match(row)
        owned = [owners.get(key) for owners, key in ((self.place, row["place"]), (self.url, row["url"])) if key is not None]
        if any(o is not None and o is not found for o in owned):
            return "rejected", None, None, tier
        if found is None:
            row.update(active=True, id=None, made=row["seq"], rank=(1, row["seq"]))
            self.add(row)
            return "inserted", None, row["seq"], None
        for owners, field in ((self.place, "place"), (self.url, "url")):
            if row[field] is not None and row[field] != found[field]:
                owners.pop(found[field], None)
                owners[row[field]], found[field] = found, row[field]
        return "updated", found["id"], found["made"], tier


def resolve(stored: DataFrame, incoming: DataFrame, seq: str = "seq", metres: float | None = 100.0, ignore: bool = False) -> DataFrame:
    """(seq, outcome, id, made, tier): what becomes of each incoming row when rows are taken one after another in the order of seq (unique).

    A row that matches an active stored row, or one that an earlier incoming row has made, by the three tiers is ``updated``: ``id`` tells the stored row or ``made`` the seq of the
    one that made it. Its place id and url become that row's, so what later rows match depends on it. A row without a match is ``inserted``. Place ids and urls are
    unique among all stored rows, inactive ones included; a row whose own would belong to two rows is ``rejected``. Empty texts count as none. With ``ignore`` no row updates another: what conflicts
    with a stored row or an earlier new one by its place id or url is rejected, names play no part.

    Rows can only meet through a place id, a url, or an equal name in a neighbouring cell. Those links make connected groups, found for distinct keys;
    the groups are taken in order each, row by row, all groups in parallel, keys only.
    """
    text = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    keys = lambda df: (text("google_place_id").alias("place"), text("source_url").alias("url"), F.nullif(F.lower("name"), F.lit("")).alias("name"), F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"))
    n = incoming.select(F.lit(None).cast(stored.schema["id"].dataType).alias("id"), F.col(seq).alias("seq"), F.lit(True).alias("active"), *keys(incoming))
    s = stored.select("id", F.lit(None).cast(incoming.schema[seq].dataType).alias("seq"), _active(stored).alias("active"), *keys(stored))

    def hubs(rows: DataFrame) -> DataFrame:
        """The rows with a number for each key they have; equal keys have equal numbers."""
        if ignore:
            rows, name = rows.withColumns({"_by": F.lit(0), "_bx": F.lit(0)}), F.lit(None).cast("bigint")
        elif metres is not None:
            rows = _buckets(rows, "lat", "lng", metres, around=False)
            name = F.when(F.col("name").isNotNull() & F.col("_by").isNotNull() & F.col("_bx").isNotNull(), F.xxhash64(F.lit("n"), "name", "_by", "_bx"))
        else:
            name = F.when(F.col("name").isNotNull(), F.xxhash64(F.lit("n"), "name"))
        hub = lambda kind: F.when(F.col(kind).isNotNull(), F.xxhash64(F.lit(kind), kind))
        return rows.withColumn("_hubs", F.array_compact(F.array(name, hub("place"), hub("url")))).drop("_by", "_bx")

    fresh = hubs(n)
    around = None
    if metres is not None and not ignore:
        spots = n.where(F.col("name").isNotNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull()).select("name", "lat", "lng").distinct()
        own = _buckets(spots, "lat", "lng", metres, around=False).withColumn("a", F.xxhash64(F.lit("n"), "name", "_by", "_bx")).drop("_by", "_bx")
        around = _buckets(own, "lat", "lng", metres, around=True).select("a", F.xxhash64(F.lit("n"), "name", "_by", "_bx").alias("b")).distinct()
    known = fresh.select(F.explode("_hubs").alias("hub"))
    known = (known if around is None else known.unionByName(around.select(F.col("b").alias("hub")))).distinct()
    touched = hubs(s).withColumn("_row", F.struct("id")).withColumn("hub", F.explode("_hubs")).join(known, "hub", "left_semi").drop("hub").dropDuplicates(["id"]).drop("_row")
    rows = cut(fresh.unionByName(touched))
    links = rows.select(F.col("_hubs")[0].alias("a"), F.explode(F.slice("_hubs", 2, 2)).alias("b"))
    if around is not None:
        there = rows.select(F.explode("_hubs").alias("b")).distinct()
        links = links.unionByName(around.join(there, "b", "left_semi").select("a", "b"))
    groups = connected(links)
    first = rows.withColumn("_hub", F.coalesce(F.get("_hubs", F.lit(0)), F.xxhash64(F.lit("row"), F.coalesce(F.col("seq").cast("string"), F.lit("")), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    grouped = first.join(groups, F.col("_hub") == F.col("node"), "left").withColumn("group", F.coalesce("root", "_hub")).drop("_hubs", "_hub", "node", "root")
    ordered = grouped.repartition("group").sortWithinPartitions("group", F.col("id").asc_nulls_last(), "seq")

    def take(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["group"] != now:
                    now, state = row["group"], _Group(metres, ignore)
                if row["seq"] is None:
                    row.update(made=None, rank=(0, row["id"]))
                    state.add(row)
                else:
                    seq_ = row["seq"]
                    outcome, id_, made, tier = state.take(row)
                    out.append((seq_, outcome, id_, made, tier))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["seq", "outcome", "id", "made", "tier"])

    seq_type, id_type = incoming.schema[seq].dataType, stored.schema["id"].dataType
    types = [to_arrow_type(seq_type), pa.string(), to_arrow_type(id_type), to_arrow_type(seq_type), pa.int32()]
    return ordered.mapInArrow(take, f"seq {seq_type.simpleString()}, outcome string, id {id_type.simpleString()}, made {seq_type.simpleString()}, tier int")


def upsert(stored: DataFrame, incoming: DataFrame, seq: str = "seq", metres: float | None = 100.0, resolved: DataFrame | None = None, counters: Observation | None = None, changed_only: bool = False) -> DataFrame:
    """The stored table after the batch (or only its rows that the batch has changed or added), as if its rows were stored one by one in the order of seq; see ``resolve``.

    A stored row keeps its KEPT columns, takes FILLED ones where a row has any, and the others from the last row that matched it. New rows are numbered after the largest
    stored id in the order of seq and are active. ``counters`` counts the rows ``inserted`` and ``updated`` (every update of a row) while the result is written, without a pass of its own.
    """
    res = (cut(resolve(stored, incoming, seq, metres)) if resolved is None else resolved).where(F.col("outcome") != "rejected")
    rows = incoming.join(res.select(*(F.col(c).alias(f"_r_{c}") for c in res.columns)), F.col(seq) == F.col("_r_seq"))
    cols = stored.columns
    taken = [c for c in cols if c not in KEPT and c not in FILLED and c in incoming.columns]
    filled = [c for c in FILLED if c in cols and c in incoming.columns]
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    last = rows.groupBy("_r_id", "_r_made").agg(F.count("*").alias("_times"), F.max_by(F.struct(F.lit(1).alias("_one"), *taken), F.col(seq)).alias("_last"), *(F.max_by(some(c), F.when(some(c).isNotNull(), F.col(seq))).alias(f"_{c}") for c in filled))
    value = lambda c: F.col(f"_last.{c}") if c in taken else F.coalesce(f"_{c}", c) if c in filled else F.col(c)
    updated = stored.join(last.where(F.col("_r_id").isNotNull()), F.col("id") == F.col("_r_id"), "left")
    updated = updated.select(*(F.when(F.col("_times").isNotNull(), value(c)).otherwise(F.col(c)).alias(c) for c in cols), F.lit(0).alias("_new"), F.coalesce("_times", F.lit(0)).alias("_times"))
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    own = rows.where(F.col("_r_outcome") == "inserted").select(F.col(seq).alias("_own"), *(F.col(c).alias(f"_c_{c}") for c in cols if c in incoming.columns))
    makers = numbered(own, ["_own"]).join(F.broadcast(top)).join(last.where(F.col("_r_id").isNull()), F.col("_own") == F.col("_r_made"))

    def made(c: str) -> Column:
        kind = stored.schema[c].dataType
        if c == "id":
            return (F.col("_top") + F.col("_i") + 1).cast(kind)
        if c == "is_active":
            return F.coalesce(f"_c_{c}", F.lit(True).cast(kind)) if c in incoming.columns else F.lit(True).cast(kind)
        if c in taken:
            return F.col(f"_last.{c}")
        return F.col(f"_{c}") if c in filled else F.col(f"_c_{c}") if c in incoming.columns else F.lit(None).cast(kind)

    updated = updated.where(F.col("_times") > 0) if changed_only else updated
    both = updated.unionByName(makers.select(*(made(c).alias(c) for c in cols), F.lit(1).alias("_new"), "_times"))
    if counters is not None:
        both = both.observe(counters, F.sum("_new").alias("inserted"), F.sum(F.col("_times") - F.col("_new")).alias("updated"))
    return both.select(*cols)


def insert_ignoring(stored: DataFrame, incoming: DataFrame, seq: str = "seq", counters: Observation | None = None) -> DataFrame:
    """The stored table with the incoming rows that conflict with none, stored or earlier, by place id or url; as a batch of inserts that does nothing on conflict."""
    return upsert(stored, incoming, seq, None, cut(resolve(stored, incoming, seq, None, ignore=True)), counters)


def flush(business: DataFrame, mappings: DataFrame, stored: DataFrame, seq: str = "id", counters: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored table after the clean rows of ``business`` are curated and inserted, conflicts ignored; and how many rows each category source had, with its share."""
    from .curate import clean_rows, curate, distribution

    curated = curate(clean_rows(business), mappings)
    table = insert_ignoring(stored, curated.drop("is_active").withColumnRenamed(seq, "_flush_seq"), "_flush_seq", counters)
    return table, distribution(curated.withColumn("category_source", F.coalesce("category_source", F.lit(UNCLASSIFIED))), "category_source")


def store_batch(spark: SparkSession, path: str, bad_path: str, incoming: DataFrame, seq: str = "seq", metres: float | None = 100.0) -> dict[str, int]:
    """Stores a batch in the table at ``path``; rows that can't be stored are appended to ``bad_path`` with their reason. Returns the counts of rows inserted, updated and quarantined.

    The counts come from the two writes themselves; no row is read once more to be counted.
    """
    from ..sources.tables import publish

    stored = spark.read.parquet(path)
    good, bad = quarantine(incoming)
    resolved = cut(resolve(stored, good, seq, metres))
    conflicts = good.join(resolved.where("outcome = 'rejected'").select(F.col("seq").alias("_seq")), F.col(seq) == F.col("_seq"), "left_semi").withColumn("reason", F.lit(CONFLICT))
    wrong, right = Observation(), Observation()
    bad.unionByName(conflicts).observe(wrong, F.count("*").alias("quarantined")).write.mode("append").parquet(bad_path)
    publish(upsert(stored, good, seq, metres, resolved, right), path)
    return {k: int(v or 0) for k, v in {**right.get, **wrong.get}.items()}


def latest(df: DataFrame, keys: list[str], version: list[Column | str]) -> DataFrame:
    """Upsert by key over appended versions: the last one stands."""
    return first_by(df, keys, [F.col(v).desc() if isinstance(v, str) else v for v in version])


def keyed_upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], first_seen: str, last_seen: str, untouched: tuple[str, ...] = ()) -> DataFrame:
    """Full outer join by key: incoming values win, the first sighting and the untouched columns stay."""
    both = stored.alias("s").join(incoming.alias("n"), keys, "full_outer")
    known = F.col(f"s.{first_seen}").isNotNull()
    new = F.col(f"n.{last_seen}").isNotNull()
    value = lambda c: F.when(known & (F.lit(c in (first_seen, *untouched)) | ~new), F.col(f"s.{c}")).otherwise(F.col(f"n.{c}"))
    return both.select(*keys, *(value(c).alias(c) for c in stored.columns if c not in keys))


def task_state(events: DataFrame, key: str = "task", seq: str = "seq") -> DataFrame:
    """Current state of each task: the latest status, its result count if completed, and how often it failed."""
    return events.groupBy(key).agg(
        F.max_by("status", seq).alias("status"), F.max_by(F.when(F.col("status") == "completed", F.col("results_count")), F.when(F.col("status") == "completed", F.col(seq))).alias("results_count"), F.count_if(F.col("status") == "failed").alias("retry_count")
    )


def tasks_to_resume(tasks: DataFrame, events: DataFrame, key: str = "task", seq: str = "seq") -> DataFrame:
    """The tasks that aren't completed."""
    done = task_state(events, key, seq).where(F.col("status") == "completed")
    return tasks.join(done, key, "left_anti")


def missing_category(c: Column, placeholder: str = "Sin categoria") -> Column:
    return c.isNull() | (F.trim(c) == "") | (c == placeholder)


def repair_categories(stored: DataFrame, found: DataFrame, key: str = "source_url") -> DataFrame:
    """Fills categories where they are missing and the found rows (key, category) have one."""
    n = found.where(~missing_category(F.col("category"))).groupBy(key).agg(F.min("category").alias("_found"))
    return stored.join(n, key, "left").select(*(F.when(missing_category(F.col("category")) & F.col("_found").isNotNull(), F.col("_found")).otherwise(F.col("category")).alias("category") if c == "category" else F.col(c) for c in stored.columns))


def only_new(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """What an insert that ignores conflicts adds."""
    return incoming.join(stored, keys, "left_anti")


def exists_similar(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Adds ``known``: whether an active stored row has the same name but for case."""
    names = stored.where("is_active").select(F.lower("name").alias("_known")).where(F.col("_known").isNotNull()).distinct()
    return incoming.join(names, F.lower("name") == F.col("_known"), "left").withColumn("known", F.col("_known").isNotNull()).drop("_known")


#: What a business record can't be stored without, and why.
REASONS = (("name", "no name"), ("lat", "no latitude"), ("lng", "no longitude"))
CONFLICT = "place id or url of another row"
#: What rows without a category count as.
UNCLASSIFIED = "sin clasificar"


def quarantine(incoming: DataFrame, extra: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that can be stored, and the others with the ``reason``, the first that applies; a bad row stops no batch.

    extra: further reasons and the conditions under which they hold.
    """
    tests = [F.when(F.col(c).isNull() | ((F.trim(F.col(c).cast("string")) == "") if c == "name" else F.isnan(F.col(c).cast("double"))), why) for c, why in REASONS]
    tests += [F.when(F.abs(F.col("lat")) > 90, "latitude out of range"), F.when(F.abs(F.col("lng")) > 180, "longitude out of range"), *(F.when(c, why) for why, c in (extra or {}).items())]
    judged = incoming.withColumn("reason", F.coalesce(*tests))
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())
