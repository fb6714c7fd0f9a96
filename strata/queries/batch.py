"""Batch queries: parsing, dimensions, facts, summaries, reports, windows, history and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import ads, dedup, dwd, dws, rollups, scd2
from strata.queries import views as V
from strata.queries.registry import query

SIX = "DECIMAL(38,6)"


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_parse_props(spark, t) -> DataFrame:
    rows = t.events.withColumn("p", F.from_json("props", "struct<k:bigint>")).where("p.k is not null")
    return rows.select("event_id", F.col("p.k").alias("k"))


@query("SELECT l_returnflag, count(nullif(l_discount, 0)) AS known, sum(round(nullif(l_discount, 0) * 100)::BIGINT)::BIGINT AS total FROM lineitem GROUP BY 1")
def zero_as_null_avg(spark, t) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", C.zero_as_null(F.col("l_discount")).alias("d"))
    return rows.groupBy("l_returnflag").agg(F.count("d").alias("known"), F.sum(V.cents("d")).alias("total"))


@query(f"WITH {V.MOVIES} SELECT movie_id, round(revenue / nullif(CASE WHEN popularity <= 5 THEN 0 ELSE budget END, 0), 6) AS roi FROM movies")
def safe_divide_roi(spark, t) -> DataFrame:
    budget = F.when(F.col("popularity") <= 5, 0).otherwise(F.col("budget"))
    return V.movies(t).select("movie_id", F.round(C.safe_divide(F.col("revenue"), budget), 6).alias("roi"))


@query(f"WITH {V.MOVIES}, r AS (SELECT movie_id, round(revenue / nullif(budget, 0), 6) AS roi FROM movies) SELECT movie_id, roi, rank FROM (SELECT *, dense_rank() OVER (ORDER BY roi DESC)::INT AS rank FROM r WHERE roi IS NOT NULL) WHERE rank <= 100")
def roi_ranking(spark, t) -> DataFrame:
    rows = V.movies(t).select("movie_id", F.lit(1).alias("dt"), F.round(C.safe_divide(F.col("revenue"), F.col("budget")), 6).alias("roi"))
    return ads.top(rows, "roi", 100).select("movie_id", "roi", "rank")


@query("SELECT DISTINCT p_type AS genre_name, 'movie' AS media_type FROM part UNION SELECT DISTINCT event_type, 'tv' FROM events")
def dim_genre_union(spark, t) -> DataFrame:
    movie = t.part.select(F.col("p_type").alias("genre_name"), F.lit("movie").alias("media_type"))
    tv = t.events.select(F.col("event_type").alias("genre_name"), F.lit("tv").alias("media_type"))
    return movie.unionByName(tv).dropDuplicates(["genre_name", "media_type"])


@query("SELECT c_custkey, regexp_replace(c_name || ' (' || c_mktsegment || ')', '\\s*\\(.*?\\)\\s*$', '') AS name FROM customer")
def dim_company_normalized(spark, t) -> DataFrame:
    return t.customer.select("c_custkey", C.company_name(F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")"))).alias("name"))


@query("SELECT w, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY w")
def explode_words(spark, t) -> DataFrame:
    return t.documents.select(F.explode(F.split("text", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, o_orderkey, l_linenumber FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45) ON l_orderkey = o_orderkey""")
def explode_outer_two_level(spark, t) -> DataFrame:
    """Arrays of arrays, exploded twice; owners of empty arrays stay with nulls."""
    lines = t.lineitem.where("l_quantity > 45").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("lines"))
    orders = t.orders.where("o_orderpriority = '1-URGENT'").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    nested = orders.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "lines")).alias("orders"))
    rows = t.customer.join(nested, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.explode_outer("orders").alias("o"))
    return rows.select("c_custkey", F.col("o.o_orderkey").alias("o_orderkey"), F.explode_outer("o.lines").alias("l_linenumber"))


@query(f"WITH {V.CREDITS} SELECT credit_id, movie_id, person_id, credit_type, quantity FROM (SELECT *, row_number() OVER (PARTITION BY credit_id ORDER BY made_at DESC, movie_id DESC, person_id DESC, credit_type DESC, quantity DESC) AS r FROM credits) WHERE r = 1")
def credit_fact_dedup(spark, t) -> DataFrame:
    rows = V.credits(t).select("credit_id", "movie_id", "person_id", "credit_type", "quantity", "at")
    return dedup.latest(rows, ["credit_id"], *[F.col(c) for c in ("at", "movie_id", "person_id", "credit_type", "quantity")]).drop("at")


@query(f"WITH {V.CREDITS} SELECT movie_id, sum(CASE WHEN credit_type = 'cast' THEN 1 ELSE 0 END)::BIGINT AS cast_count, sum(CASE WHEN credit_type = 'crew' THEN 1 ELSE 0 END)::BIGINT AS crew_count FROM credits GROUP BY 1")
def credit_counts(spark, t) -> DataFrame:
    return dws.credit_counts(V.credits(t).withColumn("dt", F.lit(1))).drop("dt")


METRIC = f"""WITH {V.DAILY}, {V.CREDITS}, c AS (SELECT (movie_id % 5)::BIGINT AS k, count(*) AS credit_count FROM credits WHERE credit_type = 'cast' GROUP BY 1),
  keyed AS (SELECT *, (CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 4 END)::BIGINT AS k, lag(popularity, 7) OVER (PARTITION BY event_type ORDER BY dt) AS before FROM daily)
SELECT dt, event_type, popularity, round(coalesce((popularity - before) / nullif(before, 0), 0.0), 6) AS wow, coalesce(credit_count, 0) AS credit_count FROM keyed LEFT JOIN c USING (k)"""


@query(METRIC)
def movie_metric_1d(spark, t) -> DataFrame:
    """A daily series with its change over the week, left joined to counts of another table."""
    c = V.credits(t).where("credit_type = 'cast'").groupBy((F.col("movie_id") % 5).alias("k")).agg(F.count(F.lit(1)).alias("credit_count"))
    code = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1).when(F.col("event_type") == "purchase",
        2).when(F.col("event_type") == "error", 3).otherwise(4).cast("bigint")
    week = F.lag("popularity", 7).over(Window.partitionBy("event_type").orderBy("dt"))
    rows = V.daily(t).withColumn("k", code).withColumn("before", week).join(c, "k", "left")
    return rows.select("dt", "event_type", "popularity", F.round(C.change_ratio(F.col("popularity"), F.col("before")), 6).alias("wow"),
        F.coalesce("credit_count", F.lit(0)).alias("credit_count"))


@query(f"""WITH {V.DAILY}, w AS (SELECT *, lag(popularity, 7) OVER (PARTITION BY event_type ORDER BY dt) AS before FROM daily),
  r AS (SELECT dt, event_type, popularity, round(coalesce((popularity - before) / nullif(before, 0), 0.0), 6) AS wow, dense_rank() OVER (PARTITION BY dt ORDER BY popularity DESC)::INT AS rank FROM w)
SELECT * FROM r WHERE rank <= 3""")
def top_movie(spark, t) -> DataFrame:
    """The flagship: daily popularity, its change over the week, and the day's best."""
    week = F.lag("popularity", 7).over(Window.partitionBy("event_type").orderBy("dt"))
    rows = V.daily(t).withColumn("wow", F.round(C.change_ratio(F.col("popularity"), week), 6))
    return ads.top(rows, "popularity", 3).select("dt", "event_type", "popularity", "wow", "rank")


@query(f"WITH {V.MOVIES} SELECT genre, release_year, count(DISTINCT movie_id) AS movie_count, round(sum(popularity) / count(popularity), 6) AS avg_popularity, sum(revenue)::BIGINT AS total_revenue FROM movies WHERE release_year IS NOT NULL GROUP BY 1, 2")
def genre_year_metric(spark, t) -> DataFrame:
    m = V.movies(t)
    genres = m.select("movie_id", F.col("genre").alias("genre_id"), F.col("genre").alias("genre_name"))
    rows = dws.genre_year(genres, m.withColumn("vote_average", F.lit(None).cast("double")))
    return rows.select(F.col("genre_id").alias("genre"), "release_year", "movie_count", F.round("avg_popularity", 6).alias("avg_popularity"), "total_revenue")


@query(f"WITH {V.MOVIES}, {V.PERSONS}, {V.CREDITS} SELECT country, release_year, count(DISTINCT movie_id) AS movie_count, sum(revenue)::BIGINT AS total_revenue FROM (SELECT DISTINCT movie_id, country FROM credits JOIN persons USING (person_id)) JOIN movies USING (movie_id) WHERE release_year IS NOT NULL GROUP BY 1, 2")
def country_year_metric(spark, t) -> DataFrame:
    countries = V.credits(t).join(V.persons(t), "person_id").select("movie_id", F.col("country").alias("country_code"),
        F.col("country").alias("country_name")).distinct()
    rows = dws.country_year(countries, V.movies(t).withColumn("vote_average", F.lit(None).cast("double")))
    return rows.select(F.col("country_code").alias("country"), "release_year", "movie_count", "total_revenue")


CAREER = f"""{V.MOVIES}, {V.PERSONS}, {V.CREDITS}, career AS (
  SELECT person_id, count(DISTINCT movie_id) AS work_count, sum(is_director)::BIGINT AS as_director_count, sum(CASE WHEN credit_type = 'cast' THEN 1 ELSE 0 END)::BIGINT AS as_cast_count,
         min(release_year) AS first_work_year, max(release_year) AS latest_work_year, round(sum(popularity) / count(popularity), 6) AS avg_vote_average
  FROM credits JOIN movies USING (movie_id) GROUP BY 1)"""


def career(t) -> DataFrame:
    m = V.movies(t).select("movie_id", "release_year", F.col("popularity").alias("vote_average"))
    p = V.persons(t).select("person_id", "person_name", F.col("country").alias("known_for_department"), F.col("popularity_cents").alias("popularity"))
    return dws.person_career(V.credits(t), m, p).withColumn("avg_vote_average", F.round("avg_vote_average", 6))


@query(f"WITH {CAREER} SELECT c.*, person_name, country FROM career c LEFT JOIN persons USING (person_id)")
def person_career(spark, t) -> DataFrame:
    return career(t).drop("popularity").withColumnRenamed("known_for_department", "country")


@query(f"""WITH {CAREER}, i AS (SELECT person_id, person_name, work_count, round(coalesce(popularity_cents::DOUBLE, 0) + 2 * coalesce(work_count::DOUBLE, 0) + 10 * coalesce(avg_vote_average, 0), 6) AS influence FROM career LEFT JOIN persons USING (person_id))
SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY influence DESC)::INT AS rank FROM i) WHERE rank <= 50""")
def person_influence(spark, t) -> DataFrame:
    rows = career(t).withColumn("influence", F.round(C.influence(F.col("popularity"), F.col("work_count"), F.col("avg_vote_average")), 6)).withColumn("dt",
        F.lit(1))
    return ads.top(rows, "influence", 50).select("person_id", "person_name", "work_count", "influence", "rank")


@query(f"WITH {V.MOVIES} SELECT company, count(DISTINCT movie_id) AS movie_count, sum(budget)::BIGINT AS total_budget, sum(revenue)::BIGINT AS total_revenue, round(avg(round(revenue / nullif(budget, 0), 6)::{SIX}), 4) AS avg_roi FROM movies GROUP BY 1")
def company_finance(spark, t) -> DataFrame:
    """The mean of ratios adds decimals, so it does not depend on their order."""
    m = V.movies(t)
    companies = m.select("movie_id", F.col("company").alias("company_id"), F.col("company").alias("company_name"))
    rows = dws.company_finance(companies, m).drop("company_name", "avg_roi")
    roi = m.groupBy("company").agg(F.avg(F.round(C.safe_divide(F.col("revenue"), F.col("budget")), 6).cast("decimal(28,6)")).alias("a"))
    rows = rows.join(roi, F.col("company_id") == F.col("company"))
    return rows.select("company", "movie_count", "total_budget", "total_revenue", F.round(F.col("a").cast("double"), 4).alias("avg_roi"))


@query(f"WITH {V.DAILY}, w AS (SELECT *, lag(popularity, 7) OVER (PARTITION BY event_type ORDER BY dt) AS before FROM daily) SELECT dt, event_type, n AS samples, round(coalesce((popularity - before) / nullif(before, 0), 0.0), 6) AS popularity_change FROM w")
def genre_trend(spark, t) -> DataFrame:
    week = F.lag("popularity", 7).over(Window.partitionBy("event_type").orderBy("dt").rowsBetween(-7, -7))
    return V.daily(t).select("dt", "event_type", F.col("n").alias("samples"), F.round(C.change_ratio(F.col("popularity"), week), 6).alias("popularity_change"))


PER_USER = V.OBSERVED + ", per_user AS (SELECT event_time::DATE AS dt, entity_id, sum(popularity)::BIGINT AS popularity FROM observed GROUP BY 1, 2)"


def per_user(t) -> DataFrame:
    return V.observed(t).groupBy(F.to_date("event_time").alias("dt"), "entity_id").agg(F.sum("popularity").alias("popularity"))


@query(f"WITH {PER_USER} SELECT dt, entity_id, popularity, lag(popularity, 7) OVER (PARTITION BY entity_id ORDER BY dt) AS before FROM per_user")
def lag7_rows(spark, t) -> DataFrame:
    return per_user(t).withColumn("before", F.lag("popularity", 7).over(Window.partitionBy("entity_id").orderBy("dt")))


@query(f"WITH {PER_USER} SELECT a.dt, a.entity_id, a.popularity, b.popularity AS before FROM per_user a LEFT JOIN per_user b ON b.entity_id = a.entity_id AND b.dt = a.dt - 7")
def lag7_calendar(spark, t) -> DataFrame:
    return dws.lag_calendar(per_user(t), ["entity_id"], "popularity").select("dt", "entity_id", "popularity", "before")


@query("""SELECT dt, year(dt)::INT AS year, quarter(dt)::INT AS quarter, month(dt)::INT AS month, day(dt)::INT AS day, week(dt)::INT AS week, isodow(dt)::INT AS day_of_week, CASE WHEN isodow(dt) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS dt FROM orders)""")
def dim_date(spark, t) -> DataFrame:
    """The calendar of the orders, from the first day to the last."""
    first, last = t.orders.agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return dwd.dim_date(spark, str(first), (last - first).days + 1)


FAR = "TIMESTAMP '2099-12-31'"
BATCHES = """o AS (SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS valid_from,
    row_number() OVER (PARTITION BY o_custkey, o_orderdate >= DATE '1998-01-01' ORDER BY o_orderdate DESC, o_orderstatus DESC, o_orderpriority DESC) AS r, o_orderdate >= DATE '1998-01-01' AS late FROM orders),
  a AS (SELECT * FROM o WHERE NOT late AND r = 1), b AS (SELECT * FROM o WHERE late AND r = 1)"""
INITIAL = f"SELECT customer_id, status, priority, valid_from, {FAR} AS valid_to FROM a"
MERGED = f"""changed AS (SELECT b.* FROM b LEFT JOIN a USING (customer_id) WHERE a.customer_id IS NULL OR sha256(coalesce(a.status, '') || '|' || coalesce(a.priority, '')) <> sha256(coalesce(b.status, '') || '|' || coalesce(b.priority, ''))),
  merged AS (SELECT a.customer_id, a.status, a.priority, a.valid_from, coalesce(c.valid_from, {FAR}) AS valid_to FROM a LEFT JOIN changed c USING (customer_id)
  UNION ALL SELECT customer_id, status, priority, valid_from, {FAR} FROM changed)"""
BUSINESS = ["status", "priority"]


def no_zone(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def history(t, merges: int) -> DataFrame:
    first, second = V.versions(t)
    rows = scd2.merge(first.limit(0), first, "customer_id", BUSINESS)
    for _ in range(merges):
        rows = scd2.merge(rows, second, "customer_id", BUSINESS)
    return rows


@query(f"WITH {BATCHES} {INITIAL}")
def scd2_initial(spark, t) -> DataFrame:
    return no_zone(history(t, 0))


@query(f"WITH {BATCHES}, {MERGED} SELECT * FROM merged")
def scd2_merge(spark, t) -> DataFrame:
    return no_zone(history(t, 1))


@query(f"WITH {BATCHES}, {MERGED} SELECT * FROM merged")
def scd2_rerun_idempotent(spark, t) -> DataFrame:
    return no_zone(history(t, 2))


@query(f"WITH {BATCHES}, {MERGED} SELECT customer_id, status, priority, valid_from, valid_to, CASE WHEN valid_to = {FAR} THEN 1 ELSE 0 END AS is_current FROM merged")
def scd2_is_current(spark, t) -> DataFrame:
    return no_zone(scd2.with_is_current(history(t, 1)))


def pit(t, closed: bool) -> DataFrame:
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("timestamp").alias("at"))
    return no_zone(scd2.as_of(facts, history(t, 1), "customer_id", "at", closed).select("o_orderkey", "customer_id", "status", "priority", "valid_from"))


@query(f"WITH {BATCHES}, {MERGED} SELECT o_orderkey, customer_id, status, priority, valid_from FROM orders JOIN merged ON o_custkey = customer_id AND o_orderdate >= valid_from AND o_orderdate < valid_to")
def scd2_pit_join(spark, t) -> DataFrame:
    return pit(t, closed=False)


@query(f"WITH {BATCHES}, {MERGED} SELECT o_orderkey, customer_id, status, priority, valid_from FROM orders JOIN merged ON o_custkey = customer_id AND o_orderdate BETWEEN valid_from AND valid_to")
def scd2_pit_join_closed(spark, t) -> DataFrame:
    return pit(t, closed=True)


@query("SELECT p_partkey, sha256(coalesce(p_name, '') || '|' || coalesce(p_brand, '') || '|' || coalesce(p_size::VARCHAR, '')) AS hash FROM part")
def content_hash(spark, t) -> DataFrame:
    return t.part.select("p_partkey", C.content_hash("p_name", "p_brand", "p_size").alias("hash"))


@query("SELECT event_id, sha256(event_type || ':' || user_id || ':' || (epoch_us(ts) // 1000)) AS batch_id, left(sha256(event_type || chr(1) || user_id || chr(1) || 'null'), 32) AS stable_id FROM events")
def event_id(spark, t) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", C.event_id(F.col("event_type"), F.col("user_id"), ms).alias("batch_id"),
        C.deterministic_id(F.col("event_type"), F.col("user_id"), F.lit(None)).alias("stable_id"))


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1, 2")
def replacing_latest(spark, t) -> DataFrame:
    return dedup.replacing(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts")


@query("""SELECT o_custkey, s AS window_start, least(s + 13, e) AS window_end FROM (SELECT o_custkey, e, unnest(generate_series(b, e, INTERVAL 14 DAY))::DATE AS s
  FROM (SELECT o_custkey, min(o_orderdate)::DATE AS b, max(o_orderdate)::DATE AS e FROM orders GROUP BY 1))""")
def change_windows_14d(spark, t) -> DataFrame:
    """From each customer's first order to the last, closed windows of 14 days."""
    rows = t.orders.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("b"), F.max(F.to_date("o_orderdate")).alias("e"))
    rows = rows.select("o_custkey", F.explode(C.date_windows(F.col("b"), F.col("e"))).alias("w"))
    return rows.select("o_custkey", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type")
def dedup_content_batch(spark, t) -> DataFrame:
    """Of A, B, A all three stay, of A, A one."""
    return dedup.content_changes(t.events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query(f"""WITH {V.OBSERVED}, h AS (SELECT date_trunc('hour', event_time) AS bucket, event_type, count(*) AS n, sum(popularity)::BIGINT AS total, max(popularity) AS most, min(popularity) AS least FROM observed GROUP BY 1, 2)
SELECT bucket, event_type, n, total, most, least, round(total / n, 6) AS average FROM h""")
def rollup_hourly(spark, t) -> DataFrame:
    rows = rollups.read(rollups.hourly(V.observed(t), "event_time", ["event_type"], "popularity"))
    return no_zone(rows.withColumn("average", F.round("average", 6)))


@query(f"WITH {V.OBSERVED} SELECT event_time::DATE AS bucket, event_type, count(*) AS n, sum(popularity)::BIGINT AS total, max(popularity) AS most, min(popularity) AS least, round(sum(popularity) / count(*), 6) AS average FROM observed GROUP BY 1, 2")
def rollup_daily_merge(spark, t) -> DataFrame:
    """Days from hourly states; the SQL takes them from the events themselves."""
    hours = rollups.hourly(V.observed(t), "event_time", ["event_type"], "popularity")
    days = rollups.read(rollups.merged(hours, F.to_date("bucket"), ["event_type"]))
    return days.withColumn("average", F.round("average", 6))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01'")
def partition_scan(spark, t) -> DataFrame:
    return t.orders.where("o_orderdate >= timestamp_ntz'1998-03-01 00:00:00' and o_orderdate < timestamp_ntz'1998-04-01 00:00:00'").select("o_orderkey",
        "o_custkey", "o_totalprice")


@query("SELECT c_custkey, CASE c_nationkey % 5 WHEN 1 THEN 'female' WHEN 2 THEN 'male' WHEN 3 THEN 'non-binary' ELSE 'unknown' END AS gender, CASE c_nationkey % 8 WHEN 1 THEN '首映' WHEN 2 THEN '限定上映' WHEN 3 THEN '院线' WHEN 4 THEN '数字' WHEN 5 THEN '实体' WHEN 6 THEN '电视' ELSE '其他' END AS release_type FROM customer")
def code_names(spark, t) -> DataFrame:
    return t.customer.select("c_custkey", C.gender_name(F.col("c_nationkey") % 5).alias("gender"),
        C.release_type_name(F.col("c_nationkey") % 8).alias("release_type"))


@query("SELECT c_custkey, CASE WHEN length(c_name) >= 12 THEN left(c_name, 4) || '****' || right(c_name, 4) ELSE '****' END AS masked, try_cast(CASE WHEN c_custkey % 2 = 0 THEN '2024-02-' || lpad((c_custkey % 40)::VARCHAR, 2, '0') ELSE '' END AS DATE) AS parsed FROM customer")
def lenient_values(spark, t) -> DataFrame:
    """Masked names, and dates of which many don't exist."""
    text = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("2024-02-"), F.lpad((F.col("c_custkey") % 40).cast("string"), 2, "0"))).otherwise("")
    return t.customer.select("c_custkey", C.mask_secret(F.col("c_name")).alias("masked"), C.lenient_date(text).alias("parsed"))
