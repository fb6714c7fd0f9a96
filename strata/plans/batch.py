"""The daily batch: raw partitions to named tables of every layer, and their writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import ads, dwd, dws, scd2
from strata.session import checkpointed
from strata.sources import lake, raw, schemas

DIM_KEYS = {"dim_movie": ("movie_id", dwd.MOVIE_BUSINESS), "dim_person": ("person_id", dwd.PERSON_BUSINESS)}
SCHEMAS = {"movie": schemas.MOVIE, "tv": schemas.TV, "person": schemas.PERSON}


def parse(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: dwd.parsed(frames[k], s) for k, s in SCHEMAS.items()}


def modelled(parsed: dict[str, DataFrame], dt: str, existing: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions, bridges and facts of a day. ``existing`` has the histories of dim_movie and dim_person."""
    movies, tv = parsed["movie"], parsed["tv"]
    out: dict[str, DataFrame] = {}
    for name, fresh in (("dim_movie", dwd.dim_movie(movies, dt)), ("dim_person", dwd.dim_person(parsed["person"], dt))):
        key, business = DIM_KEYS[name]
        out[name] = scd2.merge(existing[name], fresh, key, business) if name in existing else fresh
    out |= {"dim_company": dwd.dim_company(movies, dt), "dim_genre": dwd.dim_genre(movies, tv, dt), "dim_keyword": dwd.dim_keyword(movies, dt, tv)}
    out |= {"dim_country": dwd.dim_country(movies, dt), "dim_language": dwd.dim_language(movies, dt), "dim_collection": dwd.dim_collection(movies, dt)}
    out |= dwd.bridges(movies, tv, dt)
    out |= {"fact_movie_credit": dwd.fact_credit(movies, dt), "fact_movie_daily_snapshot": dwd.fact_snapshot(movies, dt)}
    return out | {"fact_movie_release": dwd.fact_release(movies, dt), "fact_change_event": dwd.fact_change(movies, dt)}


def summed(tables: dict[str, DataFrame], dt: str, past: DataFrame | None = None) -> dict[str, DataFrame]:
    """Summaries of a day from the modelled tables. ``past`` has the snapshots of the days before."""
    today = lambda name: tables[name].where(f"dt = date'{dt}'")
    snapshots, credits = today("fact_movie_daily_snapshot"), today("fact_movie_credit")
    if past is not None:  # a week of days before, so that there is something to compare with
        past = past.where(f"dt < date'{dt}' and dt >= date_sub(date'{dt}', 14)")
        snapshots = past.select(*snapshots.columns).unionByName(snapshots)
    now, persons = dws.current_movies(tables["dim_movie"]), scd2.current(tables["dim_person"])
    metric = dws.movie_metric(snapshots, credits, now).where(f"dt = date'{dt}'")
    out = {"dws_genre_year_metric": dws.genre_year(tables["bridge_movie_genre"], now), "dws_person_career": dws.person_career(credits, now, persons)}
    out |= {"dws_country_year_metric": dws.country_year(tables["bridge_movie_country"], now),
        "dws_company_finance": dws.company_finance(tables["bridge_movie_company"], now)}
    return {"dws_movie_metric_1d": metric} | {k: dwd.loaded(v, dt, with_dt=True) for k, v in out.items()}


def reported(tables: dict[str, DataFrame], dt: str) -> dict[str, DataFrame]:
    """Reports of a day from its summaries."""
    metric, career = (tables[k].where(f"dt = date'{dt}'") for k in ("dws_movie_metric_1d", "dws_person_career"))
    out = {"ads_top_movie": ads.top_movie(metric), "ads_genre_trend": ads.genre_trend(tables["bridge_movie_genre"], metric)}
    return out | {"ads_roi_ranking": ads.roi_ranking(metric), "ads_person_influence": ads.person_influence(career)}


def transform(frames: dict[str, DataFrame], dt: str, existing: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All tables of a day, lazily. ``existing`` has the histories of dim_movie, dim_person and fact_movie_daily_snapshot."""
    existing = existing or {}
    out = modelled(parse(frames), dt, existing)
    out |= summed(out, dt, existing.get("fact_movie_daily_snapshot"))
    return out | reported(out, dt)


def run(spark: SparkSession, base: str, dt: str) -> dict[str, DataFrame]:
    """Reads a day's raw records, writes all tables under ``base``/lake, and returns them as written.

    Records are parsed once, and each layer is built from the tables of the one below as they were written, so no
    table's plan is computed again for another's.
    """
    home = lambda name: f"{base}/lake/{name}"
    parsed = {k: checkpointed(df) for k, df in parse({k: raw.read_partition(spark, base, k, dt) for k in SCHEMAS}).items()}
    existing = {k: spark.read.parquet(home(k)) for k in (*DIM_KEYS, "fact_movie_daily_snapshot") if raw.exists(spark, home(k))}
    written: dict[str, DataFrame] = {}

    def write(tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            if "dt" in table.columns:
                lake.overwrite_partitions(table, home(name))
            else:
                lake.publish(table, home(name))
        # The schema is the plan's: what is read back has its types and order of columns.
        written.update({name: spark.read.schema(table.schema).parquet(home(name)) for name, table in tables.items()})

    write(modelled(parsed, dt, existing))
    write(summed(written, dt, written["fact_movie_daily_snapshot"]))
    write(reported(written, dt))
    return written
