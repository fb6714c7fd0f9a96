"""Explicit schemas: nothing is inferred, unknown fields are ignored."""

from __future__ import annotations

RAW = "schema_version int, entity_type string, entity_id bigint, dt string, ingest_time bigint, source string, payload string"
_NAMED = "array<struct<id:bigint,name:string>>"
MOVIE = (
    "struct<id:bigint,title:string,original_title:string,original_language:string,overview:string,status:string,release_date:string,runtime:int,"
    "budget:bigint,revenue:bigint,popularity:double,vote_average:double,vote_count:int,adult:boolean,belongs_to_collection:struct<id:bigint,name:string>,"
    f"genres:{_NAMED},production_companies:{_NAMED},production_countries:array<struct<iso_3166_1:string,name:string>>,"
    f"spoken_languages:array<struct<iso_639_1:string,name:string>>,keywords:struct<keywords:{_NAMED}>,"
    "credits:struct<cast:array<struct<id:bigint,credit_id:string,name:string,character:string,order:int>>,"
    "crew:array<struct<id:bigint,credit_id:string,name:string,department:string,job:string>>>,"
    "release_dates:struct<results:array<struct<iso_3166_1:string,release_dates:array<struct<certification:string,release_date:string,type:int>>>>>>"
)
TV = (
    "struct<id:bigint,name:string,original_name:string,original_language:string,overview:string,status:string,first_air_date:string,"
    "number_of_seasons:int,number_of_episodes:int,popularity:double,vote_average:double,vote_count:int,adult:boolean,"
    f"genres:{_NAMED},networks:{_NAMED},production_companies:{_NAMED},origin_country:array<string>,keywords:struct<results:{_NAMED}>>"
)
PERSON = "struct<id:bigint,name:string,gender:int,birthday:string,deathday:string,place_of_birth:string,known_for_department:string,popularity:double,adult:boolean,biography:string>"
EVENT = "struct<event_id:string,event_type:string,schema_version:int,source:string,trace_id:string,entity_type:string,entity_id:bigint,event_time:bigint,ingest_time:bigint,content_hash:string,payload:string>"
POPULARITY = "struct<title:string,popularity:double,vote_average:double,vote_count:int,rank:int,list_name:string,observed_at:bigint>"
EXPORT = "id bigint, adult boolean, popularity double, title string, name string, original_title string, original_name string, video boolean"
EVENT_TYPES = ["ENTITY_CHANGED", "ENTITY_SNAPSHOT", "POPULARITY_OBSERVED"]
ENTITY_TYPES = ["movie", "tv", "person", "company", "collection", "genre", "keyword"]
