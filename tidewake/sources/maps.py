"""Map layers: the query text, download with fail-over, and parsing into boxes and places."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.config import DEFAULT

MAX_SPAN_M = 3000.0

ELEMENTS = "struct<elements:array<struct<type:string,id:bigint,lat:double,lon:double,bounds:struct<minlat:double,minlon:double,maxlat:double,maxlon:double>,center:struct<lat:double,lon:double>,tags:map<string,string>>>>"


def layer_query(tags: dict[str, list[str]], areas: tuple[str, ...] = ("NO", "SJ")) -> str:
    """All nodes, ways and relations with one of the values, in the areas, with their bounds."""
    where = "".join(f'area["ISO3166-1"="{a}"]->.{a.lower()};' for a in areas)
    parts = [f'{kind}["{key}"~"^({"|".join(values)})$"](area.{a.lower()});' for a in areas for key, values in tags.items() for kind in ("node", "way", "relation")]
    return f"[out:json][timeout:180];{where}({''.join(parts)});out tags center bb;"


def download(query: str, servers: list[str], fetch: Callable[[str, str], dict]) -> dict:
    """The first server's answer that has elements; an empty answer counts as a failure."""
    problems = []
    for server in servers:
        try:
            answer = fetch(server, query)
            if answer.get("elements"):
                return answer
            problems.append(f"{server}: empty")
        except Exception as e:
            problems.append(f"{server}: {e}")
    raise ConnectionError("; ".join(problems))


def features(spark: SparkSession, payloads: DataFrame, tags: dict[str, list[str]], column: str = "payload") -> DataFrame:
    """osm_id, kind, name and bounds of each element of the JSON documents in ``payloads``.

    A point is its own box; elements without a position or larger than 3 km are left out; the kind is the first
    tag that matches, with blanks.
    """
    e = payloads.select(F.explode(F.from_json(column, ELEMENTS)["elements"]).alias("e")).select("e.*")
    low = lambda k: F.coalesce(F.col(k), F.col(f"bounds.min{k}"), F.col(f"center.{k}"))
    high = lambda k: F.coalesce(F.col(k), F.col(f"bounds.max{k}"), F.col(f"center.{k}"))
    kind = F.coalesce(*[F.when(F.col("tags")[k].isin(*v), F.replace(F.col("tags")[k], F.lit("_"), F.lit(" "))) for k, v in tags.items()])
    b = e.select(F.col("id").alias("osm_id"), kind.alias("kind"), F.col("tags")["name"].alias("name"), low("lat").alias("min_lat"), low("lon").alias("min_lon"), high("lat").alias("max_lat"), high("lon").alias("max_lon"))
    height = (F.col("max_lat") - F.col("min_lat")) * DEFAULT.metres_per_degree
    width = (F.col("max_lon") - F.col("min_lon")) * DEFAULT.metres_per_degree * F.cos(F.radians("min_lat"))
    return b.filter(F.col("min_lat").isNotNull() & F.col("min_lon").isNotNull() & (F.hypot(height, width) <= MAX_SPAN_M))


def payload_frame(spark: SparkSession, *payloads: dict) -> DataFrame:
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")


REGISTER = "struct<features:array<struct<geometry:struct<coordinates:array<double>>,properties:struct<id:bigint,locode:string,name:string,type:string>>>>"


def register(payloads: DataFrame, kinds: dict[str, str], column: str = "payload") -> DataFrame:
    """Official places from a GeoJSON register: types by the map ``kinds``, names that say so are anchorages, (0, 0) is no place."""
    f = payloads.select(F.explode(F.from_json(column, REGISTER)["features"]).alias("f"))
    lon, lat = F.col("f.geometry.coordinates")[0], F.col("f.geometry.coordinates")[1]
    name = F.replace(F.col("f.properties.name"), F.lit('"'), F.lit("'"))
    named = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("f.properties.type")]
    kind = F.when(name.rlike("(?i)anchor|ankring|ankerplass"), "anchorage").otherwise(named)
    out = f.select(F.col("f.properties.id").alias("location_id"), F.col("f.properties.locode").alias("locode"), name.alias("location_name"), kind.alias("kind"), F.round(lat, 6).alias("latitude"), F.round(lon, 6).alias("longitude"))
    return out.filter(~((F.col("latitude") == 0) & (F.col("longitude") == 0)) & F.col("kind").isNotNull()).orderBy("location_id")
