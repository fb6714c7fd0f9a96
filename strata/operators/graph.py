"""Analytics over a property graph: vertices (id, label, name) and edges (from_id, to_id, type).

Person edges are ACTED_IN and DIRECTED to movies; movies have HAS_GENRE, HAS_KEYWORD and PRODUCED_BY edges. Results
that are ranked break ties by id.
"""

from __future__ import annotations

import math
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import checkpointed
from strata.sources import lake, upserts

CREDITS = ["ACTED_IN", "DIRECTED"]
FEATURES = ["ACTED_IN", "HAS_GENRE", "HAS_KEYWORD"]


def checked_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose ends both exist, once each."""
    ends = vertices.select("id")
    one = edges.join(ends.withColumnRenamed("id", "from_id"), "from_id", "left_semi")
    return one.join(ends.withColumnRenamed("id", "to_id"), "to_id", "left_semi").dropDuplicates(["from_id", "to_id", "type"])


def merged_vertices(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("label", "id").agg(F.max("name").alias("name"))


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """existing with incoming upserted by its keys (null is a key): one row a key, incoming's values where it has one, of
    several the greatest. Merging the same again changes nothing. ``save`` does this on disk.
    """
    return upserts.merged(existing, incoming, keys)


VERTEX_KEYS, EDGE_KEYS = ["label", "id"], ["from_id", "to_id", "type"]


def violations(vertices: DataFrame) -> DataFrame:
    """What breaks the constraint that a label's ids are there and unique: label, id, n."""
    rows = vertices.groupBy(*VERTEX_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return rows.where("n > 1 or id is null or label is null")


def save(vertices: DataFrame, edges: DataFrame, path: str, buckets: int = 64) -> dict[str, int]:
    """Upserts a graph into the tables below ``path``, vertices first; returns how many buckets of each were written.

    Vertices without a label or an id are refused. An edge needs both ends among the vertices as they are then.
    """
    spark = vertices.sparkSession
    if not vertices.where("id is null or label is null").isEmpty():
        raise ValueError("a vertex has no label or no id")
    written = {}
    for name, rows, keys in (("vertices", vertices, VERTEX_KEYS), ("edges", edges, EDGE_KEYS)):
        home = f"{path}/{name}"
        if not lake.load_state(spark, f"{home}/_table"):
            upserts.create(rows.limit(0), home, keys, buckets)
        if name == "edges":
            rows = checked_edges(rows, upserts.read(spark, f"{path}/vertices"))
        written[name] = len(upserts.upsert(rows, home))
    return written


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The vertices and edges of a saved graph."""
    return tuple(upserts.read(spark, f"{path}/{name}") for name in ("vertices", "edges"))


#: What the modelled tables say: edge type, table, its two columns, and the labels of their ends.
MODEL_EDGES = [
    ("HAS_GENRE", "bridge_movie_genre", "movie_id", "genre_id", "movie", "genre"),
    ("PRODUCED_BY", "bridge_movie_company", "movie_id", "company_id", "movie", "company"),
    ("HAS_KEYWORD", "bridge_movie_keyword", "movie_id", "keyword_id", "movie", "keyword"),
]
MODEL_VERTICES = [("movie", "dim_movie", "movie_id", "title"), ("person", "dim_person", "person_id", "person_name"),
    ("genre", "dim_genre", "genre_id", "genre_name"), ("company", "dim_company", "company_id", "company_name"),
    ("keyword", "dim_keyword", "keyword_id", "keyword_name")]


def from_tables(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Vertices (label, id, name) and edges (from_id, to_id, type, from_label, to_label) of the modelled tables.

    Of histories the current versions count; a vertex without a name stays, one without an id does not; an edge whose
    end has no vertex is left out, and each edge is there once.
    """
    vertices = None
    for label, name, key, said in MODEL_VERTICES:
        rows = tables[name]
        if "valid_to" in rows.columns:
            rows = rows.where(F.col("valid_to") == F.lit("2099-12-31 00:00:00").cast("timestamp"))
        rows = rows.where(F.col(key).isNotNull()).select(F.lit(label).alias("label"), F.col(key).cast("bigint").alias("id"), F.col(said).alias("name"))
        vertices = rows if vertices is None else vertices.unionByName(rows)
    vertices = merged_vertices(vertices)
    credits = tables["fact_movie_credit"].select(F.col("person_id").alias("from_id"), F.col("movie_id").alias("to_id"), "credit_type", "is_director")
    ends = lambda rows, kind, a, b: rows.select("from_id", "to_id", F.lit(kind).alias("type"), F.lit(a).alias("from_label"),
        F.lit(b).alias("to_label"))
    edges = ends(credits.where("credit_type = 'cast'"), "ACTED_IN", "person",
        "movie").unionByName(ends(credits.where("is_director = 1"), "DIRECTED", "person", "movie"))
    for kind, name, a, b, from_label, to_label in MODEL_EDGES:
        edges = edges.unionByName(ends(tables[name].select(F.col(a).alias("from_id"), F.col(b).cast("bigint").alias("to_id")), kind, from_label, to_label))
    for end in ("from", "to"):
        known = vertices.select(F.col("label").alias(f"{end}_label"), F.col("id").alias(f"{end}_id"))
        edges = edges.join(known, [f"{end}_label", f"{end}_id"], "left_semi")
    return vertices, edges.select("from_id", "to_id", "type", "from_label", "to_label").distinct()


def parameter(text: str) -> tuple[str, int | Decimal | str]:
    """k=v as a name and an int, a decimal or a text."""
    name, sign, value = text.partition("=")
    if not sign or not name.strip():
        raise ValueError(f"{text} is not name=value")
    value = value.strip()
    try:
        return name.strip(), int(value)
    except ValueError:
        pass
    try:
        number = Decimal(value)
        return name.strip(), number if number.is_finite() else value
    except InvalidOperation:
        return name.strip(), value


def of(edges: DataFrame, types: list[str] | str) -> DataFrame:
    return edges.where(F.col("type").isin([types] if isinstance(types, str) else types)).select("from_id", "to_id", "type")


def ranked(df: DataFrame, metric: str, limit: int | None, *ids: str) -> DataFrame:
    return df.orderBy(F.desc(metric), *ids).limit(limit) if limit else df


def degree(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct movies of each person."""
    return ranked(of(edges, CREDITS).groupBy(F.col("from_id").alias("person_id")).agg(F.count_distinct("to_id").alias("degree")), "degree", limit, "person_id")


#: A movie with more actors is heavy: its pairs are dealt in blocks of about so many actors by as many.
HEAVY, BLOCK = 1024, 512


def _pairs_within(rows: DataFrame, heavy: int, block: int) -> DataFrame:
    """a_id < b_id, once for each movie (rows: from_id, to_id, distinct) that has both.

    Light movies pair their actors where they meet. A heavy one's actors go to blocks, and each pair of blocks is a key
    of its own, so none of its tasks has more than one block by another.
    """
    sizes = checkpointed(rows.groupBy("to_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy))
    oriented = lambda both: both.select(F.least("x", "y").alias("a_id"), F.greatest("x", "y").alias("b_id"))
    light = rows.join(sizes, "to_id", "left_anti")
    pairs = oriented(light.select("to_id", F.col("from_id").alias("x")).join(light.select("to_id", F.col("from_id").alias("y")), "to_id").where("x < y"))
    if sizes.isEmpty():
        return pairs
    dealt = rows.join(sizes, "to_id").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("from_id"), F.col("blocks")).cast("int"))
    left = dealt.select("to_id", F.col("from_id").alias("x"), F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"))
    right = dealt.select("to_id", F.col("from_id").alias("y"), F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"))
    met = left.join(right, ["to_id", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("x") < F.col("y")))
    return pairs.unionByName(oriented(met))


def coactors(edges: DataFrame, limit: int | None = None, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """Pairs of actors a < b with their distinct shared movies.

    With a limit, the pairs among the persons of most movies say how many shared movies a pair has to have at least to
    be among the first; two persons share no more movies than either has, so others are left out before they pair.
    """
    acted = checkpointed(of(edges, "ACTED_IN").select("from_id", "to_id").distinct())
    shared = lambda rows: _pairs_within(rows, heavy, block).groupBy("a_id", "b_id").agg(F.count(F.lit(1)).alias("shared"))
    if limit:
        degrees = acted.groupBy("from_id").agg(F.count(F.lit(1)).alias("n"))
        few = degrees.orderBy(F.desc("n"), "from_id").limit(2 + math.isqrt(2 * limit) * 2)
        among = ranked(shared(acted.join(few.select("from_id"), "from_id", "left_semi")), "shared", limit, "a_id", "b_id")
        told = among.agg(F.count(F.lit(1)).alias("n"), F.min("shared").alias("least")).first()
        if told["n"] == limit and told["least"] > 1:
            acted = acted.join(degrees.where(F.col("n") >= told["least"]).select("from_id"), "from_id", "left_semi")
    return ranked(shared(acted), "shared", limit, "a_id", "b_id")


def director_actor(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """A director may be an actor of the same movie; pairs go by id."""
    directed = of(edges, "DIRECTED").select(F.col("from_id").alias("director_id"), "to_id").distinct()
    acted = of(edges, "ACTED_IN").select(F.col("from_id").alias("actor_id"), "to_id").distinct()
    pairs = directed.join(acted, "to_id").groupBy("director_id", "actor_id").agg(F.count(F.lit(1)).alias("shared"))
    return ranked(pairs, "shared", limit, "director_id", "actor_id")


def director_actor_names(edges: DataFrame, persons: DataFrame, limit: int | None = None) -> DataFrame:
    """The same by the persons' names (id, name): those of one name count together, by distinct movies."""
    named = lambda kind, name: of(edges, kind).join(persons.select(F.col("id").alias("from_id"), F.col("name").alias(name)), "from_id").select(name,
        "to_id").distinct()
    pairs = named("DIRECTED", "director").join(named("ACTED_IN", "actor"), "to_id").groupBy("director", "actor").agg(F.count(F.lit(1)).alias("shared"))
    return ranked(pairs, "shared", limit, "director", "actor")


def actor_network(edges: DataFrame, person: int, limit: int | None = None) -> DataFrame:
    acted = of(edges, "ACTED_IN").select("from_id", "to_id").distinct()
    own = acted.where(F.col("from_id") == person).select("to_id")
    others = acted.where(F.col("from_id") != person).join(own, "to_id")
    return ranked(others.groupBy(F.col("from_id").alias("person_id")).agg(F.count(F.lit(1)).alias("shared")), "shared", limit, "person_id")


def cooccurrence(edges: DataFrame, kind: str = "HAS_GENRE", limit: int | None = None) -> DataFrame:
    has = of(edges, kind).select("from_id", "to_id").distinct()
    pairs = has.select("from_id", F.col("to_id").alias("a_id")).join(has.select("from_id", F.col("to_id").alias("b_id")), "from_id").where("a_id < b_id")
    return ranked(pairs.groupBy("a_id", "b_id").agg(F.count(F.lit(1)).alias("movies")), "movies", limit, "a_id", "b_id")


def company_genre(edges: DataFrame, limit: int | None = None) -> DataFrame:
    made = of(edges, "PRODUCED_BY").select("from_id", F.col("to_id").alias("company_id")).distinct()
    has = of(edges, "HAS_GENRE").select("from_id", F.col("to_id").alias("genre_id")).distinct()
    return ranked(made.join(has, "from_id").groupBy("company_id", "genre_id").agg(F.count(F.lit(1)).alias("movies")), "movies", limit, "company_id", "genre_id")


def similar(edges: DataFrame, movie: int, limit: int | None = None) -> DataFrame:
    """Movies that share actors, genres or keywords with one; a neighbour counts once per kind."""
    acted = of(edges, "ACTED_IN").select(F.col("to_id").alias("movie_id"), F.concat_ws(":", "type", "from_id").alias("feature"))
    has = of(edges, FEATURES[1:]).select(F.col("from_id").alias("movie_id"), F.concat_ws(":", "type", "to_id").alias("feature"))
    features = acted.unionByName(has).distinct()
    own = features.where(F.col("movie_id") == movie).select("feature")
    shared = features.where(F.col("movie_id") != movie).join(own, "feature").groupBy("movie_id").agg(F.count(F.lit(1)).alias("shared"))
    return ranked(shared, "shared", limit, "movie_id")


def keyword_centrality(edges: DataFrame, limit: int | None = None) -> DataFrame:
    return ranked(of(edges, "HAS_KEYWORD").groupBy(F.col("to_id").alias("keyword_id")).agg(F.count_distinct("from_id").alias("movies")), "movies", limit,
        "keyword_id")


def counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    v = vertices.groupBy(F.lit("vertex").alias("what"), F.col("label").alias("kind")).count()
    return v.unionByName(edges.groupBy(F.lit("edge").alias("what"), F.col("type").alias("kind")).count())


def _both_ways(edges: DataFrame, types: list[str]) -> DataFrame:
    """Undirected person-movie edges; ids carry their side, as persons and movies number separately."""
    pairs = of(edges, types).select(F.concat(F.lit("p"), "from_id").alias("u"), F.concat(F.lit("m"), "to_id").alias("v")).distinct()
    return pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))


def shortest_path(edges: DataFrame, start: int, end: int, most_hops: int = 6) -> DataFrame:
    """hops of the shortest path between two persons, and the least of the shortest paths by its nodes; no row beyond
    ``most_hops``.

    The links are written once. A search first grows the nodes within each hop, one row a node; it stops at the end
    or when nothing new is reached. Then only the nodes that lie on shortest paths are walked back.
    """
    links = checkpointed(_both_ways(edges, CREDITS))
    spark = links.sparkSession
    layers = [spark.createDataFrame([(f"p{start}",)], "node string")]
    seen = layers[0]
    for _ in range(most_hops):
        grown = checkpointed(layers[-1].join(links, F.col("node") == F.col("u")).select(F.col("v").alias("node")).distinct().join(seen, "node", "left_anti"))
        layers.append(grown)
        if grown.isEmpty() or not grown.where(F.col("node") == f"p{end}").isEmpty():
            break
        seen = seen.unionByName(grown)
    hops = len(layers) - 1
    paths = layers[-1].where(F.col("node") == f"p{end}").select("node", F.col("node").alias("path"))
    for layer in reversed(layers[:-1]):  # a node keeps the least of its ways on to the end
        back = paths.join(links, F.col("node") == F.col("v")).select(F.col("u").alias("node"), F.concat_ws(">", "u", "path").alias("path"))
        paths = back.join(layer, "node", "left_semi").groupBy("node").agg(F.min("path").alias("path"))
    return paths.where(F.lit(hops > 0)).select(F.lit(hops).alias("hops"), "path")


def path_names(paths: DataFrame, persons: DataFrame, movies: DataFrame) -> DataFrame:
    """paths (hops, path) with names: those of its nodes, in order; a node without a name shows its id."""
    names = persons.select(F.concat(F.lit("p"), "id").alias("node"), "name").unionByName(movies.select(F.concat(F.lit("m"), "id").alias("node"), "name"))
    nodes = paths.select("hops", "path", F.posexplode(F.split("path", ">")).alias("at", "node")).join(names, "node", "left")
    named = nodes.groupBy("hops", "path").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("name", "node").alias("name")))).alias("n"))
    return named.select("hops", "path", F.transform("n", lambda x: x["name"]).alias("names"))


def circle(edges: DataFrame, person: int, depth: int = 2) -> DataFrame:
    """Distinct movies within 1..depth hops (1 to 4) of a person over acting."""
    links = checkpointed(_both_ways(edges, ["ACTED_IN"]))
    frontier = links.sparkSession.createDataFrame([(f"p{person}",)], "node string")
    seen = frontier
    for _ in range(min(4, max(1, depth))):
        frontier = checkpointed(frontier.join(links, F.col("node") == F.col("u")).select(F.col("v").alias("node")).distinct().join(seen, "node", "left_anti"))
        seen = seen.unionByName(frontier)
    return seen.where(F.col("node").startswith("m")).agg(F.count_distinct("node").alias("movies"))
