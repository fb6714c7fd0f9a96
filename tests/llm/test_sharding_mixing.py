import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm import mixing, sharding

SCHEMA = "doc_id long, text string, lang string, source string, size int, cell int, shard string"


def documents(spark, n=500):
    rows = [(i, None if i % 50 == 0 else "wörd " * (i * 7 % 90), None if i % 11 == 0 else "en", None if i % 13 == 0 else f"s{i % 3 if i % 2 else 0}", 1, 2,
        "x") for i in range(n)]
    rows += [rows[3]] * 3 + [(None, "null id", "en", "s1", 0, 0, "")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_the_curve_is_a_walk():
    axes = np.array([(a, b, c) for a in range(32) for b in range(32) for c in range(32)])
    index = sharding.hilbert_index(axes)
    assert sorted(index) == list(range(32**3))
    assert (np.abs(np.diff(axes[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    rows, docs = documents(spark)
    placed = sharding.hilbert_shards(docs, rows_per_task=20).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in placed) == Counter((i, len((t or "").encode()) + 1,
        zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append((r["slot"], r["cell"]))
    assert set(slots) == set(range(16)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in slots.values())
    order = [c for k in range(16) for _, c in sorted(slots[k])]
    assert order == sorted(order)  # shards and slots follow the curve
    assert sharding.hilbert_shards(spark.createDataFrame([], SCHEMA)).count() == 0
    ranges = sharding.manifest(sharding.hilbert_shards(docs)).collect()  # with repeated and null ids
    assert len(ranges) == 16 and all(r["min_size"] <= r["max_size"] for r in ranges) and sum(r["rows"] for r in ranges) == len(rows)
    assert sum(r["null_name_a"] for r in ranges) == sum(r[2] is None for r in rows)


def test_names_keep_their_order(spark):
    names = sorted({f"{a}{b}" for a in ("src", "web", "é", "") for b in range(12)} | {""})
    rows = [(i, name) for i, name in enumerate(names)] * 3 + [(1000 + i, "src0") for i in range(500)] + [(9, None)] * 4
    df = spark.createDataFrame(rows, "n long, name string")
    [cuts, _] = sharding.cuts_of(df, ("name", "name"))
    cells = dict(df.select("name", sharding.cell_of(sharding.as_number(F.col("name")), cuts)).distinct().collect())
    by_bytes = sorted((n for n in cells if n is not None), key=lambda n: n.encode()[:7])
    assert len(cuts) <= 31 and [cells[n] for n in by_bytes] == sorted(cells[n] for n in by_bytes) and cells[None] == 0 == min(cells.values())
    assert max(cells.values()) > 5


def test_a_manifest_prunes_by_name(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50), f"l{i % 4}", f"s{i % 8}") for i in range(2000)], "doc_id long, text string, lang string, source string")
    ranges = sharding.manifest(sharding.hilbert_shards(docs)).collect()
    assert sum(r["min_name_b"] <= "s3" <= r["max_name_b"] for r in ranges) < 12 and sum(r["min_name_a"] <= "l2" <= r["max_name_a"] for r in ranges) < 12


def test_targets():
    assert mixing.source_targets([80, 80, 80]) == [150.0, 60.0, 30.0]
    assert mixing.source_targets([10, 100, 100]) == [30.0, 120.0, 60.0]
    assert sum(mixing.source_targets([1, 2, 300])) == 303.0 and mixing.source_targets([]) == [] and mixing.source_targets([0, 5]) == [0.0, 5.0]


def test_quotas_add_up():
    quotas = mixing.split_quotas([1000, 10, 0, 333], 7, seed=1)
    assert quotas.sum(axis=0).tolist() == [1000, 10, 0, 333] and max(quotas.sum(axis=1)) - min(quotas.sum(axis=1)) <= 7
    assert (quotas == mixing.split_quotas([1000, 10, 0, 333], 7, seed=1)).all()


def test_mix(spark):
    rows, docs = documents(spark)
    sizes = [len((t or "").split()) for _, t, *_ in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    own = [sum(s for s, r in zip(sizes, rows, strict=True) if r[3] == name) for name in names]
    targets = dict(zip(names, mixing.source_targets(own), strict=True))
    planned = mixing.mix(docs, docs_per_block=16, keep=["source"]).collect()
    assert len(planned) == len(rows)
    for name in names:
        mine = [r for r in planned if r["keep_source"] == name]
        assert {(r["source_size"], r["target"]) for r in mine} == {(own[names.index(name)], targets[name])}
        assert abs(sum(r["size"] * r["copies"] for r in mine) - targets[name]) <= max(r["size"] for r in mine) / 2 + 1e-9
    assert all(0 <= r["copies"] <= 3 and len(r["shards"]) == r["copies"] and all(0 <= s < 64 for s in r["shards"]) for r in planned)
    again = mixing.mix(docs.repartition(2), docs_per_block=16, keep=["source"]).collect()
    assert Counter(map(str, again)) == Counter(map(str, planned))
    taken = mixing.mixed_rows(docs, docs_per_block=16)
    assert taken.columns == [*docs.columns, "mix_shard", "mix_place"] and taken.count() == sum(r["copies"] for r in planned)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert taken.where(F.col("mix_shard").isNull()).count() == 0


def test_shards_take_the_drawn_quotas_in_disjoint_runs(spark):
    _, docs = documents(spark)
    meta = docs.select(*[c.alias(k) for k, c in mixing.keyed(docs, 7, "doc_id", "text", "source").items()])
    places = mixing.placed_blocks(meta, 8, 7, 3, mixing.WEIGHTS, 1.0, 16).collect()
    names = sorted({r["src"] for r in places}, key=lambda s: (s is None, s or ""))
    draws = {name: sorted((k, r["block_start"], r["blk"],
        r["places"][k]) for r in places if r["src"] == name for k in range(3) if k * r["source_size"] + r["block_start"] < r["target"]) for name in names}
    want = mixing.split_quotas([len(draws[name]) for name in names], 8, 7)
    for i, name in enumerate(names):
        shards = [shard for *_, shard in draws[name]]
        assert shards == sorted(shards)  # runs of the permuted blocks
        assert [shards.count(k) for k in range(8)] == want[:, i].tolist()
    assert want.sum() > 30 and (want.sum(axis=1) > 0).all()


def test_written_shards(spark, tmp_path):
    _, docs = documents(spark)
    mixing.write_shards(docs, str(tmp_path / "mix"), shards=4, docs_per_block=16)
    planned = mixing.mix(docs, shards=4, docs_per_block=16).collect()
    want = Counter((r["doc_id"], shard) for r in planned for shard in r["shards"])
    got, places = Counter(), 0
    for shard in range(4):
        [file] = (tmp_path / "mix" / f"mix_shard={shard}").glob("*.parquet")
        rows = spark.read.parquet(str(file)).collect()
        got.update((r["doc_id"], shard) for r in rows)
        order = [r["mix_place"] for r in rows]
        assert order == sorted(order) and [r["doc_id"] for r in rows] != sorted((r["doc_id"] for r in rows), key=str)
        places += len(order)
    assert got == want and places == sum(want.values())


def test_own_names_clash(spark):
    docs = documents(spark)[1].withColumns({"mix_shard": F.lit("x"), "mix_place": F.lit("y"), "__copy": F.lit("z"), "copies": F.lit("k")})
    taken = mixing.mixed_rows(docs, docs_per_block=16)
    assert taken.columns == ["doc_id", "text", "lang", "source", "size", "cell", "shard", "copies", "mix_shard", "mix_place"]
    assert {r["copies"] for r in taken.collect()} == {"k"}
