"""Sharding of records whose columns are named like its results, against plain values."""

from zlib import crc32

from lakemart.llm import queries, sharding


def test_clashing_names_and_plain_values(spark, tmp_dir):
    texts = [None, "", "a", "éé\n", "x" * 70_000] * 9
    rows = [(None if i % 11 == 0 else i % 30, t, i, "s", 1, 2) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, shard int, Slot string, shard_ int, __at int"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op5_sharding(spark, tmp_dir).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    want = [(r[0], len((r[1] or "").encode()) + 1, crc32((r[1] or "").encode())) for r in rows]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=key) == sorted(want, key=key)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(16)) and sum(map(len, slots.values())) == len(rows)
    sizes = [len(slots.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    df = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    assert sharding.shuffled_shards(df, "doc_id", 4).columns == ["doc_id", "text", "shard__", "Slot_", "shard_", "__at_", "shard", "slot"]


def test_empty_table(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    assert queries.op5_sharding(spark, tmp_dir).count() == 0
