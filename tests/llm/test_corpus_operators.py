"""Sharding, search, duplicate and contamination operators and the pipeline
against brute-force versions, with nulls, ties, repeated rows and empty tables."""

import hashlib
import itertools

import numpy as np
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import decontaminate, jaccard_join, sharding, suffix_dedup, topk
from lakemart.llm.bwt import repeat_classes
from lakemart.llm.components import components
from lakemart.llm.queries import QUERIES
from tests.conftest import SF0001

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def groups_by_force(rows, n, percent):
    sets = {i: grams(t, n) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def near_rows(seed=1):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    passage = [f"p{i}" for i in range(40)]
    for size in (1, 2, 3, 4, 5, 7, 9, 12, 20, 40, 120, 400, 1500):
        base = [f"w{x}" for x in rng.integers(0, 5000, size)]
        for edits in (0, 0, 1, 2, 4, 8, 20):
            w = list(base)
            for _ in range(min(edits, size // 3)):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(10**6)}"
            rows.append((k, " ".join(w)))
            rows.append((k + 1, " ".join(passage + list(rng.choice(w, 6)))))
            k += 2
    return rows + [(k, None), (k + 1, ""), (k + 2, " \t"), (k + 3, "A b"), (k + 4, "a B")]


def test_near_groups_equal_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, component_id int, n int").repartition(5)
    for n, percent in ((4, 85), (5, 80), (1, 60)):
        got = jaccard_join.near_groups(docs, words=n, percent=percent).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == groups_by_force(rows, n, percent)
    # null ids link with nothing; repeated rows stay
    odd = spark.createDataFrame([(None, rows[-2][1]), (9, "x y z"), (9, "x y z"), (4, "X Y Z")], "doc_id long, text string")
    got = jaccard_join.near_groups(odd).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(4, 4), (9, 4), (9, 4)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard_join.near_groups(docs.limit(0)).count() == 0


def test_large_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    rows = near_rows(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_groups(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == groups_by_force(rows, 4, 85)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    bands = jaccard_join.Bands(85)
    for size in (1, 3, 7, 13, 50, 200, 900, 3000):
        for _ in range(20):
            a = rng.choice(1 << 40, size, replace=False)
            b = a.copy()
            drop = int(rng.integers(0, max(1, int(0.081 * size)) + 1))
            b[:drop] = rng.choice(1 << 40, drop) + (1 << 41)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                doc = np.repeat([0, 1], size)
                d, s = jaccard_join.signatures(bands, doc, np.concatenate([a, b]).astype(np.uint64), 2)
                assert np.intersect1d(s[d == 0], s[d == 1]).size


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), spark).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {95: 90, 100: 90, 201: 200}


def removed_by_force(rows, length=100):
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if b[s: s + length] in seen:
                cover[s: s + length] = b"\1" * length
            seen.add(b[s: s + length])
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((i, len(b), sum(cover), kept))
    return out


def test_repeats_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    word = lambda n: " ".join("".join(rng.choice(list("abé"), 5)) for _ in range(n))
    passage, rows = word(40), []
    for i in range(40):
        rows.append((i, word(30) + passage[int(rng.integers(30)):] + word(int(rng.integers(40)))))
    rows += [(40, rows[3][1]), (41, "a" * 1000), (42, "ab" * 300), (43, "a" * 99), (44, "a" * 100), (45, None), (46, ""), (47, rows[5][1][7:] + "x")]
    want = removed_by_force(rows)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string").repartition(6)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    for i, n, removed, kept in want:
        r = got[i]
        assert bytes(r.kept) == kept and sum(b - a for a, b in r.spans) == removed
        assert all(a < b for a, b in r.spans) and all(x[1] < y[0] for x, y in zip(r.spans, r.spans[1:]))
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "q" + "x y " * 50), (1, "q" + "x y " * 50), (None, "short")], "doc_id long, text string")
    sizes = sorted(len(r.kept) for r in suffix_dedup.remove_repeats(twice).collect())
    assert sizes[:2] == [0, 5] and sizes[2] > 0


def test_repeats_of_one_id_go_to_many_parts(spark, monkeypatch):
    rng = np.random.default_rng(9)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))
    shared, same = word(30), word(40)
    rows = [(None if i % 2 else 7, word(20) + shared, i) for i in range(300)] + [(7, same, i) for i in range(300)] + [(7, "short", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    remove, held = suffix_dedup._remove, spark.sparkContext.accumulator([], type("Sizes", (AccumulatorParam,), {
        "zero": lambda self, x: [], "addInPlace": lambda self, a, b: a + b})())

    def counted(columns, as_text):
        run = remove(columns, as_text)
        return lambda docs, found: (held.add([(docs.num_rows, docs.column("text").nbytes)]), run(docs, found))[1]

    monkeypatch.setattr(suffix_dedup, "_remove", counted)
    got = suffix_dedup.remove_repeats(docs).collect()
    size = {n: len(t) for _, t, n in rows[:300]}
    assert sorted(r.n for r in got) == sorted(n for _, _, n in rows)
    whole = [r for r in got if not r.spans]
    assert sum(bytes(r.kept) == b"short" for r in whole) == 3
    assert sum(bytes(r.kept).decode() == same for r in got) == 1 and sum(r.spans == [[0, len(same)]] for r in got) == 299
    cut = [r for r in got if r.spans and r.spans != [[0, len(same)]]]
    assert len(cut) == 299 and all(bytes(r.kept).decode() in rows[r.n][1] and len(r.kept) < size[r.n] for r in cut)
    assert max(k for k, _ in held.value) < 200 and sum(b for _, b in held.value) < 300 * 360 + 12 * 300


def test_wide_anchors_and_long_texts_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefgh "), 300))
    rows = [(i, "".join(rng.choice(list("abcdefgh "), 80)) + passage + "".join(rng.choice(list("abcdefgh "), 80))) for i in range(30)]
    rows.append((30, "".join(rng.choice(list("abcdefgh "), 9000)) + passage))
    want = removed_by_force(rows)
    found = np.concatenate([np.frombuffer(t.encode(), np.uint8) for _, t in rows])
    off = np.concatenate([[0], np.cumsum([len(t) for _, t in rows])])
    monkeypatch.setattr(suffix_dedup, "WIDE", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {i: kept for i, _, _, kept in want}
    begin, strings, _, _ = suffix_dedup.segments(found, off)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(begin, strings, strict=True)])
    assert covered.tolist() == [p for k in range(len(rows)) for p in range(off[k], off[k + 1] - 99)]


def test_interval_expansion_equals_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 200):
        text = rng.integers(0, 3, n)
        for length in (1, 4, 9):
            order, cls = repeat_classes(text, length)
            long = np.concatenate([text] * (length // n + 2))
            strings = [tuple(long[i: i + length]) for i in order]
            assert len(set(strings)) == len(set(cls.tolist())) == len(set(zip(strings, cls.tolist(), strict=True)))


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [int(x) for x in rng.integers(-3, 4, 8) * (rng.random(8) < 0.6)]) for i in range(120)]
    rows += [(200, None), (250, [1, None]), (None, [1] * 8), (300, [1, 2]), (301, []), (350, rows[50][1])]
    v = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, weights array<long>, score int")
    got = topk.top_k(v, v.where("vec_id % 50 = 0"), 5).collect()
    usable = [(i, w) for i, w in rows if i is not None and w is not None and None not in w]
    want = []
    for q, a in usable:
        if q % 50 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)[:5]
            want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.top_k(v.limit(0), v.limit(0), 5).count() == 0
    e = spark.createDataFrame([(1, [0.5, -0.001]), (2, [float("nan")]), (3, None), (4, [None])], "vec_id long, embedding array<float>")
    assert {r.vec_id: r.weights for r in topk.integer_vectors(e).collect()} == {1: [128, -1], 2: None, 3: None, 4: None}


def test_top_k_does_not_broadcast_blocks_of_queries(spark):
    """A few queries look small; their blocks, once for each lane, are not."""
    v = spark.range(400).selectExpr("id vec_id", "transform(sequence(1, 32), i -> (id * i) % 17) weights").localCheckpoint()
    got = topk.top_k(v, v.where("vec_id % 2 = 0"), 3)
    assert got.count() == 600
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_shards_differ_by_one_row_and_have_no_gaps(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    monkeypatch.setattr(sharding, "GROUP", 3)
    rows = [(i % 400 if i % 3 else None, f"t{i % 7}") for i in range(1003)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shuffled_shards(df, "doc_id", 16).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in got)) == sorted((i is None, i or 0, t) for i, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(slots) == 16 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shuffled_shards(df.limit(0), "doc_id", 16).count() == 0
    assert sharding.shuffled_shards(df.limit(5), "doc_id", 16).count() == 5
    sharding.write_shards(df, f"{tmp_dir}/out", "doc_id", 4)
    assert spark.read.parquet(f"{tmp_dir}/out").groupBy("shard").count().count() == 4


def test_sharding_writes_whole_records(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 20_000)
    written, write = [], sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda records, path, *a, **b: (written.append(path), write(records, path, *a, **b)))
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = QUERIES["op5_sharding"](spark, SF0001).collect()
    out = spark.read.parquet(written[0])
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, out.select(*docs.columns).collect())) == sorted(map(key, docs.collect()))
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in out.collect())
    # buckets follow the bytes of the texts, long ones too, and files follow each other in slot order
    rows = [(i % 5, "x" * (3000 if i % 50 == 0 else 300)) for i in range(400)]
    write(spark.createDataFrame(rows, "id long, text string").repartition(3), f"{tmp_dir}/out", "id", 4)
    files = spark.read.parquet(f"{tmp_dir}/out").select("*", F.input_file_name().alias("file")).collect()
    assert len(files) == 400 and {len(r.text) for r in files} == {300, 3000}
    assert len({r.file.split("/")[-1].split("-")[1] for r in files}) == -(-(400 * 24 + 392 * 300 + 8 * 3000) // 20_000)
    for shard in range(4):
        assert [r.slot for r in sorted((r for r in files if r.shard == shard), key=lambda r: (r.file, r.slot))] == list(range(100))


def test_decontamination_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 800, n)]
    items = [(i, " ".join(word(n))) for i, n in enumerate((2, 5, 6, 9, 14, 30, 70, 200))] + [(50, None), (51, ""), (52, " ".join(word(3))), (52, "A b C")]
    docs = []
    for k in range(60):
        w = word(int(rng.integers(0, 900)))
        if k % 2:
            item = (items[k % 8][1]).upper().split()
            cut = len(item) // (1 + k % 5) if k % 5 else len(item)
            at = int(rng.integers(len(w) + 1))
            w = w[:at] + item[:cut] + word(30) + item[cut:] + w[at:]
        docs.append((k, " ".join(w)))
    docs += [(100, None), (101, ""), (None, items[4][1]), (102, "a B c")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((k is None, k or 0, j, len(grams(t, 5) & grams(u, 5)), len(grams(u, 5))) for k, t in docs for j, u in items
                  if grams(u, 5) and 100 * len(grams(t, 5) & grams(u, 5)) >= 80 * len(grams(u, 5)))
    for size in (8 << 20, 300):  # one pass, several
        monkeypatch.setattr(decontaminate, "ITEM_BYTES", size)
        got = decontaminate.contaminated(d, i).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id, r.n_shared, r.n_item) for r in got) == want
    assert decontaminate.contaminated(d.limit(0), i).count() == 0
    assert decontaminate.contaminated(d, i.limit(0)).count() == 0


def test_pipeline_stages_keep_what_they_must(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.saved(stage(spark, docs, SF0001), spark)
        if name != "bpe":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        out[name] = (before.select("doc_id", "text").collect(), docs.collect())
    before, after = out["near_copies"]
    assert {r.doc_id for r in after} == {g for _, _, g in groups_by_force(before, 5, 80)}
    before, after = out["repeats"]
    want = {i: k.decode("utf-8", "ignore") for i, _, _, k in removed_by_force(sorted(before))}
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)
    before, after = out["decontamination"]
    items = [grams(r.text, 5) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    bad = {i for i, t in before for g in items if g and 100 * len(grams(t, 5) & g) >= 80 * len(g)}
    assert {r.doc_id for r in after} == {i for i, _ in before} - bad
    assert {r.doc_id for r in out["bpe"][1]} == {r.doc_id for r in after}


def test_pipeline_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x", None, "s", 1), (3, "a b " * 200, "en", "s", 800)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, DOCS)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, SF0001), spark)
        assert docs.count() == (4 if some else 0)


def test_near_copies_are_rows_not_ids(spark):
    word = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(1, word("a")), (5, word("a") + " x"), (5, word("b")), (5, word("c")), (5, word("c")), (6, word("c") + " y"), (7, " "), (7, " "), (7, None),
            (7, word("d")), (7, word("e")), (None, word("a")), (None, word("a"))]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, SF0001).collect()
    want = [(1, word("a")), (5, word("b")), (5, word("c")), (7, " "), (7, None), (7, word("d")), (7, word("e")), (None, word("a")), (None, word("a"))]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, want))


def test_queries_return_the_contracts_columns(spark):
    got = QUERIES["op2_suffix_dedup"](spark, SF0001)
    want = {i: (n, r, hashlib.sha256(k).hexdigest()) for i, n, r, k in
            removed_by_force(sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()))}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in got.collect()} == want
    shards = QUERIES["op5_sharding"](spark, SF0001).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert len(shards) == 16 and all(r.n == r.m + 1 for r in shards)
