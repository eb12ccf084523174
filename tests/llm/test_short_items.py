"""Short test items, many items and repeated rows in decontamination; counts of the toxicity features."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import decontaminate, toxicity


def _words(rng, n):
    return [f"w{rng.randrange(100_000)}" for _ in range(n)]


def test_items_of_one_to_four_shingles_are_all_found(spark):
    rng = random.Random(3)
    docs, items = [], []
    for i in range(1600):
        w = _words(rng, 300)
        n = 5 + i % 4
        at = rng.randrange(300 - n)
        docs.append((i, " ".join(w)))
        items.append((i, " ".join(w[at: at + n])))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = decontaminate.contaminated(d, spark.createDataFrame(items, "item_id long, text string"))
    rows = got.where("doc_id = item_id").collect()
    assert len(rows) == 1600 and all(r.n_shared == r.n_item == 1 + r.item_id % 4 for r in rows)
    assert got.count() == 1600


def test_repeated_items_hit_as_often_as_they_stand_and_blocks_agree(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(_words(rng, 40)) for _ in range(30)]
    items = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 50 + [(None, texts[4])]
    d = spark.createDataFrame([(i, "x " + t + " y z") for i, t in enumerate(texts)], "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contaminated(d, it).collect()), key=repr)
    assert len(one) == 30 + 50 + 1
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 2000)
    assert sorted(map(tuple, decontaminate.contaminated(d, it).collect()), key=repr) == one


def test_tables_of_fifty_thousand_items_are_made_quickly():
    rng = random.Random(5)
    texts = [" ".join(_words(rng, 12)) for _ in range(50_000)]
    began = time.perf_counter()
    decontaminate.Items(list(range(len(texts))), texts, 5, [1] * len(texts))
    assert time.perf_counter() - began < 15


def plain_risk(weights, bias, positive, unlabelled, prior):
    """The nnPU risk of a linear model, by definition."""
    def loss(docs, sign):
        return np.mean([np.log1p(np.exp(-sign * (sum(weights[i] for i in d) + bias))) for d in docs])
    clean = loss(unlabelled, -1) - prior * loss(positive, -1)
    return prior * loss(positive, 1) + max(0.0, clean)


def test_training_lowers_the_risk_it_is_defined_by():
    rng = np.random.default_rng(1)
    positive = [np.flatnonzero(rng.random(6) < [0.9, 0.8, 0.7, 0.1, 0.1, 0.1]) for _ in range(40)]
    unlabelled = [np.flatnonzero(rng.random(6) < 0.1) for _ in range(300)] + positive[:20]
    model = toxicity.Model(np.arange(6).astype(np.uint64))
    before = plain_risk(model.weights, model.bias, positive, unlabelled, 0.06)
    model.train(positive, unlabelled, 0.06)
    after = plain_risk(model.weights, model.bias, positive, unlabelled, 0.06)
    assert after < before
    # no small step along any one weight lowers the risk by more than the weight decay allows
    decay = min(1e-3, 0.3 / len(positive))
    clean = np.mean([np.log1p(np.exp(sum(model.weights[i] for i in d) + model.bias)) for d in unlabelled])
    clean -= 0.06 * np.mean([np.log1p(np.exp(sum(model.weights[i] for i in d) + model.bias)) for d in positive])
    if clean > 1e-3:
        for i in range(6):
            w = model.weights.copy()
            w[i] += 1e-5
            slope = (plain_risk(w, model.bias, positive, unlabelled, 0.06) - after) / 1e-5
            assert abs(slope + decay * model.weights[i]) < 5e-3


def test_repeated_ids_and_empty_tables(spark):
    docs = [(i, f"clean words number {i} and more of them {i % 13}") for i in range(300)]
    docs += [(1000 + i, f"you are a pathetic moron and idiot {i} of kind {i * 7}") for i in range(60)]
    docs += [(5, "clean words number 5 and more of them 5")] * 400
    labels = [(i, 0) for i in range(300)] + [(1000 + i, 1) for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(d, lab)
    scored = toxicity.score(d, model).withColumn("bad", F.col("doc_id") >= 1000)
    assert scored.count() == len(docs)
    got = {r.bad: (r.lo, r.hi) for r in scored.groupBy("bad").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).collect()}
    assert got[True][0] > 0.7 > got[False][1]
    none = toxicity.fit(d.limit(0), lab)
    assert toxicity.score(d.limit(0), none).count() == 0 and not len(none.features)


def test_windows_are_made_of_documents_that_share_a_shingle_and_lose_no_candidate():
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, n)) for n in (6, 9, 20, 40, 70)]
    items = decontaminate.Items(list(range(5)), texts, 5, [1] * 5)
    docs = [" ".join([*rng.choice(words, 50), t, *rng.choice(words, 30)]) for t in texts]
    docs += [" ".join(texts[4].split()[:5]), ""] + [" ".join(rng.choice(words, 200)) for _ in range(60)]
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    doc, h = decontaminate.shingles(data, off, 5)
    kept, same = items.near(doc, h)
    assert set(kept.tolist()) == set(range(6))  # of the others none has a run of five words in common
    assert np.array_equal(h[doc < 6], same) and np.array_equal(doc[doc < 6], kept)
    found = items.candidates(doc, h)
    assert {(i, i) for i in range(5)} <= found
    items.near = lambda doc, h: (doc, h)  # every document's windows
    assert items.candidates(doc, h) == found


def test_rows_that_no_join_wants_are_told_by_a_bitmap(spark):
    from lakemart.llm.jaccard_join import marked_rows
    rows = spark.range(40_000).selectExpr("if(id % 1000 = 1, null, id * 7 - 90000) doc_id", "id other")
    ids = spark.range(0, 40_000, 40).selectExpr("id * 7 - 90000 member")
    wanted = {r.member for r in ids.collect()}
    got = marked_rows(rows, "doc_id", ids)
    assert got.columns == rows.columns
    found = [r.doc_id for r in got.collect() if r.doc_id is not None]
    assert wanted <= set(found) and len(found) == len({*found}) and len(found) < 1000 + 40_000 / 8
    assert "hashpartitioning(doc_id" not in got._jdf.queryExecution().executedPlan().toString()
    full = marked_rows(rows, "doc_id", ids, bits=15)  # more ids than it is made for: more rows stay
    assert wanted <= {r.doc_id for r in full.collect()}
    assert marked_rows(rows, "doc_id", ids.limit(0)).count() == 0
