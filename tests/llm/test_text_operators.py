"""Token counts, BPE, HTML extraction, chat formatting and toxicity against
brute-force versions and libraries, with nulls, empty tables and odd rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import bpe, chat, html_extract, token_counts, toxicity
from lakemart.llm.queries import HOSTILE, QUERIES, tokenizer_path
from tests.conftest import SF0001

tokenizers = pytest.importorskip("tokenizers")

ODD = [None, "", " ", "  two  spaces \n and\n\nlines\t", "don't we'll 'S 12345", "<|endoftext|> a<|endoftext|>b", "\x1c a\x1db\x85c",
       "Σς ΑΣ İ ǅ ﬁ", "漢字かな交じり 한국어", "Ᲊ \U00010940x ֏", "x" * 3000, "a b " * 4000, "don’t \U0001F600", " \n<|startoftext|> x"]


def odd_docs(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(ODD)] + [(3, ODD[3], 1, "x"), (None, "null id", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")


def test_token_counts_equal_the_library(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    for docs in (odd_docs(spark), spark.read.parquet(f"{SF0001}/documents.parquet")):
        key = lambda x: (x[0] is None, x[0] or 0, x[1:])
        want = sorted(((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
                       for r in docs.collect()), key=key)
        got = token_counts.count_tokens(docs, path).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_counts.count_tokens(odd_docs(spark).limit(0), path).count() == 0


def test_sentencepiece_counts(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(odd_docs(spark).where("doc_id <> 3"), path).collect()}
    assert got == {i: len(model.encode(t or "")) for i, t in enumerate(ODD) if i != 3}


def test_bpe_equals_the_library_and_decodes(spark):
    path = tokenizer_path("word_bpe_49k.json")
    library, own = tokenizers.Tokenizer.from_file(path), bpe.load(path)
    for docs in (odd_docs(spark), spark.read.parquet(f"{SF0001}/documents.parquet")):
        texts = {r.doc_id: r.text for r in docs.collect()}
        got = bpe.encode_decode(docs, path).collect()
        assert len(got) == docs.count()
        for r in got:
            ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
            assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
            assert r.decoded == library.decode(ids, skip_special_tokens=False) == own.decode(ids)
    assert bpe.encode_decode(odd_docs(spark).limit(0), path).count() == 0


def test_segment_tree_merges_leftmost_lowest_first():
    own = bpe.load(tokenizer_path("word_bpe_49k.json"))
    rank = {int(k): int(r) for k, r in zip(own.keys[:-1], own.ranks[:-1], strict=True)}
    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"aenrstoi'"), size=n).tolist()) for n in (1, 2, 3, 5, 8, 13, 33, 64, 100) for _ in range(20)]
    for word, (ids, _) in zip(words, own.words(words), strict=True):
        s = [int(own.inner[b]) for b in word[:-1]] + [int(own.final[word[-1]])]
        while True:
            ranked = [(rank.get(a * own.width + b, 1 << 60), i) for i, (a, b) in enumerate(zip(s, s[1:]))]
            best = min(ranked, default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            s[best[1]: best[1] + 2] = [int(own.made[best[0]])]
        assert np.frombuffer(ids, "<u4").tolist() == s


PAGE = """<html><body><header><h1>Site</h1></header><div id="cookie-banner"><p>We use cookies on this site, please accept them all.</p></div>
<div class="layout"><div class="sidebar"><ul><li><a href=1>x y z</a></li></ul></div><article class="post"><h1>T &amp; x</h1>
<p>Hello   world <a href=x>link</a><br>more<p>Second &#8212; one.<div class="ad">Buy now</div><ul><li>one<li>two</ul></article>
<section id="comments"><h2>Replies</h2><div class="comment"><p>I think this is a great article, thank you for it.</p></div></section></div>
<form><label>Name</label><input></form><footer>c</footer><script>var x="<p>no</p>"</script></body></html>"""


def test_html_extraction(spark):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, None, "", "x"), (4, "u", "plain text", "x"), (None, "u", "<p>broken <b", "x"), (1, "u", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in html_extract.extract_text(pages).collect()}
    assert got[1, "u"] == "T & x\nHello world link more\nSecond — one.\none\ntwo"
    assert got[2, "u"] == got[3, None] == "" and got[4, "u"] == "plain text"
    assert html_extract.extract_text(pages).count() == 6
    assert html_extract.extract_text(pages.limit(0)).count() == 0


def test_html_marginals_equal_enumeration():
    forest = html_extract.Forest([html_extract.Dom("<div class=nav><p>a</p><p>b <a>c</a></p></div><article>x</article>")])
    rng = np.random.default_rng(1)
    unary, edge = rng.normal(size=len(html_extract.FEATURES)), rng.normal(size=(2, 2, 2))
    score = np.bincount(forest.owner, unary[forest.feature], forest.n)
    total, ones = 0.0, np.zeros(forest.n)
    for bits in range(1 << forest.n):
        y = [(bits >> i) & 1 for i in range(forest.n)]
        w = np.exp(sum(score[i] * y[i] for i in range(forest.n))
                   + sum(edge[forest.kind[i], y[forest.parent[i]], y[i]] for i in range(forest.n) if forest.parent[i] >= 0))
        total, ones = total + w, ones + w * np.array(y)
    assert np.allclose(forest.marginals(unary, edge)[0][:, 1], ones / total)


def test_chat_fold_and_round_trip(spark):
    events = [(1, "a", 1, "message", "user", "hi"), (1, "b", 2, "delta", "assistant", "He"), (1, "b", 3, "delta", None, "llo"),
              (1, "b", 4, "regenerate", None, None), (1, "b", 6, "delta", None, "ew \\# <x>"), (1, "b", 5, "delta", None, "N"),
              (1, "c", 7, "message", "user", "gone"), (1, "c", 8, "delete", None, None), (1, "a", 9, "edit", None, "hi </turn>\n### x: "),
              (2, "z", 1, "message", None, None), (None, "n", 1, "delta", "assistant", "x")]
    log = spark.createDataFrame(events, "conv_id long, message string, seq long, kind string, role string, text string")
    segments = chat.format_conversations(log).collect()
    text = "".join(r.formatted for r in sorted((r for r in segments if r.conv_id == 1), key=lambda r: r.turn))
    assert chat.read_back(text) == [("user", "hi </turn>\n### x: "), ("assistant", "New \\# <x>")]
    mine = next(r for r in segments if r.conv_id == 1 and r.role == "assistant")
    assert chat.unescape(text[mine.loss_start: mine.loss_end]) == "New \\# <x>"
    assert {r.conv_id for r in segments} == {1, 2, None}
    assert chat.format_conversations(log.limit(0)).count() == 0


def test_chat_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF0001}/conversations.parquet").collect()
    want = {}
    for r in sorted(rows, key=lambda r: r.turn):
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want[-7] = [("user", HOSTILE), ("assistant", HOSTILE)]
    got = QUERIES["op1_chat_formatting"](spark, SF0001).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.segment(a, b)[0]) for a, b in turns)


def test_repeated_turns_stay(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(chat.turn_events(turns))).first()["n_turns"] == 3


def test_toxicity_on_held_out_documents(spark):
    rng = np.random.default_rng(5)
    common = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1500):
        bad = i % 10 == 0
        text = list(rng.choice(common, size=60)) + ([f"vile{'xyz'[i % 3]}", "rotten"] if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), 0.5))
        labels.append((i, int(bad)))
    rows += [(None, None, 0.5), (2000, "", 0.5), (2000, "", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    got = toxicity.score(docs, model).join(marks.where("toxic is not null"), "doc_id").where(toxicity.fold_of(F.col("doc_id")) == 1).collect()
    assert all((r.score >= 0.7) == (r.toxic == 1) for r in got) and len(got) > 400
    assert toxicity.score(docs, model).count() == 1503
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.fit(docs, marks.limit(0))
    assert toxicity.score(docs, none).where("score > 0.1").count() == 0


def test_toxicity_keeps_all_words_of_few_examples(spark):
    rng = np.random.default_rng(7)
    common, bad = [f"w{i}" for i in range(300)], [f"{c}ile" for c in "abcdefghijklmnopqrstuvwx"]
    ids = [r.id for r in spark.range(1000).where(toxicity.fold_of(F.col("id")) != 1).collect()]
    rows = [(i, " ".join([*rng.choice(common, 60), *([bad[(k + j) % 24] for j in range(8)] if k < 32 else [])])) for k, i in enumerate(ids)]
    labels = [(i, int(k < 32)) for k, i in enumerate(ids)]
    # copies of one example, exact and with another last word: their rare words are no features
    copied = " ".join(f"only{j}" for j in range(40))
    rows += [(5000 + k, f"{copied} last{k // 4}") for k in range(12)]
    labels += [(5000 + k, 1) for k in range(12)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))

    def present(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return len(model.present(data, np.array([0, len(data)]))[1])

    assert all(present(w) for w in bad) and not any(present(f"only{j}") for j in range(40))
