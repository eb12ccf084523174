"""URL filter, phrase mining and Merkle manifest against plain versions."""

import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from lakemart.llm import merkle, phrases, queries, url_filter
from lakemart.llm.url_filter import Rule

# ----- URLs --------------------------------------------------------------------

RULES = queries.URL_RULES


def plain_verdict(url, rules, strict, soft, soft_hits):
    host, path = "", ""
    if url is not None and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        r = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)))
        return host, path, r.host + r.path, r.verdict
    words = re.sub("[A-Z]", lambda c: c[0].lower(), host + path)

    def count(terms):
        return sum(re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", words) is not None for t in terms)

    bad = count(strict) or count(set(soft) - set(strict)) >= soft_hits
    return host, path, None, "block" if bad else "allow"


URLS = [None, "", "no scheme/casino", "http://", "https://Casino.example.org/x", "https://mycasino.example.org/", "http://a.org/free/BETS?x=1", "http://a.org/free/free",
        "http://a.org/freebets", "http://a.org/free-\u00e9bets/bets\u00e9", "http://WWW.Example.com/en/1", "http://b.example.com/en/1", "http://b.example.com/en", "http://example.com",
        "http://x.net/es/a", "http://x.net/de/casino", "http://net/fr/", "http://xcom/", "http://.com/", "http://u@h.org:80/a?http://casino.com", "http://a.org#casino",
        "ftp://q://casino/", "http://a.org/" + "z" * 300_000 + "/casino", "http://a.org/casinocasino/xxx1", "http://a.org/xxx"] * 2


def test_urls_equal_a_plain_version(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[4], None, None)], "page_id long, url string, host string, __url string")
    got = url_filter.judge(pages, RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "terms", "verdict"]
    rows = {r.page_id: r for r in got.collect()}
    assert len(rows) == len(URLS) + 1 and rows[None].verdict == "block"
    for i, u in enumerate(URLS):
        r = rows[i]
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(u, RULES, url_filter.STRICT, url_filter.SOFT, 2), u and u[:60]


def test_longest_rule_wins_and_ties_go_to_the_longer_host(spark):
    rules = [Rule("allow", "b.org", "/aaaa"), Rule("block", "a.b.org", "/aa"), Rule("block", "b.org", "/aaaab")]
    pages = spark.createDataFrame([(1, "http://a.b.org/aaaa"), (2, "http://a.b.org/aaaab"), (3, "http://b.org/aaaa"), (4, "http://b.org/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {1: ("a.b.org/aa", "block"), 2: ("b.org/aaaab", "block"), 3: ("b.org/aaaa", "allow"), 4: (None, "allow")}


def test_urls_of_an_empty_table_and_an_empty_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://casino.org/")], "page_id long, url string")
    assert url_filter.judge(pages.limit(0), RULES).count() == 0
    assert [r.verdict for r in url_filter.judge(pages, strict=(), soft=()).collect()] == ["allow"]


# ----- phrases -----------------------------------------------------------------

def plain_phrases(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            totals[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i: i + k])] += 1
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}

        def inside(p, q):
            return any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))

        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and inside(p, q) and 100 * b >= 80 * a for q, b in found.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def _texts():
    import random
    rng = random.Random(7)
    words = ["a", "b", "the", "of", "\u00c9t\u00e9", "x\u000bnew", "q-1", "A", "hot"]
    rows = [("the quick fox jumps. over\tthe quick  fox", "en")] * 9
    rows += [(" ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\n"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und", ""])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" \t .;", "fr"), ("hot " * 4000, "en"), ("w" * 50_000 + " a", "en")]
    return rows


def _as_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("cells", [1 << 21, 1 << 6])
def test_phrases_equal_a_plain_version(spark, cells):
    rows = _texts()
    docs = spark.createDataFrame([(t, g, 1, 2) for t, g in rows], "text string, lang string, p int, f int").repartition(5)
    got = _as_rows(phrases.collocations(docs, least=5, top=25, cells=cells))
    assert got == plain_phrases(rows, 5, 25)


def test_long_prefixes_are_extended(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HEAVY", 3)
    monkeypatch.setattr(phrases, "GROUP", 16)
    rows = _texts()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert _as_rows(phrases.collocations(docs, least=5, top=40, cells=1 << 12)) == plain_phrases(rows, 5, 40)


def test_phrases_of_no_texts(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


def test_suffixes_are_grouped_once_each_and_rare_words_are_not_stored(spark, monkeypatch):
    import random
    rng = random.Random(12)
    common = [" ".join(rng.choices(["red", "green", "blue", "grey"], k=rng.randint(2, 9))) for _ in range(80)]
    rows = [(f"{t} rare{i}x{rng.random()}", "en") for i, t in enumerate(common)]
    monkeypatch.setattr(phrases, "HELD", 16)
    monkeypatch.setattr(phrases, "KEPT", 24)
    stored, grouped, saved, plain = [], [], phrases.saved, phrases._grouped
    monkeypatch.setattr(phrases, "saved", lambda df, spark: stored.append(saved(df, spark)) or stored[-1])
    monkeypatch.setattr(phrases, "_grouped", lambda rows, spark: grouped.append(rows) or plain(rows, spark))
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = _as_rows(phrases.collocations(docs, least=5, top=25))
    assert got == plain_phrases(rows, 5, 25)
    assert grouped[0].count() == grouped[0].select("h1", "h2", "h3", "h4").distinct().count() > 0
    kept = {r.word for df in stored if "word" in df.columns for r in df.where("word IS NOT NULL").select("word").collect()}
    assert kept == {"red", "green", "blue", "grey"}


def test_small_partitions_do_not_pass_on_the_same_words_each(spark, monkeypatch):
    rows = [("red green blue. grey red", "en")] * 640
    stored, saved = [], phrases.saved
    monkeypatch.setattr(phrases, "saved", lambda df, spark: stored.append(saved(df, spark)) or stored[-1])
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(64)
    assert _as_rows(phrases.collocations(docs)) == plain_phrases(rows, 30, 2000)
    passed_on = next(df for df in stored if {"h1", "word", "c"} <= set(df.columns))
    tasks = 2 * spark.sparkContext.defaultParallelism
    # four words, and the suffixes red green blue, green blue, grey red; 64 times before
    assert passed_on.count() <= 7 * tasks < 7 * 64


# ----- manifest ----------------------------------------------------------------

def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])

    def tree(nodes):
        """The root and each leaf's steps (siblings before, after)."""
        level, below, ways = list(nodes), [[i] for i in range(len(nodes))], [[] for _ in nodes]
        while len(level) > 1:
            nxt, under = [], []
            for i in range(0, len(level), 3):
                run = level[i: i + 3]
                for j in range(len(run)):
                    for x in below[i + j]:
                        ways[x].append((run[:j], run[j + 1:]))
                nxt.append(h(*run))
                under.append([x for b in below[i: i + 3] for x in b])
            level, below = nxt, under
        return level[0], ways

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([leaf(r) for r in sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in names}
    root, tops = tree([subs[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        ordered = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for r, way in zip(ordered, subs[s][1], strict=True):
            way = way + top
            seen = r
            if r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                seen = (*r[:4], r[4].replace("\n", ""))
            now = leaf(seen)
            for before, after in way:
                now = h(*before, now, *after)
            out.append((r[0], leaf(r), subs[s][0], root, h(*[x for b, a in way for x in (*b, *a)]), now, now == root))
    return sorted(out, key=repr)


def _tampered():
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(marked, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def _manifest(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "g", 1, b"h") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, g string, pos int, h binary").repartition(6)
    return sorted((tuple(r) for r in merkle.manifest(docs, checked=_tampered(), **options).collect()), key=repr)


def _docs(n_hot):
    rows = [(i, "hot", "en", i % 5, f"text {i}\nline" if i % 4 else None) for i in range(n_hot)]
    rows += [(1000 + i, f"s{i}", None, None, "one\n") for i in range(11)]
    rows += [(i, None, "fr", 3, "") for i in range(2000, 2004)] + [(None, "", "fr", 3, "x\ny"), (None, "", "fr", 3, "x\ny"), (None, None, None, None, None)]
    return rows + [(5, "hot", "en", 0, "other\ntext"), (6, "hot", "en", 0, "same"), (6, "hot", "en", 0, "same"), (7, "\u00e9", "en", 0, "long\n" * 40_000), (8, "z", "en", 1, "a")]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_a_plain_version(spark, levels):
    rows = _docs(95)
    assert _manifest(spark, rows, levels=levels) == plain_manifest(rows)


def test_manifest_of_one_row_and_of_none(spark):
    rows = [(2, "a", None, None, "x\n")]
    assert _manifest(spark, rows) == plain_manifest(rows)
    assert _manifest(spark, [(2, "a", None, None, "x\n")][:0]) == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81])
def test_witnesses_of_a_growing_tree(n):
    leaves = [sha256(bytes([i])).digest() for i in range(n)]
    height = merkle.levels_of(n)
    tree = merkle.Tree(height)
    for x in leaves:
        tree.append(x)
    tree.close()
    assert all(merkle.fold(x, bytes(w)) == tree.root for x, w in zip(leaves, tree.witness, strict=True))
    assert n == 1 or merkle.fold(leaves[0], bytes(tree.witness[-1])) != tree.root
