"""Very long and hostile single inputs of HTML extraction and BPE: results as of
short ones, within a time that a quadratic scan would miss by far."""

import random
import time
import tracemalloc

import numpy as np
import pytest

from lakemart.llm import bpe, html_extract
from lakemart.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
MEGABYTE = {"unclosed": "<a " * 350_000, "unclosed quote": "<a " * 350_000 + '">', "quotes": "<a '" * 250_000, "mixed": "<a \"'" * 200_000 + ">",
            "names": "<a" * 500_000 + ' ">', "declarations": "<!" * 500_000, "sections": "<![CDATA[>" * 100_000, "raw": "<script>" + "</script " * 120_000,
            "bounded": "<p><button>" + "<div>" * 100_000, "angles": "<" * 1_000_000}


@pytest.mark.parametrize("name", MEGABYTE)
def test_hostile_pages_are_read_in_linear_time(name):
    start = time.perf_counter()
    html_extract.Dom(MEGABYTE[name])
    assert time.perf_counter() - start < 10


def test_deep_pages_keep_their_article():
    deep = "<div>" * 20_000 + "<article><p>" + "A sentence that is long enough to be the text. " * 5 + "</p></article>" + "</div>" * 20_000
    start = time.perf_counter()
    got = html_extract.extract([deep, "<article><p>Plain text of a page, and more of it so that it counts.</p></article>"])
    assert time.perf_counter() - start < 20
    assert got[1] == "Plain text of a page, and more of it so that it counts."
    assert len(html_extract.Dom(deep).parent) == 20_003


def test_broken_markup_has_a_defined_reading():
    def texts(page):
        return [t for _, t in html_extract.Dom(page).pieces]

    assert texts("a <b") == ["a <b"]
    assert texts("a <b x='>' y>c</b>d") == ["a ", "c", "d"]
    assert texts("a <b x='> c") == ["a <b x='> c"]
    assert texts("a<!-- b <p> c") == ["a"]
    assert texts("a<!-- <p> -->b<![CDATA[<c>]]>d") == ["a", "b", "<c>", "d"]
    assert texts("a<![CDATA[<c> d") == ["a", " d"]
    assert texts("a<script>if (x < 'b') </scripts> </script >c") == ["a", "c"]
    assert texts("<title>x <![CDATA[ </title><p>y</p> ]]>") == ["y", " ]]>"]
    assert texts("1 < 2 <3 > 4") == ["1 < 2 <3 > 4"]


def test_siblings_end_as_in_a_page():
    dom = html_extract.Dom("<table><tr><td>a<p>b<td>c<tr><td>d</table><ul><li>e<ul><li>f</ul><li>g</ul>")
    assert dom.tag == ["html", "table", "tr", "td", "p", "td", "tr", "td", "ul", "li", "ul", "li", "li"]
    assert dom.parent == [-1, 0, 1, 2, 3, 2, 1, 6, 0, 8, 9, 10, 8]


def test_long_words_equal_the_library():
    path = tokenizer_path("word_bpe_49k.json")
    library, ours = tokenizers.Tokenizer.from_file(path), bpe.Bpe(path)
    library.no_truncation()
    rng = random.Random(5)
    words = ["x" * 200_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "漢字" * 20_000, "ab" * 3]
    start = time.perf_counter()
    ids, decoded = ours.encode(words)
    assert time.perf_counter() - start < 30
    for i, word in enumerate(words):
        want = library.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(ids[i], "<u4").tolist() == want
        assert decoded[i] == library.decode(want, skip_special_tokens=False)


def test_one_by_one_and_as_rows_merge_alike(monkeypatch):
    path = tokenizer_path("word_bpe_49k.json")
    rng = random.Random(6)
    words = ["".join(rng.choices("aabeinorst", k=rng.randint(1, 70))).encode() for _ in range(300)]
    rows = bpe.Bpe(path).words(words)
    monkeypatch.setattr(bpe, "FEW", len(words) + 1)
    assert bpe.Bpe(path).words(words) == rows


def test_bpe_memories_hold_ids_and_nothing_else():
    own, n = bpe.Bpe(tokenizer_path("word_bpe_49k.json")), 20_000
    text = " ".join(f"{i * 7919:x}q" for i in range(n))
    tracemalloc.start()
    ids, decoded = own.encode([text])
    assert decoded == [own.decode(np.frombuffer(ids[0], "<u4").tolist())]
    held = tracemalloc.get_traced_memory()[0]
    assert len(own.memory.new) == n
    own.memory.clear()
    own.word_memory.clear()
    each = (held - tracemalloc.get_traced_memory()[0]) / n
    tracemalloc.stop()
    assert each < 200  # 278 bytes a word with the decoded texts, 138 without
