"""Token counts: lengths of texts under a public tokenizer, without the ids.

Texts are cut at boundaries where the tokenizer's own pre-tokenizer always
cuts: a single space between two characters that are not white space begins a
new pre-token, whatever stands around it.  Distinct pieces are encoded once, in
batches balanced by bytes, and only their lengths are kept.  Texts with runs of
white space are cut only at such safe spaces; the piece between two of them may
hold any white space.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.memory import Memory, light

#: Bytes of pieces given to the tokenizer at once, and of texts cut at once.
BATCH_BYTES = 1 << 18
#: Distinct pieces whose lengths a worker keeps in each of two generations.
MEMORY = 500_000
_SAFE = re.compile(r"(?<=\w) (?=\w)")


def pieces_of(text: str) -> list[str]:
    """Pieces whose token counts add up to the text's.  All but the first lost
    the space they began with, which the caller puts back, unless they begin
    with a line feed: one that stands alone is a pre-token of its own."""
    return text.replace("\n", " \n").split(" ")


def irregular(piece: str) -> bool:
    """White space at an end of a piece: the text has a run of white space there."""
    return not piece or piece[-1].isspace() or (piece[0] != "\n" and piece[0].isspace()) or piece[1:2].isspace()


def balanced(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of texts of about ``limit`` bytes; longest texts first, so that the
    texts of a run have like lengths."""
    texts = sorted(texts, key=len, reverse=True)
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


class Counter:
    """Counts tokens with a tokenizer file of either library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda run: [len(x) for x in model.encode(run, num_threads=1)]
            self.cut = False  # its pieces may cross spaces
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.encode = lambda run: [len(x) for x in t.encode_batch_fast(run, add_special_tokens=False)]
            self.ids = lambda text: np.array(t.encode(text, add_special_tokens=False).ids)
            line = t.encode("\n", add_special_tokens=False).ids
            self.line = line[0] if line else -1
            # its pieces never cross spaces, and a line feed is one token
            self.cut = "ByteLevel" in type(t.pre_tokenizer).__name__ and len(line) == 1
        self.memory = Memory(MEMORY)

    def lengths(self, texts: list[str]) -> list[int]:
        if not self.cut:
            at = sorted(range(len(texts)), key=lambda i: len(texts[i]), reverse=True)
            got = [n for run in balanced(texts) for n in self.encode(run)]
            out = [0] * len(texts)
            for i, n in zip(at, got, strict=True):
                out[i] = n
            return out
        cut = [pieces_of(t) for t in texts]
        need = set()
        for pieces in cut:
            need.update(pieces[1:])
        self.learn(self.memory.missing(need))
        get = self.memory.new.__getitem__
        heads = []
        for k in range(0, len(cut), 256):
            heads += self.encode([pieces[0] for pieces in cut[k: k + 256]])
        out = []
        for text, pieces, n in zip(texts, cut, heads, strict=True):
            try:
                if pieces[0][-1:].isspace():
                    raise TypeError
                out.append(n + sum(map(get, pieces[1:])))
            except TypeError:  # an irregular piece has no count of its own
                safe = _SAFE.split(text)
                out.append(sum(self.encode([safe[0], *[" " + p for p in safe[1:]]])))
        return out

    def learn(self, need: list[str]) -> None:
        """Counts of pieces.  Those that cannot meet a separator are encoded
        together, a line feed before each; its token shows where they end."""
        known, plain, other = self.memory.new, [], []
        for p in need:
            if irregular(p):
                known[p] = None
            elif "\n" in p or "<|" in p:
                other.append(p)
            else:
                plain.append(p)
        for run in balanced(plain):
            ids = self.ids("".join(["\n " + p for p in run]))
            ends = np.append(np.flatnonzero(ids == self.line), len(ids))
            known.update(zip(run, (np.diff(ends) - 1).tolist(), strict=True))
        for run in balanced(other):
            known.update(zip(run, self.encode([p if p[0] == "\n" else " " + p for p in run]), strict=True))


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per input row: the id, n_bytes (UTF-8), n_tokens and over_limit
    (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens; null ids and repeated rows
    stay as they are; other columns are not read.  Special strings inside texts
    are handled as the library does by default; none are added, and nothing is
    truncated or padded.
    """
    def run(batches):
        counter = _counter(path)
        try:
            yield from counted_batches(counter, batches)
        finally:
            counter.memory.clear()

    def counted_batches(counter, batches):
        for b in batches:
            ids, texts = b.column(0), b.column(2)
            out, group, size = [], [], 0
            for t in texts.to_pylist():
                group.append(t or "")
                size += len(group[-1])
                if size >= 4 * BATCH_BYTES:
                    out += counter.lengths(group)
                    group, size = [], 0
            if group:
                out += counter.lengths(group)
            yield pa.record_batch([ids, b.column(1), pa.array(out, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("id"),
                      F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
                      F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    counted = src.mapInArrow(light(run), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
