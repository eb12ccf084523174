"""BPE encoding and decoding over a segment tree of adjacent pair ranks.

Each word is an array of symbols.  A segment tree stands over the ranks of its
adjacent pairs; a leaf holds rank * width + position, so the root is the
leftmost pair of the lowest rank.  That pair is merged, the pairs that changed
are updated in logarithmic time, and so on until the root is empty.  The trees
of all words of like length are kept as the rows of one array and advance
together.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.memory import Memory, light

#: Distinct white-space-free pieces whose encoding a worker keeps in each of two generations.
MEMORY = 1 << 17
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 1 << 18
#: Fewer words of a width than this are merged one by one, not as the rows of an array.
FEW = 16
_EMPTY = np.int64(1) << 62
#: Characters whose properties are the same in all Unicode versions of the libraries used here.
_SETTLED = regex.compile("[^\x00-ԯ‐-⁞₠-₿←-⏿─-➿ぁ-ゖ"
                         "ァ-ヺ一-龥가-힣！-～]")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes as they are, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return table


class Bpe:
    """A word BPE of a tokenizer file with word ends and a splitting pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        if model["continuing_subword_prefix"] or model["byte_fallback"] or model["unk_token"]:
            raise ValueError(f"unsupported options in {path}")
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = (regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
                                         + ")") if self.special else None)
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        table = byte_symbols()
        self.bytes_of = {c: b for b, c in enumerate(table)}
        self.inner = np.array([vocab[c] for c in table], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in table], dtype=np.int64)
        self.width = max(self.strings) + 1
        left, right, made = [], [], []
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        keys = np.array(left, np.int64) * self.width + np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], _EMPTY), np.append(order, 0)
        self.made = np.array(made, np.int64)
        self._pairs: dict[int, int] | None = None
        self.memory, self.word_memory = Memory(MEMORY), Memory(MEMORY)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = a * self.width + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, sym: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Merge the words in the rows of ``sym`` (a power of two wide, ``size``
        symbols each); returns the symbols left in place, -1 elsewhere."""
        n, w = sym.shape
        here = np.arange(w)
        has = here[None, :-1] + 1 < size[:, None]
        tree = np.full((n, 2 * w), _EMPTY)
        r = np.full((n, w - 1), -1, np.int64)
        r[has] = self.rank(sym[:, :-1][has], sym[:, 1:][has])
        tree[:, w:-1] = np.where(r >= 0, r * w + here[:-1], _EMPTY)
        level = w
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        after = np.broadcast_to(here + 1, (n, w)).copy()
        before = np.broadcast_to(here - 1, (n, w)).copy()
        live = np.flatnonzero(tree[:, 1] < _EMPTY)
        while len(live):
            rank, p = np.divmod(tree[live, 1], w)
            q = after[live, p]
            nxt = after[live, q]
            sym[live, p] = self.made[rank]
            sym[live, q] = -1
            after[live, p] = nxt
            inside = nxt < size[live]
            before[live[inside], nxt[inside]] = p[inside]
            self._set(tree, live, q, np.full(len(live), _EMPTY), w)
            new = np.full(len(live), -1, np.int64)
            new[inside] = self.rank(sym[live[inside], p[inside]], sym[live[inside], nxt[inside]])
            self._set(tree, live, p, np.where(new >= 0, new * w + p, _EMPTY), w)
            o = before[live, p]
            prior = np.flatnonzero(o >= 0)
            if len(prior):
                rows, o = live[prior], o[prior]
                new = self.rank(sym[rows, o], sym[rows, p[prior]])
                self._set(tree, rows, o, np.where(new >= 0, new * w + o, _EMPTY), w)
            live = live[tree[live, 1] < _EMPTY]
        return sym

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, place: np.ndarray, value: np.ndarray, w: int) -> None:
        """Point update of one leaf in each row, and of the nodes above it."""
        node = place + w
        tree[rows, node] = value
        while w > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            w >>= 1

    def merge_one(self, sym: list[int], w: int) -> list[int]:
        """Merge one word, a list of symbols, over a tree of ``w`` leaves (a power
        of two); returns the symbols left.  An update of a leaf stops at the first
        node that it leaves as it was."""
        if self._pairs is None:
            self._pairs = dict(zip(self.keys[:-1].tolist(), self.ranks[:-1].tolist(), strict=True))
        pairs, width, none, n = self._pairs, self.width, int(_EMPTY), len(sym)

        def leaf(a: int, b: int, at: int) -> int:
            rank = pairs.get(a * width + b)
            return none if rank is None else rank * w + at

        tree = [none] * w + [leaf(a, b, i) for i, (a, b) in enumerate(zip(sym, sym[1:], strict=False))]
        tree += [none] * (2 * w - len(tree))
        for node in range(w - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = at + w
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                low = value if value < other else other
                if tree[node] == low:
                    return
                tree[node] = value = low

        made = self.made.tolist() if n > 4096 else self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] < none:
            rank, p = divmod(tree[1], w)
            q = after[p]
            nxt = after[q]
            sym[p] = int(made[rank])
            sym[q] = -1
            after[p] = nxt
            put(q, none)
            if nxt < n:
                before[nxt] = p
                put(p, leaf(sym[p], sym[nxt], p))
            else:
                put(p, none)
            if before[p] >= 0:
                put(before[p], leaf(sym[before[p]], sym[p], before[p]))
        return [x for x in sym if x >= 0]

    def words(self, words: list[bytes]) -> list[tuple[bytes, str]]:
        """Ids and decoded text of each word, given as its UTF-8 bytes (not empty)."""
        return [(ids, self.decode(np.frombuffer(ids, "<u4").tolist())) for ids in self.word_ids(words)]

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, given as its UTF-8 bytes (not empty)."""
        out: list = [None] * len(words)
        size = np.array([len(x) for x in words], dtype=np.int64)
        width = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
        for w in np.unique(width):
            rows_at = np.flatnonzero(width == w)
            if len(rows_at) < FEW:
                for i in rows_at.tolist():
                    sym = self.inner[np.frombuffer(words[i], np.uint8)].tolist()
                    sym[-1] = int(self.final[words[i][-1]])
                    out[i] = np.array(self.merge_one(sym, int(w)), "<u4").tobytes()
                continue
            step = max(1, (1 << 19) // int(w))
            for k in range(0, len(rows_at), step):
                at = rows_at[k: k + step]
                n = size[at]
                flat = np.frombuffer(b"".join([words[i] for i in at]), np.uint8)
                sym = np.full((len(at), int(w)), -1, np.int64)
                sym[np.arange(int(w))[None, :] < n[:, None]] = self.inner[flat]
                sym[np.arange(len(at)), n - 1] = self.final[flat[np.cumsum(n) - 1]]
                got = self.merge(sym, n)
                left = got >= 0
                raw = got[left].astype("<u4").tobytes()
                start = 0
                for i, end in zip(at.tolist(), np.cumsum(left.sum(1)).tolist(), strict=True):
                    out[i] = raw[4 * start: 4 * end]
                    start = end
        return out

    def learn(self, pieces: list[str], split) -> None:
        """Encode pieces; ``split`` gives a piece's words."""
        parts = [split(p) for p in pieces]
        need = {w for ws in parts for w in ws}
        missing = self.word_memory.missing(need)
        word = self.word_memory.new
        if missing:
            word.update(zip(missing, self.word_ids(missing), strict=True))
        known = self.memory.new
        for p, ws in zip(pieces, parts, strict=True):
            known[p] = word[ws[0]] if len(ws) == 1 else b"".join([word[x] for x in ws])

    def split_piece(self, piece: str) -> list[bytes]:
        return [x.encode() for x in self.pattern.findall(piece)]

    def split_odd(self, text: str) -> list[bytes]:
        """Words of a text with characters of newer Unicode versions, by the
        library's own normalizer and splitter."""
        of = self.bytes_of
        return [bytes(of[c] for c in w) for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def pieces(self, text: str) -> tuple[list[str], bool]:
        """Normalised pieces without white space, or the text itself as one odd piece."""
        if not text.isascii():
            if _SETTLED.search(text):
                return [text], True
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if _ODD_SPACE.search(text):
            return [x for x in _SPACES.split(text) if x], False
        return text.split(), False

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids (little-endian 32-bit) and decoded text of each text."""
        plans, need, odd = [], set(), {}
        for t in texts:
            parts = self.at_special.split(t) if self.at_special and "<|" in t else [t]
            plan = []
            for part in parts:
                if part in self.special:
                    plan.append(part)
                elif part:
                    got, strange = self.pieces(part)
                    if strange:
                        odd["\0" + part] = part
                        plan.append(["\0" + part])
                    elif got:
                        need.update(got)
                        plan.append(got)
            plans.append(plan)
        self.learn(self.memory.missing(need), self.split_piece)
        known = self.memory.new
        self.learn(list(odd), lambda p: self.split_odd(p[1:]))
        all_ids, all_text = [], []
        for plan in plans:
            ids = b"".join([self.special[part].to_bytes(4, "little") if isinstance(part, str) else b"".join([known[p] for p in part])
                            for part in plan])
            all_ids.append(ids)
            # the memories hold no decoded text: looked up anew, it costs little
            all_text.append(self.decode(np.frombuffer(ids, "<u4").tolist()))
        for p in odd:
            known.pop(p, None)
        return all_ids, all_text

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens kept, as a tokenizer without decoder has it."""
        return " ".join([self.strings[i] for i in ids if i in self.strings])


_loaded: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, ids (binary: token ids as
    little-endian unsigned 32-bit integers), n_tokens and decoded.

    Null, empty and blank texts have no tokens and decode to the empty string.
    Whole texts are encoded; null ids and repeated rows stay as they are; other
    columns are not read.  ``keep`` must not hold names of the results.
    """
    def run(batches):
        bpe = load(path)
        try:
            yield from encoded(bpe, batches)
        finally:
            bpe.memory.clear()
            bpe.word_memory.clear()

    def encoded(bpe, batches):
        for b in batches:
            texts = b.column(b.num_columns - 1)
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            start, size = 0, 0
            for i, n in enumerate(lengths):
                size += n
                if size >= GROUP_CHARS or i == len(lengths) - 1:
                    part = b.slice(start, i + 1 - start)
                    ids, text = bpe.encode([t or "" for t in part.column(b.num_columns - 1).to_pylist()])
                    yield pa.record_batch([*part.columns[:-1], pa.array(ids, pa.binary()), pa.array(text, pa.string())],
                                          names=[*keep, "ids", "decoded"])
                    start, size = i + 1, 0

    src = docs.select(*keep, F.col(text_col).alias("__text"))
    out = src.mapInArrow(light(run), ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1]) + ", ids binary, decoded string")
    return out.select(*keep, "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "decoded")
