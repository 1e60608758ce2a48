"""Byte-pair encoding and decoding by batched numpy merge rounds.

Every distinct word of a batch that the worker's cache lacks is laid, as symbol
ids, into one flat array.  A round looks all neighbouring pairs up by binary
search in the sorted pair keys, takes each word's pair of lowest rank, and merges
all its occurrences from the left; words without a known pair leave the array.

Defined cases: null text is empty; an empty text has no ids and decodes to "";
a very long text is encoded whole, in a batch of its own; equal rows give equal results; columns beside the key and the text pass through
``encode``'s ``keep`` only.  Strings of special tokens inside a text become
their ids, as the tokenizers library does.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tokens import CACHE_ENTRIES, TokenCache, batches, flatten, gather, spans, tokenizer_path, young_texts

_NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte (fixed rule of GPT-2)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class WordBpe:
    """A vocabulary file with word ends, lower-cased text and dropped white space."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        end = spec["model"]["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.width = max([*vocab.values(), *self.special.values()]) + 1
        self.inner = np.array([vocab[s] for s in byte_symbols()], np.int32)
        self.last = np.array([vocab[s + end] for s in byte_symbols()], np.int32)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        self.names = [""] * self.width
        for s, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = s
        self.cache = TokenCache(entries)
        self.path, self.library = path, None

    def merge(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order and their counts, from byte symbols; lens: symbols of each word, 1 or more."""
        done_ids, done_words = [], []
        word = np.repeat(np.arange(len(lens), dtype=np.int64), lens)
        counts = np.zeros(len(lens), np.int64)
        while len(sym):
            key = sym[:-1].astype(np.int64) * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[1:] == word[:-1])
            rank = np.append(np.where(known, self.ranks[at], _NONE), _NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            over = least == _NONE
            if over.any():
                done_ids.append(sym[over])
                done_words.append(word[over])
            best = np.flatnonzero((rank == least) & ~over)
            if len(best):  # of overlapping occurrences (aaa) every second counts from the left
                run = np.append(True, np.diff(best) != 1)
                best = best[(np.arange(len(best)) - np.maximum.accumulate(np.where(run, np.arange(len(best)), 0))) % 2 == 0]
            keep = ~over
            if len(best):
                sym = sym.copy()
                sym[best] = self.made[at[best]]
                keep[best + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_ids:
            return np.zeros(0, np.int32), counts
        ids, words = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return ids[order], np.bincount(words, minlength=len(lens)).astype(np.int64)

    def _miss(self, cp: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = cp[gather(s, e - s)]
        size = 1 + (flat >= 0x80).astype(np.int64) + (flat >= 0x800) + (flat >= 0x10000)
        lens = np.add.reduceat(size, np.cumsum(e - s) - (e - s))
        raw = np.frombuffer(flat.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(lens) - 1
        sym[ends] = self.last[raw[ends]]
        return self.merge(sym, lens)

    def normal(self, text: str, young: bool) -> str:
        """Composed and lower case; a text that must be composed, or with characters younger than Python's tables, goes to the library's own normaliser, whose tables are other than Python's."""
        if text.isascii():
            return text.lower()
        if young or not unicodedata.is_normalized("NFC", text):
            from tokenizers import Tokenizer

            self.library = self.library or Tokenizer.from_file(self.path).normalizer
            return self.library.normalize_str(text)
        return (text.replace("Σ", "σ") if "Σ" in text else text).lower()

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        parts: list[str] = []
        plan: list[tuple[int, list[tuple[int, int]]]] = []  # the parts of each text, and its special ids with their places
        for t in texts:
            if self.split is not None and any(x in t for x in self.special):
                bits = self.split.split(t)
                plan.append((len(bits) // 2 + 1, [(i, self.special[b]) for i, b in enumerate(bits[1::2])]))
                parts += bits[::2]
            else:
                plan.append((1, []))
                parts.append(t)
        done: list[np.ndarray] = []
        for a, b in batches(parts):
            young = young_texts(*flatten(parts[a:b])).tolist()
            cp, docs = flatten([self.normal(t, y) for t, y in zip(parts[a:b], young)])
            s, e = spans(cp, docs, keep_spaces=False)
            ids, lens = self.cache.encode(cp, s, e, lambda x, y, cp=cp: self._miss(cp, x, y)) if len(s) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            ends = np.concatenate([[0], np.cumsum(lens)])[np.searchsorted(s, docs)]
            done += [ids[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
        out, at = [], 0
        for n, specials in plan:
            if not specials:
                out.append(done[at])
            else:
                out.append(np.concatenate([x for i in range(n) for x in (done[at + i], np.array([k for j, k in specials if j == i], np.int32))]))
            at += n
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary names no decoder, so tokens are joined by one space."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One for each worker, with its cache."""
    return WordBpe(path)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, decode: bool = False) -> DataFrame:
    """key, n_tokens, ids (little-endian unsigned 32-bit integers), and with decode the decoded text."""
    path = path or tokenizer_path("word_bpe_49k.json")
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, ids binary" + (", decoded string" if decode else "")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for frame in frames:
            texts = frame.column(1).to_pylist()
            for a, b in batches(texts):
                ids = bpe.encode(texts[a:b])
                cols = [frame.column(0).slice(a, b - a), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                if decode:
                    cols.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, [key, "n_tokens", "ids"] + ["decoded"] * decode)

    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text)).mapInArrow(run, schema)


def decode(encoded: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """key, decoded text of ids; null ids give null."""
    path = path or tokenizer_path("word_bpe_49k.json")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for frame in frames:
            text = [None if x is None else bpe.decode(np.frombuffer(x, "<u4")) for x in frame.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(text, pa.string())], [key, "decoded"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {encoded.schema[key].dataType.simpleString()}, decoded string")
