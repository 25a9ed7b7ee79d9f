"""Operator 9: encode texts with byte-pair merges and decode ids.

A word's merges are taken from a priority queue of merge ranks over a doubly linked list of its
symbols; entries that a neighbouring merge has made stale are skipped when they come up. Decoding
joins vocabulary strings.

The vocabulary file is read where the work runs, by the given path, so the path must exist on every
machine (as an installed package does). It has at most some 50,000 entries.
"""

from __future__ import annotations

import json
import re
import string
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from marketloom.llm.common import pick, raw, remembers, steps

#: A worker remembers the ids of the last words it met, one to two times this many.
REMEMBERED = 120_000
#: Longer words are not remembered.
REMEMBERED_BYTES = 64
#: Below this code point all Unicode versions agree on case, composition and class.
SETTLED = 0x250
PUNCTUATION = string.punctuation
PUNCTUATION_BYTES = PUNCTUATION.encode()
_UNSETTLED = re.compile(f"[^\x00-{chr(SETTLED - 1)}]")

SYMBOL_BITS, PLACE_BITS = 20, 40
SYMBOL_MASK, PLACE_MASK = (1 << SYMBOL_BITS) - 1, (1 << PLACE_BITS) - 1


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if visible Latin-1, else the next of U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Byte-level BPE with word ends, as described by a ``tokenizers`` file.

    Only files of this kind are taken: NFC, white space and lower case as normaliser, a splitting
    pattern whose matches are words, byte letters, merges without dropout, no unknown token.
    """

    remembered = REMEMBERED

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [x["type"] for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if (kinds, splits, model["type"], model.get("dropout"), model.get("unk_token"), spec["decoder"]) != (
                ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE", None, None, None):
            raise ValueError(f"{path}: not a byte-level BPE with word ends")
        self.vocabulary: dict[str, int] = model["vocab"] | {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Keys and values are packed into one integer each: left and right symbol; rank and merged symbol.
        self.merges = {self.vocabulary[a] << SYMBOL_BITS | self.vocabulary[b]: rank << SYMBOL_BITS | self.vocabulary[a + b]
                       for rank, (a, b) in enumerate(pairs)}
        self.letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.special_bytes = [s.encode() for s in self.special]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        library = Tokenizer.from_file(path)
        self.normaliser, self.splitter, self.model = library.normalizer, library.pre_tokenizer, library.model
        size = max(self.vocabulary.values()) + 1
        strings: list[str | None] = [None] * size
        for s, i in self.vocabulary.items():
            strings[i] = s
        self.strings = pa.array(strings, pa.string())
        self.known = np.array([s is not None for s in strings])
        # Symbols of single bytes, within a word and at its end; None if the vocabulary has none.
        self.inner = [self.vocabulary.get(c) for c in self.letters]
        self.final = [self.vocabulary.get(c + self.end) for c in self.letters]
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Apply merges by rank, leftmost first, to one word's symbols."""
        n = len(ids)
        if n < 2:
            return ids
        find = self.merges.get
        queue = []
        left = ids[0]
        for i in range(1, n):
            right = ids[i]
            found = find(left << SYMBOL_BITS | right)
            if found is not None:
                queue.append((found >> SYMBOL_BITS) << PLACE_BITS | i - 1)
            left = right
        if not queue:
            return ids
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & PLACE_MASK
            left, j = ids[i], after[i]
            if left < 0 or j >= n:
                continue
            found = find(left << SYMBOL_BITS | ids[j])
            if found is None or found >> SYMBOL_BITS != entry >> PLACE_BITS:
                continue  # stale: one of the two symbols has been merged since
            merged = found & SYMBOL_MASK
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = find(merged << SYMBOL_BITS | ids[k])
                if found is not None:
                    heappush(queue, (found >> SYMBOL_BITS) << PLACE_BITS | i)
            h = before[i]
            if h >= 0:
                found = find(ids[h] << SYMBOL_BITS | merged)
                if found is not None:
                    heappush(queue, (found >> SYMBOL_BITS) << PLACE_BITS | h)
        return [x for x in ids if x >= 0]

    def _remember(self, word: bytes, ids: bytes) -> None:
        """Keep short words; the older half of what is known goes when there are too many."""
        if len(word) <= REMEMBERED_BYTES:
            if len(self._known) >= self.remembered:
                self._older, self._known = self._known, {}
            self._known[word] = ids

    def _piece(self, piece: bytes) -> bytes:
        """Ids (32-bit little-endian) of what the splitting pattern leaves together, normalised."""
        got = self._known.get(piece) or self._older.get(piece)
        if got is None:
            got = array("i", self.ids_of(piece)).tobytes()
            self._remember(piece, got)
        return got

    def ids_of(self, piece: bytes) -> list[int]:
        """Symbols of a piece's bytes, the last one as a word's end, merged."""
        inner = self.inner
        symbols = [inner[b] for b in piece]
        symbols[-1] = self.final[piece[-1]]
        if None in symbols:
            symbols = [x for x in symbols if x is not None]
        return self.merge(symbols)

    def _segment(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if _UNSETTLED.search(text):
            # The library's own tables decide on classes and case.
            plain = self.normaliser.normalize_str(text)
            split = [plain[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(plain)]
        else:
            split = self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        return b"".join([self._piece(s.encode()) for s in split])

    def _word(self, word: bytes) -> bytes:
        """Ids of what stands between white space."""
        got = self._older.get(word)
        if got is None:
            low = word.lower()
            letters = low.rstrip(PUNCTUATION_BYTES)
            if letters.isalpha():  # ASCII letters, then perhaps punctuation: two pieces
                got = self._piece(letters)
                if letters == word:
                    return got
                if len(letters) < len(low):
                    got += self._piece(low[len(letters):])
            else:
                got = self._other_word(word)
        self._remember(word, got)
        return got

    def _other_word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        low = text.lower()
        letters = low.rstrip(PUNCTUATION)
        if letters.isalpha() and not _UNSETTLED.search(letters):
            # The same with letters that are composed already.
            got = self._piece(letters.encode())
            return got + self._piece(low[len(letters):].encode()) if len(letters) < len(low) else got
        if any([s in word for s in self.special_bytes]):
            return b"".join([array("i", [self.special[s]]).tobytes() if s in self.special else self._segment(s)
                             for s in self.special_split.split(text)])
        return self._segment(text)

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole UTF-8 text as 32-bit little-endian. Nothing merges or composes across white space."""
        words = text.split()
        try:
            known = self._known
            return b"".join([known[w] for w in words])
        except KeyError:
            own = {w: known[w] if w in known else self._word(w) for w in set(words)}
            return b"".join([own[w] for w in words])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of the id lists that ``offsets`` cuts; ids without a string are passed over."""
        fine = (ids >= 0) & (ids < len(self.known))
        fine[fine] = self.known[ids[fine]]
        if not fine.all():
            offsets = np.concatenate([[0], np.cumsum(fine)])[offsets]
            ids = ids[fine]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.strings.take(pa.array(ids)))
        return pc.binary_join(lists, " ")


@lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


remembers("tokens", load.cache_clear)


def id_lists(encoded: list[bytes]) -> pa.Array:
    """Lists of ids from their bytes."""
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in encoded], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(encoded), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row, repeated rows included, in a single pass.

    A NULL or empty text has no ids; a NULL id stays NULL. Other columns are not read. Memory in a
    worker: the vocabulary, the remembered words and one step of texts.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in steps(batches, "text", holder="tokens"):
            ids = id_lists([bpe.encode(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return rows.select("doc_id", raw("text").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ``ids`` and ``decoded``: the vocabulary strings joined by a space, special tokens included.

    NULL ids give an empty text; ids outside the vocabulary and NULL entries are passed over, as the
    library does.
    """
    rows = pick(encoded, doc_id=id_col, ids=ids_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in steps([batch], "ids", holder="tokens"):
                lists = part.column("ids")
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                text = bpe.decode(ids, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, text], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
