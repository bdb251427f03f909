"""Byte-level BPE with the vocabulary of a public tokenizer: encode texts to ids, and back.

The new words of a slice of texts lie in one flat array of symbols. Each round looks up all
neighbouring pairs by binary search over the sorted pair keys, and merges the lowest-ranked pair of
every word, left to right, until no word holds a known pair. A worker keeps the ids of the words it
has met, `MAX_WORDS` of them at most.

The tables of the vocabulary (some 50,000 entries) are read on the driver and travel with the
function, so executors need no file.

Defined cases: a NULL text encodes to no ids, and NULL or empty ids decode to the empty text; a NULL
id is skipped, and an id outside the vocabulary is refused; bytes that are not UTF-8 decode to
U+FFFD; the strings of special tokens encode to their ids; repeated rows give repeated results.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake.llm import texts as tx

MAX_WORDS = 150_000
_SLICE_BYTES = 1 << 20
_NEVER = np.iinfo(np.int64).max
# The pattern that the vocabulary was made with, and the code points that became letters
# or numbers after Unicode 16, which the tokenizers library knows.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LATER = """
558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf
10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686
16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191
191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de
1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead
323b0-33479 3d000-3fc3f
"""


def _later_class() -> str:
    ends = [part.split("-") for part in _LATER.split()]
    return "".join(f"\\U{int(e[0], 16):08x}-\\U{int(e[-1], 16):08x}" for e in ends)


_PIECES = regex.compile(_PATTERN)
_HAS_LATER = regex.compile(f"[{_later_class()}]")
_PIECES_BEFORE = regex.compile(
    "(?V1)"
    + _PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{_later_class()}])")
    .replace(r"\p{L}+", rf"[\p{{L}}--[{_later_class()}]]+")
    .replace(r"\p{N}+", rf"[\p{{N}}--[{_later_class()}]]+")
)


def pieces(text: str) -> list[str]:
    """The parts of a text within which symbols are merged."""
    if not text.isascii() and _HAS_LATER.search(text):
        return _PIECES_BEFORE.findall(text)
    return _PIECES.findall(text)


def _byte_of_character() -> dict[str, int]:
    """Vocabulary files show printable Latin-1 bytes as themselves and the others from U+0100 on."""
    shown = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Lookup tables of a tokenizer file of kind byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids = model["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        byte_of = _byte_of_character()
        token = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        token |= {i: text.encode() for text, i in self.specials.items()}
        self.size = max(token) + 1
        every = [token.get(i, b"") for i in range(self.size)]
        self.token_bytes = np.frombuffer(b"".join(every), np.uint8)
        self.token_lengths = np.array([len(b) for b in every])
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.byte_ids = np.zeros(256, np.int64)
        for character, byte in byte_of.items():
            self.byte_ids[byte] = ids[character]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs])
        order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[order]
        self.pair_ranks = order
        self.pair_ids = np.array([ids[a + b] for a, b in pairs])[order]


def merged(vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many words, one after the other, and the number of ids of each."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    symbols = vocabulary.byte_ids[data]
    last_key = len(vocabulary.pair_keys) - 1
    done_words, done_symbols = [], []
    while len(symbols):
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        sizes = np.diff(np.append(starts, len(word)))
        rank = np.full(len(symbols), _NEVER)
        inner = np.flatnonzero(word[1:] == word[:-1])
        keys = symbols[inner] * vocabulary.size + symbols[inner + 1]
        found = np.minimum(np.searchsorted(vocabulary.pair_keys, keys), last_key)
        known = vocabulary.pair_keys[found] == keys
        rank[inner[known]] = vocabulary.pair_ranks[found[known]]
        lowest = np.minimum.reduceat(rank, starts)
        lowest_here = np.repeat(lowest, sizes)
        finished = lowest_here == _NEVER
        done_words.append(word[finished])
        done_symbols.append(symbols[finished])
        merge = (rank == lowest_here) & ~finished
        # In a run of overlapping pairs (one symbol repeated), every second pair merges.
        place = np.arange(len(merge))
        run = place - np.maximum.accumulate(np.where(merge, -1, place))
        merge &= run % 2 == 1
        at = np.flatnonzero(merge)
        slot = np.searchsorted(vocabulary.pair_keys, symbols[at] * vocabulary.size + symbols[at + 1])
        symbols[at] = vocabulary.pair_ids[slot]
        keep = ~finished
        keep[at + 1] = False
        word, symbols = word[keep], symbols[keep]
    word = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
    symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.bincount(word, minlength=len(lengths))


class _Seen(dict):
    """Number of each word, in the order of first meeting."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Encoder:
    """Encodes texts and remembers the words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(map(regex.escape, specials))})") if specials else None
        self._forget()

    def _forget(self) -> None:
        self.seen = _Seen()
        self.seen.fresh = []
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def _numbers(self, text: str) -> np.ndarray:
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1:
            found = pieces(text)
        else:  # every second part is a special token
            found = [p for i, part in enumerate(parts) for p in ([part] if i % 2 else pieces(part))]
        return np.fromiter(map(self.seen.__getitem__, found), np.int64, len(found))

    def _learn(self) -> None:
        fresh, self.seen.fresh = self.seen.fresh, []
        if not fresh:
            return
        specials = self.vocabulary.specials
        encoded = [b"" if w in specials else w.encode() for w in fresh]
        lengths = np.array([len(b) for b in encoded])
        ids, counts = merged(self.vocabulary, np.frombuffer(b"".join(encoded), np.uint8), lengths)
        for place in np.flatnonzero(lengths == 0):
            ids = np.insert(ids, int(counts[:place].sum()), specials[fresh[place]])
            counts[place] = 1
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each text."""
        if len(self.seen) > MAX_WORDS:
            self._forget()
        numbers = [self._numbers(text) for text in texts]
        self._learn()
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        per_word = self.counts[flat]
        total = np.concatenate(([0], np.cumsum(per_word)))
        ends = np.cumsum([len(n) for n in numbers], dtype=np.int64)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return self.ids[tx.ragged(self.starts[flat], per_word)], total[ends] - total[starts]


def decoded(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of lists of ids."""
    if len(ids) and (ids.min() < 0 or ids.max() >= vocabulary.size):
        raise ValueError("an id lies outside the vocabulary")
    lengths = vocabulary.token_lengths[ids]
    data = vocabulary.token_bytes[tx.ragged(vocabulary.token_starts[ids], lengths)].tobytes()
    total = np.concatenate(([0], np.cumsum(lengths)))
    ends = np.cumsum(counts)
    return [
        data[total[end - count] : total[end]].decode("utf-8", "replace")
        for end, count in zip(ends.tolist(), counts.tolist())
    ]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """Some texts of a column at a time, or one long one."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        before = sizes[start - 1] if start else 0
        end = max(int(np.searchsorted(sizes, before + _SLICE_BYTES, "right")), start + 1)
        yield column.slice(start, end - start)
        start = end


def _encoded(tables: Vocabulary, columns: Iterator[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and counts of the texts, part by part: what a task holds does not follow Spark's batches."""
    encoder = Encoder(tables)
    for column in columns:
        for part in _parts(column):
            yield encoder.encode([text or "" for text in part.to_pylist()])


def encode(text: Column | str, path: str) -> Column:
    """The ids of a text (array of int) under the vocabulary file at `path`."""
    tables = vocabulary(path)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids, counts in _encoded(tables, columns):
            yield tx.lists(ids, counts, pa.int32())

    return F.arrow_udf(run, "array<int>").asNondeterministic()(text)


def round_trip(text: Column | str, path: str) -> Column:
    """The ids of a text, and the text that these decode to, in one pass: struct of ids, decoded."""
    tables = vocabulary(path)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids, counts in _encoded(tables, columns):
            back = pa.array(decoded(tables, ids, counts), pa.string())
            yield pa.StructArray.from_arrays([tx.lists(ids, counts, pa.int32()), back], ["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string").asNondeterministic()(text)


def decode(ids: Column | str, path: str) -> Column:
    """The text of an array of ids."""
    tables = vocabulary(path)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for start in range(0, len(column), 64):
                part = column.slice(start, 64)
                if part.null_count or part.flatten().null_count:
                    kept = [[i for i in x or () if i is not None] for x in part.to_pylist()]
                    counts = np.array([len(x) for x in kept])
                    flat = np.array([i for x in kept for i in x], np.int64)
                else:
                    counts = np.diff(part.offsets.to_numpy())
                    flat = part.flatten().to_numpy(zero_copy_only=False)
                yield pa.array(decoded(tables, flat, counts), pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()(ids)
