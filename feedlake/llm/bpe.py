"""Byte-pair encoding and decoding by speculation and verification.

A text is split into words as the tokenizer file says. Greedy longest match, one pass of an
automaton over all new words of a batch, proposes the tokens of each word. A
proposal is the encoding exactly if no merge crosses a border between two of its tokens, and
for one border that depends on the two tokens alone: while the merges run in the order of their
ranks, the piece at the right edge of the left token climbs that token's merge tree, and the
piece at the left edge of the right token climbs the other's. Going back through both trees,
array-wise for all borders at once, shows whether some pair of edge pieces that
existed at the same time could have merged first. Only words with such a border are merged
step by step.

The argument needs merges whose result outranks both parts, and one merge per token. A
vocabulary of another kind is merged step by step throughout; files with settings that are not
read here (normalizers, word ends, dropout, …) are refused.

Defined results: a null or empty text has no tokens; rows with equal ids are encoded one by one;
very long texts are taken in pieces of whole words; ids that the vocabulary does not have are skipped
in decoding, and bytes that are no UTF-8 become U+FFFD; empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import ids_and_texts

# Words whose tokens a task remembers, and words that are looked at together.
REMEMBERED_WORDS = 200_000
WORDS_AT_ONCE = 200_000
# A longer word ends what is remembered, and a longer text is split step by step.
REMEMBERED_CHARS = 4096
LONG_CHARS = 4_000_000
# Words of so many bytes are merged together, longer ones one by one.
SHORT_BYTES = 48

# How byte-level vocabularies split words, and the letters that stand for bytes in the file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Characters whose classes all Unicode versions agree on; a text with others is split by the tokenizer library.
_UNSETTLED = re.compile("[^\x00-՗ -⁰]")
_BETWEEN = "Ā"  # no byte, so no token reaches over it
_NEVER = np.iinfo(np.int64).max


def _byte_letters() -> dict[str, int]:
    """The letter in the file -> the byte: printable ones stand for themselves, the others follow U+0100 in order."""
    letters = {chr(b): b for b in PRINTABLE_BYTES}
    others = [b for b in range(256) if b not in set(PRINTABLE_BYTES)]
    return letters | {chr(256 + n): b for n, b in enumerate(others)}


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] for every (start, size), one after the other."""
    before = np.cumsum(sizes) - sizes
    return values[np.arange(sizes.sum()) + np.repeat(starts - before, sizes)]


class Vocabulary:
    """Tokens, merges and the splitting rule of a byte-level tokenizer file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, split = told["model"], told["pre_tokenizer"]
        refused = [key for key in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(key)]
        refused += [key for key in ("fuse_unk", "byte_fallback", "ignore_merges") if model.get(key)]
        refused += [f"added {key}" for t in told["added_tokens"] for key in ("single_word", "lstrip", "rstrip", "normalized") if t[key]]
        if told["normalizer"] or (split or {}).get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            refused.append("normalizer or word splitting")
        if model["type"] != "BPE" or (told["decoder"] or {}).get("type") != "ByteLevel" or refused:
            raise ValueError(f"not a plain byte-level BPE file: {refused or model['type']}")

        self.words = regex.compile(WORD_PATTERN)
        self.library_split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

        letters, ids = _byte_letters(), model["vocab"]
        self.size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * self.size
        for text, token in ids.items():
            self.bytes_of[token] = bytes(letters[c] for c in text)
        for text, token in self.added.items():
            self.bytes_of[token] = text.encode()
        self.known = np.zeros(self.size, bool)
        self.known[[*ids.values(), *self.added.values()]] = True
        self.byte_token = [ids[letter] for letter, _ in sorted(letters.items(), key=lambda item: item[1])]

        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made = np.array([ids["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]], np.int64)
        once = True
        for rank, pair in enumerate(model["merges"]):
            first, second = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = ids[first], ids[second], ids[first + second]
            self.merges[a, b] = rank, made
            once &= self.rank[made] < 0 and self.left[made] < 0
            self.left[made], self.right[made], self.rank[made] = a, b, rank
        merged = np.flatnonzero(self.rank >= 0)
        grows = (self.rank[merged] > np.maximum(self.rank[self.left[merged]], self.rank[self.right[merged]])).all()
        self.speculates = bool(once and grows)

        keys = np.array([a * self.size + b for a, b in self.merges] + [_NEVER], np.int64)
        ranks = np.array([rank for rank, _ in self.merges.values()] + [_NEVER], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.usable = self._usable(merged)

        self.automaton = ahocorasick.Automaton()
        for token in {*self.byte_token, *merged.tolist()}:
            self.automaton.add_word(self.bytes_of[token].decode("latin-1"), token)
        self.automaton.make_automaton()

        self.byte_sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def _usable(self, merged: np.ndarray) -> np.ndarray:
        """Tokens that their own bytes are merged to: those whose parts are, if nothing crosses between the parts before they merge."""
        usable = np.zeros(self.size, bool)
        usable[self.byte_token] = True
        if not self.speculates:
            return usable
        alone = self.compatible(self.left[merged], self.right[merged], self.rank[merged])
        for token in merged[alone][np.argsort(self.rank[merged[alone]])]:
            usable[token] = usable[self.left[token]] and usable[self.right[token]]
        return usable

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | int = _NEVER) -> np.ndarray:
        """Whether no merge of a rank below `until` crosses between neighbours a and b.

        `left_end` and `right_end` are the ranks at which the edge pieces go into larger ones. A crossing
        merge of equal rank comes first if it lies to the left, and so only against the right piece.
        """
        fine = np.ones(len(a), bool)
        place = np.arange(len(a))
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        left_end = np.broadcast_to(np.asarray(until, np.int64), a.shape).copy()
        right_end = left_end.copy()
        while len(place):
            crossing = self.pair_rank(a, b)
            hit = (crossing < left_end) & (crossing <= right_end)
            fine[place[hit]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            on = ~hit & ((rank_a >= 0) | (rank_b >= 0))
            place, a, b, rank_a, rank_b, left_end, right_end = (x[on] for x in (place, a, b, rank_a, rank_b, left_end, right_end))
            back = rank_a > rank_b  # which of the two came into being later
            a, left_end = np.where(back, self.right[a], a), np.where(back, rank_a, left_end)
            b, right_end = np.where(back, b, self.left[b]), np.where(back, right_end, rank_b)
        return fine

    def merged(self, word: bytes) -> list[int]:
        """The tokens of a word, merged pair by pair: the lowest rank first, then the leftmost."""
        ids = [self.byte_token[byte] for byte in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        find, end = self.merges.get, len(ids)
        heap = [(found[0], at, found[1], ids[at], ids[at + 1]) for at in range(end - 1) if (found := find((ids[at], ids[at + 1])))]
        heapq.heapify(heap)
        while heap:
            _, at, made, a, b = heapq.heappop(heap)
            other = after[at]
            if ids[at] != a or other >= end or ids[other] != b:
                continue  # one of the two has been merged meanwhile
            ids[at], ids[other] = made, -1
            after[at] = after[other]
            if after[at] < end:
                before[after[at]] = at
            for first in (before[at], at):
                if first >= 0 and after[first] < end and (found := find((ids[first], ids[after[first]]))):
                    heapq.heappush(heap, (found[0], first, found[1], ids[first], ids[after[first]]))
        return [token for token in ids if token >= 0]

    def merged_together(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all words, number of each), merged in rounds: each takes the first merge of lowest rank in every
        word that has one left. For short words, as there are as many rounds as a word has merges."""
        sizes = np.array([len(word) for word in raw], np.int64)
        ids = np.array(self.byte_token, np.int64)[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), sizes)
        rank = np.full(len(ids), _NEVER)

        def rank_at(places: np.ndarray) -> None:
            """Ranks of the pairs that begin at these places; none at the end of a word."""
            places = places[places >= 0]
            rank[places] = _NEVER
            places = places[places + 1 < len(ids)]
            places = places[word[places] == word[places + 1]]
            rank[places] = self.pair_rank(ids[places], ids[places + 1])

        rank_at(np.arange(len(ids)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begins = np.concatenate([[True], word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, np.flatnonzero(begins))[np.cumsum(begins) - 1]
            over = lowest == _NEVER
            done.append((word[over], ids[over]))
            ids, word, rank, lowest = (x[~over] for x in (ids, word, rank, lowest))
            at = np.flatnonzero(rank == lowest)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])] if len(at) else at
            ids[at] = self.made[rank[at]]
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, word, rank = ids[kept], word[kept], rank[kept]
            at = at - np.arange(len(at))
            rank_at(at)
            rank_at(at - 1)
        word, ids = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (ids, ids)
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(raw))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        raw = [word.encode() for word in words]
        if not self.speculates:
            exact = [self.merged(word) for word in raw]
            return np.fromiter(chain.from_iterable(exact), np.int64), np.array([len(ids) for ids in exact], np.int64)
        starts = np.cumsum([0, *(len(word) + 1 for word in raw)])[:-1]
        joined = _BETWEEN.join(word.decode("latin-1") for word in raw)
        proposed = np.fromiter(chain.from_iterable(self.automaton.iter_long(joined)), np.int64).reshape(-1, 2)
        ids, word = proposed[:, 1], np.searchsorted(starts, proposed[:, 0], "right") - 1
        border = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(ids[border] * self.size + ids[border + 1], return_inverse=True)
        crossed = ~self.compatible(pairs // self.size, pairs % self.size)[which]
        failing = np.zeros(len(words), bool)
        failing[word[border[crossed]]] = True
        failing[word[~self.usable[ids]]] = True

        sizes = np.bincount(word, minlength=len(words))
        long = failing & (np.array([len(word) for word in raw]) > SHORT_BYTES)
        short = failing & ~long
        redone, short_sizes = self.merged_together([raw[at] for at in np.flatnonzero(short)])
        alone = [self.merged(raw[at]) for at in np.flatnonzero(long)]
        sizes[short], sizes[long] = short_sizes, [len(tokens) for tokens in alone]
        out = np.empty(sizes.sum(), np.int64)
        out[np.repeat(~failing, sizes)] = ids[~failing[word]]
        out[np.repeat(short, sizes)] = redone
        out[np.repeat(long, sizes)] = np.fromiter(chain.from_iterable(alone), np.int64)
        return out, sizes

    def split(self, text: str) -> Iterator[list[str | int]]:
        """Lists of words, and of the ids of added tokens that the text names; a long text comes in several."""
        for n, part in enumerate(self.added_pattern.split(text) if self.added_pattern else [text]):
            if n % 2:
                yield [self.added[part]]
            elif _UNSETTLED.search(part):
                yield [part[a:b] for _, (a, b) in self.library_split(part)]
            elif len(part) <= LONG_CHARS:
                yield self.words.findall(part)
            else:
                found = (word.group() for word in self.words.finditer(part))
                while piece := list(islice(found, WORDS_AT_ONCE)):
                    yield piece

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < self.size)]
        ids = ids[self.known[ids]]
        return gathered(self.all_bytes, self.byte_starts[ids], self.byte_sizes[ids]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once by each Python worker."""
    return Vocabulary(path)


class Encoder:
    """Encodes texts and remembers the tokens of words."""

    def __init__(self, words: Vocabulary, remembered: int = REMEMBERED_WORDS):
        self.vocabulary, self.remembered = words, remembered
        self._forget()

    def _forget(self) -> None:
        """What is remembered: word -> number, and for each number the place and count of its tokens.
        An added token is a word, known by its id."""
        self.index: dict[str | int, int] = {}
        self.tokens, self.starts, self.sizes = (np.empty(0, np.int64) for _ in range(3))

    def _learn(self, ids: np.ndarray, sizes: np.ndarray, words: list[str | int]) -> None:
        self.index.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.tokens) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.tokens = np.concatenate([self.tokens, ids])

    def _ids(self, words: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        new = {word for word in words if word not in self.index}
        if added := [word for word in new if isinstance(word, int)]:
            self._learn(np.array(added, np.int64), np.ones(len(added), np.int64), added)
            new = new.difference(added)
        if new:
            self._learn(*self.vocabulary.encode_words(new := list(new)), new)
        places = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[places]
        ids = gathered(self.tokens, self.starts[places], sizes)
        if len(self.index) > self.remembered or new and max(map(len, new)) > REMEMBERED_CHARS:
            self._forget()
        return ids, sizes

    def __call__(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order. Words of many texts are looked at together."""
        words: list[str | int] = []
        counts: list[int] = []  # of the words of each text that waits; the last may go on
        begun: list[np.ndarray] = []  # ids of the text that goes on

        def taken() -> list[np.ndarray]:
            ids, sizes = self._ids(words)
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])]
            parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            words.clear()
            counts.clear()
            return parts

        for text in texts:
            counts.append(0)
            for piece in self.vocabulary.split(text):
                words.extend(piece)
                counts[-1] += len(piece)
                if len(words) >= WORDS_AT_ONCE:
                    *done, last = taken()
                    for part in done:
                        yield np.concatenate([*begun, part])
                        begun.clear()
                    begun.append(last)
                    counts.append(0)
        if counts:
            for part in taken():
                yield np.concatenate([*begun, part])
                begun.clear()


def _encoded_rows(batches: Iterable[pa.RecordBatch], encode: Encoder) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), encode(text.as_py() for text in batch.column(1)), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, rows_at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, rows_at_once)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def encoded(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        rows = _encoded_rows(batches, Encoder(vocabulary(tokenizer_path)))
        yield from _batches(((doc, ids.astype(np.int32)) for doc, ids in rows), schema, 100)

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) of every (doc_id, ids)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    rows = tokens.select(F.col("doc_id").cast("long"), F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        words = vocabulary(tokenizer_path)

        def each():
            for batch in batches:
                ids = batch.column(1)
                for n, doc in enumerate(batch.column(0).to_pylist()):
                    yield doc, words.decode(np.array([-1 if t is None else t for t in ids[n].as_py()], np.int64))

        yield from _batches(each(), schema, 100)

    return rows.mapInArrow(run, "doc_id long, text string")


def digested(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and the ids decoded again.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8.
    """
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches):
        words = vocabulary(tokenizer_path)

        def row(doc, ids):
            back = words.decode(ids).encode()
            return doc, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()

        yield from _batches((row(doc, ids) for doc, ids in _encoded_rows(batches, Encoder(words))), schema)

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
