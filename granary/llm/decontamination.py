"""Benchmark decontamination: CGK embedding, bit sampling over item-sized windows, exact edit verification.

Texts are words: runs of letters and digits in lower case (ASCII and Latin-1 letters), so white space, punctuation and
capitals never hide a passage. Kana and Han characters, which are written without blanks, are words by themselves. An item occurs where some run of words is within ``floor(edits * words of the item)``
insertions, deletions and substitutions of words.

The CGK walk (Chakraborty, Goldenberg, Koucky: Streaming algorithms for embedding and computing edit distance) emits the
word under a pointer and moves the pointer by a random bit of (step, word); few edits change few of the emitted places.
Two sampled places of a walk are one hash; ``repeats`` walks find a passage at the largest allowed distance with a chance
of about 0.98, closer ones almost surely (``tests/llm`` measures it). Windows start at every word of every text and are
as long as the shortest item of a length band. A window in which more words than the allowed edits occur in no item of
the band cannot hold one, an exact bound that spares most walks. What the samples propose is decided by the edit
distance of the whole item.

Items of fewer than ``LEAST_WORDS`` words would be found with edits by chance in clean texts. They are looked up exactly: where
all their words stand in order, and those of fewer than ``PHRASE`` words, which are no passage of a longer text, where they are
the whole text.

The benchmark is taken in blocks of ``BLOCK`` items, each small enough for every task; of several blocks the result of one is
written before the next one is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.llm.words import U, Words, lean, mixed, pieces, utf8_buffers
from granary.session import materialise

BLOCK = 20_000
#: Shorter items are looked up exactly, and those shorter than a phrase as whole texts.
LEAST_WORDS = 8
PHRASE = 4
_PLACES = 2

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def plain_words(column: pa.Array) -> Words:
    data, offsets = utf8_buffers(column)
    if len(data):
        # Latin-1 capitals: the second byte after 0xC3.
        after = np.empty(len(data), bool)
        after[0] = False
        np.equal(data[:-1], 0xC3, out=after[1:])
        capital = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        data = data + capital.astype(np.uint8) * np.uint8(0x20)
        # U+3000 to U+9FFF take three bytes from 0xE3 to 0xE9 on; the first 64 are blanks and punctuation.
        lead = (data >= 0xE3) & (data <= 0xE9)
        if lead.any():
            lead[-2:] = False
            mark = np.zeros(len(data), bool)
            mark[:-1] = lead[:-1] & (data[:-1] == 0xE3) & (data[1:] == 0x80)
            marked = mark.copy()
            marked[1:] |= mark[:-1]
            marked[2:] |= mark[:-2]
            return Words(np.where(marked, np.uint8(32), data), offsets, _BREAK, alone=lead & ~mark)
    return Words(data, offsets, _BREAK)


def _pair(item: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(mixed((item.astype(np.uint64) << U(32)) | a.astype(np.uint64)) + b.astype(np.uint64))


@dataclass
class Band:
    """Items of similar length: ``width`` words of each are looked for, at most ``edits`` edits apart."""

    width: int
    edits: int
    items: list[int]
    keys: list[tuple[np.ndarray, np.ndarray]]  # per walk: sorted samples and the items they belong to
    known: np.ndarray  # which words of the vocabulary belong to the band


class Needles:
    """Benchmark items prepared for the search."""

    def __init__(self, ids: list[int], texts: list[str], edits: float, repeats: int):
        words = plain_words(pa.array(texts, pa.string()))
        bounds = list(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True))
        kept = [i for i, (a, b) in enumerate(bounds) if b - a >= LEAST_WORDS]
        brief = [i for i, (a, b) in enumerate(bounds) if 0 < b - a < LEAST_WORDS]
        self.ids = [ids[i] for i in kept]
        self.repeats = repeats
        self.vocabulary, place = np.unique(words.hash, return_inverse=True)
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[self.vocabulary >> U(44)] = True
        symbols = (place + 1).astype(np.int32)
        self.texts = [symbols[bounds[i][0] : bounds[i][1]] for i in kept]
        # By number of words: the sorted keys of short items and their ids.
        self.brief: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({bounds[i][1] - bounds[i][0] for i in brief}):
            same = [i for i in brief if bounds[i][1] - bounds[i][0] == n]
            key = self.runs(symbols, np.array([bounds[i][0] for i in same]), n)
            order = np.argsort(key, kind="stable")
            self.brief[n] = key[order], np.array([ids[i] for i in same], np.int64)[order]
        self.allowed = [int(edits * len(t) + 1e-9) for t in self.texts]
        pairs = [_pair(np.full(len(t) - 1, i), t[:-1], t[1:]) for i, t in enumerate(self.texts)]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.bands = []
        low = LEAST_WORDS
        longest = max(map(len, self.texts), default=0)
        while low <= longest:
            high = max(low + 2, low * 4 // 3)
            items = [i for i, t in enumerate(self.texts) if low <= len(t) < high]
            if items:
                self.bands.append(self._band(items))
            low = high

    def _bits(self, walk: int, part: int) -> np.ndarray:
        """Random bits per word: 64 steps of one walk. Word 0 stands for all words of no item."""
        seed = mixed(np.array([walk * 1000 + part + 1], np.uint64))[0]
        return mixed(np.concatenate(([U(0)], self.vocabulary)) ^ seed)

    def _places(self, walk: int, width: int) -> np.ndarray:
        return np.sort(np.random.default_rng(walk * 7919 + width).choice(2 * width, _PLACES, replace=False))

    def samples(self, symbols: np.ndarray, start: np.ndarray, stop: np.ndarray, walk: int, width: int) -> np.ndarray:
        """The sampled places of one walk over ``symbols[start:stop]`` of many windows; 0 if one of them is no word of an item."""
        places = self._places(walk, width)
        pointer = start.copy()
        out = np.zeros(len(start), np.uint64)
        good = np.ones(len(start), bool)
        for step in range(int(places[-1]) + 1):
            if step % 64 == 0:
                bits = self._bits(walk, step // 64)
            word = symbols[pointer]
            if step in places:
                good &= (word > 0) & (pointer < stop)
                out = mixed(out + word.astype(np.uint64))
            pointer += ((bits[word] >> U(step % 64)) & U(1)).astype(pointer.dtype)
            np.minimum(pointer, stop, out=pointer)
        return np.where(good, out | U(1), U(0))

    def _band(self, items: list[int]) -> Band:
        width = min(len(self.texts[i]) for i in items)
        edits = max(self.allowed[i] for i in items)
        symbols = np.concatenate([self.texts[i][:width] for i in items] + [np.zeros(1, np.int32)])
        start = np.arange(len(items)) * width
        keys = []
        for walk in range(self.repeats):
            key = self.samples(symbols, start, start + width, walk, width)
            order = np.argsort(key, kind="stable")
            order = order[key[order] > 0]
            keys.append((key[order], np.array(items)[order]))
        known = np.zeros(len(self.vocabulary) + 1, bool)
        for i in items:
            known[self.texts[i]] = True
        return Band(width, edits, items, keys, known)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Words as places in the vocabulary from 1; 0 for words of no item."""
        out = np.zeros(len(hashes) + 1, np.int32)
        maybe = np.flatnonzero(self.bitmap[hashes >> U(44)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        out[maybe] = np.where(self.vocabulary[at] == hashes[maybe], at + 1, 0)
        return out

    def proposals(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (start, item) that share the samples of a walk."""
        ends = np.repeat(first[1:], np.diff(first))
        starts, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for band in self.bands:
            seen = np.zeros(len(symbols), np.int32)
            np.cumsum(band.known[symbols[:-1]], out=seen[1:])
            stop = np.minimum(np.arange(len(symbols) - 1) + band.width, ends)
            here = np.flatnonzero(seen[stop] - seen[:-1] >= band.width - band.edits)
            if not len(here):
                continue
            here_stop = stop[here]
            pairs = []
            for walk, (keys, owners) in enumerate(band.keys):
                if not len(keys):
                    continue
                found = self.samples(symbols, here, here_stop, walk, band.width)
                a = np.searchsorted(keys, found, "left")
                n = np.searchsorted(keys, found, "right") - a
                hit = np.flatnonzero(n * (found > 0))
                n = n[hit]
                rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs.append((np.repeat(here[hit], n).astype(np.uint64) << U(32)) | owners[np.repeat(a[hit], n) + rank].astype(np.uint64))
            if not pairs:
                continue
            pair = np.unique(np.concatenate(pairs))
            begin, item = (pair >> U(32)).astype(np.int64), (pair & U(0xFFFFFFFF)).astype(np.int64)
            # An edit spoils at most two neighbourhoods of words; the others must be the item's own.
            shared = np.zeros(len(begin), np.int32)
            for j in range(band.width - 1):
                at = np.minimum(begin + j, len(symbols) - 2)
                key = _pair(item, symbols[at], symbols[at + 1])
                place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
                shared += (self.pairs[place] == key) & (begin + j + 1 < ends[begin])
            fine = shared >= band.width - 1 - 2 * np.array(self.allowed)[item]
            starts.append(begin[fine])
            items.append(item[fine])
        return np.concatenate(starts), np.concatenate(items)

    @staticmethod
    def runs(symbols: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
        """A key of the ``n`` words from each start on."""
        key = np.full(len(start), n, np.uint64)
        for j in range(n):
            key = mixed(key + symbols[start + j].astype(np.uint64))
        return key

    def exact(self, symbols: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Places (text, item id, first word, word after the last) of short items, places of one item not overlapping."""
        length = np.diff(first)
        known = np.zeros(len(symbols), np.int32)
        np.cumsum(symbols[:-1] > 0, out=known[1:])
        for n, (keys, ids) in self.brief.items():
            if n < PHRASE:
                start = first[:-1][length == n]
            else:
                start = np.arange(len(symbols) - 1)
                start = start[np.repeat(first[1:], length) - start >= n]
            start = start[known[start + n] - known[start] == n]
            key = self.runs(symbols, start, n)
            low = np.searchsorted(keys, key, "left")
            times = np.searchsorted(keys, key, "right") - low
            hit = np.flatnonzero(times)
            free: dict[int, int] = {}
            for at, a, c in zip(start[hit].tolist(), low[hit].tolist(), times[hit].tolist(), strict=True):
                for item in ids[a : a + c].tolist():
                    if free.get(item, 0) <= at:
                        free[item] = at + n
                        text = int(np.searchsorted(first, at, "right")) - 1
                        yield text, item, at - int(first[text]), at - int(first[text]) + n

    def occurrences(self, symbols: np.ndarray, low: int, high: int, item: int) -> Iterator[tuple[int, int, int]]:
        """Places (edits, first word, word after the last) of the item in ``symbols[low:high]``, best first, not overlapping."""
        left = [(low, high)]
        while left:
            low, high = left.pop()
            if high - low < len(self.texts[item]) - self.allowed[item]:
                continue
            best = self.occurrence(symbols[low:high], item)
            if best is not None:
                yield best[0], low + best[1], low + best[2]
                left += [(low, low + best[1]), (low + best[2], high)]

    def occurrence(self, text: np.ndarray, item: int) -> tuple[int, int, int] | None:
        """Best place of the item in ``text``: (edits, first word, word after the last), if close enough."""
        needle = self.texts[item]
        places = np.arange(len(text) + 1)
        cost, origin = np.zeros(len(text) + 1, np.int64), places.copy()
        for i, word in enumerate(needle.tolist(), 1):
            replaced = cost[:-1] + (text != word)
            dropped = cost[1:] + 1
            better = replaced <= dropped
            new = np.concatenate(([i], np.where(better, replaced, dropped)))
            source = np.concatenate(([0], np.where(better, origin[:-1], origin[1:])))
            # Inserted words: the least of cost - place over all places before.
            slack = (new - places) * (len(text) + 2) + places
            best = np.minimum.accumulate(slack) % (len(text) + 2)
            cost, origin = new[best] + places - best, source[best]
        end = int(cost.argmin())
        return (int(cost[end]), int(origin[end]), end) if cost[end] <= self.allowed[item] else None


def _search(needles: Needles):
    names = ["doc_id", "item_id", "first_word", "last_word", "edits"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = plain_words(part.column(1))
                if not len(words.start):
                    continue
                symbols = needles.symbols(words.hash)
                starts, items = needles.proposals(symbols, words.first)
                docs = np.searchsorted(words.first, starts, "right") - 1
                rows = []
                order = np.lexsort((starts, items, docs))
                docs, items, starts = docs[order], items[order], starts[order]
                # Starts of one item whose windows meet are one region of the text.
                reach = np.array([len(t) + 2 * k for t, k in zip(needles.texts, needles.allowed, strict=True)] or [0])
                new = np.ones(len(starts), bool)
                new[1:] = (docs[1:] != docs[:-1]) | (items[1:] != items[:-1]) | (starts[1:] - starts[:-1] > reach[items[1:]])
                firsts = np.flatnonzero(new)
                lasts = np.append(firsts[1:], len(starts)) - 1
                for a, b in zip(firsts.tolist(), lasts[: len(firsts)].tolist(), strict=True):
                    doc, item = int(docs[a]), int(items[a])
                    low, high = int(words.first[doc]), int(words.first[doc + 1])
                    region = max(low, int(starts[a]) - needles.allowed[item]), min(high, int(starts[b]) + int(reach[item]))
                    for edits, begin, end in needles.occurrences(symbols, *region, item):
                        rows.append((doc, needles.ids[item], begin - low, end - low, edits))
                rows += [(*place, 0) for place in needles.exact(symbols, words.first)]
                if rows:
                    doc, *rest = zip(*rows, strict=True)
                    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.record_batch([part.column(0).take(pa.array(doc)), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))], names)

    return lean(search)


def _items(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The items, and in how many blocks they are taken."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    return items, max(1, -(-items.count() // BLOCK))


def _needles(items: DataFrame, blocks: int, edits: float, repeats: int) -> Iterator[Needles]:
    """The items, one block at a time."""
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        yield Needles([r[0] for r in rows], [r[1] for r in rows], edits, repeats)


def benchmark_passages(docs: DataFrame, benchmark: DataFrame, edits: float = 0.2, repeats: int = 20) -> DataFrame:
    """Passages of ``benchmark(item_id, text)`` in ``docs(doc_id, text)``.

    ``doc_id, item_id, first_word, last_word, edits``: the item covers the words ``first_word`` to before ``last_word``
    with that many edits; one row for each place, places of one item not overlapping. Items of fewer than ``LEAST_WORDS`` words
    are found without edits, those of fewer than ``PHRASE`` words only where they are the whole text. Null and
    empty texts on either side, empty tables and items with a null id give no row; a text without words is empty. Very long texts are searched whole. Repeated
    documents each give their rows, a null ``doc_id`` stays null, repeated items match once under each id. Other columns
    are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items, blocks = _items(benchmark)
    out = None
    for needles in _needles(items, blocks, edits, repeats):
        found = docs.mapInArrow(_search(needles), "doc_id bigint, item_id bigint, first_word int, last_word int, edits int")
        found = materialise(found, "passages") if blocks > 1 else found
        out = found if out is None else out.unionAll(found)
    return out


def _free(needles: Needles):
    """The rows, all columns, whose text holds no item."""
    search = _search(needles)

    def free(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
            for found in search(iter([pa.record_batch([pa.array(np.arange(batch.num_rows)), texts], ["doc_id", "text"])])):
                keep[found.column(0).to_numpy()] = False
            yield batch.filter(pa.array(keep))

    return free


def rows_without_benchmark(docs: DataFrame, benchmark: DataFrame, edits: float = 0.2, repeats: int = 20) -> DataFrame:
    """The rows of ``docs`` whose own text holds no passage of :func:`benchmark_passages`, whatever their id, null and repeated ones too."""
    items, blocks = _items(benchmark)
    for block, needles in enumerate(_needles(items, blocks, edits, repeats), 1):
        docs = docs.mapInArrow(_free(needles), docs.schema)
        docs = materialise(docs, "free-of-a-block") if block < blocks else docs
    return docs
