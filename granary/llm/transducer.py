"""A byte-level BPE tokenizer file compiled into a deterministic finite-state transducer over bytes.

A state stands for everything the bytes of a word read so far can still become: for each suffix that may grow into a
token its node in the trie of tokens, which tokens may follow there, and how many tokens precede it. A transition adds the
change of the token count; its sum along a word is the word's count. The state also knows the last token of what has been
read, so the tokens themselves are read off backwards from a word's end. This is exact because the last token of a word's
encoding is the one token whose neighbour on the left it may stand next to, and that can be told from the two alone.

States are compiled as texts need them. All words of a batch step through the table together, one byte at a time.
Words are cut as the file's own splitting rule does, on arrays of character classes; the class of a character is asked of
the library once. Two kinds of file are understood: words that take a blank before them along, and words in lower case
whose last byte carries an end mark. Texts that hold a special token's string are left to the library.
"""

from __future__ import annotations

import json

import numpy as np

#: States kept; beyond it the table is begun anew.
STATES = 65_000
#: A suffix that can become at most so many tokens is told apart by those that may follow, not by its neighbour.
FEW = 40
_LETTER, _NUMBER, _OTHER, _BLANK, _UNKNOWN = range(5)
_SHIFT, _MIDDLE = 6, 32  # a table cell holds the next state above, the change of the count below
_transducers: dict[str, "Transducer"] = {}


#: Lower case of the characters below 0x180, one character each.
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in map(chr, range(0x180))], np.uint32)


def _kind(parts: dict) -> str:
    """Which of the two kinds a tokenizer file is; empty for any other."""
    model, before, normal = parts["model"], parts["pre_tokenizer"] or {}, parts["normalizer"] or {}
    if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("dropout"):
        return ""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in parts["added_tokens"]):
        return ""
    if not normal and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
        return "" if model.get("end_of_word_suffix") else "blank"
    steps = [s.get("type") for s in normal.get("normalizers", [])]
    split, level = [*(before.get("pretokenizers") or []), {}, {}][:2]
    rule = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # fixed value: the rule in the file
    if steps == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": rule} and split.get("behavior") == "Removed" and split.get("invert") and level.get("type") == "ByteLevel" and not level.get("use_regex"):
        return "end mark" if model.get("end_of_word_suffix") else ""
    return ""


def transducer(path: str) -> "Transducer":
    """The worker's transducer for a file; its states stay from task to task."""
    if path not in _transducers:
        _transducers[path] = Transducer(path)
    return _transducers[path]


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level files: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (32, 173)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Transducer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.marked = _kind(parts) == "end mark"
        if not _kind(parts):
            raise ValueError(f"not a kind of BPE file that is understood: {path}")
        mark = parts["model"]["end_of_word_suffix"] or ""
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in parts["added_tokens"]]
        stand_in = _byte_alphabet()
        vocabulary = {k: i for k, i in parts["model"]["vocab"].items() if k not in self.special}

        def symbols(name: str) -> tuple[int, ...]:
            ended = bool(mark) and name.endswith(mark)
            plain = [stand_in[c] for c in (name.removesuffix(mark) if ended else name)]
            return (*plain[:-1], plain[-1] + 256) if ended else tuple(plain)

        spelled = {k: symbols(k) for k in vocabulary}
        # How each token is made: rank of its merge and the two halves; -1 for bytes.
        size = max(vocabulary.values()) + 1
        self.made, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.size = np.ones(size, np.int64)
        self.size[list(vocabulary.values())] = [len(spelled[k]) for k in vocabulary]
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(parts["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            whole = vocabulary[a + b]
            self.rank[vocabulary[a], vocabulary[b]] = rank
            if self.made[whole] < 0:
                self.made[whole], self.left[whole], self.right[whole] = rank, vocabulary[a], vocabulary[b]
        # The trie of tokens.
        self.child: list[dict[int, int]] = [{}]
        self.token = [-1]
        for name, number in vocabulary.items():
            node = 0
            for byte in spelled[name]:
                if byte not in self.child[node]:
                    self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][byte]
            self.token[node] = number
        self._below: dict[int, tuple[int, ...]] = {}
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)
        self._begin()

    def _begin(self) -> None:
        self.states: dict[tuple, int] = {}
        self.content: list[tuple] = []
        self.followers: list[tuple[int, ...]] = []
        self.follower_ids: dict[tuple, int] = {}
        self.followers_of: dict[int, int | None] = {}
        self.last = np.full(1 << 12, -1, np.int32)  # the last token of what led to a state
        self.column = np.full(512, -1, np.int16)  # bytes met so far, those with an end mark from 256 on
        self.table = np.full((1 << 12, 32), -1, np.int32)
        self._state(((0, -1, 0),))

    def _state(self, content: tuple) -> int:
        found = self.states.get(content)
        if found is None:
            found = self.states[content] = len(self.content)
            self.content.append(content)
            if found == len(self.table):
                self.table = np.concatenate((self.table, np.full_like(self.table, -1)))
                self.last = np.concatenate((self.last, np.full_like(self.last, -1)))
            self.last[found] = content[-1][1]
        return found

    def neighbours(self, a: int, b: int) -> bool:
        """May token ``b`` follow token ``a``: does encoding both together give the two again?

        Their merges are undone, the latest first, looking for a merge across the seam that would have come earlier. At
        one rank, places further left merge first.
        """
        rank, made = self.rank, self.made
        limit = 1 << 30
        while rank.get((a, b), limit) >= limit:
            if made[a] > made[b]:
                limit, a = made[a], self.right[a]
            elif made[b] >= 0:
                limit, b = made[b] + 1, self.left[b]
            else:
                return True
        return False

    def _tokens_below(self, node: int) -> tuple[int, ...]:
        """Tokens that begin with the node's bytes and are longer; at most ``FEW + 1`` of them."""
        found = self._below.get(node)
        if found is None:
            out: list[int] = []
            open_nodes = list(self.child[node].values())
            while open_nodes and len(out) <= FEW:
                n = open_nodes.pop()
                if self.token[n] >= 0:
                    out.append(self.token[n])
                open_nodes.extend(self.child[n].values())
            found = self._below[node] = tuple(out[: FEW + 1])
        return found

    def _narrowed(self, node: int, last: int) -> int | None:
        """What matters of the token before a suffix: itself, or (below -1) the set of tokens that may follow; None if none may."""
        if last == -1:
            return -1
        key = node << 24 | (last + (1 << 23))
        if key in self.followers_of:
            return self.followers_of[key]
        below = self._tokens_below(node)
        if last >= 0 and len(below) > FEW:
            out: int | None = last
        else:
            may = tuple(t for t in below if self._fits(last, t))
            out = None
            if may:
                if (node, may) not in self.follower_ids:
                    self.follower_ids[node, may] = len(self.followers)
                    self.followers.append(may)
                out = -2 - self.follower_ids[node, may]
        self.followers_of[key] = out
        return out

    def _fits(self, last: int, token: int) -> bool:
        if last == -1:
            return True
        return self.neighbours(last, token) if last >= 0 else token in self.followers[-2 - last]

    def compile(self, state: int, byte: int) -> None:
        """Work out one transition."""
        grown, token, change = [], -1, 0
        for node, last, count in self.content[state]:
            below = self.child[node].get(byte)
            if below is None:
                continue
            here = self.token[below]
            if here >= 0 and token < 0 and self._fits(last, here):
                token, change = here, count + 1
            if self.child[below]:
                may = self._narrowed(below, last)
                if may is not None:
                    grown.append((below, may, count))
        target = self._state((*((n, m, c - change) for n, m, c in grown), (0, token, 0)))
        if self.column[byte] < 0:
            self.column[byte] = self.column.max() + 1
            if self.column[byte] == self.table.shape[1]:
                self.table = np.concatenate((self.table, np.full_like(self.table, -1)), axis=1)
        self.table[state, self.column[byte]] = target << _SHIFT | change + _MIDDLE

    def _run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
        """Tokens of the words ``data[start:end]``; if given, ``last`` gets the last token up to each byte instead."""
        if len(self.content) > STATES:
            self._begin()
        size = start - end
        # Small numbers are sorted by radix.
        order = np.argsort(size.astype(np.int16) if size.min(initial=0) >= -(1 << 15) else size, kind="stable")  # longest first
        place = start[order]
        negative = place - end[order]
        state = np.zeros(len(order), np.int64)
        total = np.zeros(len(order), np.int64)
        active = len(order)
        depth = 0
        while True:
            active = int(np.searchsorted(negative[:active], -depth, "left"))
            if not active:
                break
            at = place[:active] + depth
            byte = data[at].astype(np.int64)
            now = state[:active]
            column = self.column[byte]
            cell = self.table.reshape(-1).take(now * self.table.shape[1] + column)
            if cell.min() < 0 or column.min() < 0:
                lost = np.flatnonzero((cell < 0) | (column < 0))
                for pair in np.unique(now[lost] << 9 | byte[lost]).tolist():
                    if self.column[pair & 511] < 0 or self.table[pair >> 9, self.column[pair & 511]] < 0:
                        self.compile(pair >> 9, pair & 511)
                cell[lost] = self.table[now[lost], self.column[byte[lost]]]
            state[:active] = cell >> _SHIFT
            if last is None:
                total[:active] += (cell & ((1 << _SHIFT) - 1)) - _MIDDLE
            else:
                last[at] = self.last.take(state[:active])
            depth += 1
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out

    def _classify(self, points: np.ndarray) -> np.ndarray:
        kinds = self.classes[points]
        if (kinds == _UNKNOWN).any():
            split = self.library.pre_tokenizer.pre_tokenize_str
            for point in np.unique(points[kinds == _UNKNOWN]).tolist():
                c = chr(point)
                kind = next((k for k, frame in ((_LETTER, "a"), (_OTHER, "!"), (_NUMBER, "1")) if len(split(frame + c + frame)) == 1), _BLANK)
                if self.marked and kind == _BLANK and len(split("!" + c + "!")) == 3:
                    kind = _NUMBER  # each number is a word here; white space would be dropped
                self.classes[point] = kind
            kinds = self.classes[points]
        return kinds

    def words(self, points: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words of texts that begin at ``firsts`` (ascending, no text empty).

        A run of one class is a word; an apostrophe with s, t, re, ve, m, ll or d is one. Without end marks a word takes a
        blank before it along, and white space before that is a word, its last character one of its own unless it is taken
        along. With end marks white space is dropped and each number is a word.
        """
        n = len(points)
        kinds = self._classify(points)
        fresh = np.ones(n, bool)
        fresh[1:] = kinds[1:] != kinds[:-1]
        fresh[firsts] = True
        begin = np.flatnonzero(fresh)
        kind = kinds[begin]
        stop = np.append(begin[1:], n)
        size = stop - begin
        opens = np.zeros(n + 1, bool)
        opens[firsts] = True
        opens[n] = True
        final = opens[stop]  # the run ends its text
        blank = kind == _BLANK
        taken = blank & ~final & (points[stop - 1] == 32) & (not self.marked)
        after_taken = np.zeros(len(begin), bool)
        after_taken[1:] = taken[:-1]
        mark = np.zeros(n, bool)
        mark[begin[blank & ~(taken & (size == 1))]] = True
        mark[(stop - 1)[blank & ~final & ~taken]] = True
        mark[begin[~blank] - after_taken[~blank]] = True
        short = np.flatnonzero((kind == _OTHER) & (size == 1) & (points[begin] == 39) & ~after_taken & ~final)
        short = short[kind[short + 1] == _LETTER] if len(short) else short
        if len(short):
            at = begin[short] + 1
            one = points[at]
            two = np.where(size[short + 1] > 1, points[np.minimum(at + 1, n - 1)], 0)
            single = np.isin(one, [ord(c) for c in "stmd"])
            double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            length = np.where(single, 1, np.where(double, 2, 0))
            hit = length > 0
            mark[at[hit]] = False
            rest = hit & (size[short + 1] > length)
            mark[at[rest] + length[rest]] = True
        if self.marked:
            mark |= kinds == _NUMBER
        starts = np.flatnonzero(mark)
        ends = np.append(starts[1:], n)
        if self.marked:
            kept = kinds[starts] != _BLANK
            starts, ends = starts[kept], ends[kept]
        return starts, ends

    def _points(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the texts in a row, as the file's rules for letters leave them, and the texts' sizes."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts])
        if not self.marked:
            return points, sizes
        # Beyond Latin letters, and for the one below whose lower case is two characters, the library normalises.
        beyond = (points >= 0x180) | (points == 0x130)
        if beyond.any():
            odd = np.flatnonzero(np.logical_or.reduceat(beyond, np.cumsum(sizes) - sizes))
            texts = list(texts)
            for k in odd.tolist():
                texts[k] = self.library.normalizer.normalize_str(texts[k]) or " "
            points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            sizes = np.array([len(t) for t in texts])
        return _LOWER[np.minimum(points, 0x17F)] + np.where(points > 0x17F, points - 0x17F, 0).astype(np.uint32), sizes

    def _all(self, texts: list[str], wanted: bool) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text that is not empty and holds no special token, and if wanted their ids in a row."""
        points, sizes = self._points(texts)
        firsts = np.cumsum(sizes) - sizes
        starts, ends = self.words(points, firsts)
        places = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=places[1:])
        data = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8).astype(np.uint16)
        begin, end = places[starts], places[ends]
        if self.marked:
            data[end - 1] += 256
        if not wanted:
            sums = np.zeros(len(begin) + 1, np.int64)
            np.cumsum(self._run(data, begin, end), out=sums[1:])
            at = np.searchsorted(starts, np.append(firsts, len(points)))
            return sums[at[1:]] - sums[at[:-1]], np.zeros(0, np.uint32)
        last = np.zeros(len(data), np.int32)
        self._run(data, begin, end, last)
        # Backwards from each word's end, token by token.
        final = np.zeros(len(data), bool)
        place = end
        while len(place):
            final[place - 1] = True
            place = place - self.size[last[place - 1]]
            more = place > begin
            place, begin = place[more], begin[more]
        final = np.flatnonzero(final)
        return np.diff(np.searchsorted(final, places[np.append(firsts, len(points))])), last.take(final).astype(np.uint32)

    def _plain(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Texts for the table, and texts with the string of a special token."""
        odd = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        plain = [k for k, t in enumerate(texts) if t]
        return (sorted(set(plain) - set(odd)) if odd else plain), odd

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        plain, odd = self._plain(texts)
        for k in odd:
            out[k] = len(self.library.encode(texts[k], add_special_tokens=False).ids)
        if plain:
            out[plain] = self._all([texts[k] for k in plain], False)[0]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = [b""] * len(texts)
        plain, odd = self._plain(texts)
        for k in odd:
            out[k] = np.array(self.library.encode(texts[k], add_special_tokens=False).ids, np.uint32).tobytes()
        if plain:
            counts, ids = self._all([texts[k] for k in plain], True)
            raw = ids.tobytes()
            ends = (np.cumsum(counts) * 4).tolist()
            for k, a, b in zip(plain, [0, *ends[:-1]], ends, strict=True):
                out[k] = raw[a:b]
        return out
