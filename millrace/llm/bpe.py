"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A proposal is the true merge result exactly
if every adjacent pair of it is compatible, that is, if merging the two tokens' bytes side by side
never merges across their border. All pairs of a batch are checked at once with arrays; only words
with a failing pair go through the exact merge loop.

Defined results: null text counts as empty and gives an empty list of ids; other columns pass
through; a column of the output's name is replaced; repeated rows give equal results; texts and words of any
length are encoded whole, as the exact merge loop keeps a heap of pairs; no two merges tie, as ranks differ and
equal pairs merge from the left; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.common import list_array, slices, spread, texts, with_columns

#: Fixed value of the tokenizer's file format: how text is cut before merging.
CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Two white-space characters that touch.
TOUCHING = regex.compile(r"\s\s")

#: Fixed values of the file format: bytes that stand for themselves in the vocabulary's strings.
SELVES = [*range(33, 127), *range(161, 173), *range(174, 256)]

NEVER = np.iinfo(np.int64).max
#: Words and pieces of text whose ids a worker remembers; then it starts afresh. Bounds memory only.
REMEMBERED = 400_000
#: Bytes of a word beyond which it is merged alone, with a heap.
LONG = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary's strings, and back."""
    rest = iter(range(256, 512))
    selves = set(SELVES)
    return {chr(b if b in selves else next(rest)): b for b in range(256)}


class ByteBPE:
    """The tables of a tokenizer file and the memory of one worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        n = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * n
        for s, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in s)
        for s, i in self.added.items():
            self.bytes_of[i] = s.encode()
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs))
        self.n = n
        self.ranks = {(a, b): (r, m) for r, (a, b, m) in enumerate(pairs)}
        keys = left * n + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order
        # how each token is made: by the first merge that makes it
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int64)
        for r in range(len(pairs) - 1, -1, -1):
            self.left[made[r]], self.right[made[r]], self.rank[made[r]] = left[r], right[r], r
        self.spines = self._spine(self.right), self._spine(self.left)
        self.piece = {b: i for b, i in ((self.bytes_of[i], i) for i in vocab.values()) if len(b) == 1}
        cross = self._first_crossing(left, right)
        for r in np.flatnonzero(cross == np.arange(len(pairs))):  # tokens that their own bytes give back
            self.piece[self.bytes_of[made[r]]] = int(made[r])
        self.byte_id = np.array([self.piece[bytes([b])] for b in range(256)], np.int64)
        self.made = made
        self._trie()
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.forget()

    def forget(self) -> None:
        self.memory: tuple[dict[str, int], dict[str, int], dict[str, int]] = ({}, {}, {})
        self.ids, self.at, self.len = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known = 0

    def _trie(self) -> None:
        """The proposals' trie: sorted keys node * 256 + byte, the nodes they lead to, the tokens there."""
        nodes: dict[bytes, int] = {b"": 0}
        for b in sorted(self.piece):
            for k in range(1, len(b) + 1):
                nodes.setdefault(b[:k], len(nodes))
        keys = np.array([nodes[b[:-1]] * 256 + b[-1] for b in nodes if b], np.int64)
        order = np.argsort(keys)
        self.step_keys, self.step_to = keys[order], order + 1
        self.accepts = np.array([self.piece.get(b, -1) for b in nodes], np.int64)

    def _spine(self, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token the nodes of its outer edge from the byte upwards, and each one's step to the next."""
        levels = [np.arange(self.n)]
        while (down := np.where(levels[-1] >= 0, child[levels[-1]], -1)).max() >= 0:
            levels.append(down)
        depth = sum((x >= 0).astype(np.int64) for x in levels)
        nodes = np.stack([*levels, np.full(self.n, -1)], axis=1)
        col = depth[:, None] - 1 - np.arange(nodes.shape[1])[None, :]
        nodes = np.where(col >= 0, np.take_along_axis(nodes, np.maximum(col, 0), 1), -1)
        up = np.full_like(nodes, NEVER)
        up[:, :-1] = np.where(nodes[:, 1:] >= 0, self.rank[nodes[:, 1:]], NEVER)
        return nodes, up

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.n + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def _first_crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the first merge across the border of a and b, NEVER where there is none.

        The node at the border on either side grows as its merges come; a merge of the two wins if
        it comes before both (at equal rank the one further left is first).
        """
        (an, au), (bn, bu) = self.spines
        out = np.full(len(a), NEVER)
        live = np.arange(len(a))
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        while live.size:
            x, y = a[live], b[live]
            ta, tb = au[x, i[live]], bu[y, j[live]]
            cross = self._pair_rank(an[x, i[live]], bn[y, j[live]])
            hit = (cross < ta) & (cross <= tb) & (cross < NEVER)
            out[live[hit]] = cross[hit]
            on = ~hit & ((ta < NEVER) | (tb < NEVER))
            first = ta <= tb
            i[live[on & first]] += 1
            j[live[on & ~first]] += 1
            live = live[on]
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """Exact merging of one word with a heap: the lowest rank first, the leftmost of equals first."""
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r[0], k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := self.ranks.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, x, y = heapq.heappop(heap)
            j = after[k]
            if j >= n or ids[k] != x or ids[j] != y:
                continue
            ids[k], ids[j] = self.ranks[x, y][1], -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < n and (r := self.ranks.get((ids[left], ids[after[left]]))):
                    heapq.heappush(heap, (r[0], left, ids[left], ids[after[left]]))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Exact merging of many words at once: each round does every word's merge of lowest rank."""
        out = [np.zeros(0, np.int64)] * len(words)
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = np.array(self.merge_long(w), np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(words[k] for k in short), np.uint8)]
        owner = np.repeat(np.array(short, np.int64), [len(words[k]) for k in short])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while ids.size:
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            rank = np.full(len(ids), NEVER)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self._pair_rank(ids[same], ids[same + 1])
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.concatenate([first, [len(ids)]])))
            done.append((owner[least == NEVER], ids[least == NEVER]))
            hit = (rank == least) & (least < NEVER)
            run = np.flatnonzero(hit)
            # of hits in a row, as in aaaa, every second one counts
            head = np.concatenate([[True], (run[1:] != run[:-1] + 1) | (owner[run[1:]] != owner[run[:-1]])]) if run.size else run
            place = np.arange(len(run)) - np.maximum.accumulate(np.where(head, np.arange(len(run)), 0)) if run.size else run
            take = run[place % 2 == 0] if run.size else run
            ids[take] = self.made[rank[take]]
            keep = least < NEVER
            keep[take + 1] = False
            ids, owner = ids[keep], owner[keep]
        owner, ids = (np.concatenate(x) for x in zip(*done)) if done else (owner, ids)
        order = np.argsort(owner, kind="stable")
        ids = ids[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
        for k in short:
            out[k] = ids[ends[k] : ends[k + 1]]
        return out

    def greedy(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches of all words at once, by walks down the trie: their ids and numbers."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        lane = np.flatnonzero(end > start)
        at, stop = start[lane], end[lane]
        node, best, best_at = np.zeros(len(lane), np.int64), np.full(len(lane), -1), at.copy()
        padded = np.concatenate([data, np.zeros(1, data.dtype)])
        while lane.size:
            keys = node * 256 + padded[at]
            k = np.minimum(np.searchsorted(self.step_keys, keys), len(self.step_keys) - 1)
            on = (self.step_keys[k] == keys) & (at < stop)
            node = np.where(on, self.step_to[k], 0)
            at = at + on
            hit = on & (self.accepts[node] >= 0)
            best = np.where(hit, self.accepts[node], best)
            best_at = np.where(hit, at, best_at)
            if not on.all():
                found.append((lane[~on], best[~on]))
                at = np.where(on, at, best_at)
                live = on | (at < stop)
                lane, at, stop, node, best, best_at = (x[live] for x in (lane, at, stop, node, best, best_at))
        owner, ids = (np.concatenate(x) for x in zip(*found)) if found else (lane, best)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(start))

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Proposals, the check of every adjacent pair, and exact merging of the words that fail."""
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        start = np.concatenate([[0], end[:-1]]) if len(words) else end
        ids, lens = self.greedy(np.frombuffer(b"".join(words), np.uint8), start, end)
        owner = np.repeat(np.arange(len(words)), lens)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(ids[inner] * self.n + ids[inner + 1], return_inverse=True)
        fails = self._first_crossing(keys // self.n, keys % self.n) < NEVER
        bad = np.unique(owner[inner[fails[back]]])
        if bad.size:
            exact = self.merge([words[k] for k in bad])
            keep = np.ones(len(words), bool)
            keep[bad] = False
            starts = np.cumsum(lens) - lens
            flat = np.concatenate([ids, *exact])
            lens[bad] = [len(x) for x in exact]
            starts[bad] = len(ids) + np.cumsum(lens[bad]) - lens[bad]
            ids = flat[spread(starts, lens)]
        return ids, lens

    def learn(self, kind: int, keys: list[str]) -> None:
        """Remember the ids of pieces of text. Kinds: bare, after a space, after a line break."""
        lead = ("", " ", "\n")[kind]
        words = [CUT.findall(lead + k) for k in keys]
        distinct: dict[str, int] = {}
        which = np.array([distinct.setdefault(w, len(distinct)) for x in words for w in x], np.int64)
        ids, lens = self.encode_words([w.encode("utf-8", "surrogatepass") for w in distinct])
        per_word = lens[which]
        total = np.concatenate([[0], np.cumsum(per_word)])
        size = np.diff(total[np.concatenate([[0], np.cumsum([len(x) for x in words])])])
        flat = ids[spread((np.cumsum(lens) - lens)[which], per_word)].astype(np.int32)
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(size) - size])
        self.len = np.concatenate([self.len, size])
        self.ids = np.concatenate([self.ids, flat])
        self.memory[kind].update(zip(keys, range(self.known, self.known + len(keys))))
        self.known += len(keys)

    def pieces(self, text: str) -> tuple[list[str], list[tuple[int, list[str]]]]:
        """A text without added tokens as (kind, pieces) groups that can be encoded one by one.

        Cutting before a single space or line break that no other white space touches never changes
        what CUT finds; a text with touching ones is cut by CUT itself.
        """
        if TOUCHING.search(text):
            return [(0, CUT.findall(text))]
        groups = []
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            if k or first:
                groups.append((2 if k else 0, [first]))
            if rest:
                groups.append((1, rest))
        return groups

    def encode_plain(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As encode, but the strings of added tokens are ordinary text."""
        added, self.added, splitter, self.splitter = self.added, {}, self.splitter, None
        try:
            return self.encode(strings)
        finally:
            self.added, self.splitter = added, splitter

    def encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings one after the other, and how many each string has."""
        if self.known > REMEMBERED:
            self.forget()
        parts: list[list] = []
        for s in strings:
            own: list = []
            for k, x in enumerate(self.splitter.split(s) if self.splitter and any(a in s for a in self.added) else [s]):
                if k % 2:
                    own.append((-1, [x]))
                elif x:
                    own += self.pieces(x)
            parts.append(own)
        new: list[dict[str, None]] = [{}, {}, {}]
        for own in parts:
            for kind, keys in own:
                if kind >= 0:
                    memory, miss = self.memory[kind], new[kind]
                    for key in keys:
                        if key not in memory:
                            miss[key] = None
        for kind, miss in enumerate(new):
            if miss:
                self.learn(kind, list(miss))
        index: list[int] = []
        counts = []
        specials: list[tuple[int, int]] = []
        for own in parts:
            before = len(index)
            for kind, keys in own:
                if kind >= 0:
                    memory = self.memory[kind]
                    index += [memory[key] for key in keys]
                else:
                    specials.append((len(index), self.added[keys[0]]))
                    index.append(-1)
            counts.append(len(index) - before)
        at = np.array(index, np.int64)
        lens = np.where(at >= 0, self.len[at], 1)
        starts = np.where(at >= 0, self.at[at], 0)
        ids = self.ids[spread(starts, lens)]
        ends = np.cumsum(lens)
        for k, i in specials:
            ids[ends[k] - 1] = i
        total = np.concatenate([[0], ends])
        bounds = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
        return ids, np.diff(total[bounds])

    def decode(self, ids: np.ndarray, lens: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that aren't UTF-8 become U+FFFD."""
        sizes = self.sizes[ids]
        data = self.flat[spread(self.offsets[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lens)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode_batches(path: str, column: str = "text", out: str = "ids"):
    """Record batches with a column of ids added; for mapInArrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in slices(batches, column):
            ids, lens = bpe.encode(texts(batch, column))
            yield with_columns(batch, **{out: list_array(ids, lens)})

    return run


def decode_batches(path: str, column: str = "ids", out: str = "decoded"):
    """Record batches with a column of the ids' text added; for mapInArrow. Null ids: null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(column))
            lens = np.nan_to_num(pa.compute.list_value_length(col).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            strings = bpe.decode(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lens)
            null = col.is_null().to_pylist()
            yield with_columns(batch, **{out: pa.array([None if n else s for s, n in zip(strings, null)], pa.string())})

    return run


def _plus(df: DataFrame, **fields: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in fields]
    return T.StructType([*kept, *(T.StructField(k, v) for k, v in fields.items())])


def encode(df: DataFrame, path: str, column: str = "text", out: str = "ids") -> DataFrame:
    """df with the ids of a text column, as the tokenizers library gives without a template."""
    return df.mapInArrow(encode_batches(path, column, out), _plus(df, **{out: T.ArrayType(T.IntegerType())}))


def decode(df: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text of a column of ids, added tokens included."""
    return df.mapInArrow(decode_batches(path, column, out), _plus(df, **{out: T.StringType()}))


def encode_and_decode(df: DataFrame, path: str, column: str = "text") -> DataFrame:
    """df with both `ids` and `decoded`, in one pass through Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decode_batches(path)(encode_batches(path, column)(batches))

    return df.mapInArrow(run, _plus(df, ids=T.ArrayType(T.IntegerType()), decoded=T.StringType()))
