"""Token ids in binary files, packed by an adaptive context-mixing range coder.

A file holds the ids of consecutive documents, cut into blocks of equal numbers of ids. Every
block is coded by itself, and a CRC-32 of its ids guards it, so blocks can be read, checked and
lost one by one. Three predictors work together: order-2 and order-1 contexts each recall the id
that mostly follows and how often that holds, and the order-0 model knows how often each id occurs.
They are learnt from all of a file's ids, which are at hand when it is written, and stand in its
index. How far recollections of each confidence are trusted adapts from id to id, anew in every
block. Their mix splits the range coder's interval; what no context foresaw is coded by the order-0 model.

All blocks of a group advance in step, one id at a time, each on a lane of arrays, so Python runs
per step and not per id.

File: magic, block length, counts of documents, ids and blocks (little-endian); then, deflated,
the documents' numbers (int64) and sizes (uint32), the blocks' word counts and CRCs (uint32) and what
the predictors know (uint32); then the blocks' code words (uint16). Ids must be below 65,536.

Defined results: null text counts as empty and gives the end id alone; documents with equal numbers
stay side by side, in the order of their texts; null numbers come first; a text of any length is encoded
whole; other columns are left out; an empty table gives no file and no rows; an id of 65,536 or more is an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import AtomicFile, filesystem, list_array, scratch, slices, spread, stash

MAGIC = b"IDMIX2\0\0"
HEAD = struct.Struct("<8sIIQI")
BLOCK = 1024
LANES = 8192
#: Ids after which a task begins a new file. Bounds memory.
FILE = LANES * BLOCK
#: Most entries of the tables that recall an id by its order-1 and order-2 context.
ONE, TWO = 1 << 12, 1 << 15
#: Ids looked at for an entry: of all that follow its context, then of those that the first one isn't.
ROUNDS = 2
#: Ids that the file can hold.
LIMIT = 1 << 16
#: Width of the interval that the predictors share, in bits, and most bits of the order-0 model's scale.
MIX, FINE = 12, 18
FULL = 1 << MIX
NULL = -(2**63)
#: Bytes of text whose stretches are told apart at a time.
PORTION = 8_000_000

_U = np.uint64
_ONE, _16, _48 = _U(1), _U(16), _U(48)
_LOW32 = _U(2**32 - 1)
#: A range below this is widened.
_LEAST = _U(1 << 32)
#: The least share of its context's ids that a recollection of each confidence foresees, and the trust, of 65,536, to begin with.
_LEVELS = np.array([0, 0.06, 0.12, 0.25, 0.4, 0.6, 0.8, 0.95])
_TRUST = (np.array([0, 0.08, 0.17, 0.3, 0.48, 0.68, 0.85, 0.875]) * 65536).astype(np.int64)


def _slots(one: np.ndarray, two: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the order-2 and order-1 tables for the ids before, the nearer first."""
    h = one * 40503
    return (h + two * 9973 >> 3) & (sizes[0] - 1), (h >> 2) & (sizes[1] - 1)


def _recalled(slots: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """For every slot the id that follows it most often of those looked at, times 8, plus a confidence."""
    total = np.bincount(slots, minlength=size)
    best, most = np.full(size, LIMIT, np.int64), np.zeros(size, np.int64)
    for k in range(ROUNDS):
        seen = np.full(size, LIMIT, np.uint32)
        seen[slots] = ids
        hit = seen.take(slots) == ids
        count = np.bincount(slots[hit], minlength=size)
        best, most = np.where(count > most, seen, best), np.maximum(count, most)
        if k + 1 < ROUNDS:
            slots, ids = slots[~hit], ids[~hit]
    conf = np.where(most > 2, np.searchsorted(_LEVELS, most / np.maximum(total, 1), "right") - 1, 0)
    return np.where(conf > 0, best * 8 + conf, LIMIT * 8)


class Statistics:
    """What a file's blocks have in common: how often ids occur, and which id mostly follows one or two others."""

    def __init__(self, freq: np.ndarray, two: np.ndarray, one: np.ndarray):
        self.freq, self.start, self.tables = freq, np.cumsum(freq) - freq, (two, one)
        self.sizes = (len(two), len(one))
        self.scale = int(freq.sum()).bit_length() - 1
        self.at = np.repeat(np.arange(LIMIT, dtype=np.uint16), freq)

    @classmethod
    def of(cls, blocks: np.ndarray) -> Statistics:
        flat = blocks.reshape(-1)
        count = np.bincount(flat, minlength=LIMIT)
        distinct = int(np.count_nonzero(count))
        scale = 1 << min(FINE, distinct.bit_length() + 4)
        freq = (count > 0) + count * (scale - distinct) // len(flat)
        freq[freq.argmax()] += scale - freq.sum()
        before = np.zeros((len(blocks), blocks.shape[1] + 2), np.uint32)
        before[:, 2:] = blocks
        most = 1 << max(6, (len(flat) // 64).bit_length())
        sizes = min(TWO, most), min(ONE, most)
        slots = _slots(before[:, 1:-1].reshape(-1), before[:, :-2].reshape(-1), sizes)
        return cls(freq, *(_recalled(s.astype(np.int64), flat, n) for s, n in zip(slots, sizes)))

    def pack(self) -> bytes:
        """All numbers' lowest bytes, then the next ones: they deflate better so."""
        numbers = np.concatenate([self.freq, *self.tables]).astype("<u4")
        return struct.pack("<II", *self.sizes) + numbers.view(np.uint8).reshape(-1, 4).T.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Statistics:
        two, _ = struct.unpack_from("<II", data)
        numbers = np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=8).reshape(4, -1).T).view("<u4").reshape(-1)
        return cls(*np.split(numbers.astype(np.int64), [LIMIT, LIMIT + two]))


class _Mix:
    """The predictors of a group of blocks, one block a lane, and how far each lane trusts them.

    A table's entry is the recalled id times 8 plus a confidence from 0 (nothing recalled: no id equals LIMIT) to 7;
    how often recollections of a confidence hold is learnt anew in every block.
    """

    def __init__(self, known: Statistics, lanes: int):
        self.known = known
        self.states = np.arange(lanes) * 8
        self.trust = (np.tile(_TRUST, lanes), np.tile(_TRUST, lanes))
        self.one, self.two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recalled ids of order 2 and 1 and the widths, of FULL, that they get."""
        e2, e1 = (t.take(s) for t, s in zip(self.known.tables, _slots(self.one, self.two, self.known.sizes)))
        self.foreseen = (e2 >> 3, e1 >> 3)
        self.at = (self.states + (e2 & 7), self.states + (e1 & 7))
        # a recollection of confidence 0 has no share; the trust in it never moves
        self.shares = (self.trust[0].take(self.at[0]), self.trust[1].take(self.at[1]))
        q2, q1 = self.shares[0] >> 4, self.shares[1] >> 4
        rest = (FULL - q2) * q1 >> MIX
        same = self.foreseen[0] == self.foreseen[1]
        return (*self.foreseen, np.minimum(q2 + rest * same, FULL * 31 // 32), rest * ~same)

    def update(self, ids: np.ndarray) -> None:
        for k in (0, 1):
            # shares stay below 7/8 of the interval and above nothing
            goal = (self.foreseen[k] == ids) * np.int64(57344)
            self.trust[k][self.at[k]] = self.shares[k] + ((goal - self.shares[k]) >> 5)
        self.one, self.two = ids, self.one


def _settle(lo: np.ndarray, r: np.ndarray, move) -> None:
    """Shift out the top 16 bits of every lane whose range got too small."""
    small = r < _LEAST
    whole = True
    while small.any():
        # a range across a border of the top 16 bits is cut at the border
        across = small & ((lo ^ (lo + r)) >= _U(1 << 48))
        if across.any():
            r[across] = (~lo[across] + _ONE) & _LOW32
        if whole:
            by = small.astype(_U) << _U(4)
            move(slice(None), lo, small)
            lo <<= by
            r <<= by
        else:
            who = np.flatnonzero(small)
            move(who, lo[who], small[who])
            lo[who] <<= _16
            r[who] <<= _16
        whole = False
        small = r < _LEAST


def encode_blocks(blocks: np.ndarray, known: Statistics) -> list[np.ndarray]:
    """Code words (uint16) of every row of blocks."""
    lanes, n = blocks.shape
    model = _Mix(known, lanes)
    lane, scale = np.arange(lanes), known.scale
    lo, r = np.zeros(lanes, _U), np.full(lanes, _U(2**64 - 1))
    # a column for each lane: lanes advance about alike, so what they touch lies close together
    out = np.zeros((4 * n + 8, lanes), np.uint16)
    flat, place = out.reshape(-1), lane.copy()

    def move(who, low: np.ndarray, on: np.ndarray) -> None:
        # a word that isn't on is overwritten by the next
        at = place[who]
        flat[at] = low >> _48
        place[who] = at + on.astype(np.int64) * lanes

    for ids in np.ascontiguousarray(blocks.T):
        ids = ids.astype(np.int64)
        k2, k1, two, one = model.predict()
        hit2 = (k2 == ids) & (two > 0)
        hit1 = (k1 == ids) & (one > 0) & ~hit2
        base = two + one
        left = FULL - base
        start = np.where(hit2, 0, np.where(hit1, two << scale, (base << scale) + left * known.start.take(ids)))
        freq = np.where(hit2, two << scale, np.where(hit1, one << scale, left * known.freq.take(ids)))
        r >>= _U(MIX + scale)
        lo += r * start.view(_U)
        r *= freq.view(_U)
        _settle(lo, r, move)
        model.update(ids)
    used = (place - lane) // lanes
    for k in range(4):
        out[used + k, lane] = (lo >> _U(48 - 16 * k)).astype(np.uint16)
    rows = np.ascontiguousarray(out[: used.max() + 4].T)
    return [rows[k, : used[k] + 4] for k in range(lanes)]


def decode_blocks(words: list[np.ndarray], n: int, known: Statistics) -> np.ndarray:
    """The blocks of encode_blocks, each of n ids."""
    lanes = len(words)
    model = _Mix(known, lanes)
    lane, scale = np.arange(lanes), known.scale
    width = max(map(len, words)) + 4
    data = np.zeros((lanes, width), np.uint16)
    for k, w in enumerate(words):
        data[k, : len(w)] = w
    lo, r = np.zeros(lanes, _U), np.full(lanes, _U(2**64 - 1))
    code = np.zeros(lanes, _U)
    for k in range(4):
        code = code << _16 | data[:, k]
    flat, cursor = np.ascontiguousarray(data.T).reshape(-1), lane + 4 * lanes
    last = lane + (width - 1) * lanes
    out = np.zeros((n, lanes), np.uint16)

    def move(who, _: np.ndarray, on: np.ndarray) -> None:
        at = cursor[who]
        code[who] = np.where(on, code[who] << _16 | flat.take(at), code[who])
        cursor[who] = np.minimum(at + on.astype(np.int64) * lanes, last[who])

    for i in range(n):
        k2, k1, two, one = model.predict()
        r >>= _U(MIX + scale)
        value = np.minimum((code - lo) // r, _U((1 << MIX + scale) - 1)).view(np.int64)
        top = value >> scale
        base = two + one
        left = FULL - base
        hit2, miss = top < two, top >= base
        # as floats the quotient is exact: both numbers are below 2**31
        place = (np.maximum(value - (base << scale), 0) / left).astype(np.int64)
        other = known.at.take(place).astype(np.int64)
        ids = np.where(hit2, k2, np.where(miss, other, k1))
        start = np.where(hit2, 0, np.where(miss, (base << scale) + left * known.start.take(other), two << scale))
        freq = np.where(hit2, two << scale, np.where(miss, left * known.freq.take(other), one << scale))
        lo += r * start.view(_U)
        r *= freq.view(_U)
        _settle(lo, r, move)
        out[i] = ids
        model.update(ids)
    return out.T


def block_length(total: int) -> int:
    """A power of two that leaves at least 64 blocks where there are that many ids, up to BLOCK."""
    return min(BLOCK, max(64, 1 << max(0, (total // 64).bit_length())))


def checked(ids: np.ndarray) -> np.ndarray:
    """ids as 16-bit numbers; ValueError if one doesn't fit."""
    if len(ids) and (ids.max() >= LIMIT or ids.min() < 0):
        raise ValueError(f"ids must be below {LIMIT}")
    return ids.astype(np.uint16)


def _groups(count: int) -> list[tuple[int, int]]:
    """First and last places of groups of blocks, alike in size, that advance together."""
    parts = max(1, -(-count // LANES))
    edges = [count * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:])) if count else []


def pack(docs: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> bytes:
    """A file image of documents' numbers, sizes and ids. The last block is filled up with id 0."""
    length = block_length(len(ids))
    count = -(-len(ids) // length)
    blocks = np.zeros((count, length), np.uint16)
    blocks.reshape(-1)[: len(ids)] = checked(ids)
    words: list[np.ndarray] = []
    known = Statistics.of(blocks) if count else None
    for a, b in _groups(count):
        words += encode_blocks(blocks[a:b], known)
    crcs = [zlib.crc32(b.astype("<u4")) for b in blocks]
    index = docs.astype("<i8").tobytes() + lens.astype("<u4").tobytes() + np.array([len(w) for w in words], "<u4").tobytes() + np.array(crcs, "<u4").tobytes()
    index = zlib.compress(index + (known.pack() if known else b""))
    head = HEAD.pack(MAGIC, length, len(docs), len(ids), count)
    return head + struct.pack("<I", len(index)) + index + b"".join(w.astype("<u2").tobytes() for w in words)


def unpack(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' numbers, sizes and ids of a file image; ValueError if a block is damaged."""
    magic, length, n, total, count = HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a file of ids")
    (size,) = struct.unpack_from("<I", image, HEAD.size)
    at = HEAD.size + 4
    index = zlib.decompress(image[at : at + size])
    docs, lens = np.frombuffer(index, "<i8", n), np.frombuffer(index, "<u4", n, 8 * n)
    lengths, crcs = np.frombuffer(index, "<u4", count, 12 * n), np.frombuffer(index, "<u4", count, 12 * n + 4 * count)
    known = Statistics.unpack(index[12 * n + 8 * count :]) if count else None
    data = np.frombuffer(image, "<u2", offset=at + size)
    ends = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    parts = []
    for a, b in _groups(count):
        got = decode_blocks([data[ends[k] : ends[k + 1]] for k in range(a, b)], length, known).astype("<u4", order="C")
        for k, block in enumerate(got, a):
            if zlib.crc32(block) != crcs[k]:
                raise ValueError(f"block {k} is damaged")
        parts.append(got.reshape(-1))
    return docs, lens.astype(np.int64), np.concatenate(parts)[:total] if parts else np.zeros(0, np.uint32)


class _Memory(dict):
    """Numbers for texts in order of first sight, and the ids of each; `new` lists those still to be encoded."""

    def __init__(self):
        self.new: list[str] = []
        self.ids, self.at, self.len = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        number = self[key] = len(self)
        return number

    def numbers(self, strings: pa.StringArray, library: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The numbers of strings, after the library has encoded those that are new."""
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        if self.new:
            ids, lens = library(self.new)
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(lens) - lens])
            self.len = np.concatenate([self.len, lens])
            self.ids = np.concatenate([self.ids, ids])
            self.new = []
        return found[coded.indices.to_numpy()]


class Chunks:
    """Encodes with the tokenizers library, asking it once for each distinct stretch between blanks.

    Blanks part tokens in this kind of tokenizer file (it drops white space), so the ids of a text
    are the ids of its stretches. Likewise marks before and after a stretch of Latin letters part from
    them, and the case of such letters is dropped; an apostrophe before letters may go with them, so it
    doesn't count as such a mark. These letters and marks have nothing to normalise, and each of them is one piece
    to the tokenizer file, so the library gets them by the thousand, parted by blanks, and only its merges
    are run; the ids that end a piece tell where the next one begins. All else, such as a stretch with one of the
    file's added tokens, goes through the file's own rules.
    """

    #: Stretches that a worker remembers; then it starts afresh. Bounds memory only.
    REMEMBERED = 1_000_000
    #: Letters A to Z and those of U+00C0 to U+017F but U+0130, whose small form has two characters.
    PLAIN = r"^(?P<head>[!-&(-/:-@\[-`{-~]*)(?P<word>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library, self.merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        for t in (self.library, self.merges):
            t.no_truncation()
            t.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for w, k in vocabulary.items() if w.endswith(self.END)]] = True
        self.forget()

    def forget(self) -> None:
        self.memory = _Memory()

    def _whole(self, strings: list[str], library=None) -> tuple[np.ndarray, np.ndarray]:
        coded = [e.ids for e in (library or self.library).encode_batch_fast(strings, add_special_tokens=False)]
        lens = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter(chain.from_iterable(coded), np.int32, int(lens.sum())), lens

    def _pieces(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        filled = [s for s in strings if s]
        ids, _ = self._whole([" ".join(filled[a : a + 1000]) for a in range(0, len(filled), 1000)], self.merges)
        bounds = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(bounds) != len(filled) + 1 or bounds[-1] != len(ids):
            return self._whole(strings)  # not a file whose pieces end in ids of their own
        lens = np.zeros(len(strings), np.int64)
        lens[np.fromiter(map(bool, strings), bool, len(strings))] = np.diff(bounds)
        return ids, lens

    def _stretches(self, strings: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        parts = pa.compute.extract_regex(strings, self.PLAIN)
        plain = parts.is_valid()
        for token in self.added:
            plain = pa.compute.and_not(plain, pa.compute.match_substring(strings, token))
        head, word, tail = (parts.field(k).filter(plain) for k in range(3))
        which, on = np.zeros((len(strings), 3), np.int64), plain.to_numpy(zero_copy_only=False)
        for k, piece in enumerate((head, pa.compute.utf8_lower(word), tail)):
            which[on, k] = self.memory.numbers(piece, self._pieces)
        which[~on, 1] = self.memory.numbers(strings.filter(pa.compute.invert(plain)), self._whole)
        which[~on, ::2] = self.memory.numbers(pa.array([""]), self._whole)
        return self.of(which.reshape(-1)), self.memory.len[which].sum(axis=1)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self.memory.ids[spread(self.memory.at[numbers], self.memory.len[numbers])]

    def encode(self, strings: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings, one after the other, and how many each has; null counts as empty."""
        if len(self.memory) > self.REMEMBERED:
            self.forget()
        parts = pa.compute.ascii_split_whitespace(strings.fill_null(""))
        coded = parts.flatten().dictionary_encode()
        ids, lens = self._stretches(coded.dictionary)
        which = coded.indices.to_numpy()
        sizes = lens[which]
        total = np.concatenate([[0], np.cumsum(sizes)])
        bounds = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy())]).astype(np.int64)
        return ids[spread((np.cumsum(lens) - lens)[which], sizes)], np.diff(total[bounds])


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Chunks(path)


def write_ids(df: DataFrame, key: str, column: str, path: str, folder: str, end_id: int | None, most: int = FILE) -> DataFrame:
    """Write the ids of a text column in ascending order of key, in files of about `most` ids or fewer for each sorted partition.

    Returns the files: `file`, `first` (its first key), `n_docs`, `n_ids`; one row each. Names ascend with keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = (f"{folder}/ids-{TaskContext.get().partitionId():06d}-{k:06d}.bin" for k in count())

        def written() -> pa.RecordBatch:
            docs, lens, ids = map(np.concatenate, zip(*held))
            held.clear()
            name = next(names)
            with AtomicFile(name) as out:
                out.write(pack(docs, lens, ids))
            return pa.RecordBatch.from_pydict({"file": [name], "first": [int(docs[0])], "n_docs": [len(docs)], "n_ids": [len(ids)]})

        for batch in slices(batches, column, min(PORTION, most)):
            got, n = chunks(path).encode(batch.column(batch.schema.get_field_index(column)))
            if end_id is not None:
                ends = np.cumsum(n)
                got = np.insert(got, ends, end_id)
                n = n + 1
            numbers = batch.column(batch.schema.get_field_index(key))
            held.append((pa.compute.fill_null(numbers, NULL).to_numpy(zero_copy_only=False).astype(np.int64), n, checked(got)))
            if sum(len(ids) for *_, ids in held) >= most:
                yield written()
        if held:
            yield written()

    order = [F.col(key).asc_nulls_first(), F.col(column).asc_nulls_first()]
    ordered = df.select(key, column).repartitionByRange(order[0]).sortWithinPartitions(*order)
    return stash(ordered.mapInArrow(run, "file string, first long, n_docs long, n_ids long"), "idfiles")


def read_ids(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """`doc_id`, `start` (ids of all documents before it), `n_tokens`, `ids` and their CRC-32.

    The driver sees one row for each file; the tasks read the files.
    """
    rows = files.orderBy("first", "file").collect()
    starts = np.concatenate([[0], np.cumsum([r.n_ids for r in rows], dtype=np.int64)])
    spark = files.sparkSession
    # a task for each file
    files = spark.sparkContext.parallelize([(r.file, int(s)) for r, s in zip(rows, starts)], max(1, len(rows)))
    listed = spark.createDataFrame(files, "file string, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = filesystem(file)
                with fs.open_input_stream(path) as f:
                    docs, lens, ids = unpack(f.read())
                before = np.cumsum(lens) - lens
                step = max(1, int(1_000_000 // max(1, lens.mean())))
                for a in range(0, len(docs), step):
                    own = slice(a, a + step)
                    some = ids[before[a] : before[a] + lens[own].sum()].astype(np.int32)
                    numbers = pa.array(docs[own], pa.int64(), mask=docs[own] == NULL)
                    raw, ends = some.astype("<u4").tobytes(), np.cumsum(lens[own]) * 4
                    crc = [zlib.crc32(raw[x - 4 * n : x]) for x, n in zip(ends.tolist(), lens[own].tolist())]
                    new = [numbers, pa.array(base + before[own]), pa.array(lens[own]), pa.array(crc, pa.int64())]
                    if with_ids:
                        new.append(list_array(some, lens[own]))
                    yield pa.RecordBatch.from_arrays(new, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(new)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return listed.mapInArrow(run, schema)


def folder(spark) -> str:
    return scratch(spark, "ids")
