"""N-gram Jaccard join as a blocked sparse matrix product.

A row of the incidence matrix is a document's set of word n-grams, a column an n-gram. The product of
the matrix with its transpose counts overlaps; only cells that could reach the bound are computed, and
they are computed in blocks of columns (ranges of n-gram hashes): after every block, a cell whose count so
far and what its two rows still hold can't reach the overlap that their sizes ask for is discarded.

Which cells those are is found from compound columns, which join several n-grams, so that rows that
merely share a passage make no cells. Rows that agree in a compound column form a list.

* By default a row's n-grams are dealt into blocks, by hash. Two sets of x and y n-grams at Jaccard
  similarity t or more differ in at most (x + y)(1 - t)/(1 + t) n-grams; with a few blocks more than that,
  they agree in some whole block, whose fingerprint is the compound column. The number of blocks depends on
  the larger size, so rows are told once for the band of sizes they lie in and once for the next one. Exact.
* Where the bound is low blocks hold few n-grams, and there are many. With `sampled`, a compound column
  is made of the first n-grams in a few hash orders. Each agrees with the chance t at least, and there are
  so many columns that the chance of missing a pair at the bound is below 2**-64, that of two equal hashes.

Equal sets form classes first, and one row stands for each. Links are needed up to connectivity only: in
each list, every row is compared with the list's smallest row. Lists whose other rows still lie in several
components then form clusters, whose rows are multiplied with each other tile by tile. Every pair
that could matter is compared, no list of copies is multiplied out, and only links leave a tile. A row with
very many others to compare has them dealt to several groups.

Defined results: words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; a document with 1 to n - 1
words has its whole sequence as its one n-gram; one without words or with null text has an empty set,
links with nothing and is its own component; repeated rows with one number count once, and of different
texts under one number the one of the smallest set (then hash) counts; texts of any length are taken whole;
ties don't arise, as a component is named by its smallest number; extra columns are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import groups_of, hash_words, list_array, local_roots, mix, slices, spread, stash, texts
from millrace.llm.components import components

#: Rows of a cluster, or others of one row, that meet in one group: two pieces at most, about.
PIECE = 256
#: Blocks beyond the bound: a row needs as many empty blocks before empty ones have to be told.
SPARE = 3
#: Blocks of columns of a product, and bytes of text that a task turns into n-grams at once.
COLUMNS, TEXT = 8, 1_000_000
#: Tables of at most so many rows of a few numbers each are broadcast; larger ones are joined by a shuffle.
BROADCAST = 1_000_000
_U = np.uint64


def gram_sets(strings: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes, by document then hash, and each document's number of them."""
    word, doc, _, _ = hash_words(strings)
    words = np.bincount(doc, minlength=len(strings))
    last = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1]) if len(doc) >= n else np.zeros(0, np.int64)
    gram = np.zeros(len(last), _U)
    for k in range(n):
        gram = mix(gram * _U(3) + word[last + k] + _U(k))
    owner = doc[last]
    short = np.flatnonzero((words > 0) & (words < n))
    if short.size:
        start = np.cumsum(words) - words
        one = np.zeros(len(short), _U)
        for k in range(n - 1):
            on = words[short] > k
            one[on] = mix(one[on] * _U(3) + word[(start[short] + k)[on]] + _U(k))
        one = mix(one ^ words[short].astype(_U) * _U(0xC2B2AE3D27D4EB4F))
        gram, owner = np.concatenate([gram, one]), np.concatenate([owner, short])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[new], np.bincount(owner[new], minlength=len(strings))


def sets_of(strings: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """gram_sets of any number of texts, by portions, so that what is held beside the result is bounded."""
    ends = np.cumsum([len(s) for s in strings]) // TEXT
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(strings)]
    parts = [gram_sets(strings[a:b], n) for a, b in zip(cuts, cuts[1:])]
    return np.concatenate([g for g, _ in parts]), np.concatenate([s for _, s in parts])


def set_names(gram: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes that name each set."""
    start = np.cumsum(size) - size
    names = []
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(gram ^ _U(salt)), dtype=_U)])
        names.append((sums[start + size] - sums[start]).view(np.int64))
    return names[0], names[1]


class Bands:
    """Bands of set sizes, and how many blocks the rows of a band and of the one below share.

    similarity: per cent.
    """

    def __init__(self, similarity: int):
        self.similarity = similarity
        self.edges = np.array([1, 2], np.int64)

    def _grow(self, size: int) -> None:
        edges = self.edges.tolist()
        while edges[-2] <= size:
            # sizes similar to the last of the band before end before the next edge
            edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // self.similarity + 1))
        self.edges = np.array(edges, np.int64)

    def of(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each size's band, and the blocks of that band and of the next."""
        if size.size:
            # up to the end of the band after the largest size's, however often sizes are asked for
            self._grow(int(size.max()))
        band = np.searchsorted(self.edges, size, side="right") - 1
        return band, self.blocks(band), self.blocks(band + 1)

    def bound(self, band: np.ndarray) -> np.ndarray:
        """The most n-grams in which two similar sets below the band's end differ."""
        return 2 * (self.edges[band + 1] - 1) * (100 - self.similarity) // (100 + self.similarity)

    def blocks(self, band: np.ndarray) -> np.ndarray:
        bound = self.bound(band)
        return np.where(bound == 0, 1, bound + SPARE)


def fingerprints(gram: np.ndarray, size: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(document number, fingerprint) of every block that has to be told, for both bands."""
    owner = np.repeat(np.arange(len(size)), size)
    docs, prints = [], []
    full = np.flatnonzero(size > 0)
    band, *counts = bands.of(size[full])
    for step, blocks in enumerate(counts):
        per_doc = np.zeros(len(size), np.int64)
        per_doc[full] = blocks
        where = np.zeros(len(size), np.int64)
        where[full] = band + step
        # hashes are sorted within a document, so the blocks of equal ranges are runs
        block = ((gram >> _U(32)) * per_doc[owner].astype(_U)) >> _U(32)
        head = np.ones(len(gram), bool)
        head[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(head)
        if not first.size:
            continue
        total = np.add.reduceat(mix(gram ^ _U(0x9E6C63D0876A9A47)), first)
        run_doc, run_block = owner[first], block[first]
        name = mix(where[run_doc].astype(_U) * _U(0x9E3779B97F4A7C15) + run_block)
        docs.append(run_doc)
        prints.append(mix(total ^ name))
        # empty blocks count only where so many are empty that all agreeing blocks might be
        told = np.bincount(run_doc, minlength=len(size))
        for d in np.flatnonzero((per_doc > 1) & (per_doc - told >= SPARE)):
            empty = np.setdiff1d(np.arange(per_doc[d], dtype=_U), run_block[run_doc == d])
            docs.append(np.full(len(empty), d))
            prints.append(mix(mix(where[d : d + 1].astype(_U) * _U(0x9E3779B97F4A7C15) + empty) ^ _U(0xE7037ED1A0B428DB)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(docs), np.concatenate(prints)


def sample_plan(similarity: int) -> tuple[int, int]:
    """How many n-grams a sampled compound column joins, and how many columns a row has."""
    t = similarity / 100
    width = max(1, round(-1 / math.log(t))) if t < 1 else 1
    return width, math.ceil(64 * math.log(2) / -math.log1p(-(t**width))) if t < 1 else 1


def sampled_columns(gram: np.ndarray, size: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, name) of every compound column that joins the first n-grams in some hash orders."""
    full = np.flatnonzero(size > 0)
    if not full.size:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    start = (np.cumsum(size) - size)[full]
    short = (gram >> _U(32)).astype(np.uint32)
    width, count = sample_plan(similarity)
    rng = np.random.default_rng(23)
    salts, factors = rng.integers(0, 2**32, (2, count, width), dtype=np.uint32)
    names = np.empty((count, len(full)), _U)
    for k in range(count):
        name = np.full(len(full), k, _U)
        for salt, factor in zip(salts[k], factors[k] | np.uint32(1)):
            name = mix(name * _U(0x9E3779B97F4A7C15) + np.minimum.reduceat((short ^ salt) * factor, start))
        names[k] = name
    return np.tile(full, count), names.ravel()


def _rows(n: int, similarity: int, sampled: bool):
    """Per document: its set's size, two hashes that name the set, and its compound columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(similarity)
        for batch in slices(batches, "text", TEXT):
            gram, size = gram_sets(texts(batch, "text"), n)
            names = set_names(gram, size)
            doc, prints = sampled_columns(gram, size, similarity) if sampled else fingerprints(gram, size, bands)
            order = np.argsort(doc, kind="stable")
            per = np.bincount(doc, minlength=len(size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), *map(pa.array, names), list_array(prints[order].view(np.int64), per)], names=["id", "n", "s1", "s2", "prints"])

    return run


def meet(df: DataFrame, key: str, few: DataFrame, other: str, how: str) -> DataFrame:
    """df joined on a number with a written table, which is broadcast only if it has at most BROADCAST rows."""
    return df.join(F.broadcast(few) if few.count() <= BROADCAST else few, F.col(key) == F.col(other), how)


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """df without the rows of some numbers (a written table); rows whose key is null stay."""
    return meet(df, key, ids.select(F.col(key).alias("_gone")), "_gone", "left_anti")


def reach(gram: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: int) -> np.ndarray:
    """Which cells (left, right) of the product of an incidence matrix with its transpose reach the bound.

    gram: sorted in each row. Cells are counted by blocks of columns, and given up as soon as they can't reach
    the overlap that the sizes of their rows ask for.
    """
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    block = (gram >> _U(64 - COLUMNS.bit_length() + 1)).astype(np.int64)
    per = np.bincount(owner * COLUMNS + block, minlength=len(size) * COLUMNS).reshape(-1, COLUMNS)
    x, y = size[left], size[right]
    need = np.maximum(1, -(-similarity * (x + y) // (100 + similarity)))
    cells = np.flatnonzero(np.minimum(x, y) >= need)
    shared = np.zeros(len(left), np.int64)
    rest_x, rest_y = x.copy(), y.copy()
    at = start.copy()
    for c in range(COLUMNS):
        if not cells.size:
            break
        rows = np.unique(left[cells])
        # entries of the left rows, named by row and column
        entries = np.sort(gram[spread(at[rows], per[rows, c])] ^ np.repeat(rows, per[rows, c]).astype(_U) * _U(0x9E3779B97F4A7C15))
        many = per[right[cells], c]
        mine = np.repeat(np.arange(len(cells)), many)
        asked = gram[spread(at[right[cells]], many)] ^ left[cells][mine].astype(_U) * _U(0x9E3779B97F4A7C15)
        if len(entries):
            place = np.minimum(np.searchsorted(entries, asked), len(entries) - 1)
            shared[cells] += np.bincount(mine[entries[place] == asked], minlength=len(cells))
        rest_x[cells] -= per[left[cells], c]
        rest_y[cells] -= many
        cells = cells[shared[cells] + np.minimum(rest_x[cells], rest_y[cells]) >= need[cells]]
        at += per[:, c]
    out = np.zeros(len(left), bool)
    out[cells] = True
    return out


def _similar(pairs: DataFrame, near: DataFrame, n: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose n-gram sets are similar enough.

    The others of each row a meet it in groups of about PIECE, so its text is read once a group.
    """
    pairs = stash(pairs, "pairs")
    key = lambda c: F.col(c).bitwiseXOR(F.lit(1))  # noqa: E731  exchanges of their own, which Spark can split at a hot row
    pieces = pairs.groupBy("a").agg(F.count("*").alias("m")).filter(F.col("m") > PIECE).select(key("a").alias("k"), F.ceil(F.col("m") / PIECE).alias("pieces"))
    cut = pairs.join(pieces, key("a") == F.col("k"), "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), "pieces"), F.lit(0)).alias("piece"))
    cut = stash(cut, "cut")
    hubs = cut.select("a", "piece").distinct().join(near, F.col("a") == F.col("id"))
    both = hubs.unionByName(cut.join(near, F.col("b") == F.col("id")).drop("b"))
    both = both.repartition("a", "piece").sortWithinPartitions("a", "piece", F.col("a") != F.col("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub: tuple[int, int, str] | None = None
        for batch in slices(batches, "text", TEXT):
            a, piece, ids, s1 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("a", "piece", "id", "s1"))
            strings = texts(batch, "text")
            is_hub = a == ids
            told = hub is not None and not is_hub[0] and (a[0], piece[0]) == hub[:2]
            gram, size = gram_sets(([hub[2]] if told else []) + strings, n)
            # rows of a number's other texts don't count
            valid = set_names(gram, size)[0][told:] == s1
            at = np.maximum.accumulate(np.concatenate([[0 if told else -1], np.where(is_hub & valid, np.arange(len(a)) + told, -1)]))[1:]
            who = np.flatnonzero(~is_hub & valid & (at >= 0))
            of = np.concatenate([[hub[0]], a] if told else [a])
            who = who[of[at[who]] == a[who]]
            hit = who[reach(gram, size, at[who], who + told, similarity)]
            yield pa.RecordBatch.from_arrays([pa.array(a[hit]), pa.array(ids[hit])], names=["a", "b"])
            last = np.flatnonzero(is_hub & valid)
            if last.size:
                hub = (a[last[-1]], piece[last[-1]], strings[last[-1]])

    return both.mapInArrow(run, "a long, b long")


def _products(rows: DataFrame, n: int, similarity: int) -> DataFrame:
    """Links (a, b) within each cluster that keep its connectivity, by tiles of the matrix times their transposes.

    rows: id, cluster, text, s1. A cluster is cut into pieces; each pair of pieces is a group of its own, so
    what a task holds is bounded and a large cluster spreads over many tasks.
    """
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("m")).select(F.col("cluster").alias("c"), F.ceil(F.col("m") / PIECE).cast("int").alias("pieces"))
    others = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda p: F.struct(F.least(p, F.col("piece")).alias("low"), F.greatest(p, F.col("piece")).alias("high")))
    cut = rows.join(sizes, F.col("cluster") == F.col("c")).withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    met = cut.select("cluster", "id", "piece", "text", "s1", F.explode(others).alias("m")).select("cluster", "m.low", "m.high", "piece", "id", "text", "s1")
    met = met.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["cluster", "low", "high"], 2_000):
            if group.num_rows < 2:
                continue
            ids, side = group.column("id").to_numpy(), group.column("piece").to_numpy()
            gram, size = sets_of([s or "" for s in group.column("text").to_pylist()], n)
            valid = set_names(gram, size)[0] == group.column("s1").to_numpy()
            linked = _tile(gram, size, similarity) & valid[:, None] & valid[None, :]
            if group.column("low")[0].as_py() != group.column("high")[0].as_py():
                linked &= side[:, None] != side[None, :]
            i, j = np.nonzero(linked)
            if i.size:
                root = local_roots(ids, i, j)
                hit = np.flatnonzero(root != ids)
                yield pa.RecordBatch.from_arrays([pa.array(root[hit]), pa.array(ids[hit])], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _tile(gram: np.ndarray, size: np.ndarray, similarity: int) -> np.ndarray:
    """Which rows i < j of a few hundred reach the bound: a square of booleans.

    Columns with one entry add to no overlap and are left out, as are rows that no other row's size allows.
    """
    rows = len(size)
    need = np.maximum(1, -(-similarity * (size[:, None] + size[None, :]) // (100 + similarity)))
    alive = np.triu(np.minimum(size[:, None], size[None, :]) >= need, 1)
    owner = np.repeat(np.arange(rows), size)
    some = (alive.any(axis=0) | alive.any(axis=1))[owner]
    owner, (_, column, count) = owner[some], np.unique(gram[some], return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rest = np.bincount(owner, minlength=rows)
    overlap = np.zeros((rows, rows), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        block = np.zeros((rows, 4096), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        overlap += block @ block.T
        rest = rest - np.bincount(owner[a:b], minlength=rows)
        alive &= overlap + np.minimum(rest[:, None], rest[None, :]) >= need
        if not alive.any():
            break
    return alive & (overlap >= need)


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components with further links, given as those of their ends' components (ra, rb): a graph of components, so a small one."""
    more = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b"))).select(F.col("id").alias("i"), F.col("root").alias("r"))
    old = roots.join(more, F.col("root") == F.col("i"), "left").select("id", F.coalesce("r", "root").alias("root"))
    return stash(old.unionByName(more.join(roots, F.col("i") == F.col("id"), "left_anti").select(F.col("i").alias("id"), F.col("r").alias("root"))), "roots")


def join(df: DataFrame, key: str, column: str, n: int = 3, similarity: int = 90, sampled: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id of every document; similarity in per cent.

    sampled: lists come from sampled compound columns instead of blocks (see above).
    """
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text"))
    rows = stash(docs.mapInArrow(_rows(n, similarity, sampled), "id long, n long, s1 long, s2 long, prints array<long>"), "rows")
    sets = stash(rows.groupBy("id").agg(F.min(F.struct("n", "s1", "s2")).alias("s")).select("id", "s.*"), "sets")

    # classes of equal sets; an empty set is in none
    # (written first: a join of two plain exchanges is one that Spark splits at a class with very many copies)
    classes = stash(sets.filter("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.count("*").alias("m")).filter("m > 1"), "copies")
    equal = stash(sets.filter("n > 0").join(classes, ["s1", "s2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")), "equal")

    # rows that agree in a compound column, as (column's name, its smallest row, another row)
    told = meet(rows.filter(F.size("prints") > 0).select("id", "prints"), "id", equal.select(F.col("a").alias("copy")), "copy", "left_anti").select("id", F.explode("prints").alias("print"))
    # (written first, as the classes are, for a column that very many near copies share)
    lists = stash(told.groupBy("print").agg(F.min("id").alias("hub"), F.max("id").alias("top")).filter("hub < top").select(F.col("print").alias("p"), "hub"), "lists")
    met = stash(told.join(lists, F.col("print") == F.col("p")).filter("id <> hub").select("print", F.col("hub").alias("a"), F.col("id").alias("b")), "met")
    size = lambda c: sets.select(F.col("id").alias(f"i{c}"), F.col("n").alias(f"n{c}"))
    cells = met.select("a", "b").distinct().join(size("a"), F.col("a") == F.col("ia")).join(size("b"), F.col("b") == F.col("ib"))
    cells = stash(cells.filter(100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb")).select("a", "b"), "cells")

    members = met.select(F.col("a").alias("i")).unionByName(met.select(F.col("b").alias("i"))).distinct()
    members = stash(members.join(sets, F.col("i") == F.col("id")).select("i", "s1"), "members")
    near = stash(meet(docs, "id", members, "i", "inner").select("id", "text", "s1"), "near")

    # one smaller row for every row, then the others that are still elsewhere
    first = cells.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    roots = components(equal.unionByName(_similar(first, near, n, similarity)))

    def root_of(df: DataFrame, c: str) -> DataFrame:
        of = roots.select(F.col("id").alias(f"_{c}"), F.col("root").alias(f"r{c}"))
        return df.join(of, F.col(c) == F.col(f"_{c}"), "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c)).drop(f"_{c}")

    second = root_of(root_of(cells.join(first, ["a", "b"], "left_anti"), "a"), "b").filter("ra <> rb").select("a", "b")
    roots = _joined(roots, root_of(root_of(_similar(second, near, n, similarity), "a"), "b"))

    # lists whose rows but the smallest, compared by now, lie in several components: what they connect is
    # a cluster, multiplied out in tiles
    split = root_of(met.select("print", "b"), "b")
    mixed = split.groupBy("print").agg(F.min("rb").alias("low"), F.max("rb").alias("high"), F.min("b").alias("first")).filter("low < high").select(F.col("print").alias("p"), "first")
    chains = stash(split.join(mixed, F.col("print") == F.col("p")).select("b", "first").distinct(), "chains")
    clusters = components(chains.select(F.col("b").alias("a"), F.col("first").alias("b"))).select(F.col("id").alias("i"), F.col("root").alias("cluster"))
    products = _products(near.join(clusters, F.col("id") == F.col("i")).select("id", "cluster", "text", "s1"), n, similarity)
    roots = _joined(roots, root_of(root_of(products, "a"), "b"))

    out = sets.join(roots.select(F.col("id").alias("i"), "root"), F.col("id") == F.col("i"), "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))
