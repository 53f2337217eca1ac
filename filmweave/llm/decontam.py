"""Benchmark decontamination: edit distance by CGK embedding, bit-sampling LSH, exact verification.

A document leaks an item of ``n`` words if some part of it has word edit distance ``k`` of at most a fifth of ``n`` to
it (similarity 0.8). The part has ``n - k`` to ``n + k`` words; a document may be shorter than the item. Words are
lower-cased and stripped of punctuation at their ends.

Search, for each item length ``n`` of the benchmark, over the windows at every word of every text, of ``n + k`` words or
up to the text's end:

1. A part within ``k`` edits shares at least ``n - 1 - 2k`` neighbouring word pairs with the item. Windows that share
   fewer with each item of that length can match none of them and aren't embedded; this loses no match. Where pairs
   stand in very many items, they are counted out of all items of the length together, which loses none either.
2. The CGK walk embeds a window: a random bit per step and word says whether the walk moves on. Edits become few
   differing steps. ``WALKS`` walks, each with ``TABLES`` samples of ``SAMPLED`` steps, give the keys; a window and an
   item with any key in common are a candidate. The numbers are set so that pairs at the very bound are found with
   probability above 0.98, whether words are changed, left out or put in; nearer ones almost surely.
3. Candidates are verified by exact edit distance to the nearest beginning of the window.

The benchmark is the stated query set: it is taken in blocks of bounded size, and each block passes over all
documents. Documents are never shuffled; hits are (document, item) rows.

Defined cases: NULL and empty texts leak nothing; items without an id are searched as well and each is reported
under a NULL id; NULL, empty or punctuation-only items match nothing; items shorter
than ``LEAST_WORDS`` words are matched whole and exactly (edits of a few words mean nothing); repeated items count
each; repeated documents are reported each; extra columns are ignored or kept.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, slices, text_or_empty, word_codes

EDITS = 0.2  # of an item's words
LEAST_WORDS = 8
WALKS, TABLES, SAMPLED = 6, 6, 1
BLOCK_WORDS = 200_000  # words of the benchmark in one pass
ITEMS_PER_PAIR = 8  # items that a met pair stands in, on average, up to which pairs are counted by item
SEED = 99
_MARKS = string.punctuation + "\u00a1\u00a7\u00ab\u00b6\u00b7\u00bb\u00bf\u2010\u2011\u2012\u2013\u2014\u2018\u2019\u201a\u201c\u201d\u201e\u2022\u2026\u3001\u3002"


def _bare(words: pa.Array) -> pa.Array:
    """Words without punctuation and symbols at their ends."""
    return pc.utf8_trim(words, characters=_MARKS)


def item_words(text: str | None) -> list[str]:
    return [w for w in _bare(pa.array((text or "").lower().split(), pa.large_string())).to_pylist() if w]


def allowed(n: int) -> int:
    return int(EDITS * n) if n >= LEAST_WORDS else 0


def _hash_of(ids: np.ndarray, salt: int) -> np.ndarray:
    """64 mixed bits for each id (SplitMix64)."""
    with np.errstate(over="ignore"):
        z = (ids.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def embed(windows: np.ndarray, sizes: np.ndarray, walk: int) -> np.ndarray:
    """CGK walks over ``windows``, rows of word ids filled up with -2: two steps for each word of the longest."""
    count, width = windows.shape
    padded = np.hstack([windows, np.full((count, 1), -2, windows.dtype)])
    flat = padded.ravel()
    base = np.arange(count) * (width + 1)
    end = base + sizes
    at = base.copy()
    out = np.empty((2 * width, count), windows.dtype)
    least = flat.min(initial=0)
    known = np.arange(least, flat.max(initial=0) + 1)
    if len(known) <= len(flat):  # windows overlap, so most words are hashed once instead of many times
        words, places = known, flat - least
    else:
        words, places = flat, slice(None)
    for step in range(2 * width):
        if step % 32 == 0:  # a bit for each word and each of the next steps
            bits = (_hash_of(words + 3, SEED + 1000 * walk + step // 32) >> np.uint64(32)).astype(np.uint32)[places]
        out[step] = flat.take(at)
        at += (bits.take(at) >> (step % 32)) & 1
        np.minimum(at, end, out=at)
    return out


def keys(windows: np.ndarray, sizes: np.ndarray, filled: np.ndarray | None = None) -> np.ndarray:
    """LSH keys: for each window one key per walk and table, from steps sampled over twice the item's length.

    ``sizes`` are the items' lengths, ``filled`` the words the windows have, if those aren't as many.
    """
    count = len(windows)
    filled = sizes if filled is None else filled
    rows = np.arange(count)
    out = np.empty((count, WALKS * TABLES), np.uint64)
    sampled = np.random.default_rng(SEED).random((WALKS, TABLES, SAMPLED))
    for walk in range(WALKS):
        walked = embed(windows, filled, walk)
        for table in range(TABLES):
            key = _hash_of(sizes, walk * TABLES + table)
            for share in sampled[walk, table]:
                key = _hash_of(key ^ _hash_of(walked[(share * 2 * sizes).astype(np.int64), rows] + 3, 7), 11)
            out[:, walk * TABLES + table] = key
    return out


def edit_distances(items: np.ndarray, sizes: np.ndarray, windows: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Edit distance of each item to the nearest beginning of its window, ``most + 1`` if it is more.

    Items have ``sizes`` words; both are filled up with numbers that no word of the other has.
    """
    count, width = windows.shape
    out = most + 1
    live = np.arange(count)
    steps = np.arange(width + 1)
    row = np.broadcast_to(steps, (count, width + 1))
    for i in range(sizes.max(initial=0)):
        new = np.empty((len(live), width + 1), np.int64)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (windows[live] != items[live, i][:, None]))
        row = np.minimum.accumulate(new - steps, axis=1) + steps  # insertions
        least = row.min(axis=1)
        near = least <= most[live]
        whole = near & (sizes[live] == i + 1)
        out[live[whole]] = least[whole]
        near &= ~whole
        live, row = live[near], row[near]
        if not len(live):
            break
    return out


@dataclass(frozen=True)
class Pairs:
    """Word pairs of the items of one length, in order, and from ``first`` of each on the items it stands in."""

    table: np.ndarray
    first: np.ndarray
    items: np.ndarray


@dataclass(frozen=True)
class Block:
    """Items of one pass, by length: their words as numbers, their word pairs, and their keys in order."""

    vocabulary: pa.Array
    pairs: np.ndarray
    pairs_by_length: dict[int, Pairs]
    ids: list[int | None]
    rows: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray
    sorted_keys: np.ndarray
    owners: np.ndarray


def _pairs(found: list[tuple[int, np.ndarray]]) -> Pairs:
    found = [(i, np.unique(own)) for i, own in found]
    pairs = np.concatenate([own for _, own in found])
    items = np.repeat([i for i, _ in found], [len(own) for _, own in found])
    table, first = np.unique(np.sort(pairs), return_index=True)
    return Pairs(table, np.append(first, len(pairs)), items[np.argsort(pairs, kind="stable")].astype(np.int32))


def prepare(items: list[tuple[int | None, str | None]]) -> Block:
    words = [(item, item_words(text)) for item, text in items]
    words = [(item, w) for item, w in words if w]
    vocabulary = {w: i for i, w in enumerate(sorted({x for _, w in words for x in w}))}
    size = len(vocabulary)
    sizes = np.array([len(w) for _, w in words], np.int64)
    rows = np.full((len(words), max(sizes, default=1)), -2, np.int64)
    by_length: dict[int, list] = {}
    for i, (_, w) in enumerate(words):
        coded = np.array([vocabulary[x] for x in w], np.int64)
        rows[i, : len(w)] = coded
        # Items of one word have no pairs; the word stands for them.
        by_length.setdefault(len(w), []).append((i, coded[:-1] * size + coded[1:] if len(w) > 1 else -1 - coded))
    by_length = {n: _pairs(found) for n, found in sorted(by_length.items())}
    own = keys(rows, sizes)
    flat = own.ravel()
    order = np.argsort(flat, kind="stable")
    pairs = np.unique(np.concatenate([p.table for p in by_length.values()])) if by_length else np.empty(0, np.int64)
    ids = [item for item, _ in words]
    return Block(pa.array(list(vocabulary), pa.large_string()), pairs, by_length, ids, rows, sizes, own, flat[order], order // (WALKS * TABLES))


def _within(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.searchsorted(table, values).clip(0, len(table) - 1)] == values


def _distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _repeated(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Runs of ``many`` numbers from ``first`` on, one behind the other."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())


def _starts(hits: np.ndarray, owners: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts, from the first word on, of windows of ``n`` words with at least ``least`` of an owner's ``hits`` among their pairs, and the owners.

    ``hits`` are in order within each owner, owners are in order.
    """
    least = max(least, 1)
    span = max(n - 1, 1)
    if len(hits) < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first, last, owner = hits[: len(hits) - least + 1], hits[least - 1 :], owners[: len(hits) - least + 1]
    low, high = last - span + 1, first
    good = (low <= high) & (owner == owners[least - 1 :])
    low, high, owner = np.maximum(low[good], 0), high[good], owner[good]
    # Runs of an owner overlap: each begins behind the one before.
    low[1:] = np.where(owner[1:] == owner[:-1], np.maximum(low[1:], high[:-1] + 1), low[1:])
    many = np.maximum(high - low + 1, 0)
    return _repeated(low, many), np.repeat(owner, many)


def _likely(both: np.ndarray, pair: np.ndarray, pairs: Pairs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows with enough of an item's pairs, and the item, or -1 if pairs are of too many items to tell them.

    The words at ``both`` and behind are ``pair``.
    """
    at = np.searchsorted(pairs.table, pair).clip(0, len(pairs.table) - 1)
    own = pairs.table[at] == pair
    hits, at = both[own], at[own]
    owners = np.full(len(hits), -1)
    many = pairs.first[at + 1] - pairs.first[at]
    if many.sum() <= ITEMS_PER_PAIR * len(hits):
        owners = pairs.items[_repeated(pairs.first[at], many)]
        order = np.argsort(owners, kind="stable")
        hits, owners = np.repeat(hits, many)[order], owners[order]
    return _starts(hits, owners, n + allowed(n), n - 1 - 2 * allowed(n))


def _candidates(mine: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Windows and items with a key in common, each pair once."""
    low = np.searchsorted(block.sorted_keys, mine, side="left")
    many = (np.searchsorted(block.sorted_keys, mine, side="right") - low).ravel()
    window = np.repeat(np.repeat(np.arange(len(mine)), mine.shape[1]), many)
    found = _distinct(window * np.int64(len(block.ids)) + block.owners[_repeated(low.ravel(), many)])
    return found // len(block.ids), found % len(block.ids)


def find(texts: pa.Array, block: Block) -> list[list[dict]]:
    """For each text the items it leaks: item, nearest window, edits."""
    codes, starts, vocabulary = word_codes(texts)
    bare = _bare(vocabulary)
    ids = pc.fill_null(pc.index_in(bare, value_set=block.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    ids[pc.binary_length(bare).to_numpy(zero_copy_only=False) == 0] = -3
    words = ids[codes] if len(codes) else np.empty(0, np.int64)
    kept = words != -3
    starts = np.concatenate([[0], np.cumsum(kept)])[starts]
    words = words[kept]
    size = len(block.vocabulary)
    both = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0))
    pair = words[both] * size + words[both + 1]
    own = _within(pair, block.pairs)
    both, pair = both[own], pair[own]
    ends = starts[1:]
    lasts = np.repeat(ends, np.diff(starts))  # for each word the end of its text

    found, items, sizes = [], [], []
    for n, pairs in block.pairs_by_length.items():
        if n > 1:
            some, item = _likely(both, pair, pairs, n)
        else:
            some = np.flatnonzero(_within(-1 - words, pairs.table) & (words >= 0))
            item = np.full(len(some), -1)
        inside = some < len(words)
        some, item = some[inside], item[inside]
        inside = lasts[some] - some >= n - allowed(n)
        order = np.argsort(some[inside], kind="stable")
        found.append(some[inside][order])
        items.append(item[inside][order])
        sizes.append(np.full(len(order), n))
    found, items, sizes = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (found, items, sizes))

    best: dict[tuple[int, int], tuple[int, int]] = {}
    for part in range(0, len(found), 8192):
        start, n = found[part : part + 8192], sizes[part : part + 8192]
        new = np.append(True, (start[1:] != start[:-1]) | (n[1:] != n[:-1]))  # windows that are likely for several items are embedded once
        window = np.cumsum(new) - 1
        begin, n, likely = start[new], n[new], items[part : part + 8192]
        most = np.array([allowed(x) for x in range(n.max() + 1)], np.int64)[n]
        columns = np.arange((n + most).max())  # lengths are in order, so most batches are narrow
        room = np.minimum(n + most, lasts[begin] - begin)
        windows = np.where(columns < room[:, None], words[np.minimum(begin[:, None] + columns, len(words) - 1)], -4)
        filled = np.minimum(n, room)
        columns = columns[: n.max()]
        mine = keys(np.where(columns < filled[:, None], windows[:, : len(columns)], -2), n, filled)
        told = likely >= 0
        known, items_known = window[told], likely[told]
        common = (mine[known] == block.keys[items_known]).any(axis=1)
        open_ = window[~told]  # of any item: looked up by key
        w, i = _candidates(mine[open_], block)
        all_w, all_i = np.concatenate([known[common], open_[w]]), np.concatenate([items_known[common], i])
        same = block.sizes[all_i] == n[all_w]
        all_w, all_i = all_w[same], all_i[same]
        for chunk in range(0, len(all_w), 65536):
            w, i = all_w[chunk : chunk + 65536], all_i[chunk : chunk + 65536]
            edits = edit_distances(block.rows[i], block.sizes[i], windows[w], most[w])
            for at in np.flatnonzero(edits <= most[w]):
                text = int(np.searchsorted(ends, begin[w[at]], side="right"))
                own = block.ids[i[at]]
                key, value = (text, own is None, int(i[at]) if own is None else own), (int(edits[at]), int(begin[w[at]] - starts[text]))
                best[key] = min(best.get(key, value), value)
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for (text, no_id, item), (edits, position) in sorted(best.items()):
        out[text].append({"item_id": None if no_id else item, "word": position, "edits": edits})
    return out


def _finder(block: Block):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("word", pa.int64()), ("edits", pa.int32())]))

    def run(texts: pa.Array) -> pa.Array:
        parts = [pa.array(find(part, block), kind) for part in slices(texts, SLICE_BYTES)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return F.arrow_udf(run, "array<struct<item_id: long, word: long, edits: int>>").asNondeterministic()


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[Block]:
    """The benchmark in blocks of about ``block_words`` words, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long"), text_or_empty(F.col("text")).alias("text"))
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    count = -(-total // block_words)
    for block in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == block)
        yield prepare([tuple(r) for r in own.orderBy("item_id", "text").collect()])


def leaks(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, word, edits``: a row for each document and item it leaks, with the place of the nearest window."""
    out = None
    for block in blocks(benchmark):
        found = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.inline(_finder(block)(F.col(f"`{text}`"))))
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = "item_id long, word long, edits int"
        empty = documents.sparkSession.createDataFrame([], schema)
        return documents.select(F.col(f"`{doc_id}`").alias("doc_id")).limit(0).join(empty)
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``documents`` that leak no item, columns as they were; a narrow filter for each block."""
    kept = documents
    for block in blocks(benchmark):
        kept = kept.where(F.size(_finder(block)(F.col(text))) == 0)
    return kept
