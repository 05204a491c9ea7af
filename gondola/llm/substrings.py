"""Substring dedup by recompression.

The words of a text are compressed in rounds: first runs of one word, then, round by round, pairs of
neighbours, of which the left is of one class and the right of the other (a bit of the symbol's name). A
symbol's name is a fingerprint of what it stands for, so equal runs and pairs get equal names in every
task. Each symbol knows which words determined it; where those lie inside a window of words, every equal
window holds the same symbol at the same place. So each window is named after one of its interior
symbols, and Spark counts these names globally: windows whose name occurs once can't repeat. Only the
others are shuffled by their full content, to find for each the first place where it starts.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import spread_scan, text_or_empty, written
from gondola.llm.words import _P, _STEP, _power, mix, pieces, utf8, words

WINDOW = 20
ROUNDS = 6
#: Symbols determined by this many words name windows first: fewer repeat by chance, more fit few windows.
LEAST, MOST = 6, 13
_NONE = np.iinfo(np.int64).max


def _spans(h: np.ndarray):
    """Fingerprint of the words lo to hi, for arrays lo and hi."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power("up", len(h) + 1)[:len(h)], out=total[1:])
    return lambda lo, hi: mix((total[hi] - total[lo]) * _power("down", len(h) + 1)[lo] + (hi - lo).astype(np.uint64))


def interior_symbols(h: np.ndarray, first: np.ndarray):
    """(lo, hi, name) of the symbols of all rounds; lo to hi are the words that determine a symbol.

    A symbol whose shape depends on a row's edge gets a lo before or a hi behind the row.
    """
    n = len(h)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin, end = first[row], first[row + 1]
    new = np.ones(n, bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    name = np.where(size > 1, mix(h[at] * np.uint64(_P) + size.astype(np.uint64)), h[at])
    lo, hi, row, begin, end = at - 1, at + size + 1, row[at], begin[at], end[at]
    out = [(lo, hi, name)]
    for r in range(ROUNDS):
        right = (mix(name + np.uint64(r + 1)) & np.uint64(1)).astype(bool)
        joined = np.zeros(len(name), bool)  # with the next symbol
        joined[:-1] = ~right[:-1] & right[1:] & (row[:-1] == row[1:])
        second = np.zeros(len(name), bool)
        second[1:] = joined[:-1]
        # a symbol that stays alone does so because of its neighbour on its open side
        next_hi, prev_lo = end + 1, begin - 1
        same = row[:-1] == row[1:]
        next_hi[:-1] = np.where(same, hi[1:], next_hi[:-1])
        prev_lo[1:] = np.where(same, lo[:-1], prev_lo[1:])
        alone = ~joined & ~second
        lo = np.where(alone & right, np.minimum(lo, prev_lo), lo)
        hi = np.where(alone & ~right, np.maximum(hi, next_hi), hi)
        left = np.flatnonzero(joined)
        name = name.copy()
        name[left] = mix(name[left] * np.uint64(_P) + name[left + 1])
        hi[left] = np.maximum(hi[left], hi[left + 1])
        lo[left] = np.minimum(lo[left], lo[left + 1])
        keep = ~second
        name, lo, hi, row, begin, end = name[keep], lo[keep], hi[keep], row[keep], begin[keep], end[keep]
        out.append((lo, hi, name))
    return tuple(np.concatenate(x) for x in zip(*out))


def window_names(h: np.ndarray, first: np.ndarray):
    """(name, start, size) of the runs of windows that share a naming symbol, over all rows."""
    n = len(h)
    rows = np.flatnonzero(np.diff(first) >= WINDOW)
    empty = np.zeros(0, np.int64)
    if not len(rows):
        return empty.astype(np.uint64), empty, empty
    lo, hi, name = interior_symbols(h, first)
    fit = (hi - lo >= LEAST) & (hi - lo <= MOST) & (lo >= 0) & (hi <= n)
    lo, hi, name = lo[fit], hi[fit], name[fit]
    value = np.concatenate([mix(_spans(h)(lo, hi) ^ name) >> np.uint64(1), h | np.uint64(1 << 63)])  # single words come last
    lo, hi = np.concatenate([lo, np.arange(n)]), np.concatenate([hi, np.arange(1, n + 1)])
    row_of = np.searchsorted(first, lo, "right") - 1
    a = np.maximum(hi - WINDOW, first[row_of])
    b = np.minimum(lo, first[row_of + 1] - WINDOW)
    ok = (a <= b) & (hi <= first[row_of + 1])
    lo, value, a, b = lo[ok], value[ok], a[ok], b[ok]
    order = np.lexsort((lo, value))
    lo, value, a, b = lo[order], value[order], a[order], b[order]
    # least rank over ranges of starts: cover each by two powers of two, then push down
    level = np.floor(np.log2(b - a + 1)).astype(np.int64)
    best = np.full(n + 64, _NONE)
    for k in range(int(level.max(initial=0)), -1, -1):
        here = np.flatnonzero(level == k)[::-1]  # smallest rank is written last
        own = np.full(n + 64, _NONE)
        own[a[here]] = here
        other = np.full(n + 64, _NONE)
        other[b[here] - (1 << k) + 1] = here
        best = np.minimum(best, np.minimum(own, other))
        if k:
            half = 1 << (k - 1)
            best[half:] = np.minimum(best[half:], best[:-half])
    starts = np.concatenate([np.arange(first[r], first[r + 1] - WINDOW + 1) for r in rows])
    pick = best[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    return value[pick[at]], starts[at], np.diff(np.append(at, len(starts)))


def _pieces(batch, column: str):
    """(first row, fingerprints, first word of each row) for some rows of a batch at a time."""
    data, offsets = utf8(batch.column(column))
    for i, j in pieces(offsets):
        own = offsets[i:j + 1]
        h, _, _, first = words(data[own[0]:own[-1]], own - own[0])
        yield i, h, first


def _named(batches):
    """The runs of windows that share a name, each with two fingerprints of the words that it covers."""
    for batch in batches:
        ids, parts = batch.column("id").to_numpy(), batch.column("part").to_numpy()
        for i, h, first in _pieces(batch, "text"):
            name, start, size = window_names(h, first)
            row = np.searchsorted(first, start, "right") - 1
            one, two = _prints(h, start, start + size + WINDOW - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array(one), pa.array(two), pa.array(ids[i + row]), pa.array(parts[i + row]),
                 pa.array((start - first[row]).astype(np.int32)), pa.array(size.astype(np.int32))], names=["name", "key", "key2", "id", "part", "start", "size"])


def _prints(h: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """A 64-bit and an independent 32-bit fingerprint of the words lo to hi."""
    return _spans(h)(lo, hi).view(np.int64), (_spans(mix(h + _STEP))(lo, hi) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _windows(batches):
    """The single windows of listed runs with their fingerprints."""
    for batch in batches:
        ids, parts = batch.column("id").to_numpy(), batch.column("part").to_numpy()
        starts, sizes = batch.column("starts"), batch.column("sizes")
        for i, h, first in _pieces(batch, "text"):
            picked, n = starts.slice(i, len(first) - 1), sizes.slice(i, len(first) - 1)
            row = np.repeat(np.arange(len(picked)), picked.value_lengths().to_numpy())
            start, size = first[row] + picked.flatten().to_numpy(), n.flatten().to_numpy().astype(np.int64)
            each = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
            row = np.repeat(row, size)
            one, two = _prints(h, each, each + WINDOW)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(ids[i + row]), pa.array(parts[i + row]),
                                              pa.array((each - first[row]).astype(np.int32))], names=["key", "key2", "id", "part", "start"])


def _cut(batches):
    """Texts without the words of the listed runs of windows."""
    for batch in batches:
        starts, sizes = batch.column("starts"), batch.column("sizes")
        raw_texts = batch.column("text").to_pylist()
        n_words, n_gone, texts = [], [], []
        for i, h, first in _pieces(batch, "text"):
            picked, n = starts.slice(i, len(first) - 1), sizes.slice(i, len(first) - 1)
            lengths = np.nan_to_num(picked.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            row = np.repeat(np.arange(len(picked)), lengths)
            start, size = first[row] + picked.flatten().to_numpy(), n.flatten().to_numpy().astype(np.int64)
            gone = np.zeros(len(h) + 1, np.int64)
            np.add.at(gone, start, 1)
            np.add.at(gone, start + size + WINDOW - 1, -1)
            kept = np.cumsum(gone)[:-1] == 0
            for r in range(len(first) - 1):
                own = kept[first[r]:first[r + 1]]
                split = (raw_texts[i + r] or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(own))
                n_gone.append(int((~own).sum()))
                texts.append(b" ".join(split if not n_gone[-1] else compress(split, own.tolist())).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(texts, pa.string())],
                                         names=["id", "n_words", "n_removed", "text"])


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_words``, ``n_removed`` and ``text`` (the kept words joined by one space).

    A word goes when a window of 20 words covers it whose words also start earlier: at a smaller id, or
    at a smaller word number of the same id. A null id counts as smaller than any other. Rows that share an
    id are told apart by a hash of their text, which decides between equal word numbers; rows equal in
    id and text are one document and come out alike. Null and empty texts have no words. An empty table gives
    an empty result; extra columns are ignored.
    """
    low = F.lit(-(1 << 63)).cast("long")
    src = df.select(F.coalesce(F.col(id_col).cast("long"), low).alias("id"), F.hash(text_or_empty(text_col)).alias("part"), text_or_empty(text_col).alias("text"))
    named = written(spread_scan(src).mapInArrow(_named, "name long, key long, key2 int, id long, part int, start int, size int"), "substr-named")
    # windows whose name occurs once can't repeat; a name that very many runs share is combined before the shuffle,
    # and in the join it is a skewed key, which Spark splits
    again = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    hits = written(named.join(again, "name"), "substr-hits")
    place = F.struct("id", "start", "part")

    def first_places(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min(place).alias("first"))

    # runs whose whole content starts earlier go as they are
    run = ["key", "key2", "size"]
    firsts = written(first_places(hits, [*run, "name"]), "substr-runs")
    late_runs = hits.join(firsts.select(*run, "name", "first"), [*run, "name"]).where(place > F.col("first")).select("id", "part", "start", "size")
    # the first run of each content is compared window by window with the other contents under its name
    mixed = firsts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    open_runs = firsts.join(mixed, "name", "left_semi").select("first.id", "first.part", "first.start", "size")
    lists = open_runs.groupBy("id", "part").agg(F.collect_list(F.struct("start", "size")).alias("l")).select(
        "id", "part", F.col("l.start").alias("starts"), F.col("l.size").alias("sizes"))
    windows = written(src.join(lists, ["id", "part"]).mapInArrow(_windows, "key long, key2 int, id long, part int, start int").distinct(), "substr-windows")
    late = windows.join(first_places(windows, ["key", "key2"]), ["key", "key2"]).where(place > F.col("first")).select(
        "id", "part", "start", F.lit(1).alias("size"))
    gone = late_runs.union(late).groupBy("id", "part").agg(F.collect_list(F.struct("start", "size")).alias("l"))
    gone = written(gone.select("id", "part", F.col("l.start").alias("starts"), F.col("l.size").alias("sizes")), "substr-gone")
    out = src.join(gone, ["id", "part"], "left").select("id", "text", "starts", "sizes").mapInArrow(_cut, "id long, n_words long, n_removed long, text string")
    return out.withColumn("id", F.nullif("id", low))
