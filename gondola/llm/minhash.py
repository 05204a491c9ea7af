"""MinHash near-dedup with odd sketches.

Every text becomes its set of word shingles (fingerprints). ``bands * rows`` min-wise samples of the
set serve twice: in bands as bucket keys, and folded by parity into a bitmap (an odd sketch) whose
XOR with another text's bitmap estimates their similarity; an estimate well below the threshold
drops a candidate before its texts are fetched. Remaining candidates are decided on the full sets.

Equal sets are one class from the start, so copies cost nothing further. Buckets are not expanded
into pairs. Rounds offer a linear number of candidates: first each member with its bucket's smallest
id, then each member with the likeliest member of another component in the bucket; links found merge
components in between. What is left is decided exactly and without making pairs into rows: the
remaining members of a bucket meet in pairs of blocks, where every two members of different
components whose sketches admit the threshold are compared by their full sets (in the first band
they share only), and a block pair returns the links that merge components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import spread_scan, written
from gondola.llm.components import components
from gondola.llm.words import chain, mix, pieces, utf8, words

SHINGLE = 4
#: 25 bands of 5 samples miss a pair of similarity 0.8 with probability 5e-5, of 0.85 with 1e-6.
BANDS, ROWS = 25, 5
#: Bits of the odd sketch; with 125 samples the estimate at 0.8 is off by about 0.04 (one sigma).
BITS = 512
#: Candidates estimated this far below the threshold (six sigma) are dropped.
SLACK = 0.24
#: Rows of a bucket compared at once, block by block.
BLOCK = 512
SEEDS = np.random.Generator(np.random.PCG64(99)).integers(1, 2**63, size=(2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column, k: int = SHINGLE):
    """Per row the sorted distinct fingerprints of its k-word shingles (lower-cased A-Z); a text of
    fewer words is one shingle, a text without words has none."""
    data, offsets = utf8(column)
    for i, j in pieces(offsets):
        at = offsets[i:j + 1]
        h, _, _, first = words(data[at[0]:at[-1]], at - at[0], fold=True)
        runs = chain(h, k)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                yield np.unique(runs[a:b - k + 1])
            elif b > a:
                yield chain(h[a:b], int(b - a))
            else:
                yield h[:0]


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """Min-wise samples of non-empty sets, one row each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), BANDS * ROWS), np.uint64)
    for j in range(BANDS * ROWS):
        out[:, j] = np.minimum.reduceat(flat * SEEDS[0, j] + SEEDS[1, j], starts)
    return out


def odd_sketch(sig: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples (each with its place), as rows of uint64."""
    place = np.arange(sig.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bit = (mix(sig + place) % np.uint64(BITS)).astype(np.int64)
    hits = np.zeros((len(sig), BITS), np.uint8)
    np.add.at(hits, (np.arange(len(sig))[:, None], bit), 1)
    return np.packbits(hits & 1, axis=1).view(np.uint64)


def estimate(odd: np.ndarray) -> np.ndarray:
    """Similarity from the number of differing sketch bits: 1 + bits/(4 samples) * ln(1 - 2 odd/bits)."""
    share = np.minimum(2.0 * odd / BITS, 1 - 1e-9)
    return 1 + BITS / (4.0 * BANDS * ROWS) * np.log1p(-share)


def _signatures(k: int):
    def run(batches):
        for batch in batches:
            yield from _signed(batch, k)

    return run


def _signed(batch, k: int):
    ids, done = batch.column(0), 0
    pend: list[np.ndarray] = []

    def flush():
        nonlocal pend, done
        full = [s for s in pend if len(s)]
        n = len(pend)
        prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in pend]
        bands: list = [None] * n
        sketch: list = [None] * n
        if full:
            sig = samples(full)
            keys = np.empty((len(full), BANDS), np.uint64)
            for b in range(BANDS):
                keys[:, b] = chain_rows(sig[:, b * ROWS:(b + 1) * ROWS], b)
            sk = odd_sketch(sig)
            at = [i for i, s in enumerate(pend) if len(s)]
            for x, i in enumerate(at):
                bands[i] = keys[x].view(np.int64)
                sketch[i] = sk[x].tobytes()
        out = pa.RecordBatch.from_arrays([
            ids.slice(done, n).cast(pa.int64()), pa.array([len(s) for s in pend], pa.int64()),
            pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
            names=["id", "n", "print", "bands", "sketch"])
        done += n
        pend = []
        return out

    size = 0
    for s in shingle_sets(batch.column(1), k):
        pend.append(s)
        size += len(s)
        if size > 1 << 18:
            yield flush()
            size = 0
    if pend:
        yield flush()


def chain_rows(sig: np.ndarray, band: int) -> np.ndarray:
    out = np.full(len(sig), band + 1, np.uint64)
    for j in range(sig.shape[1]):
        out = mix(out * np.uint64(0xD1342543DE82EF95) + sig[:, j])
    return out


def _confirm(threshold: tuple[int, int], k: int):
    """Keep the pairs (a, b, ta, tb) whose full shingle sets reach the threshold."""
    num, den = threshold

    def run(batches):
        for batch in batches:
            keep = []
            left, right = shingle_sets(batch.column(2), k), shingle_sets(batch.column(3), k)
            for x, y in zip(left, right):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and den * both >= num * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(mask)

    return run


def _sides(table: pa.Table):
    """Ids, components, sketches, and the rows of the left and the right block."""
    side = table["side"].to_numpy()
    bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(side), -1)
    left = np.flatnonzero(side == 0)
    right = left if table["bi"][0].as_py() == table["bj"][0].as_py() else np.flatnonzero(side == 1)
    return table["id"].to_numpy(), table["comp"].to_numpy(), bits, left, right


def _similar(bits, comp, li, r) -> np.ndarray:
    """Estimated similarities of rows li and r; -1 within a component."""
    odd = np.zeros((len(li), len(r)), np.int64)
    for w in range(bits.shape[1]):
        odd += np.bitwise_count(bits[li, w][:, None] ^ bits[r, w][None, :])
    sim = estimate(odd)
    sim[comp[li][:, None] == comp[r][None, :]] = -1
    return sim


def _best_partner(floor: float):
    """Each row of a block pair with its likeliest partner in another component."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp, bits, left, right = _sides(table)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in ((left, right), (right, left)) if left is not right else ((left, right),):
            for i in range(0, len(x) if len(y) else 0, 128):
                sim = _similar(bits, comp, x[i:i + 128], y)
                at = sim.argmax(1)
                ok = sim[np.arange(len(at)), at] >= floor
                p, q = ids[x[i:i + 128][ok]], ids[y[at[ok]]]
                a.append(np.minimum(p, q))
                b.append(np.maximum(p, q))
        return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})

    return run


def _decide_block(floor: float, threshold: tuple[int, int], k: int):
    """Links by full sets that merge components of a block pair."""
    num, den = threshold

    def run(table: pa.Table) -> pa.Table:
        ids, comp, bits, left, right = _sides(table)
        bands = np.array(table["bands"].to_pylist(), np.int64).reshape(len(ids), -1)
        here = table["key"][0].as_py()
        texts, sets = table["text"], {}
        root = {c: c for c in comp.tolist()}

        def top(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        def full(i):
            if i not in sets:
                sets[i] = next(shingle_sets(texts.slice(i, 1).combine_chunks(), k))
            return sets[i]

        a, b = [], []
        for i in range(0, len(left) if len(right) else 0, 128):
            li = left[i:i + 128]
            sim = _similar(bits, comp, li, right)
            p, q = np.nonzero(sim >= floor)
            order = np.argsort(-sim[p, q], kind="stable")
            p, q = li[p[order]], right[q[order]]
            for at in range(0, len(p), 4096):
                x, y = p[at:at + 4096], q[at:at + 4096]
                first = (bands[x] == bands[y]).argmax(1)
                mine = bands[x, first] == here
                if left is right:
                    mine &= x < y
                for u, v in zip(x[mine].tolist(), y[mine].tolist()):
                    cu, cv = top(comp[u].item()), top(comp[v].item())
                    if cu == cv:
                        continue
                    m, n = full(u), full(v)
                    least, most = sorted((len(m), len(n)))
                    if den * least < num * most:
                        continue
                    both = len(np.intersect1d(m, n, assume_unique=True))
                    if den * both >= num * (len(m) + len(n) - both):
                        root[max(cu, cv)] = min(cu, cv)
                        a.append(ids[u])
                        b.append(ids[v])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (80, 100),
               shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_shingles`` (size of its set), ``component_id`` (smallest
    id reachable by links, itself included) and ``kept`` (id = component_id).

    Two rows are linked when den * intersection >= num * union of their sets of ``shingle``-word
    shingles, for ``threshold`` = (num, den). A null or empty text, or one without words, has an empty set and links with
    nothing. Rows that share an id share a component, and all of them are kept when the id is; a row
    without an id takes no part: its component_id is null and kept is true. An empty table gives an
    empty result; extra columns are ignored. Where rows of one id hold different texts, a link of any of
    them links the id.
    """
    num, den = threshold
    floor = num / den - SLACK
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = written(spread_scan(src).mapInArrow(_signatures(shingle), "id long, n long, print binary, bands array<long>, sketch binary"), "minhash-sets")
    named = sets.where("id is not null and n > 0")
    classes = written(named.groupBy("print").agg(F.min("id").alias("rep"), F.min_by(F.struct("bands", "sketch"), "id").alias("s"),
                                                 F.min("n").alias("n")), "minhash-classes")
    reps = classes.select(F.col("rep").alias("id"), "s.bands", "s.sketch", "n")
    member = named.select("print", F.col("id").alias("b")).join(classes.select("print", F.col("rep").alias("a")), "print").select("a", "b").where("a <> b")

    keys = reps.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("center")).where("m > 1")
    buckets = written(keys.join(shared, "key").select("key", "id", "center", "m"), "minhash-buckets")
    sketches = reps.select("id", "sketch")
    wanted = written(buckets.select("id").distinct(), "minhash-wanted")
    texts = src.join(wanted, "id", "left_semi")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
            texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb").mapInArrow(
            _confirm(threshold, shingle), "a long, b long")

    def open_rows(labels: DataFrame) -> DataFrame:
        """Members of buckets that still span components, dealt to pairs of blocks."""
        rows = buckets.join(labels, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
        spans = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
        rows = rows.join(spans.select("key", "m"), "key").withColumn("nb", F.expr(f"cast((m - 1) div {BLOCK} + 1 as int)"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        return rows.select("key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "id", "comp",
                           (F.col("own") > F.col("other")).cast("int").alias("side"))

    # each member with its bucket's smallest id
    pairs = buckets.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    pairs = written(pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a").join(
        sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b").mapInArrow(_admit(floor), "a long, b long"), "minhash-center")
    links = written(member.union(confirmed(pairs)), "minhash-links")
    labels = components(links)
    # each open member with its likeliest partner in another component
    rows = open_rows(labels).join(sketches.select("id", "sketch"), "id")
    near = rows.groupBy("key", "bi", "bj").applyInArrow(_best_partner(floor), "a long, b long").distinct().join(pairs, ["a", "b"], "left_anti")
    links = written(links.union(confirmed(near)), "minhash-links")
    labels = components(links)
    # all that is left, block against block
    rows = written(open_rows(labels), "minhash-open")
    still = texts.join(rows.select("id").distinct(), "id", "left_semi")
    rows = rows.join(reps.select("id", "sketch", "bands"), "id").join(still, "id")
    rest = rows.groupBy("key", "bi", "bj").applyInArrow(_decide_block(floor, threshold, shingle), "a long, b long")
    labels = components(written(links.union(rest), "minhash-links"))
    return sets.join(labels, sets.id == labels.node, "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("comp", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("comp", "id"), F.lit(True)).alias("kept"))


def _admit(floor: float):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a = np.frombuffer(b"".join(batch.column("sa").to_pylist()), np.uint64).reshape(n, -1)
            b = np.frombuffer(b"".join(batch.column("sb").to_pylist()), np.uint64).reshape(n, -1)
            ok = estimate(np.bitwise_count(a ^ b).sum(1).astype(np.int64)) >= floor
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))

    return run
