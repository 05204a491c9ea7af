"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each task.

A text is cut by the tokenizer's pattern. The distinct words of a batch start as one token per byte; each
step of a recursive query lays them out as token-position rows (a word under contraction is a string of
one character per token), joins neighbours with the merge table
and contracts each word's leftmost pair of the smallest rank, until none is left; ordered aggregation
over the positions gives the ids and decodes them. Words already met by the task are remembered (bounded), so a word is contracted once.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import spread_scan

#: Words remembered by a worker; beyond it those go that have not come for the longest.
REMEMBER = 700_000
#: Rows of all rounds that one recursive query may make (a word of n bytes makes n*n/2 at most).
QUERY_ROWS = 2_000_000
#: A longer word (bytes) would make too many rows and is contracted by a heap, in the same order.
LONG = 1_000

_ENCODE = """
WITH RECURSIVE s(word, toks, rnd) AS (
  SELECT word, toks, 0 FROM words_of
  UNION ALL
  -- one row per neighbouring pair, joined with the merges; the smallest (rank, place) of a word is contracted
  SELECT word, substr(toks, 1, spot - 1) || chr(made + CASE WHEN made < 55295 THEN 1 ELSE 2049 END) || substr(toks, spot + 2), rnd + 1
  FROM (
    SELECT word, any_value(toks) AS toks, any_value(rnd) AS rnd, (min(first_rank + i) & 4294967295)::INTEGER AS spot, (min(first_rank + i) >> 32)::INTEGER AS made
    FROM (SELECT word, toks, rnd, i, substr(toks, i, 2) AS pair FROM (SELECT word, toks, rnd, unnest(range(1, length(toks))) AS i FROM s))
    JOIN merges USING (pair) GROUP BY word)
),
ends AS (SELECT word, arg_max(toks, rnd) AS toks FROM s GROUP BY word),
places AS (SELECT word, substr(toks, i, 1) AS sym, i FROM (SELECT word, toks, unnest(range(1, length(toks) + 1)) AS i FROM ends))
SELECT word, string_agg(named, ' ' ORDER BY i) AS named FROM places JOIN tokens USING (sym) GROUP BY word
"""


def symbol(token: int) -> str:
    """A token as one character, so that a word under contraction is a short string: no NUL, no surrogates."""
    return chr(token + (1 if token < 55295 else 2049))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Word contraction by one DuckDB connection; one lives in each Python worker."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.byte = [symbol(self.ranks[bytes([b])]) for b in range(256)]
        merges = [(symbol(self.ranks[t[:i]]) + symbol(self.ranks[t[i:]]), r << 32)
                  for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.con.register("merge_rows", pa.table({"pair": pa.array([m for m, _ in merges], pa.string()), "first_rank": pa.array([r for _, r in merges], pa.int64())}))
        # one ordered aggregate gives ids and bytes at once: "id/hex" per token
        self.con.register("token_rows", pa.table({"sym": pa.array([symbol(i) for i in self.tokens]), "named": pa.array([f"{i}/{t.hex()}" for i, t in self.tokens.items()])}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows; CREATE TABLE tokens AS SELECT * FROM token_rows")
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def meet(self, words: set[str]) -> None:
        """See to it that ``known`` has these words; of the words met before, those that still come stay."""
        if len(self.known) > REMEMBER // 2:
            self.known, self.older = {}, self.known
        new = [w for w in words if w not in self.known]
        if self.older:
            self.known.update((w, self.older[w]) for w in new if w in self.older)
            new = [w for w in new if w not in self.known]
        self.learn(new)

    def learn(self, new: list[str]) -> None:
        """Add (ids joined by spaces, decoded bytes) of words not met yet."""
        batch, cost = [], 0
        for w in new:
            raw = w.encode("utf-8", "surrogatepass")
            if len(raw) > LONG:
                ids = self.contract_long(raw)
                self.known[w] = (b" ".join(b"%d" % i for i in ids), b"".join(self.tokens[i] for i in ids))
                continue
            if raw in self.ranks:  # a word that is a token stays whole
                self.known[w] = (b"%d" % self.ranks[raw], raw)
                continue
            batch.append((w, raw))
            cost += len(raw) * (len(raw) + 2) // 2
            if cost > QUERY_ROWS:
                self._query(batch)
                batch, cost = [], 0
        if batch:
            self._query(batch)

    def _query(self, batch: list[tuple[str, bytes]]) -> None:
        rows = pa.table({"word": pa.array(range(len(batch)), pa.int32()),
                         "toks": pa.array(["".join([self.byte[b] for b in raw]) for _, raw in batch], pa.string())})
        self.con.register("words_of", rows)
        for i, named in self.con.execute(_ENCODE).fetchall():
            parts = named.replace("/", " ").split(" ")
            self.known[batch[i][0]] = (" ".join(parts[::2]).encode(), bytes.fromhex("".join(parts[1::2])))
        self.con.unregister("words_of")

    def contract_long(self, raw: bytes) -> list[int]:
        """The same contraction order over a linked list: smallest rank first, then leftmost."""
        n = len(raw)
        tok = [bytes([b]) for b in raw]
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, 2) for i in range(n - 1) if (r := self.ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            if not alive[i] or nxt[i] >= n or len(tok[i]) + len(tok[nxt[i]]) != size or self.ranks.get(tok[i] + tok[nxt[i]]) != r:
                continue
            j = nxt[i]
            tok[i] += tok[j]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for a in (prv[i], i):
                if a >= 0 and nxt[a] < n and (x := self.ranks.get(tok[a] + tok[nxt[a]])) is not None:
                    heapq.heappush(heap, (x, a, len(tok[a]) + len(tok[nxt[a]])))
        return [self.ranks[tok[i]] for i in range(n) if alive[i]]


_encoders: dict[str, Encoder] = {}


def _encode(path: str, pattern: str, with_ids: bool):
    def run(batches):
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        enc, find = _encoders[path], regex.compile(pattern).findall
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cut = [find(t or "") for t in part.column(1).to_pylist()]
                enc.meet({w for ws in cut for w in ws})
                known = enc.known
                n, ids, decoded, texts = [], [], [], []
                for ws in cut:
                    got = [known[w] for w in ws]
                    joined, back = b" ".join([g[0] for g in got]), b"".join([g[1] for g in got])
                    n.append(joined.count(b" ") + 1 if joined else 0)
                    ids.append(hashlib.sha256(joined).hexdigest())
                    decoded.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        texts.append((joined, back))
                out = [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out += [pa.array([[int(x) for x in j.split()] for j, _ in texts], pa.list_(pa.int32())), pa.array([b for _, b in texts], pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def bpe_round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space) and
    ``decoded_sha256`` (bytes decoded from the ids); with ``with_ids`` also ``ids`` and ``decoded``.

    Special tokens are ordinary text. A null or empty text has no tokens, whose digests are those of the
    empty string. Rows that repeat, and null ids, are encoded each; an empty table gives an empty result;
    extra columns are ignored. ``ranks_path`` must exist on every executor.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else "")
    return spread_scan(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(_encode(ranks_path, pattern, with_ids), schema)
