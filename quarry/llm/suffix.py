"""Removal of long repeated byte strings by merging the suffix orders of shards.

A byte-wise Burrows-Wheeler merge takes one pass over all bytes for each byte of the wanted
length.  Here the alphabet is coarser, as in prefix-free parsing: a text is read as the
sequence of its *anchors*, places that the text around them picks (the least hash of every
64 grams), and an anchor's symbol is the hash of the ``CONTEXT`` bytes that follow.  Every
string of ``LENGTH`` bytes holds an anchor whose whole symbol lies in it.

* A shard holds the anchors of some texts.  Its suffixes start at anchors; a suffix's
  Burrows-Wheeler symbol is what stands before it (the anchor to its left).
* Merging: shards send their symbols in sorted order to ranges, where the shards' orders are
  interleaved; a first round forms blocks of one symbol.  Suffixes alone in their block are
  settled.  The next round refines the blocks by the following symbol, one step of the
  anchors further, and by the Burrows-Wheeler symbol on the left.  Two rounds give common
  prefixes of ``LENGTH`` bytes or more, whatever the texts.  No suffix is sorted again.
* A refined block of two or more is a repeated interval.  Blocks that fall apart mark the
  edges of repeats; the strings that start around such edges (a representative of each
  refined block) are compared by 128-bit hashes, so the result is exact to the byte.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, pick, slots, staged, table

LENGTH = 200  # bytes of a string whose repeats go
GRAM = 8  # bytes that are hashed to choose anchors
WINDOW = 64  # grams, of which the first with the least hash is an anchor
CONTEXT = LENGTH - WINDOW + 1  # bytes of an anchor's symbol: lies in every LENGTH bytes that begin less than WINDOW before
STEP = LENGTH - CONTEXT  # least way to the next symbol of a suffix: two symbols span LENGTH bytes
SHARD_BYTES = 8 << 20  # text of one shard
RANGE_ROWS = 2_000_000  # symbols (rows of two numbers) that one range of the merge holds
PIECE = 1 << 20  # grams hashed at a time

U = np.uint64
_NO_LEFT, _NO_STEP, _SHORT = U(0xD1B54A32D192ED03), U(0x8CB92BA72F3D8DD7), 7


def _mix(*columns) -> np.ndarray:
    """One 64-bit hash of some columns of numbers."""
    out = np.zeros(len(columns[0]), U)
    for c in columns:
        out = (out ^ c.astype(U)) * U(0x9E3779B97F4A7C15)
        out ^= out >> U(32)
        out *= U(0xBF58476D1CE4E5B9)
        out ^= out >> U(29)
    return out


def anchors(text: bytes) -> np.ndarray:
    """Places of the anchors of a text of ``WINDOW + GRAM - 1`` bytes or more, rising.

    A window is hashed piece by piece; which gram wins depends on the window's bytes only.
    """
    buf = np.frombuffer(text, np.uint8)
    windows = len(buf) - GRAM - WINDOW + 2
    found = [np.zeros(0, np.int64)]
    for lo in range(0, windows, PIECE):
        hi = min(windows, lo + PIECE)  # windows lo..hi, grams lo..hi + WINDOW - 1
        n = hi - lo + WINDOW - 1
        part = buf[lo:lo + n + GRAM - 1]
        gram = np.empty(n, U)
        for k in range(GRAM):
            gram[k::8] = part[k:k + (n + GRAM - 1 - k) // 8 * 8].view("<u8")
        h = (gram ^ (gram >> U(31))) * U(0x9E3779B97F4A7C15)
        # the hash above, the place in the window order below: least hash, then first
        h = (h >> U(24) << U(24)) | np.arange(n, dtype=U)
        pad = -n % WINDOW
        rows = np.concatenate([h, np.full(pad, ~U(0))]).reshape(-1, WINDOW)
        ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        back = np.minimum.accumulate(rows, axis=1).ravel()
        least = np.minimum(ahead[:hi - lo], back[WINDOW - 1:WINDOW - 1 + hi - lo]) & U(0xFFFFFF)
        found.append(least[np.flatnonzero(np.diff(least, prepend=~U(0)))].astype(np.int64) + lo)
    return np.unique(np.concatenate(found))


SHARD = ("shard long, ids array<long>, sizes array<long>, digests array<binary>, "
         "texts array<int>, heads binary, tails binary, n_anchors array<int>, gaps binary, symbols binary, total long")


class _Shard:
    """Anchors and symbols of some texts while they are read."""

    def __init__(self):
        self.ids, self.sizes, self.digests, self.texts = [], [], [], []
        self.heads, self.tails, self.n_anchors, self.gaps, self.symbols = [], [], [], [], []
        self.size = 0

    def add(self, doc, text: bytes):
        from xxhash import xxh3_64_intdigest as xxh

        n = len(text)
        self.size += n
        if n >= LENGTH:
            at = anchors(text)
            places = at.tolist()
            full = int(np.searchsorted(at, n - CONTEXT, "right"))
            self.texts.append(len(self.ids))
            self.heads.append(xxh(text[:places[0]]))
            self.tails.append(xxh(text[-2 * LENGTH:]))
            self.n_anchors.append(len(places))
            self.gaps.append(np.diff(at, prepend=-1).astype(np.uint8).tobytes())
            self.symbols.append(np.array([xxh(text[p:p + CONTEXT]) for p in places[:full]]
                                         + [xxh(text[p:], _SHORT) for p in places[full:]], U).tobytes())
        self.ids.append(doc)
        self.sizes.append(n)
        self.digests.append(sha256(text).digest())

    def row(self, shard: int, schema) -> pa.RecordBatch:
        values = [shard, self.ids, self.sizes, self.digests, self.texts, np.array(self.heads, U).tobytes(),
                  np.array(self.tails, U).tobytes(), self.n_anchors, b"".join(self.gaps), b"".join(self.symbols),
                  sum(self.n_anchors)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _shards(shard_bytes: int):
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    schema = pa.schema([("shard", pa.int64()), ("ids", longs), ("sizes", longs), ("digests", pa.list_(pa.binary())),
                        ("texts", ints), ("heads", pa.binary()), ("tails", pa.binary()), ("n_anchors", ints),
                        ("gaps", pa.binary()), ("symbols", pa.binary()), ("total", pa.int64())])

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        shard, made = _Shard(), 0
        for batch in batches:
            ids, texts = batch.columns
            for i in range(batch.num_rows):
                shard.add(ids[i].as_py(), texts[i].as_py() or b"")
                if shard.size >= shard_bytes:
                    yield shard.row(first + made, schema)
                    shard, made = _Shard(), made + 1
        if shard.ids:
            yield shard.row(first + made, schema)

    return run


# --- the merge: shards send sorted rows to ranges, ranges answer a few bits a row ---

def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each 64-bit key: ranges are in the order of the keys."""
    return ((keys >> U(32)) * U(ranges) >> U(32)).astype(np.int64)


def _split(keys: np.ndarray, ranges: int):
    """(range, slice) of sorted keys."""
    at = _range_of(keys, ranges)
    cuts = np.flatnonzero(np.diff(at, prepend=-1, append=ranges))
    return [(int(at[lo]), slice(int(lo), int(hi))) for lo, hi in zip(cuts[:-1], cuts[1:])] if len(keys) else []


def _sorted_pairs(a: np.ndarray, b: np.ndarray):
    """Distinct (a, b) in order, how often each occurs, and the place of each input row among them."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return x[starts], y[starts], np.diff(np.append(starts, len(x))), back


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                       enumerate((pa.int32(), pa.int64(), pa.binary()))], names=["range", "shard", "rows"])


SENT, ANSWER = "range int, shard long, rows binary", "range int, shard long, answer binary"


def _answered(rows: pa.Table, answers: list[bytes]) -> pa.Table:
    return pa.table([rows["range"], rows["shard"], pa.array(answers, pa.binary())], names=["range", "shard", "answer"])


def _first_round(state: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """A shard's distinct whole symbols in order, and whether each occurs twice or more."""
    symbols, n = np.unique(state["symbols"][state["whole"]], return_counts=True)
    return symbols, n > 1


def _interleave(rows: pa.Table) -> pa.Table:
    """Round one in a range: which symbols occur twice or more in all shards together.

    Shards send the low half of a symbol, twice if they hold it twice: within a range that
    tells all but about one symbol in a thousand apart, and the next round compares all of it.
    """
    rows = rows.sort_by("shard")
    parts = [np.frombuffer(b, np.uint32) for b in rows["rows"].to_pylist()]
    values, back, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    live = (n > 1)[back]
    cuts = np.cumsum([0, *map(len, parts)])
    return _answered(rows, [np.packbits(live[lo:hi]).tobytes() for lo, hi in zip(cuts[:-1], cuts[1:])])


def _read(row: dict) -> dict:
    """Arrays of a shard row: for each anchor its text, place, gap, symbol, and if the symbol is whole."""
    counts = np.array(row["n_anchors"], np.int64)
    gaps = np.frombuffer(row["gaps"], np.uint8).astype(np.int64)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    run = np.cumsum(gaps)
    before = np.concatenate([[0], run])[first]
    at = run - before[text] - 1  # the first gap counts from -1
    size = np.array(row["sizes"], np.int64)[np.array(row["texts"], np.int64)] if len(counts) else np.zeros(0, np.int64)
    return {"text": text, "first": first, "at": at, "gap": gaps, "size": size,
            "symbols": np.frombuffer(row["symbols"], U), "whole": at + CONTEXT <= size[text]}


def _send_symbols(ranges: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                symbols, twice = _first_round(_read(row))
                low = (symbols & U(0xFFFFFFFF)).astype(np.uint32)
                out = [(r, row["shard"], np.repeat(low[s], 1 + twice[s]).tobytes()) for r, s in _split(symbols, ranges)]
                if out:
                    yield _sent(out)

    return run


BLOCKS = ("shard long, ids array<long>, sizes array<long>, digests array<binary>, texts array<int>, "
          "n_kept binary, at binary, gap binary, span binary, symbol binary, refined binary")


def _refine(ranges: int):
    """Round two in a shard: of the anchors in blocks of two or more, the refined symbols."""

    def fn(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        s = _read(row)
        symbols, twice = _first_round(s)
        live_symbol = np.zeros(len(symbols), bool)
        answers = dict(zip(right["range"].to_pylist(), right["answer"].to_pylist()))
        for r, part in _split(symbols, ranges):
            n = 1 + twice[part]
            ends = np.cumsum(n)
            live_symbol[part] = np.unpackbits(np.frombuffer(answers[r], np.uint8))[ends - 1].astype(bool)
        n_all = len(s["at"])
        live = np.zeros(n_all, bool)
        live[s["whole"]] = live_symbol[np.searchsorted(symbols, s["symbols"][s["whole"]])]
        # anchors up to WINDOW before a live one start strings that hold it: kept with it
        place = s["at"] + np.concatenate([[0], np.cumsum(s["size"] + LENGTH)])[s["text"]]  # texts far apart
        lit = place[live]
        ahead = np.searchsorted(lit, place)
        kept = np.zeros(n_all, bool)
        inside = ahead < len(lit)
        kept[inside] = lit[ahead[inside]] - place[inside] < WINDOW
        if n_all:
            # the next symbol: the first anchor at STEP or more in the same text
            nxt = np.searchsorted(place, place + STEP)
            same = nxt < n_all
            same[same] = s["text"][nxt[same]] == s["text"][same]
            nxt[~same] = 0
            tails = np.frombuffer(row["tails"], U)[s["text"]]
            heads = np.frombuffer(row["heads"], U)[s["text"]]
            step = np.where(same, s["at"][nxt] - s["at"], s["size"][s["text"]] - s["at"])
            after = np.where(same, s["symbols"][nxt], tails ^ _NO_STEP)
            end = np.where(same, np.minimum(s["at"][nxt] + CONTEXT, s["size"][s["text"]]), s["size"][s["text"]])
            start = np.zeros(n_all, bool)
            start[s["first"]] = True
            before = np.where(start, heads ^ _NO_LEFT, np.roll(s["symbols"], 1))
            refined = _mix(before, s["gap"], s["symbols"], step, after)
        else:
            end = refined = np.zeros(0, np.int64)
        dead = kept & ~live
        symbol = np.where(dead, U(0), s["symbols"])[kept]
        values = {"n_kept": np.bincount(s["text"][kept], minlength=len(s["first"])).astype(np.int32),
                  "at": s["at"][kept].astype(np.int32), "gap": s["gap"][kept].astype(np.uint8),
                  "span": (end - s["at"])[kept].astype(np.uint16), "symbol": symbol,
                  "refined": np.where(dead, U(0), refined)[kept].astype(U)}
        out = left.select(["shard", "ids", "sizes", "digests", "texts"])
        for name, v in values.items():
            out = out.append_column(name, pa.array([v.tobytes()], pa.binary()))
        return out

    return fn


def _kept(row: dict) -> dict:
    return {n: np.frombuffer(row[n], t) for n, t in (("n_kept", np.int32), ("at", np.int32), ("gap", np.uint8),
                                                      ("span", np.uint16), ("symbol", U), ("refined", U))}


def _blocks_of(k: dict):
    """A shard's refined blocks (refined symbol, symbol) and, by symbol, the least and greatest refined symbol."""
    live = np.flatnonzero(k["symbol"] != 0)
    refined, symbol, n, back = _sorted_pairs(k["refined"][live], k["symbol"][live])
    order = np.lexsort((refined, symbol))
    s, t = symbol[order], refined[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    starts = np.flatnonzero(new)
    lasts = np.append(starts[1:], len(s)) - 1
    return live, (refined, symbol, n, back), (s[starts], t[starts], t[lasts]) if len(s) else (s, t, t)


def _send_blocks(ranges: int):
    """Blocks to the ranges of their refined symbol, and symbols to further ranges of their own."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, (refined, symbol, n, _), (own, least, most) = _blocks_of(_kept(row))
                out = [(r, row["shard"], np.stack([refined[s], symbol[s], n[s].astype(U)], 1).tobytes())
                       for r, s in _split(refined, ranges)]
                out += [(ranges + r, row["shard"], np.stack([own[s], least[s], most[s]], 1).tobytes())
                        for r, s in _split(own, ranges)]
                if out:
                    yield _sent(out)

    return run


def _settle(ranges: int):
    """Round two in a range.

    Of a block: does it hold two or more suffixes, and is this shard its first.  Of a symbol:
    does its block fall apart.
    """

    def fn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard")
        parts = [np.frombuffer(b, U).reshape(-1, 3) for b in rows["rows"].to_pylist()]
        every = np.concatenate(parts)
        if rows["range"][0].as_py() < ranges:
            _, _, _, back = _sorted_pairs(every[:, 0], every[:, 1])
            total = np.bincount(back, every[:, 2].astype(np.float64))
            first = np.full(len(total), len(every), np.int64)
            np.minimum.at(first, back, np.arange(len(every)))
            bits = (total[back] > 1).astype(np.uint8) | ((first[back] == np.arange(len(every))).astype(np.uint8) << 1)
        else:
            _, back = np.unique(every[:, 0], return_inverse=True)
            least, most = np.full(back.max() + 1, ~U(0)), np.zeros(back.max() + 1, U)
            np.minimum.at(least, back, every[:, 1])
            np.maximum.at(most, back, every[:, 2])
            bits = (least != most)[back].astype(np.uint8)
        cuts = np.cumsum([0, *map(len, parts)])
        return _answered(rows, [bits[lo:hi].tobytes() for lo, hi in zip(cuts[:-1], cuts[1:])])

    return fn


FOUND = "id long, digest binary, size long, gone_from array<int>, gone_to array<int>, ask_from array<int>, ask_to array<int>"


def _intervals(ranges: int):
    """Per text: its repeated intervals, and starts of strings to compare around broken blocks."""

    def fn(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        k = _kept(row)
        live, (refined, _, _, back), (own, _, _) = _blocks_of(k)
        answers = dict(zip(right["range"].to_pylist(), right["answer"].to_pylist()))
        block, broken = np.zeros(len(refined), np.uint8), np.zeros(len(own), np.uint8)
        for r, s in _split(refined, ranges):
            block[s] = np.frombuffer(answers[r], np.uint8)
        for r, s in _split(own, ranges):
            broken[s] = np.frombuffer(answers[ranges + r], np.uint8)
        n = len(k["at"])
        at, low = k["at"].astype(np.int64), k["at"].astype(np.int64) - k["gap"]  # low: the anchor before, -1 for none
        text = np.repeat(np.arange(len(k["n_kept"])), k["n_kept"])
        size = np.array(row["sizes"], np.int64)[np.array(row["texts"], np.int64)] if len(k["n_kept"]) else np.zeros(0, np.int64)
        repeated, edge, chosen = np.zeros(n, bool), np.zeros(n, bool), np.ones(n, bool)
        repeated[live] = block[back] & 1
        # one suffix of a block speaks for it: the first of its first shard
        first = np.zeros(len(live), bool)
        first[np.unique(back, return_index=True)[1]] = True
        chosen[live] = first & (block[back] >> 1 == 1)
        edge[live] = broken[np.searchsorted(own, k["symbol"][live])] == 1
        place = at + np.concatenate([[0], np.cumsum(size + LENGTH)])[text]
        lit = place[edge]
        ahead = np.searchsorted(lit, place)
        ask = np.zeros(n, bool)
        inside = ahead < len(lit)
        ask[inside] = lit[ahead[inside]] - place[inside] < WINDOW
        ask &= chosen
        end = at + k["span"]
        gone = repeated & (end - np.maximum(low, 0) >= LENGTH)
        a, b = low + 1, np.minimum(at, size[text] - LENGTH) + 1
        ask &= a < b
        out = []
        bounds = np.concatenate([[0], np.cumsum(k["n_kept"])])
        for i, doc in enumerate(row["texts"]):
            s = slice(bounds[i], bounds[i + 1])
            g, q = gone[s], ask[s]
            if g.any() or q.any():
                lo, hi = _union(np.maximum(low[s][g], 0), end[s][g])
                out.append((row["ids"][doc], row["digests"][doc], row["sizes"][doc],
                            *[v.tolist() for v in (lo, hi, a[s][q], b[s][q])]))
        kinds = (pa.int64(), pa.binary(), pa.int64(), *[pa.list_(pa.int32())] * 4)
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table([pa.array([o[j] for o in out], t) for j, t in enumerate(kinds)], names=names)

    return fn


def _union(lo: np.ndarray, hi: np.ndarray):
    """Intervals joined where they touch or overlap."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    starts = np.flatnonzero(new)
    return lo[starts], hi[np.append(starts[1:], len(lo)) - 1]


def _hashes(text: bytes, lo, hi) -> list[tuple[int, bytes]]:
    """(start, 128-bit hash) of the strings that start in the given ranges."""
    from xxhash import xxh3_128_digest as xxh

    return [(s, xxh(text[s:s + LENGTH])) for a, b in zip(lo, hi) for s in range(a, b)]


def _send_strings(ranges: int):
    def run(batches):
        for batch in batches:
            found: dict[int, list[bytes]] = {}
            for row in batch.to_pylist():
                found.setdefault(row["shard"], []).extend(
                    h for _, h in _hashes(row["text"], row["ask_from"], row["ask_to"]))
            out = []
            for shard, hs in found.items():
                if hs:
                    h = np.frombuffer(b"".join(hs), U).reshape(-1, 2)
                    a, b, n, _ = _sorted_pairs(h[:, 0], h[:, 1])
                    twice = 1 + (n > 1)  # a string that a shard holds more often goes twice
                    out += [(r, shard, np.repeat(np.stack([a[s], b[s]], 1), twice[s], 0).tobytes())
                            for r, s in _split(a, ranges)]
            if out:
                yield _sent(out)

    return run


def _repeated_strings(rows: pa.Table) -> pa.Table:
    """To each shard the hashes that it sent and that occur twice or more."""
    rows = rows.sort_by("shard")
    parts = [np.frombuffer(b, U).reshape(-1, 2) for b in rows["rows"].to_pylist()]
    every = np.concatenate(parts)
    _, _, n, back = _sorted_pairs(every[:, 0], every[:, 1])
    again = n[back] > 1
    cuts = np.cumsum([0, *map(len, parts)])
    return _answered(rows, [np.unique(p[again[lo:hi]], axis=0).tobytes()
                            for p, lo, hi in zip(parts, cuts[:-1], cuts[1:])])


CUT = "id long, digest binary, gone_from array<int>, gone_to array<int>, kept binary"


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    """The texts of a shard without their repeated bytes."""
    again = {blob[i:i + 16] for blob in right["answer"].to_pylist() for i in range(0, len(blob), 16)}
    out = []
    for row in left.to_pylist():
        text = row["text"]
        more = np.array([s for s, h in _hashes(text, row["ask_from"], row["ask_to"]) if h in again], np.int64)
        lo, hi = _union(np.concatenate([np.array(row["gone_from"], np.int64), more]),
                        np.concatenate([np.array(row["gone_to"], np.int64), more + LENGTH]))
        if len(lo):
            kept = b"".join(text[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(text)]))
            out.append((row["id"], row["digest"], lo.tolist(), hi.tolist(), kept))
    kinds = (pa.int64(), pa.binary(), *[pa.list_(pa.int32())] * 2, pa.binary())
    return pa.table([pa.array([o[j] for o in out], t) for j, t in enumerate(kinds)], names=[c.split()[0] for c in CUT.split(", ")])


def _with_shard(shard_bytes: int):
    """Rows with a shard number, a new one after every ``shard_bytes`` of text."""

    def run(batches):
        shard, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield part.append_column("shard", pa.array([shard] * part.num_rows, pa.int64()))
                size += part.nbytes
                if size >= shard_bytes:
                    shard, size = shard + 1, 0

    return run


def _ranges(spark: SparkSession, rows: int) -> int:
    return max(slots(spark), -(-rows // RANGE_ROWS))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Every text without the bytes of strings of ``LENGTH`` bytes that also start elsewhere.

    Two tables: every row of ``docs`` as (id, digest, size), digest being the SHA-256 of its
    bytes; and for each (id, digest) that loses bytes (gone_from, gone_to) intervals and the
    bytes ``kept``.  Texts are whole and taken as UTF-8 bytes; null counts as empty; repeated
    rows, ids or texts are documents of their own, so all but texts shorter than ``LENGTH``
    lose everything; matches end where a text ends; an empty table gives none.
    """
    spark = docs.sparkSession
    src = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"),
                                                      F.col("text").cast("binary").alias("text"))
    shards = staged(map_arrow(src, _shards(shard_bytes), SHARD), "suffix-shards")
    total = shards.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    n = _ranges(spark, total)
    suffixes = shards.filter("total > 0")
    first = (map_arrow(suffixes.select("shard", "sizes", "texts", "n_anchors", "gaps", "symbols"), _send_symbols(n), SENT)
             .groupBy("range").applyInArrow(_interleave, ANSWER))
    blocks = staged(suffixes.drop("total").groupBy("shard").cogroup(first.groupBy("shard"))
                    .applyInArrow(_refine(n), BLOCKS), "suffix-blocks")
    kept = blocks.agg(F.coalesce(F.sum(F.length("gap")), F.lit(0))).first()[0]
    n = _ranges(spark, kept)
    second = (map_arrow(blocks.select("shard", "n_kept", "at", "gap", "span", "symbol", "refined"), _send_blocks(n), SENT)
              .groupBy("range").applyInArrow(_settle(n), ANSWER))
    found = staged(blocks.groupBy("shard").cogroup(second.groupBy("shard")).applyInArrow(_intervals(n), FOUND), "suffix-found")
    # rows alike in id and text share one entry; only texts that keep a part or speak for others are read again
    one = found.groupBy("id", "digest").agg(
        F.first("size").alias("size"), F.max_by("gone_from", F.size("gone_from")).alias("gone_from"),
        F.max_by("gone_to", F.size("gone_to")).alias("gone_to"),
        *[F.flatten(F.collect_list(F.when(F.size("ask_from") > 0, F.col(c)))).alias(c) for c in ("ask_from", "ask_to")])
    none = (F.size("ask_from") == 0) & (F.size("gone_from") == 1) & (F.col("gone_to")[0] - F.col("gone_from")[0] == F.col("size"))
    empty = one.filter(none).select("id", "digest", "gone_from", "gone_to", F.lit(b"").alias("kept"))
    again = src.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumnRenamed("id", "_id").withColumnRenamed("digest", "_digest")
    part = one.filter(~none).drop("size")
    touched = again.join(part, (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("id"))).drop("_id", "_digest")
    names = ["id", "digest", "text", "gone_from", "gone_to", "ask_from", "ask_to"]
    schema = ("id long, digest binary, text binary, gone_from array<int>, gone_to array<int>, "
              "ask_from array<int>, ask_to array<int>, shard long")
    touched = staged(map_arrow(touched.select(*names), _with_shard(shard_bytes), schema), "suffix-texts")
    asked = touched.agg(F.coalesce(F.sum(F.aggregate(F.zip_with("ask_from", "ask_to", lambda a, b: (b - a).cast("long")),
                                                     F.lit(0).cast("long"), lambda x, y: x + y)), F.lit(0))).first()[0]
    strings = (map_arrow(touched.select("shard", "text", "ask_from", "ask_to"), _send_strings(_ranges(spark, asked)), SENT)
               .groupBy("range").applyInArrow(_repeated_strings, ANSWER))
    cut = touched.groupBy("shard").cogroup(strings.groupBy("shard")).applyInArrow(_cut, CUT)
    lost = cut.dropDuplicates(["id", "digest"]).unionByName(empty)
    rows = shards.select(F.explode(F.arrays_zip("ids", "sizes", "digests")).alias("r")).select(
        F.col("r.ids").alias("id"), F.col("r.digests").alias("digest"), F.col("r.sizes").alias("size"))
    return rows, lost


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op12: the whole ``documents`` table without repeated strings of 200 bytes."""
    rows, lost = repeated(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("gone_from", "gone_to", lambda a, b: (b - a).cast("long")),
                          F.lit(0).cast("long"), lambda x, y: x + y)
    lost = lost.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), removed.alias("n_removed"),
                       F.size("gone_from").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    out = rows.join(lost, (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    return out.select(F.col("id").alias("doc_id"), F.col("size").alias("n_bytes"),
                      F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                      F.coalesce("kept_sha256", F.lower(F.hex("digest"))).alias("kept_sha256"))
