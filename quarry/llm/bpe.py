"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by concatenation."""

from __future__ import annotations

import base64
import hashlib
import json
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import appended, pick, table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
NO_RANK = 2**31 - 1
BUCKETS = 2**16
CACHE_WORDS = 200_000  # twice as many are held, about 80 MB in a worker


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line of base64 piece and rank each."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# --- the fold in SQL functions, for a column of words -------------------------------------------

def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of small maps, dealt by a hash of the piece.

    A piece is spelled with a character from 0 to 255 for each byte.  A plain map literal would
    be searched from its start at every look-up; a bucket holds one or two pieces.
    """
    from xxhash import xxh64_intdigest

    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        spelled = piece.decode("latin-1")
        buckets[xxh64_intdigest(spelled.encode(), 42) % BUCKETS][spelled] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def rank_of(literal: Column, piece: Column) -> Column:
    # the low bits of a signed and an unsigned hash agree
    return F.try_element_at(F.get(literal, F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")), piece)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged_pieces(word: Column, literal: Column) -> Column:
    """array<string>: the pieces of a word's bytes after all merges, lowest rank first, leftmost of equals."""
    spelled = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    single = F.transform(F.sequence(F.lit(1), F.length(spelled)), lambda i: F.substring(spelled, i, F.lit(1)))

    def once(parts, _):
        n = F.size(parts)
        pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.coalesce(
            rank_of(literal, F.concat(F.get(parts, i - 1), F.get(parts, i))), F.lit(NO_RANK)))

        def merge(ranks):
            at = F.array_position(ranks, F.array_min(ranks)).cast("int")
            return F.when(F.array_min(ranks) == NO_RANK, parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                F.slice(parts, at + 2, n)))

        return F.when(n < 2, parts).otherwise(_let(pairs, merge))

    return F.when(rank_of(literal, spelled).isNotNull(), F.array(spelled)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.length(spelled)), single, once))


def word_ids(words: DataFrame, ranks: dict[bytes, int], col: str = "word") -> DataFrame:
    """(word, ids): each distinct non-empty word once, with its token ids."""
    literal = rank_literal(ranks)
    return (words.select(F.col(col).alias("word")).filter("word <> ''").distinct()
            .withColumn("ids", F.transform(merged_pieces(F.col("word"), literal), lambda p: rank_of(literal, p))))


# --- whole texts -------------------------------------------------------------------------------

class Merges:
    """The ranks as a table of pairs of ids: (left << 32 | right) -> id of the merged piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [ranks[bytes([c])] for c in range(256)]
        self.pairs = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank


def fold(word: bytes, merges: Merges) -> list[int]:
    """Token ids of one word: the adjacent pair of lowest rank is merged (leftmost of equals) until none has a rank."""
    whole = merges.ranks.get(word)
    if whole is not None:
        return [whole]
    single, get = merges.single, merges.pairs.get
    parts = [single[c] for c in word]
    pairs = [get(a << 32 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == NO_RANK:
            break
        i = pairs.index(low)
        parts[i:i + 2] = (low,)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(low << 32 | parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = get(parts[i - 1] << 32 | low, NO_RANK)
    return parts


def fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long run of bytes, with a heap of pairs: n log n instead of n squared."""
    from heapq import heapify, heappop, heappush

    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0: merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        if not end[i] or end[i] >= n or end[end[i]] != stop:
            continue  # one of the two parts has changed since
        j = end[i]
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        h = before[i]
        if h >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class WordIds(dict):
    """Ids of distinct words as int32 bytes; the words met since before last time ``limit`` was reached are remembered."""

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE_WORDS):
        super().__init__()
        self.merges, self.limit, self.older = Merges(ranks), limit, {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            coded = word.encode("utf-8", "replace")
            ids = fold(coded, self.merges) if len(coded) <= 64 else fold_long(coded, self.merges.ranks)
            out = array("i", ids).tobytes()
            if len(coded) > 64:
                return out
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


# kept by a Python worker from task to task, by rank file
REMEMBERED: dict[str, WordIds] = {}


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with ``out_col``, array<int>: the ids of the whole text (null: of the empty one), no special tokens.

    Each match of ``pattern`` is merged separately.  Every distinct word is folded once by a
    worker while it is remembered; a match longer than 64 bytes is folded by a heap.
    ``rank_path`` is read where the query is planned and sent to the tasks.
    """
    ranks = read_ranks(rank_path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def setup():
        import regex

        find = regex.compile(pattern).findall
        known = REMEMBERED[key] if key in REMEMBERED else REMEMBERED.setdefault(key, WordIds(ranks))

        def of(texts):
            coded = [b"".join(map(known.__getitem__, find(t))) if t else b"" for t in texts.to_pylist()]
            ends = np.cumsum([0] + [len(c) // 4 for c in coded]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))]

        return of

    return appended(docs, text_col, [(out_col, "array<int>")], setup)


def decode(docs: DataFrame, rank_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col``, binary: the pieces of the ids, one after the other (null ids: empty)."""
    ranks = read_ranks(rank_path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece

    def setup():
        size = np.array([len(p) for p in pieces], np.int64)
        start = np.cumsum(size) - size
        store = np.frombuffer(b"".join(pieces), np.uint8)

        def one(ids: np.ndarray) -> bytes:
            out = []
            for lo in range(0, len(ids), 65_536):
                part = ids[lo:lo + 65_536]
                n = size[part]
                shift = start[part] - (np.cumsum(n) - n)
                out.append(store[np.repeat(shift, n) + np.arange(n.sum())].tobytes())
            return b"".join(out)

        def of(lists):
            values = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            return [pa.array([one(values[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())]

        return of

    return appended(docs, ids_col, [(out_col, "binary")], setup)


def with_digests(docs: DataFrame) -> DataFrame:
    """``docs`` (ids, decoded) with n_tokens and the SHA-256 of the ids, comma-joined, and of the decoded bytes."""
    return docs.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
        "decoded_sha256": F.sha2("decoded", 256)})


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op2: every whole text of ``documents`` encoded, and the ids decoded again."""
    import public_tokenizers

    path = public_tokenizers.path(RANK_FILE)
    coded = encode(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"), path, public_tokenizers.PATTERN)
    return with_digests(decode(coded.select("doc_id", "ids"), path)).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
