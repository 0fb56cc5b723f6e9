"""Packing token pieces into sequences by linear grouping, and best fit for the small ones.

The plan is made on the driver from the histogram of lengths alone, which has at most ``capacity``
entries however many documents there are; ranks of equally long pieces then look up their places.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.llm.common import frugal, portions, ranked, stage, table

CAPACITY = 4096
#: The id that ends a document.
END_ID = 1
#: Groups of equal cardinality that large lengths are rounded up in.
GROUPS = 128
#: Lengths up to capacity // SMALL are small: they go into what the large ones leave. A configuration has fewer than SMALL large ones.
SMALL = 4
#: Characters of texts that are tokenised together, and bytes of tokens with their ids that a task remembers; beyond, it starts again.
AT_ONCE = 1 << 21
REMEMBERED = 48 << 20
#: About the bytes that a remembered token takes besides its letters and ids.
ENTRY = 200


def _class(major: str) -> str:
    """A class for patterns of the letters of the tables below U+0180 that are of a major Unicode category."""
    return "".join(re.escape(c) for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x180)]) if c != "\u0130" and unicodedata.category(c)[0] == major)


#: The tokenizer's own pattern of what it takes apart before merging (a fixed value): for any text, and for Latin letters.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
LATIN_TOKEN = re.compile(rf"[{_class('L')}]+|'(?:s|t|re|ve|m|ll|d)|[{_class('N')}]|[^\s{_class('L')}{_class('N')}]+").findall
#: Texts of these letters are in composed form and have one lower case in every library.
FOREIGN = re.compile("[^\x09-\x0d\x20-\x7e\xa1-\u012f\u0131-\u017f]").search
CONTROL = re.compile("[\x1c-\x1f]").search
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    """The file of the public 49k word tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it prints, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class PairMerges:
    """Byte pair merges of a tokenizer file, done for many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[letters[b] + end] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[x] << 32 | vocab[y] for x, y in pairs], np.int64)
        self.made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        # pairs by hash, in the first free place from theirs on; ranks one past the last mean none
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, len(keys), np.int64)
        todo, at = np.arange(len(keys)), self.place(keys)
        while len(todo):
            free = self.keys[at] < 0
            self.keys[at[free]], self.rank[at[free]] = keys[todo[free]], todo[free]
            lost = self.keys[at] != keys[todo]
            todo, at = todo[lost], (at[lost] + 1) & (len(self.keys) - 1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or the number of merges."""
        at = self.place(keys)
        out, seen = self.rank[at], self.keys[at]
        todo = np.flatnonzero((seen != keys) & (seen >= 0))
        at = at[todo]
        out[todo] = len(self.made)
        while len(todo):
            at = (at + 1) & (len(self.keys) - 1)
            seen = self.keys[at]
            hit = seen == keys[todo]
            out[todo[hit]] = self.rank[at[hit]]
            more = ~hit & (seen >= 0)
            todo, at = todo[more], at[more]
        return out

    def __call__(self, tokens: list[bytes]) -> list[bytes]:
        """The ids of each non-empty token, as little-endian bytes."""
        lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        sym, word = self.inner[raw], np.repeat(np.arange(len(tokens)), lens)
        last = np.cumsum(lens) - 1
        sym[last] = self.final[raw[last]]
        none = len(self.made)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            key = sym[:-1] << 32 | sym[1:]
            rank = np.append(np.where(word[:-1] == word[1:], self.ranks(key), none), none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
            going = best < none
            done.append((word[~going], sym[~going]))
            place = np.flatnonzero((rank == best) & going)
            if not len(place):
                break
            # of pairs that overlap, as in a run of one letter, every other one from the left
            run = np.append(True, np.diff(place) != 1)
            first = place[np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))]
            place = place[(place - first) % 2 == 0]
            sym[place] = self.made[rank[place]]
            keep = going.copy()
            keep[place + 1] = False
            sym, word = sym[keep], word[keep]
        word, sym = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        data = sym[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(tokens)))).tolist()
        return [data[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]


@lru_cache(maxsize=2)
def pair_merges(path: str) -> PairMerges:
    """The merges of a tokenizer file, kept by the worker: arrays of some two megabytes."""
    return PairMerges(path)


class TextIds:
    """Ids of texts, by way of their pre-tokens in lower case; what a task has merged it remembers, up to REMEMBERED bytes.

    The tokenizer drops white space and never merges over it, so a text's ids are those of its
    pre-tokens. Words with other than Latin letters go through the library one by one, and texts
    with the tokenizer's special tokens, or with control characters that Python alone takes for
    white space, go through it whole.
    """

    def __init__(self, path: str):
        self.path, self.merges = path, pair_merges(path)
        self.tokens: dict[str, bytes] = {}
        self.held = 0
        self.library = None

    def whole(self, text: str) -> bytes:
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, tokens: set[str]) -> None:
        if self.held > REMEMBERED:
            self.tokens, self.held = {}, 0
        if fresh := list(tokens.difference(self.tokens)):
            ids = self.merges([t.encode() for t in fresh])
            self.tokens.update(zip(fresh, ids, strict=True))
            self.held += sum(map(len, fresh)) + sum(map(len, ids)) + ENTRY * len(fresh)

    def foreign(self, text: str) -> list[str | bytes]:
        """Pre-tokens of the Latin words, and the ids of the others."""
        out: list[str | bytes] = []
        for w in text.split():
            out += [self.whole(w)] if FOREIGN(w) else LATIN_TOKEN(w.lower())
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        split: list[list] = []
        plain: set[str] = set()
        for t in texts:
            if "<|" in t or CONTROL(t):
                split.append([self.whole(t)])
            elif FOREIGN(t):
                split.append(self.foreign(t))
                plain.update(x for x in split[-1] if isinstance(x, str))
            else:
                split.append(LATIN_TOKEN(t.lower()))
                plain.update(split[-1])
        self.learn(plain)
        get = self.tokens.__getitem__
        try:
            return [b"".join(map(get, s)) for s in split]
        except KeyError:
            return [b"".join(x if isinstance(x, bytes) else get(x) for x in s) for s in split]


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """piece, start, length and CRC of the pieces of a document's ids."""
    step = 4 * capacity
    for k, at in enumerate(range(0, len(ids), step)):
        part = ids[at : at + step]
        yield k, at // 4, len(part) // 4, zlib.crc32(part)


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces of at most ``capacity`` ids.

    A null text is empty: its document is the end id alone. Equal rows give pieces of their own.
    """
    end = int(end_id).to_bytes(4, "little")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TextIds(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                some = b.slice(at, 1024)
                docs_, texts = some.column(0).to_pylist(), [t or "" for t in some.column(1).to_pylist()]
                k = 0
                for n in portions(map(len, texts), AT_ONCE):
                    rows = [(d, *p) for d, ids in zip(docs_[k : k + n], tokens.ids(texts[k : k + n]), strict=True) for p in cut(ids + end, capacity)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                    k += n

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), PIECES)


class Plan:
    """Where ranks of equally long pieces go: rank lo + i of ``length`` to sequence ``first`` + i at ``offset``."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int]] = []  # length, lo, first, offset
        self.sequences = 0
        self.taken: dict[int, int] = {}  # ranks of a length that have a place
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: first sequence, count

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def put(self, length: int, n: int, first: int, offset: int) -> None:
        """The next n pieces of a length, one into each of n sequences."""
        lo = self.taken.get(length, 0)
        self.rows.append((length, lo, first, offset))
        self.taken[length] = lo + n

    def leave(self, first: int, n: int, used: int) -> None:
        if used < self.capacity:
            self.room[self.capacity - used].append((first, n))


def linear_groups(counts: dict[int, int], groups: int) -> dict[int, deque]:
    """Lengths, largest first, cut into groups of equal cardinality: the rounded length of each, and its actual runs [length, count].

    Groups of one rounded length are one.
    """
    total = sum(counts.values())
    size = max(1, -(-total // groups))
    out: dict[int, deque] = {}
    left = 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not left:
                top, left = length, size
            k = min(n, left)
            out.setdefault(top, deque()).append([length, k])
            n, left = n - k, left - k
    return out


def dearest(sizes: np.ndarray, price: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """The numbers of the at most ``most`` sizes that fit the capacity and have the largest sum of prices: a knapsack by dynamic programming."""
    tables = [np.zeros(capacity + 1)]
    for _ in range(most - 1):
        low = tables[-1]
        up = low.copy()
        for s, p in zip(sizes.tolist(), price.tolist(), strict=True):
            if p > 0:
                np.maximum(up[s:], low[: capacity + 1 - s] + p, out=up[s:])
        tables.append(up)
    used, room = [], capacity
    for k in range(most - 1, -1, -1):
        value = np.where(sizes <= room, price + tables[k][room - np.minimum(sizes, room)], -1.0)
        i = int(np.argmax(value))
        if value[i] <= (tables[k][room] if k else 0.0) + 1e-12:
            continue  # one size less is worth as much
        used.append(i)
        room -= int(sizes[i])
    return np.array(used, np.int64)


def inverted(a: np.ndarray) -> np.ndarray:
    """The inverse, by elimination with the largest pivots. (The library's own starts threads, which a driver that has forked may wait for without end.)"""
    n = len(a)
    x = np.hstack([a, np.eye(n)])
    for k in range(n):
        p = k + int(np.argmax(np.abs(x[k:, k])))
        x[[k, p]] = x[[p, k]]
        x[k] /= x[k, k]
        rest = x[:, k].copy()
        rest[k] = 0.0
        x -= np.outer(rest, x[k])
    return x[:, n:]


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, most: int, gap: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (columns of how often each size is in one) and how often to use each, for the fewest sequences in fractions.

    The linear program is solved by column generation: the simplex method over a basis of as many
    configurations as there are sizes, and the knapsack prices for the next one. It ends when no
    configuration is worth more than a sequence, or Farley's bound shows the sum to be within ``gap``
    of the least; a hundred steps a size are never needed but bound the work.
    """
    n = len(sizes)
    start = np.minimum(capacity // sizes, most).astype(float)
    basis, inverse = np.diag(start), np.diag(1 / start)
    x = (demand + 1e-5 * np.arange(1, n + 1)) / start  # apart, so that no two steps tie for ever
    for step in range(100 * n):
        price = inverse.sum(axis=0)
        used = dearest(sizes, price, capacity, most)
        column = np.bincount(used, minlength=n).astype(float)
        worth = price @ column
        if worth <= 1 + 1e-9 or x.sum() * (1 - 1 / worth) <= gap * x.sum():
            break
        way = (inverse * column).sum(axis=1)
        ratio = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1.0), np.inf)
        out = int(np.argmin(ratio))
        x = np.maximum(x - ratio[out] * way, 0.0)
        x[out] = ratio[out]
        basis[:, out] = column
        if step % 200 == 199:
            inverse = inverted(basis)
        else:
            row = inverse[out] / way[out]
            inverse = inverse - np.outer(way, row)
            inverse[out] = row
    return basis.astype(np.int64), x


def pack_large(plan: Plan, counts: dict[int, int], groups: int, most: int) -> dict[int, int]:
    """Configurations of rounded lengths, as often as the linear program says in whole numbers, with actual pieces put in.

    Returns what is left: pieces that the program leaves alone in a sequence, where their actual
    length may find a room that the rounded one does not, and what whole numbers leave over.
    """
    made = linear_groups(counts, groups)
    if not made:
        return {}
    sizes, runs = np.array(list(made), np.int64), list(made.values())
    left = np.array([sum(k for _, k in r) for r in runs], np.int64)
    columns, x = configurations(sizes, left.astype(float), plan.capacity, most)
    whole = np.floor(x + 1e-6).astype(np.int64)
    order = np.argsort(whole - x, kind="stable")  # the largest fractions are rounded up first, as far as pieces are left
    for extra, j in [*((0, j) for j in range(len(x))), *((1, j) for j in order.tolist() if x[j] - whole[j] > 0.5)]:
        need = columns[:, j]
        if need.sum() < 3:
            continue
        some = np.flatnonzero(need)
        times = int(min(extra or whole[j], (left[some] // need[some]).min()))
        left[some] -= need[some] * times
        slots = [i for i in some.tolist() for _ in range(int(need[i]))]
        while times:
            n = times
            for i in some.tolist():  # as many sequences as the runs in front fill alike
                front, k = runs[i][0][1], int(need[i])
                n = min(n, front // k if front >= k else 1)
            first, used = plan.new(n), 0
            for i in slots:
                length, k = runs[i][0]
                n_here = min(n, k)
                plan.put(length, n_here, first, used)
                runs[i][0][1] -= n_here
                if k == n_here:
                    runs[i].popleft()
                used += length
            plan.leave(first, n, used)
            times -= n
    rest: dict[int, int] = {}
    for length, k in (r for run in runs for r in run):
        rest[length] = rest.get(length, 0) + k
    return rest


def pack_small(plan: Plan, counts: dict[int, int]) -> None:
    """What is left of the large lengths and the small ones, largest first, into the least room that holds it, else into new sequences."""
    for length in sorted(counts, reverse=True):
        n, room = counts[length], length
        while n:
            while room <= plan.capacity and not plan.room[room]:
                room += 1
            if room > plan.capacity:
                first = plan.new(m := -(-n // (plan.capacity // length)))
                plan.room[plan.capacity].append((first, m))
                room = plan.capacity
            first, m = plan.room[room].pop()
            k = min(n, m)
            plan.put(length, k, first, plan.capacity - room)
            if k < m:
                plan.room[room].append((first + k, m - k))
            rest = room - length
            if rest:
                plan.room[rest].append((first, k))
            n -= k
            if rest >= length:
                room = min(room, rest)


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> Plan:
    """A place for every piece counted in ``histogram`` (length to number)."""
    plan = Plan(capacity)
    limit = capacity // small
    rest = pack_large(plan, {k: n for k, n in histogram.items() if k > limit and n}, groups, small - 1)
    pack_small(plan, rest | {k: n for k, n in histogram.items() if k <= limit and n})
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """Add sequence_id and offset to pieces of 1 to ``capacity`` ids (doc_id, piece, start, length, ids_crc32).

    The histogram (at most ``capacity`` rows) comes to the driver; the plan, whose size follows the
    number of different lengths, is sent to the workers. Equal pieces get places of their own. An
    empty table gives an empty result.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = make_plan(histogram, capacity, groups, small)
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 4)
    shared = pieces.sparkSession.sparkContext.broadcast((rows[:, 0] << 40 | rows[:, 1], rows[:, 1], rows[:, 2], rows[:, 3]))
    placed = ranked(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "__rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lo, first, offset = shared.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("__rank").to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(first[at] + rank - lo[at]), pa.array(offset[at])], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return placed.mapInArrow(frugal(run), PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and the place there."""
    return pack(stage(tokenize_pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces"), capacity)


def op9_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 ids."""
    return pack_documents(table(spark, sf_dir, "documents"))
